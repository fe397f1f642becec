"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Adaptive execution sizes partitions at run time and may hash a measured small side instead
# of sorting both. Bloom filters cover key sets that are too large to broadcast. A few
# concurrent writers per task spare partitioned writes a sort of whole rows. The rest keeps
# results independent of the machine.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "256MB",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1GB",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "40000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "536870912",
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def build_session(
    app: str = "paperloom", master: str | None = None, settings: dict[str, str] | None = None
) -> SparkSession:
    """A session with the settings above; entries of `settings` win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: `spark.checkpoint.dir`.

    Unset, it is a temporary folder where driver and executors are one process, and an error on
    a cluster, whose machines would each write to a disk of their own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="paperloom-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured.rstrip("/")
