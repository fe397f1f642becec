"""Run log: what each job did, and the most recent runs."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.schemas import RUN_LOG, struct_of


def run_record(stats: DataFrame, job: str, **facts) -> DataFrame:
    """One log row from a one-row `stats` frame (any of the log's columns) and known facts."""
    known = {"run_id": time.time_ns() // 1000, "job": job, **facts}
    columns = []
    for field in struct_of(RUN_LOG).fields:
        if field.name in known:
            value = F.lit(known[field.name])
        elif field.name == "recorded_at":
            value = F.current_timestamp()
        elif field.name in stats.columns:
            value = F.col(field.name)
        else:
            value = F.lit(None)
        columns.append(value.cast(field.dataType).alias(field.name))
    return stats.select(*columns)


def append_run(log: str, stats: DataFrame, job: str, **facts) -> None:
    """Append one record to the run log at path `log`."""
    run_record(stats, job, **facts).coalesce(1).write.mode("append").parquet(log)


def append_runs(spark: SparkSession, log: str, runs: Sequence[Mapping]) -> None:
    """Append several records of known facts, in their order, as one file."""
    first = time.time_ns() // 1000
    one = spark.range(1, numPartitions=1)
    records = [run_record(one, **{"run_id": first + i, **facts}) for i, facts in enumerate(runs)]
    reduce(DataFrame.unionAll, records).coalesce(1).write.mode("append").parquet(log)


def run_log(spark: SparkSession, log: str) -> DataFrame:
    return spark.read.schema(struct_of(RUN_LOG)).parquet(log)


def recent_runs(spark: SparkSession, log: str, n: int = 20) -> DataFrame:
    """The `n` latest runs, newest first."""
    return run_log(spark, log).orderBy(F.desc("run_id")).limit(n)


def latest_path(spark: SparkSession, log: str, job: str) -> str | None:
    """Where the latest run of `job` wrote its table, if there is a log and such a run."""
    try:
        runs = run_log(spark, log)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    last = (
        runs.filter((F.col("job") == job) & F.col("path").isNotNull())
        .orderBy(F.desc("run_id"))
        .select("path")
        .first()
    )
    return last["path"] if last else None
