"""Size estimate and readability of sources, without reading their rows."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.sources.manifest import parquet_footers
from paperloom.sources.scan import scan_parquet


def estimate_size(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """One row: files, rows, compressed and estimated in-memory gigabytes.

    `estimated_memory_gb` extrapolates the bytes per row of the first file in path order;
    `uncompressed_gb` is the exact sum over all footers.
    """
    gib = F.lit(1024.0**3)
    footers = parquet_footers(spark, path, pattern)
    totals = footers.agg(
        F.count(F.lit(1)).alias("n_files"),
        F.sum("rows").alias("total_rows"),
        F.sum("compressed").alias("compressed"),
        F.sum("uncompressed").alias("uncompressed"),
        F.min_by(F.struct("rows", "uncompressed"), "path").alias("sample"),
    )
    per_row = F.coalesce(
        F.try_divide(F.col("sample.uncompressed"), F.col("sample.rows")), F.lit(0.0)
    )
    estimate = totals.select(
        "n_files",
        "total_rows",
        F.round(F.col("compressed") / gib, 2).alias("compressed_gb"),
        F.round(F.col("total_rows") * per_row / gib, 1).alias("estimated_memory_gb"),
        F.round(F.col("uncompressed") / gib, 2).alias("uncompressed_gb"),
    )
    # An empty folder is an error, not an estimate of zero.
    checked = F.when(
        F.col("n_files") == 0, F.raise_error(F.lit(f"no Parquet files below {path}")).cast("bigint")
    ).otherwise(F.col("n_files"))
    return estimate.withColumn("n_files", checked)


def source_probe(spark: SparkSession, sources: dict[str, str]) -> DataFrame:
    """(source, readable, message) per source: can at least one row be read?

    `sources` maps names to paths of trees of any depth. Each is probed by itself, at most one
    row being read, so whatever fails about one says nothing about the others.
    """
    found = []
    for name, path in sources.items():
        try:
            # The scan stays unpruned: a row counts as readable if all of it can be read.
            some = scan_parquet(spark, path).limit(1).collect()
            found.append((name, bool(some), "ok" if some else "no rows"))
        except Exception as error:
            reason = error.getCondition() if isinstance(error, PySparkException) else None
            found.append((name, False, reason or str(error).strip().split("\n")[0]))
    return spark.createDataFrame(found, "source string, readable boolean, message string")


def all_readable(probe: DataFrame) -> DataFrame:
    """One row: are all probed sources readable?"""
    return probe.agg(F.bool_and("readable").alias("ready"))
