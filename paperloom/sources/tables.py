"""Written tables: partitioned loads, full refreshes and outputs made once."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.sources.scan import year_filter


def write_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Overwrite `path`, one folder per value of `partition_by`.

    The rebalance hint brings the rows of a value together so that each folder gets few
    files, and lets adaptive execution cut a value with very many rows into several tasks of
    the advisory size. Unpartitioned tables are written without a shuffle.
    """
    if partition_by is None:
        df.write.mode("overwrite").parquet(path)
        return
    balanced = df.hint("rebalance", F.col(partition_by))
    balanced.write.mode("overwrite").partitionBy(partition_by).parquet(path)


def load_stats(table: DataFrame, year_column: str | None = None) -> DataFrame:
    """One row: rows and, with a year column, its distinct count and range."""
    total = F.count(F.lit(1)).alias("total_rows")
    if year_column is None:
        return table.agg(total)
    # Counted per year first, so the distinct count needs no second shuffle of rows.
    per_year = table.groupBy(F.col(year_column).alias("y")).agg(total)
    return per_year.agg(
        F.coalesce(F.sum("total_rows"), F.lit(0)).alias("total_rows"),
        F.count("y").alias("distinct_years"),
        F.min("y").alias("min_year"),
        F.max("y").alias("max_year"),
    )


def load_table(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    year_column: str | None = None,
    test_year: int | None = None,
    bounds: tuple[int, int] = (1900, 2026),
) -> DataFrame:
    """Write `df` to `path` and return the statistics of what was written.

    With a year column (`partition_by` unless given) only rows inside `bounds` are kept, or
    only `test_year`. Without one all rows are kept.
    """
    year_column = year_column or partition_by
    if year_column:
        df = year_filter(df, year_column, test_year, bounds)
    write_table(df, path, partition_by)
    return load_stats(read_back(df, path), year_column)


def read_back(df: DataFrame, path: str) -> DataFrame:
    """The table written from `df` at `path`, with the columns and types of `df`."""
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def rebuild_table(
    df: DataFrame, root: str, view: str, partition_by: str | None = None
) -> tuple[DataFrame, str]:
    """Full refresh: write a new version below `root`, then point `view` at it.

    The old version stays in place, so `df` may read it and a failed run changes nothing.
    """
    path = f"{root.rstrip('/')}/version-{uuid.uuid4().hex}"
    write_table(df, path, partition_by)
    table = read_back(df, path)
    table.createOrReplaceTempView(view)
    return table, path


def table_at(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at `path`, or None if there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def current_version(spark: SparkSession, root: str) -> str | None:
    """Folder of the newest complete version below `root`.

    A version is complete with the marker that Spark's committer writes last, as one step. What a
    killed write left behind has none and does not count. Names of versions sort by their time.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    marks = hadoop.Path(f"{root.rstrip('/')}/version-*/_SUCCESS")
    found = marks.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(marks)
    folders = sorted(mark.getPath().getParent().toString() for mark in found or [])
    return folders[-1] if folders else None


def create_if_absent(
    spark: SparkSession,
    path: str,
    make: Callable[[], DataFrame],
    year_column: str = "year",
    force: bool = False,
) -> tuple[bool, DataFrame]:
    """Write `make()` below `path` unless a table is there; returns (created, statistics).

    Every write is a new version, which becomes the current one when it is complete: readers of
    the old one are not disturbed, with `force` either, `make` may read it, and a write that
    is killed midway changes nothing. `current_version` tells where the table is.
    """
    done = None if force else current_version(spark, path)
    if done is not None:
        return False, load_stats(spark.read.parquet(done), year_column)
    frame = make()
    version = f"{path.rstrip('/')}/version-{time.time_ns():020d}-{uuid.uuid4().hex}"
    write_table(frame, version)
    return True, load_stats(read_back(frame, version), year_column)


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Catalog table hashed and sorted by `key`: joins of such tables on `key` need no shuffle.

    Choose `buckets` so that one bucket of the widest table fits one task.
    """
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)
