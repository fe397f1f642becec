"""Measurements that decide a plan: size of an intermediate result, repeated keys."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.session import shared_folder

# A key set up to this many bytes in memory is sent to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024
# What a hash table needs per row and per string on top of the values.
_ROW_OVERHEAD = 48
_VALUE_BYTES = 16


@dataclass(frozen=True)
class Staged:
    """A written intermediate table with its measured size."""

    frame: DataFrame
    rows: int
    bytes: int
    seen: dict = field(default_factory=dict)

    def fits(self, limit: int) -> bool:
        return self.bytes <= limit


def _row_bytes(schema: T.StructType) -> Column:
    total = F.lit(_ROW_OVERHEAD)
    for field in schema.fields:
        if isinstance(field.dataType, T.StringType):
            total = total + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
        total = total + F.lit(_VALUE_BYTES)
    return total


def stage(df: DataFrame, label: str, **measures: Column) -> Staged:
    """Write a frame of scalar columns to the shared folder and read it back.

    Row count, byte size and any further `measures` (aggregates) ride along with the write. Later stages depend on the files
    only, so a lost executor costs no recomputation of what led here.
    """
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    seen = Observation()
    (
        df.observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(_row_bytes(df.schema)), F.lit(0)).cast("bigint").alias("bytes"),
            *[measure.alias(name) for name, measure in measures.items()],
        )
        .write.parquet(path)
    )
    frame = df.sparkSession.read.schema(df.schema).parquet(path)
    return Staged(frame, seen.get["rows"], seen.get["bytes"], {m: seen.get[m] for m in measures})


def has_repeated(df: DataFrame, column: str) -> bool:
    """Does any value of `column` occur twice?"""
    repeated = df.groupBy(column).count().filter(F.col("count") > 1)
    return not repeated.isEmpty()
