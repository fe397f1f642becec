"""Parquet scans and views."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.sources import manifest


def scan_parquet(
    spark: SparkSession,
    path: str | Sequence[str],
    pattern: str = "*.parquet",
    schema: T.StructType | None = None,
    folder_columns: bool = False,
) -> DataFrame:
    """All Parquet files below `path` whose name fits `pattern`, at any depth.

    A folder whose name fits is a table: all Parquet files in it belong to the scan.

    With `folder_columns`, folders named `column=value` become columns, also where other files of the tree lie outside
    such folders: those keep the column of their own, or get NULL. Values are whole numbers if
    all of them are, else strings.
    """
    roots = [path] if isinstance(path, str) else list(path)
    paths, names = manifest.fitting(spark, roots, pattern)
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", names)
    if schema is not None:
        reader = reader.schema(schema)
    frame = reader.parquet(*paths)
    if not folder_columns:
        return frame
    types = manifest.folder_columns(spark, roots, pattern)
    if types and schema is None:
        # Files in such folders lack the column that others of the tree may have.
        frame = reader.schema(manifest.merged_schema(spark, roots, pattern)).parquet(*paths)
    return _with_folder_columns(frame, types)


def _with_folder_columns(frame: DataFrame, types: dict[str, str]) -> DataFrame:
    for name, kind in types.items():
        text = F.regexp_extract(
            F.col("_metadata.file_path"), f"/{re.escape(name)}=([^/]*)/", 1
        )
        text = F.nullif(F.url_decode(text), F.lit(""))
        text = F.nullif(text, F.lit(manifest.NO_VALUE))
        column = unquote(name)
        if column in frame.columns:
            found = F.coalesce(text.cast(frame.schema[column].dataType), F.col(f"`{column}`"))
        else:
            found = text.cast(kind)
        frame = frame.withColumn(column, found)
    return frame


def scan_union_by_name(
    spark: SparkSession,
    vintages: Sequence[str],
    drop: Sequence[str] = (),
    schema: T.StructType | None = None,
) -> DataFrame:
    """Files of several vintages aligned by column name; a column a vintage lacks is NULL.

    `drop` names columns whose types conflict between vintages. With a declared `schema` the
    scan reads exactly its columns minus `drop` from all files at once. Without one, each
    vintage keeps its own types and they are united by name.
    """
    if schema is not None:
        wanted = T.StructType([f for f in schema.fields if f.name not in set(drop)])
        return scan_parquet(spark, list(vintages), schema=wanted)
    frames = [scan_parquet(spark, vintage).drop(*drop) for vintage in vintages]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def view_parquet(spark: SparkSession, name: str, path: str) -> DataFrame:
    """(Re)create view `name` over the files below `path`; reads no data, fails without files."""
    frame = scan_parquet(spark, path, folder_columns=True)
    frame.createOrReplaceTempView(name)
    return frame


def year_filter(
    df: DataFrame, column: str, test_year: int | None = None, bounds: tuple[int, int] = (1900, 2026)
) -> DataFrame:
    """Rows inside the inclusive year bounds, or of `test_year` only (0 and None: off)."""
    year = F.col(column)
    return df.filter(year == test_year if test_year else year.between(*bounds))
