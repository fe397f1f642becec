"""What is known of the files of a Parquet tree without reading their rows.

Listing and footers are data that tasks work on: the driver sees one row per folder column and
one per distinct schema, however many files there are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FOOTER = "path string, compressed bigint, rows bigint, uncompressed bigint, schema_id string"
_FOLDER_VALUE = r"/([^/=]+)=([^/]*)(?=/)"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_PARQUET = "*.parquet"


def _listing(spark: SparkSession, paths: list[str], pattern: str) -> DataFrame:
    """The files of a tree by name; no file is opened as long as `content` is not selected."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(paths)
    )


def _files(spark: SparkSession, path: str | Sequence[str], pattern: str) -> DataFrame:
    return _listing(spark, *fitting(spark, path, pattern))


def _literal(path: str) -> str:
    """Paths are read as patterns; this one stands for itself."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _name_regex(pattern: str) -> str:
    """The names that fit a file pattern, as a regular expression."""
    marks = {"*": "[^/]*", "?": "[^/]", "{": "(?:", "}": ")"}
    found, braces = "", 0
    for part in re.findall(r"\\.|\[[^\]]+\]|.", pattern):
        braces += (part == "{") - (part == "}")
        if part[0] == "[" and len(part) > 1:
            found += f"[^/{part[2:]}" if part[1] in "!^" else part
        elif part == "," and braces:
            found += "|"
        else:
            found += marks.get(part) or re.escape(part[-1])
    return f"(?:{found})"


def _folders(spark: SparkSession, paths: list[str]) -> list[str]:
    """The folders that `paths` stand for, of files those they lie in, spelt as in listings."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folders = []
    for path in map(hadoop.Path, paths):
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for status in files.globStatus(path) or []:
            at = status.getPath()
            folders.append((at.getParent() if status.isFile() else at).toString().rstrip("/"))
    return folders


def fitting(
    spark: SparkSession, path: str | Sequence[str], pattern: str
) -> tuple[list[str], str]:
    """Paths and file pattern by which a reader finds what fits `pattern` below `path`.

    A folder that fits is a table: all Parquet files in it belong to it, also by other names. The
    driver sees one row per such folder, and per file outside of them that fits if there are any.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if pattern == _PARQUET:  # already fits the files in all folders
        return paths, pattern
    names = f"{{{pattern},{_PARQUET}}}"
    listed = _listing(spark, paths, names).select("path").coalesce(spark.sparkContext.defaultParallelism)
    above = "|".join(map(re.escape, _folders(spark, paths)))
    outermost = f"^(?:{above})/(?:[^/]+/)*?{_name_regex(pattern)}(?=/|$)"
    found = (
        listed.withColumn("fits", F.regexp_extract("path", outermost, 0))
        .filter("fits <> ''")
        .groupBy("fits")
        .agg(F.bool_or(F.col("fits") != F.col("path")).alias("folder"))
    )
    if found.filter("folder").isEmpty():
        return paths, pattern
    return [_literal(row["fits"]) for row in found.sort("fits").collect()], names


def parquet_footers(
    spark: SparkSession, path: str | Sequence[str], pattern: str = "*.parquet"
) -> DataFrame:
    """(path, compressed, rows, uncompressed, schema_id) of each file below `path`.

    File names and sizes come from the listing; tasks then read footers only. Files of one
    `schema_id` have the same columns, types and Spark schema.
    """

    # Local, so that executors get the function itself and need not have this package.
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib
        from urllib.parse import quote

        import pyarrow.parquet as pq
        from pyarrow import fs

        for batch in batches:
            rows, sizes, schemas = [], [], []
            for name in batch["path"]:
                scheme, _, rest = name.partition(":")
                if scheme == "file":  # names come with blanks and marks as they are
                    filesystem, inner = fs.LocalFileSystem(), "/" + rest.lstrip("/")
                else:
                    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
                    filesystem, inner = fs.FileSystem.from_uri(
                        f"{scheme}:{quote(rest, safe='/:@=+,')}"
                    )
                with filesystem.open_input_file(inner) as file:
                    meta = pq.read_metadata(file)
                groups = (meta.row_group(i) for i in range(meta.num_row_groups))
                rows.append(meta.num_rows)
                sizes.append(sum(group.total_byte_size for group in groups))
                leaves = (meta.schema.column(i) for i in range(len(meta.schema)))
                layout = [
                    (c.path, c.physical_type, str(c.logical_type), c.converted_type, c.length)
                    + (c.max_definition_level, c.max_repetition_level)
                    for c in leaves
                ]
                own = (meta.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata", b"")
                schemas.append(hashlib.sha256(own + repr(layout).encode()).hexdigest())
            yield batch.assign(rows=rows, uncompressed=sizes, schema_id=schemas)

    files = _files(spark, path, pattern).select("path", F.col("length").alias("compressed"))
    tasks = spark.sparkContext.defaultParallelism
    return files.repartition(tasks).mapInPandas(read, _FOOTER)


def merged_schema(
    spark: SparkSession, path: str | Sequence[str], pattern: str = "*.parquet"
) -> T.StructType:
    """The schema of all files together, types widened as Spark does it.

    Tasks read the footers and the driver merges one file per distinct schema.
    """
    firsts = parquet_footers(spark, path, pattern).groupBy("schema_id").agg(F.min("path").alias("path"))
    names = [_literal(row["path"]) for row in firsts.sort("path").collect()]
    options = {"recursiveFileLookup": "true", "mergeSchema": "true"}
    return spark.read.options(**options).parquet(*names).schema


def folder_columns(
    spark: SparkSession, path: str | Sequence[str], pattern: str = "*.parquet"
) -> dict[str, str]:
    """Names, as they stand in paths, and types of the `column=value` folders below `path`.

    Values are whole numbers if all of them are, else strings.
    """
    roots = [path] if isinstance(path, str) else list(path)
    above = {name for root in roots for name, _ in re.findall(_FOLDER_VALUE, f"/{root}/")}
    files = _files(spark, roots, pattern).select(F.col("_metadata.file_path").alias("file"))
    pattern_ = F.lit(_FOLDER_VALUE)
    found = files.coalesce(spark.sparkContext.defaultParallelism).select(
        F.explode(
            F.arrays_zip(
                F.regexp_extract_all("file", pattern_, F.lit(1)).alias("name"),
                F.regexp_extract_all("file", pattern_, F.lit(2)).alias("value"),
            )
        ).alias("folder")
    )
    value = F.url_decode("folder.value")
    known = F.when(value != NO_VALUE, value)
    kinds = found.groupBy(F.col("folder.name").alias("name")).agg(
        F.coalesce(F.bool_and(known.rlike(r"^-?\d{1,18}$")), F.lit(True)).alias("whole"),
        F.coalesce(F.max(F.length(known)), F.lit(0)).alias("longest"),
    )
    types = {}
    for row in kinds.sort("name").collect():
        if row["name"] not in above:
            short = "int" if row["longest"] < 10 else "bigint"
            types[row["name"]] = short if row["whole"] else "string"
    return types
