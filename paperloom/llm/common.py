"""What the operators of this folder share: reading tables, written intermediates, text batches."""

from __future__ import annotations

import contextlib
import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.session import shared_folder

# Python holds at most about this many bytes of text at a time, besides one whole text.
GROUP_BYTES = 16 * 1024 * 1024


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, which need not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="paperloom-"), "paperloom_workers.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Cut the lineage: write the rows to the shared folder and read them back."""
    path = fresh_path(df.sparkSession, label)
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Return freed memory to the system: an idle Python worker otherwise keeps its peak."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def text_groups(
    batches: Iterable[pa.RecordBatch], limit: int = GROUP_BYTES
) -> Iterator[tuple[list[list], list[bytes]]]:
    """Groups of rows with about `limit` bytes of text: columns before the last one, then texts.

    The last column is the text, as UTF-8; a null text comes as empty bytes.
    """
    columns: list[list] = []
    texts: list[bytes] = []
    size = 0
    for batch in batches:
        *others, text = batch.columns
        values = [c.to_pylist() for c in others]
        if not columns:
            columns = [[] for _ in values]
        start = 0
        texts_of_batch = text.cast(pa.binary()).to_pylist()
        for i, value in enumerate(texts_of_batch):
            size += len(value or b"")
            if size >= limit:
                for kept, new in zip(columns, values, strict=True):
                    kept.extend(new[start : i + 1])
                texts.extend(t or b"" for t in texts_of_batch[start : i + 1])
                yield columns, texts
                give_back()
                columns, texts, size, start = [[] for _ in values], [], 0, i + 1
        for kept, new in zip(columns, values, strict=True):
            kept.extend(new[start:])
        texts.extend(t or b"" for t in texts_of_batch[start:])
    if texts:
        yield columns, texts
    del columns, texts
    give_back()


def unused(df: DataFrame, name: str) -> str:
    """`name`, or a longer one where the frame has such a column already."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


def column(name: str) -> Column:
    """A column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def batch_slices(
    batches: Iterable[pa.RecordBatch], text: int, limit: int = GROUP_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches in slices with about `limit` bytes in column number `text`, at least one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            give_back()
            start = stop


def utf8_values(values: pa.Array) -> list[bytes]:
    """Texts as UTF-8; a null text as empty bytes."""
    return pc.fill_null(values.cast(pa.binary()), b"").to_pylist()
