"""Sinks for metric rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

BATCH_ROWS = 10_000


def jdbc_options(url: str, table: str, batch_rows: int = BATCH_ROWS, writers: int = 8) -> dict[str, str]:
    """Writer options: rows go out in batches over at most `writers` connections.

    A failed batch fails its task and with it the export.
    """
    return {
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_rows),
        "numPartitions": str(writers),
    }


def export_metrics(
    metrics: DataFrame, format: str = "parquet", mode: str = "overwrite", **options: str
) -> None:
    """Write metric rows from the executors; an empty result is an error and writes nothing."""
    kept = metrics.persist()
    try:
        if kept.isEmpty():
            raise ValueError("no metrics to export")
        kept.write.format(format).mode(mode).options(**options).save()
    finally:
        kept.unpersist()
