"""Raw releases: gzipped JSON lines to typed Parquet with a quarantine for bad lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RAW = "_raw_line"
_STATE = "_state"


def ingest_json(
    spark: SparkSession,
    source: str,
    target: str,
    schema: T.StructType,
    max_records_per_file: int = 5_000_000,
) -> tuple[DataFrame, DataFrame]:
    """Parse `source` once and write both good and bad rows below `target`.

    Returns the typed table and the quarantine (raw line, file). A gzip file cannot be split,
    so each file is one streaming task; the rows go straight to Parquet without a shuffle, and
    files are cut at `max_records_per_file`.
    """
    with_raw = T.StructType([*schema.fields, T.StructField(_RAW, T.StringType())])
    (
        spark.read.schema(with_raw)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _RAW)
        .json(source)
        .withColumn("_file", F.when(F.col(_RAW).isNotNull(), F.col("_metadata.file_path")))
        .withColumn(_STATE, F.when(F.col(_RAW).isNull(), "good").otherwise("bad"))
        .write.mode("overwrite")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(_STATE)
        .parquet(target)
    )
    stored = T.StructType(
        [
            *with_raw.fields,
            T.StructField("_file", T.StringType()),
            T.StructField(_STATE, T.StringType()),
        ]
    )
    table = spark.read.schema(stored).parquet(target)
    good = table.filter(F.col(_STATE) == "good").select(*schema.fieldNames())
    bad = table.filter(F.col(_STATE) == "bad").select(
        F.col(_RAW).alias("raw_line"), F.col("_file").alias("file")
    )
    return good, bad
