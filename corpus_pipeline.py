"""The corpus pipeline: toxic documents go, then boilerplate lines, near-duplicates and benchmark
passages; what stays is tokenised.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which `run` writes and reads
again as the next one's `docs`. All but the last return the columns of documents. They accept
null and empty texts (clean, without lines, linked with nothing, free of passages, no tokens),
null ids, repeated rows, empty tables and further columns, which stay with their rows until the
last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import bpe, decontamination, lines, minhash, toxicity
from paperloom.llm.common import table, written

NEAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic, by a model learned from `labels`.

    Scores follow from the text alone; a document's label is not looked at.
    """
    labels = table(spark, sf_dir, "labels")
    return toxicity.drop_toxic(docs, toxicity.learn(docs, toxicity.training_labels(labels)))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines shared by many sources; n_chars follows the text. No row goes.

    Copies of a text count at one source; shared lines go whatever their share of a text.
    """
    kept = lines.remove_boilerplate(docs, near_percent=NEAR_PERCENT)
    changed = F.col("n_removed") > 0
    if "n_chars" in docs.columns:
        n_chars = F.when(changed, F.length("text")).otherwise(F.col("n_chars"))
        kept = kept.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest doc_id.

    Documents with an empty text stay, each for itself. Where rows of a group share the smallest
    doc_id, or none has one, one of them stays, also if they differ in other columns.
    """
    return minhash.drop_near_duplicates(docs, NEAR_PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of `benchmark`."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the bytes they decode to."""
    return bpe.encode_decode(
        docs,
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
        digest=True,
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_boilerplate),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("tokens", tokenise),
]

#: SQL states neither the learned scores nor MinHash buckets nor BPE merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
