"""The registered queries of this folder, with SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import (
    decontamination,
    lines,
    minhash,
    negatives,
    neighbours,
    ngrams,
    quotes,
    repeats,
    simhash,
    spelling,
    toxicity,
    warc,
)
from paperloom.llm.bpe import encode_decode
from paperloom.llm.common import fresh_path, table, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def keep(query):
        QUERIES[name] = query
        if sql is not None:
            ORACLE[name] = sql
        return query

    return keep


@register("op6_byte_bpe")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_decode(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
        digest=True,
    )


@register("op3_line_dedup", sql=lines.SQL.format(min_sites=10, near_percent=80))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.remove_boilerplate(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@register("op2_quote_links", sql=quotes.SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.reply_ordered(table(spark, sf_dir, "conversations"))


@register("op10_toxicity")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.toxic_scores(docs, labels).select("doc_id", "held_out", "score", "predicted")


@register(
    "op7_warc",
    sql="""
    WITH payloads AS (
      SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes,
        max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
      FROM pages)
    SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
      CASE WHEN payload_bytes >= 1000 AND first <> page_id THEN 'revisit' ELSE 'response' END
        AS record_type,
      CASE WHEN payload_bytes >= 1000 AND first <> page_id THEN first END AS refers_to
    FROM payloads""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    records = written(warc.read_archive(spark, path).drop("payload"), "warc-records")
    return warc.resolve_revisits(records).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@register("op5_decontamination")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.find_items(docs, table(spark, sf_dir, "benchmark"))
    matches = F.col("benchmark_matches")
    best = F.array_min(F.transform(matches, lambda x: F.struct(x["errors"], x["item_id"])))
    return found.select(
        "doc_id",
        (F.size(matches) > 0).alias("contaminated"),
        F.size(matches).cast("bigint").alias("n_items"),
        best["item_id"].alias("item_id"),
        best["errors"].alias("errors"),
    )


@register("op8_kneser_ney")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.held_out_scores(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


@register("op9_one_bit_codes")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    is_query = F.pmod(F.col("vec_id"), F.lit(20)) == 0
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), is_query, k=20)


@register("op1_minhash")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)
    return found.drop("text_hash", "group")


@register("op4_fixed_block_anchors")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), window=35, digest=True)


@register("op13_simhash")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@register("op11_spelling_variants")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


@register("op12_hard_negatives", sql=negatives.SQL)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    is_anchor = F.pmod(F.col("vec_id"), F.lit(100)) == 0
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), is_anchor)
