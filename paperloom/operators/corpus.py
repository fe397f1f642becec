"""Full-text corpus of papers with a preprint id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.functions.staging import BROADCAST_BYTES, stage


def eligible_papers(
    papers: DataFrame,
    id_field: str = "ArXiv",
    year_lt: int | None = None,
    id_range: tuple[int, int] | None = None,
) -> DataFrame:
    """(corpusid, year, id) of flagged papers with an external id, inside the bounds.

    `id_range` is half open: first <= corpusid < last.
    """
    external = F.col(f"externalids.{id_field}")
    keep = external.isNotNull() & F.col("has_fulltext")
    if year_lt is not None:
        keep = keep & (F.col("year") < year_lt)
    if id_range is not None:
        keep = keep & (F.col("corpusid") >= id_range[0]) & (F.col("corpusid") < id_range[1])
    return papers.filter(keep).select(
        "corpusid", F.col("year").cast("int"), external.alias(f"{id_field.lower()}_id")
    )


def fulltext_corpus(
    papers: DataFrame,
    fulltext: DataFrame,
    id_field: str = "ArXiv",
    year_lt: int | None = 1991,
    id_range: tuple[int, int] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Eligible papers with their non-empty body text, annotations as JSON and text length.

    The texts are by far the larger side. The eligible papers are staged and measured: small
    enough, they are broadcast and the texts are never shuffled. Otherwise the texts are
    shuffled once but not sorted, as the hash tables come from the papers; the year bound is
    repeated there so that Spark may build a runtime Bloom filter from that side and drop
    other texts before the shuffle.
    """
    eligible = stage(eligible_papers(papers, id_field, year_lt, id_range), "eligible")
    bodies = fulltext.filter(
        F.col("body.text").isNotNull() & (F.col("body.text") != "")
    ).select("corpusid", "body")
    if eligible.fits(broadcast_bytes):
        side = F.broadcast(eligible.frame)
    else:
        side = eligible.frame
        if year_lt is not None:
            side = side.filter(F.col("year") < year_lt)
        side = side.hint("shuffle_hash")
    return bodies.join(side, "corpusid").select(
        "corpusid",
        "year",
        f"{id_field.lower()}_id",
        F.col("body.text").alias("text"),
        F.to_json("body.annotations").alias("annotations"),
        F.length("body.text").cast("bigint").alias("text_length"),
        F.current_timestamp().alias("created_at"),
    )


def corpus_key_range(papers: DataFrame, id_field: str = "ArXiv") -> DataFrame:
    """Smallest and largest corpusid of the flagged papers with an external id."""
    return eligible_papers(papers, id_field).agg(
        F.min("corpusid").alias("min_corpusid"), F.max("corpusid").alias("max_corpusid")
    )


def corpus_stats(corpus: DataFrame) -> DataFrame:
    """One row: papers, years, year range and text lengths."""
    return corpus.agg(
        F.count(F.lit(1)).alias("total_papers"),
        F.count_distinct("year").alias("unique_years"),
        F.min("year").alias("earliest_year"),
        F.max("year").alias("latest_year"),
        F.avg("text_length").alias("avg_text_length"),
        F.max("text_length").alias("max_text_length"),
        F.sum("text_length").alias("total_text_size"),
    )


def corpus_by_year(corpus: DataFrame, report_from: int = 2015, n: int = 10) -> DataFrame:
    """Papers per year from `report_from` on, the newest `n` years first."""
    return (
        corpus.filter(F.col("year") >= report_from)
        .groupBy("year")
        .agg(F.count(F.lit(1)).alias("papers"))
        .orderBy(F.desc("year"))
        .limit(n)
    )
