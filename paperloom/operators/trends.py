"""Topic and subfield trends over time.

`topic_counts` is small (years x topics); persist or write it once and derive the rest from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.columns import first_topic, percent, year_bin

LEVELS = {
    "topic_name": "display_name",
    "subfield_name": "subfield.display_name",
    "field_name": "field.display_name",
    "domain_name": "domain.display_name",
}


def topic_counts(works: DataFrame, ordered: bool = False) -> DataFrame:
    """Works per year and first topic with its hierarchy; no topic is a group of its own."""
    counts = (
        works.select(
            "publication_year", *[first_topic(path).alias(name) for name, path in LEVELS.items()]
        )
        .groupBy("publication_year", *LEVELS)
        .agg(F.count(F.lit(1)).alias("num_papers"))
    )
    if ordered:
        counts = counts.orderBy(F.asc_nulls_last("publication_year"), F.desc("num_papers"))
    return counts


def missing_topic_share(counts: DataFrame) -> DataFrame:
    """One row: works without a topic, all works, percentage."""
    return counts.agg(
        F.coalesce(
            F.sum(F.when(F.col("topic_name").isNull(), F.col("num_papers"))), F.lit(0)
        ).alias("n_missing"),
        F.sum("num_papers").alias("n_total"),
    ).withColumn("pct_missing", percent(F.col("n_missing"), F.col("n_total"), 2))


def top_names(counts: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The `n` names with most papers; equal totals in name order."""
    return (
        counts.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.sum("num_papers").alias("num_papers"))
        .orderBy(F.desc("num_papers"), F.asc(column))
        .limit(n)
    )


def _binned(counts: DataFrame, column: str, width: int) -> DataFrame:
    """Papers per bin and name. Rows without a year stay: they count for the ranking."""
    return (
        counts.filter(F.col(column).isNotNull())
        .groupBy(year_bin(F.col("publication_year"), width).alias("year_bin"), column)
        .agg(F.sum("num_papers").alias("num_papers"))
    )


def trend(counts: DataFrame, column: str, n: int = 10, width: int = 2) -> DataFrame:
    """(year_bin, name, num_papers) of the top `n` names; works without a year drop out."""
    binned = _binned(counts, column, width)
    top = top_names(binned, column, n).select(column)
    return (
        binned.filter(F.col("year_bin").isNotNull())
        .join(F.broadcast(top), column, "left_semi")  # at most n rows
        .select("year_bin", column, "num_papers")
    )


def trend_share(trends: DataFrame) -> DataFrame:
    """Add each name's share of its bin."""
    in_bin = Window.partitionBy("year_bin")
    return trends.withColumn("share", F.col("num_papers") / F.sum("num_papers").over(in_bin))


def heatmap(counts: DataFrame, column: str = "topic_name", n: int = 30, width: int = 2) -> DataFrame:
    """Trend of the top `n` names with their overall rank, ordered by rank and bin."""
    binned = _binned(counts, column, width)
    # The window sees at most n rows.
    by_size = Window.orderBy(F.desc("num_papers"), F.asc(column))
    ranks = top_names(binned, column, n).select(
        column, F.row_number().over(by_size).alias("name_rank")
    )
    return (
        binned.filter(F.col("year_bin").isNotNull())
        .join(F.broadcast(ranks), column)
        .select("name_rank", column, "year_bin", "num_papers")
        .orderBy("name_rank", "year_bin")
    )


def explode_topics(works: DataFrame) -> DataFrame:
    """One row per topic of each work, nested levels flattened; works without topics have none."""
    levels = [
        F.col(f"topic.{level}.{part}").alias(f"{level}_{part}")
        for level in ("subfield", "field", "domain")
        for part in ("id", "display_name")
    ]
    return works.select(F.col("id").alias("work_id"), F.explode("topics").alias("topic")).select(
        "work_id",
        F.col("topic.id").alias("topic_id"),
        F.col("topic.display_name").alias("topic_name"),
        *levels,
        F.col("topic.score").alias("score"),
    )


def work_by_id(works: DataFrame, work_id: str) -> DataFrame:
    """Point lookup; the equality reaches the Parquet scan."""
    return works.filter(F.col("id") == work_id)


def latest_works(works: DataFrame, n: int = 5) -> DataFrame:
    """The `n` most recent works, equal years in id order."""
    return works.orderBy(F.desc_nulls_last("publication_year"), F.asc("id")).limit(n)
