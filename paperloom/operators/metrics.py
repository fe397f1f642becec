"""Counts of papers by field or venue and year."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.functions.columns import model_field

GROUPS = ("field", "venue")
METRICS = ("total", "has_abstract", "has_fulltext")


def compute_metrics(
    papers: DataFrame,
    group_by: str = "field",
    year_min: int = 1900,
    year_max: int = 2025,
    ordered: bool = True,
) -> DataFrame:
    """(group, year, metric_type, count) in long form; a row exists only for counts above 0.

    All three metrics come from one scan and one aggregate. `ordered=False` skips the final
    sort when the sink does not need it.
    """
    if group_by not in GROUPS:
        raise ValueError(f"cannot group by {group_by!r}, expected one of {', '.join(GROUPS)}")
    group = model_field() if group_by == "field" else F.col("venue")
    long = (
        papers.filter(F.col("year").between(year_min, year_max))
        .select(group.alias(group_by), "year", "has_abstract", "has_fulltext")
        .filter(F.col(group_by).isNotNull())
        .groupBy(group_by, "year")
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if("has_abstract").alias("has_abstract"),
            F.count_if("has_fulltext").alias("has_fulltext"),
        )
        .unpivot([group_by, "year"], list(METRICS), "metric_type", "count")
        .filter(F.col("count") > 0)
    )
    return long.orderBy(group_by, "year", "metric_type") if ordered else long


def field_metrics(papers: DataFrame, **options) -> DataFrame:
    return compute_metrics(papers, "field", **options)


def venue_metrics(papers: DataFrame, **options) -> DataFrame:
    return compute_metrics(papers, "venue", **options)


def metrics_summary(metrics: DataFrame, group_by: str = "field") -> DataFrame:
    """Per metric: papers, rows, distinct groups and year range of an export."""
    return metrics.groupBy("metric_type").agg(
        F.sum("count").alias("papers"),
        F.count(F.lit(1)).alias("metric_rows"),
        F.count_distinct(group_by).alias("distinct_groups"),
        F.min("year").alias("min_year"),
        F.max("year").alias("max_year"),
    )
