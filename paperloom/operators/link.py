"""Cross-reference between papers and works by DOI."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.functions.columns import doi_key
from paperloom.functions.skew import ROWS_PER_TASK, SALT, replicate, spread, staged_with_hot_keys


def papers_lookup(
    papers: DataFrame,
    works: DataFrame,
    year_min: int = 1900,
    year_max: int = 2025,
    normalize: str | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """One row per (paper, work) with equal DOI.

    `works` holds one record per DOI (`dedup_works`, or `best_records` with the year).
    The match is case-sensitive unless `normalize='lower'`, which `match_method` records.
    Several papers may share a DOI; DOIs with very many papers are salted. Papers are scanned
    once: ids and DOIs are staged, and a sketch of frequent DOIs rides along.
    """
    if normalize not in (None, "lower"):
        raise ValueError(f"unknown normalize: {normalize!r}")
    fold = F.lower if normalize else (lambda c: c)

    oa = works.filter(
        F.col("doi").isNotNull() & F.col("publication_year").between(year_min, year_max)
    ).select(
        fold(doi_key(F.col("doi"))).alias("doi_key"),
        F.col("id").alias("oa_id"),
        "publication_year",
    )
    s2 = papers.filter(F.col("externalids.DOI").isNotNull()).select(
        "corpusid", fold(F.col("externalids.DOI")).alias("doi_key")
    )
    keys = ["doi_key"]
    # The number of a row within the written frame spreads those without a corpusid as well.
    s2 = s2.withColumn("_row", F.monotonically_increasing_id())
    s2, hot = staged_with_hot_keys(s2, "doi_key", "paper-dois", rows_per_task)
    if hot is not None:
        s2, oa = spread(s2, "doi_key", F.col("_row"), hot), replicate(oa, "doi_key", hot)
        keys.append(SALT)
    pairs = s2.join(oa, keys)
    return pairs.select(
        F.col("corpusid").cast("int"),
        "oa_id",
        F.col("publication_year").cast("smallint"),
        F.lit("doi_lower" if normalize else "doi").alias("match_method"),
        F.lit(1.0).cast("float").alias("match_confidence"),
        F.current_timestamp().alias("created_at"),
    )
