"""Derived columns of papers: availability flags and topics.

Flags have three values; NULL means "not checked yet". Every function computes the new state
from the given frame and returns it; write it to a new place, never over its own input.
Pass `papers` with the key and derived columns only to keep the wide columns out of the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from paperloom.functions.bitmaps import with_membership
from paperloom.functions.columns import percent
from paperloom.functions.nested import add_typed_column, column_by_name
from paperloom.functions.skew import ROWS_PER_TASK, SALT, hot_keys, replicate, spread
from paperloom.functions.staging import BROADCAST_BYTES, Staged, stage
from paperloom.schemas import CONCEPTS, TOPIC, TOPICS, type_of

FLAG_MODES = ("incremental", "force", "recompute")
TOPIC_MODES = ("incremental", "force")
_HIT = "_in_"
_NEW = "_new"
_ID_HASH = "_id_hash"


def _require(mode: str, allowed: tuple[str, ...]) -> None:
    if mode not in allowed:
        raise ValueError(f"unknown mode {mode!r}, expected one of {', '.join(allowed)}")


# ---- flags ---------------------------------------------------------------------------------


def _flag_state(
    papers: DataFrame, others: Mapping[str, DataFrame], key: str, broadcast_bytes: int
) -> DataFrame:
    """Papers with their old flags and, per flag, whether the key exists in its table.

    The keys of all tables are merged into bitmaps, so any number of flags costs one join, which
    leaves the papers in place up to very many keys (`with_membership`).
    """
    for flag in others:
        papers = add_typed_column(papers, flag, "boolean")
    return with_membership(papers, others, key, _HIT, broadcast_bytes)


def _hit(flag: str) -> Column:
    return F.col(_HIT + flag)


def _flag_updated(flag: str, mode: str) -> Column:
    return _hit(flag) & F.col(flag).isNull() if mode == "incremental" else _hit(flag)


def _flag_after(flag: str, mode: str) -> Column:
    if mode == "incremental":
        return F.coalesce(F.col(flag), _hit(flag))
    if mode == "force":
        return _hit(flag) | F.coalesce(F.col(flag), F.lit(False))
    return _hit(flag)


def flag_all(
    papers: DataFrame,
    others: Mapping[str, DataFrame],
    key: str = "corpusid",
    mode: str = "incremental",
    broadcast_bytes: int = BROADCAST_BYTES,
    seen: Observation | None = None,
) -> DataFrame:
    """Set each boolean flag in `others` by whether `key` occurs in its table.

    incremental: only NULL flags are decided, TRUE and FALSE stay.
    force: a hit sets TRUE; without a hit TRUE and FALSE stay and NULL becomes FALSE.
    recompute: the flag is the hit, which also clears stale TRUE flags.

    `seen` gets the numbers of `flag_report` while the result is written: `total`, and for each
    flag `<flag>_updated` and `<flag>_covered`.
    """
    _require(mode, FLAG_MODES)
    state = _flag_state(papers, others, key, broadcast_bytes)
    if seen is not None:
        counts = [F.count(F.lit(1)).alias("total")]
        for flag in others:
            counts.append(F.count_if(_flag_updated(flag, mode)).alias(f"{flag}_updated"))
            counts.append(F.count_if(_flag_after(flag, mode)).alias(f"{flag}_covered"))
        state = state.observe(seen, *counts)
    after = {flag: _flag_after(flag, mode) for flag in others}
    return state.withColumns(after).drop(*[_HIT + flag for flag in others])


def flag_exists(
    papers: DataFrame,
    other: DataFrame,
    key: str,
    flag: str,
    mode: str = "incremental",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """`flag_all` for one flag."""
    return flag_all(papers, {flag: other}, key, mode, broadcast_bytes)


def flag_report(
    papers: DataFrame,
    other: DataFrame,
    key: str,
    flag: str,
    mode: str = "incremental",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row: how many papers, how many updated by a hit, how many TRUE afterwards."""
    _require(mode, FLAG_MODES)
    return (
        _flag_state(papers, {flag: other}, key, broadcast_bytes)
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.count_if(_flag_updated(flag, mode)).alias("rows_updated"),
            F.count_if(_flag_after(flag, mode)).alias("covered"),
        )
        .withColumn("pct", percent(F.col("covered"), F.col("total"), 1))
    )


# ---- topics --------------------------------------------------------------------------------


def _one_link(pairs: DataFrame, works: DataFrame) -> Staged:
    """(corpusid, oa_id): the smallest work that exists of those each paper is linked to.

    A paper with one link keeps it. That others have several is seen while the links are written;
    only their links are checked against the ids of the works. Nothing wide is read here.
    """
    links = pairs.groupBy("corpusid").agg(F.min("oa_id").alias("oa_id"), F.max("oa_id").alias("last"))
    staged = stage(links, "topic-links", several=F.count_if(F.col("oa_id") != F.col("last")))
    if not staged.seen["several"]:
        return staged
    contested = staged.frame.filter("oa_id <> last").select("corpusid")
    chosen = (
        pairs.join(contested, "corpusid", "left_semi")
        .join(works.select(F.col("id").alias("oa_id")), "oa_id", "left_semi")
        .groupBy("corpusid")
        .agg(F.min("oa_id").alias("oa_id"))
    )
    single = staged.frame.filter("oa_id = last").select("corpusid", "oa_id")
    return stage(single.unionAll(chosen), "topic-winners")


def _assigned_topics(
    pairs: DataFrame,
    works: DataFrame,
    unique_ids: bool,
    broadcast_bytes: int,
    rows_per_task: int,
) -> DataFrame:
    """(corpusid, topics, concepts) of the work each paper is linked to.

    A paper linked to several works takes the one with the smallest id, and among copies of
    that work one that has topics. The work is chosen on narrow rows first, then its topics are
    fetched once: works in place if the papers are few, else both by a shuffle. Topics pass an
    aggregate only where ids of works may repeat.
    """
    payload = works.filter(F.col("id").isNotNull()).select(
        F.col("id").alias("oa_id"),
        column_by_name(works, "topics", type_of(TOPICS)).alias("topics"),
        column_by_name(works, "concepts", type_of(CONCEPTS)).alias("concepts"),
    )
    content = F.struct(F.col("topics").isNull().alias("without"), "topics", "concepts")
    first = F.min("content").alias("content")

    staged = _one_link(pairs, works)
    links = staged.frame.select("corpusid", "oa_id")
    if staged.fits(broadcast_bytes):
        # Few papers to fill: the works are scanned in place, not shuffled.
        contents = payload.select("oa_id", content.alias("content"))
        matched = contents.join(F.broadcast(links), "oa_id")
        if not unique_ids:
            matched = matched.groupBy("corpusid").agg(first)
    else:
        keys = [_ID_HASH, "oa_id"]
        hot = hot_keys(links, "oa_id", rows_per_task)
        if hot is not None:
            links = spread(links, "oa_id", F.col("corpusid"), hot)
            payload = replicate(payload, "oa_id", hot)
            keys.append(SALT)
        # Sorted by hash first: ids all start alike and compare slowly.
        id_hash = F.xxhash64("oa_id").alias(_ID_HASH)
        contents = payload.select(id_hash, *keys[1:], content.alias("content"))
        if not unique_ids:
            # Same keys as the join, which then needs no further shuffle.
            contents = contents.groupBy(*keys).agg(first)
        links = links.withColumn(_ID_HASH, F.xxhash64("oa_id"))
        matched = contents.join(links.hint("shuffle_hash"), keys)
    return matched.select("corpusid", "content.topics", "content.concepts")


def _topic_state(
    papers: DataFrame,
    lookup: DataFrame,
    works: DataFrame,
    mode: str,
    unique_ids: bool,
    broadcast_bytes: int,
    rows_per_task: int,
) -> DataFrame:
    some_filled = "oa_topics" in papers.columns
    for name, ddl in (("oa_topics", TOPICS), ("oa_concepts", CONCEPTS), ("oa_primary_topic", TOPIC)):
        papers = add_typed_column(papers, name, ddl)
    pairs = lookup.select(F.col("corpusid").cast("bigint").alias("corpusid"), "oa_id")
    pairs = pairs.filter(F.col("oa_id").isNotNull())
    if mode == "incremental" and some_filled:
        pending = papers.filter(F.col("oa_topics").isNull())
        pairs = pairs.join(
            pending.select(F.col("corpusid").cast("bigint").alias("corpusid")),
            "corpusid",
            "left_semi",
        )
    found = _assigned_topics(pairs, works, unique_ids, broadcast_bytes, rows_per_task).select(
        "corpusid", F.struct("topics", "concepts").alias(_NEW)
    )
    return papers.join(found, "corpusid", "left")


def _topics_updated(mode: str) -> Column:
    matched = F.col(_NEW).isNotNull()
    return matched & F.col("oa_topics").isNull() if mode == "incremental" else matched


def _topics_covered(mode: str) -> Column:
    return F.when(_topics_updated(mode), F.col(f"{_NEW}.topics").isNotNull()).otherwise(
        F.col("oa_topics").isNotNull()
    )


def enrich_topics(
    papers: DataFrame,
    lookup: DataFrame,
    works: DataFrame,
    mode: str = "incremental",
    unique_ids: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
    seen: Observation | None = None,
) -> DataFrame:
    """Fill `oa_topics`, `oa_concepts` and `oa_primary_topic` through the lookup.

    incremental: only papers whose `oa_topics` is NULL take new values.
    force: every linked paper takes the values of its work, also NULL.
    Papers without a linked work never change. `unique_ids=True` promises that ids of
    `works` do not repeat and saves one aggregate. `seen` gets the numbers of `topic_report`
    while the result is written: `total`, `updated` and `covered`.
    """
    _require(mode, TOPIC_MODES)
    state = _topic_state(
        papers, lookup, works, mode, unique_ids, broadcast_bytes, rows_per_task
    )
    take = _topics_updated(mode)
    if seen is not None:
        state = state.observe(
            seen,
            F.count(F.lit(1)).alias("total"),
            F.count_if(take).alias("updated"),
            F.count_if(_topics_covered(mode)).alias("covered"),
        )
    topics = F.col(f"{_NEW}.topics")
    after = {
        "oa_topics": topics,
        "oa_concepts": F.col(f"{_NEW}.concepts"),
        "oa_primary_topic": F.get(topics, F.lit(0)),
    }
    return state.withColumns(
        {name: F.when(take, new).otherwise(F.col(name)) for name, new in after.items()}
    ).drop(_NEW)


def topic_report(
    papers: DataFrame,
    lookup: DataFrame,
    works: DataFrame,
    mode: str = "incremental",
    unique_ids: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """One row: how many papers, how many updated, how many with topics afterwards."""
    _require(mode, TOPIC_MODES)
    state = _topic_state(
        papers, lookup, works, mode, unique_ids, broadcast_bytes, rows_per_task
    )
    return state.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(_topics_updated(mode)).alias("rows_updated"),
        F.count_if(_topics_covered(mode)).alias("covered"),
    ).withColumn("pct", percent(F.col("covered"), F.col("total"), 1))


def enrichment_coverage(papers: DataFrame) -> DataFrame:
    """One row per derived column that `papers` has: total, covered, percent."""
    covered = {
        "has_abstract": lambda c: F.count_if(c),
        "has_fulltext": lambda c: F.count_if(c),
        "oa_topics": lambda c: F.count(c),
    }
    present = [name for name in covered if name in papers.columns]
    return (
        papers.agg(
            F.count(F.lit(1)).alias("total"),
            *[covered[name](F.col(name)).alias(name) for name in present],
        )
        .unpivot("total", present, "column", "covered")
        .select("column", "total", "covered", percent(F.col("covered"), F.col("total"), 1).alias("pct"))
    )
