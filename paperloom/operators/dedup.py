"""One record per DOI.

The best record has, in this order: most citations, most authors, an abstract, most topics,
smallest id. Unknown counts rank last, and so does a missing id. Records without a DOI are
dropped. An id is what a record is found by: where the best record has none, its DOI has no
result, whichever way the records are joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.columns import list_length
from paperloom.functions.skew import ROWS_PER_TASK, salted_join
from paperloom.functions.staging import BROADCAST_BYTES, Staged, stage


def _counted(works: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """`key` and `columns` with the counts to rank by; reads one leaf of each list.

    The rank uses each count twice, so Spark computes them here, before the sort that the
    aggregate needs, and neither lists nor abstracts pass through it.
    """
    return works.filter(F.col(key).isNotNull()).select(
        key,
        *columns,
        F.col("cited_by_count").alias("_cited"),
        list_length("authorships.author_position").alias("_authors"),
        F.col("abstract_inverted_index").isNull().alias("_no_abstract"),
        list_length("topics.id").alias("_topics"),
    )


def _rank(id_col: str) -> list[Column]:
    """Sort key over `_counted` columns whose smallest value is the best record."""
    parts: list[Column] = []
    for count in ("_cited", "_authors"):
        parts += _most_first(count)
    parts.append(F.col("_no_abstract"))
    parts += _most_first("_topics")
    return [*parts, F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id")]


def _most_first(count: str) -> list[Column]:
    value = F.col(count)
    return [value.isNull().alias(f"{count}_unknown"), (-value.cast("bigint")).alias(count)]


def _sortable(key: str) -> Column:
    """Hash to group by ahead of `key`.

    The aggregate and the window sort by their keys. DOIs all start alike, so comparing them
    is slow, while Spark sorts numbers by radix.
    """
    return F.xxhash64(key)


def best_records(
    works: DataFrame, columns: Sequence[str] = (), key: str = "doi", id_col: str = "id"
) -> DataFrame:
    """(key, id, *columns, copies) of the best record per key; none without an id.

    One aggregate over narrow columns. Its map-side half leaves one row per key and task,
    so a key with a third of all rows costs no more than any other.
    """
    best = _winners(works, columns, key, id_col).filter(F.col(id_col).isNotNull())
    return best.drop("_mixed")


def _winners(works: DataFrame, columns: Sequence[str], key: str, id_col: str) -> DataFrame:
    """`best_records`, also for keys whose best record has no id.

    _mixed is the xor of all hashes of ids: of two records with one id it is zero.
    """
    payload = [F.struct(*columns).alias("payload")] if columns else []
    best = F.min(F.struct(*_rank(id_col), *payload))
    return (
        _counted(works, key, [id_col, *columns])
        .groupBy(_sortable(key), key)
        .agg(
            best.alias("best"),
            F.count(F.lit(1)).alias("copies"),
            F.bit_xor(F.xxhash64(id_col)).alias("_mixed"),
        )
        .select(
            key,
            F.col("best.id").alias(id_col),
            *[F.col(f"best.payload.{c}").alias(c) for c in columns],
            "copies",
            "_mixed",
        )
    )


def _repeated_winners(
    works: DataFrame, winners: Staged, key: str, id_col: str, broadcast_bytes: int
) -> DataFrame:
    """Keys whose best record shares its id with another record of the key.

    Only suspects of the ranking are looked at, on keys and ids; map tasks count before the shuffle.
    """
    pairs = works.select(key, F.col(id_col).alias("_keep"))
    suspects = winners.frame.filter("_suspect").select(key, "_keep")
    few = winners.fits(broadcast_bytes)
    if few:
        pairs = pairs.join(F.broadcast(suspects), [key, "_keep"], "left_semi")
    counted = pairs.groupBy(key, "_keep").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if not few:
        counted = counted.join(suspects, [key, "_keep"], "left_semi")
    return counted.select(key, F.lit(True).alias("_repeated"))


def dedup_works(
    works: DataFrame,
    key: str = "doi",
    id_col: str = "id",
    unique_ids: bool | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """All columns of the best record per key.

    Few keys have copies, so the wide rows stay where they are: the winners of the keys with
    copies (one narrow row per such key) are staged, measured and broadcast, and one pass over
    the works drops the losers. Too many such keys to broadcast: a shuffled join, salted for
    keys with many copies.

    That needs ids that do not repeat within a key. `unique_ids=True` promises it.
    `unique_ids=None` looks: the ranking tells which keys can have repeats, and only rows that
    share key and id with such a key's best record are ranked as wide rows. `unique_ids=False`
    ranks all wide rows directly, each map task first cutting its rows to one per key.
    """
    with_key = works.filter(F.col(key).isNotNull())
    rest = [c for c in works.columns if c != key]
    ranked = Window.partitionBy(_sortable(key), key).orderBy(*_rank(id_col))
    if unique_ids is False:
        return (
            _counted(works, key, rest)
            .withColumn("_rn", F.row_number().over(ranked))
            .filter((F.col("_rn") == 1) & F.col(id_col).isNotNull())
            .select(*works.columns)
        )

    copied = _winners(works, (), key, id_col).filter(F.col("copies") > 1)
    # Two records differ in their ids unless the hashes cancel out; more have to be looked at.
    suspect = (F.col("copies") > 2) | (F.col("_mixed") == 0)
    keep = [F.col(id_col).alias("_keep"), F.lit(True).alias("_copied"), suspect.alias("_suspect")]
    winners = stage(copied.select(key, *keep), "doi-winners", suspects=F.count_if("_suspect"))
    repeats = False
    if unique_ids is None and winners.seen["suspects"]:
        found = stage(
            _repeated_winners(with_key, winners, key, id_col, broadcast_bytes), "doi-repeats"
        )
        repeats = found.rows > 0
        if repeats:
            few = F.broadcast(found.frame) if found.fits(broadcast_bytes) else found.frame
            winners = stage(winners.frame.join(few, key, "left"), "doi-winners")
    side = winners.frame.drop("_suspect")
    if winners.fits(broadcast_bytes):
        joined = with_key.join(F.broadcast(side), key, "left")
    else:
        joined = salted_join(
            with_key, side, key, F.col(id_col), "left", rows_per_task, hash_right=True
        )
    single = F.col("_copied").isNull() & F.col(id_col).isNotNull()
    kept = joined.filter(single | (F.col(id_col) == F.col("_keep")))
    if not repeats:
        return kept.select(*works.columns)
    several = (
        _counted(kept.filter("_repeated"), key, rest)
        .withColumn("_rn", F.row_number().over(ranked))
        .filter("_rn = 1")
    )
    once = kept.filter(F.col("_repeated").isNull())
    return once.select(*works.columns).unionAll(several.select(*works.columns))
