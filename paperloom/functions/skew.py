"""Salting for join keys that hold a large share of one side.

`hot_keys` counts the rows per key on the side that may repeat keys. Keys above a row
limit get as many salts as they have multiples of that limit, so each (key, salt) pair holds
about `rows_per_task` rows whatever the share of the key. All other keys have one salt.
Nothing is dropped: a key that is not listed simply joins unsalted. Without hot keys the
join is a plain one.

Keys are compared by 64-bit hash here. A collision only salts a key that did not need it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.staging import BROADCAST_BYTES, stage

ROWS_PER_TASK = 200_000
SKETCH_KEYS, SKETCH_ITEMS = 10_000, 100_000  # of the sketch of frequent keys
SALT = "_salt"
_HASH = "_key_hash"
_SALTS = "_salts"


def hot_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame | None:
    """Hash and number of salts of every key with more than `rows_per_task` rows, if any.

    The result is staged, so both sides of a join share one count. Its size is measured: it is
    broadcast below `BROADCAST_BYTES`, and joined like any other table beyond.
    """
    hot = (
        df.select(F.xxhash64(key).alias(_HASH))
        .groupBy(_HASH)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > rows_per_task)
        .select(_HASH, F.ceil(F.col("_n") / rows_per_task).cast("int").alias(_SALTS))
    )
    staged = stage(hot, "hot-keys")
    if staged.rows == 0:
        return None
    return F.broadcast(staged.frame) if staged.fits(BROADCAST_BYTES) else staged.frame


def staged_with_hot_keys(
    df: DataFrame, key: str, label: str, rows_per_task: int = ROWS_PER_TASK
) -> tuple[DataFrame, DataFrame | None]:
    """A narrow frame, written, and `hot_keys` of it, sketched during the write.

    The frame is evaluated once. The sketch of frequent items is merged from those of the tasks;
    it holds every key above the limit as long as the limit is a small multiple of rows /
    SKETCH_ITEMS, and its counts, which decide the number of salts only, may be somewhat high or
    low. Beyond that keys are counted exactly on the written frame.
    """
    sketch = F.expr(f"approx_top_k(xxhash64(`{key}`), {SKETCH_KEYS}, {SKETCH_ITEMS})")
    staged = stage(df, label, top=sketch)
    if not staged.rows:
        return staged.frame, None
    if staged.rows > SKETCH_KEYS * rows_per_task or staged.rows * 4 > SKETCH_ITEMS * rows_per_task:
        return staged.frame, hot_keys(staged.frame, key, rows_per_task)
    hot = [
        (top["item"], -(-top["count"] // rows_per_task))
        for top in staged.seen["top"]
        if top["count"] > rows_per_task
    ]
    if not hot:
        return staged.frame, None
    listed = df.sparkSession.createDataFrame(hot, f"{_HASH} long, {_SALTS} int")
    return staged.frame, F.broadcast(listed)  # at most SKETCH_KEYS rows


def _with_salts(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    hashed = df.withColumn(_HASH, F.xxhash64(key))
    return hashed.join(hot, _HASH, "left").withColumn(
        _SALTS, F.coalesce(_SALTS, F.lit(1))
    )


def spread(df: DataFrame, key: str, row_id: Column, hot: DataFrame) -> DataFrame:
    """Give each row of the repeating side one salt, chosen by `row_id`."""
    salt = F.pmod(F.xxhash64(row_id), F.col(_SALTS).cast("bigint")).cast("int")
    return _with_salts(df, key, hot).withColumn(SALT, salt).drop(_HASH, _SALTS)


def replicate(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Repeat each row of the other side once per salt of its key."""
    salts = F.sequence(F.lit(0), F.col(_SALTS) - 1)
    return _with_salts(df, key, hot).withColumn(SALT, F.explode(salts)).drop(_HASH, _SALTS)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    row_id: Column,
    how: str = "inner",
    rows_per_task: int = ROWS_PER_TASK,
    hash_right: bool = False,
) -> DataFrame:
    """Equi-join on `key` where keys may repeat on the left (inner or left joins only).

    `hash_right` builds hash tables from a narrow right side, so a wide left side is shuffled
    but not sorted.
    """
    hot, keys = hot_keys(left, key, rows_per_task), [key]
    if hot is not None:
        left, right = spread(left, key, row_id, hot), replicate(right, key, hot)
        keys.append(SALT)
    if hash_right:
        right = right.hint("shuffle_hash")
    return left.join(right, keys, how).drop(SALT)
