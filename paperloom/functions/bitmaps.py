"""Membership in sets of ids, tested in place beside a large table.

Ids become words: 64 neighbouring ids are the bits of one number, one number for each set. A word
has 16 bytes where a hash table of ids needs dozens for each id, whether the ids lie close
together (64 to a word) or far apart. Words of a set too large to broadcast one row each are packed,
about 32 to a row, by the hash of their number; only beyond that are both sides shuffled.

Whole numbers are handled like that. Keys of other types are words of their own with one bit.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.functions.staging import stage

PACKED = 32  # words to a row, about
_PACKED_ROW_BYTES = 192  # of a row beside its words: two or more lists in a hash table
_WORD, _BITS, _AT = "_word", "_bits_", "_at"


def _split(df: DataFrame, key: str) -> tuple[Column, Column]:
    """Number of a key's word, and its bit there."""
    if isinstance(df.schema[key].dataType, T.IntegralType):
        whole = F.col(key).cast("bigint")
        return F.shiftright(whole, 6), whole.bitwiseAND(F.lit(63)).cast("int")
    return F.col(key), F.lit(0)


def _words(sets: Mapping[str, DataFrame], key: str) -> DataFrame:
    """One row for each word that any of the sets has: the ids of all sets are merged here."""
    tagged = []
    for name, ids in sets.items():
        word, bit = _split(ids, key)
        marks = [F.lit(name == other).alias(_BITS + other) for other in sets]
        tagged.append(ids.filter(F.col(key).isNotNull()).select(word.alias(_WORD), bit.alias(_AT), *marks))
    bit = F.expr(f"shiftleft(1L, {_AT})")
    bits = [
        F.coalesce(F.bit_or(F.when(F.col(_BITS + name), bit)), F.lit(0).cast("bigint")).alias(_BITS + name)
        for name in sets
    ]
    return reduce(DataFrame.unionAll, tagged).groupBy(_WORD).agg(*bits)


def with_membership(
    df: DataFrame, sets: Mapping[str, DataFrame], key: str, prefix: str, broadcast_bytes: int
) -> DataFrame:
    """`df` with a boolean column `prefix + name` for each set: does it hold the row's key?

    The words are staged and measured. They are broadcast as they are or packed, whichever fits
    `broadcast_bytes`, and `df` stays in place; else it is joined with them by two plain
    exchanges, the shape in which adaptive execution splits a skewed partition. A null key is in
    no set.
    """
    staged = stage(_words(sets, key), "id-words")
    number = _WORD
    while number in df.columns:
        number += "_"
    side = staged.frame.withColumnRenamed(_WORD, number)
    word, bit = _split(df, key)
    bits = [F.col(_BITS + name) for name in sets]
    rows = max(1, -(-staged.rows // PACKED))
    whole = isinstance(df.schema[key].dataType, T.IntegralType)
    packed_bytes = staged.rows * 8 * (1 + len(sets)) + rows * _PACKED_ROW_BYTES
    if whole and not staged.fits(broadcast_bytes) and packed_bytes <= broadcast_bytes:
        at = number + _AT
        packed = (
            side.groupBy(F.pmod(F.xxhash64(number), F.lit(rows)).alias(at))
            .agg(F.collect_list(F.struct(number, *bits)).alias("words"))
            .select(at, *[F.col(f"words.{c}").alias(c) for c in (number, *(_BITS + n for n in sets))])
        )
        joined = df.withColumn(at, F.pmod(F.xxhash64(word), F.lit(rows))).join(F.broadcast(packed), at, "left")
        place = F.array_position(number, word).cast("int") - 1  # -1: not there
        bits = [F.when(place >= 0, F.get(b, place)) for b in bits]
    else:
        side = F.broadcast(side) if staged.fits(broadcast_bytes) else side
        joined = df.withColumn(number, word).join(side, number, "left")
    found = {
        prefix + name: F.coalesce(F.getbit(b, bit) == 1, F.lit(False))
        for name, b in zip(sets, bits, strict=True)
    }
    return joined.select(*[f"`{c}`" for c in df.columns], *[c.alias(n) for n, c in found.items()])
