"""Benchmark decontamination: pieces found exactly, items verified with Myers' algorithm.

An item that stands in a text with at most k edits contains at least one of its k + 1 pieces
unchanged. Pieces are looked up by the hash of their first words, for all places of all texts at
once; places found are verified with the bit-parallel edit distance, on words. Items come in
blocks of a bounded number, so what a task holds does not grow with the benchmark; texts stay
where they are.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.llm.common import batch_slices, column, ship, utf8_values
from paperloom.llm.words import inside, texts_to_words, windows

ERROR_RATE = 0.2  # edits per word of the item
PIECE_WORDS = 4  # a piece has at least so many words
BLOCK_ITEMS = 20_000

# ASCII letters in lower case; other ASCII characters but digits separate words.
PLAIN = bytes(
    b
    if b >= 128 or chr(b).isdigit() or chr(b).islower()
    else ord(chr(b).lower())
    if chr(b).isupper()
    else 32
    for b in range(256)
)

MATCHES = "array<struct<item_id: bigint, errors: int>>"
_MATCH_TYPE = pa.list_(pa.struct([("item_id", pa.int64()), ("errors", pa.int32())]))


def error_budget(n_words: int, rate: float = ERROR_RATE) -> int:
    """Edits allowed: `rate` of the words, but so that every piece keeps PIECE_WORDS words."""
    return max(0, min(int(n_words * rate), n_words // PIECE_WORDS - 1))


def pieces(n_words: int, errors: int) -> list[int]:
    """Where the `errors` + 1 pieces of an item begin."""
    return [i * n_words // (errors + 1) for i in range(errors + 1)]


def nearest(pattern: np.ndarray, text: np.ndarray) -> int:
    """Fewest edits between the pattern and any part of the text (Myers 1999, one big word)."""
    n = len(pattern)
    places: dict[int, int] = defaultdict(int)
    for i, word in enumerate(pattern.tolist()):
        places[word] |= 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    up, down, errors, best = full, 0, n, n
    for word in text.tolist():
        same = places.get(word, 0)
        diagonal = (((same & up) + up) ^ up) | same | down
        right_up = down | ~(diagonal | up) & full
        right_down = up & diagonal
        if right_up & top:
            errors += 1
        elif right_down & top:
            errors -= 1
        right_up = (right_up << 1) & full  # a match may begin anywhere
        right_down = (right_down << 1) & full
        up = right_down | ~(diagonal | right_up) & full
        down = right_up & diagonal
        best = min(best, errors)
    return best


class Items:
    """One block of items, by the hashes of their pieces."""

    def __init__(self, rows: list[tuple[int, str]], rate: float):
        self.ids = [item for item, _ in rows]
        hashes, ends = texts_to_words([text.encode() for _, text in rows], PLAIN)
        self.words = [hashes[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        self.budget = [error_budget(len(w), rate) for w in self.words]
        found: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.short: dict[bytes, list[int]] = defaultdict(list)
        for i, (words, budget) in enumerate(zip(self.words, self.budget, strict=True)):
            if len(words) < PIECE_WORDS:
                if len(words):
                    self.short[words.tobytes()].append(i)
                continue
            hashed = windows(words, PIECE_WORDS)
            for start in pieces(len(words), budget):
                found[int(hashed[start])].append((i, start))
        self.at = dict(found)
        self.keys = np.array(sorted(found), np.uint64)
        # Most places fail at this bitmap, which fits the processor's cache.
        self.some = np.zeros(1 << 20, bool)
        self.some[(self.keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def hits(self, hashed: np.ndarray) -> np.ndarray:
        """Places whose window begins a piece."""
        if not len(self.keys):
            return np.zeros(0, np.int64)
        maybe = np.flatnonzero(self.some[(hashed & np.uint64((1 << 20) - 1)).astype(np.int64)])
        values = hashed[maybe]
        near = np.minimum(np.searchsorted(self.keys, values), len(self.keys) - 1)
        return maybe[self.keys[near] == values]

    def matches(self, texts: list[bytes]) -> list[list[tuple[int, int]]]:
        """For each text the items found in it, with the edits of the best match."""
        words, ends = texts_to_words(texts, PLAIN)
        hashed = windows(words, PIECE_WORDS)
        places = self.hits(hashed)
        places = places[inside(ends, PIECE_WORDS, len(hashed))[places]]
        owner = np.searchsorted(ends, places, "right") - 1
        best: list[dict[int, int]] = [{} for _ in texts]
        tried: set[tuple[int, int, int]] = set()
        for place, text in zip(places.tolist(), owner.tolist(), strict=True):
            for item, start in self.at[int(hashed[place])]:
                begin = place - start
                known = best[text]
                if known.get(item) == 0 or (text, item, begin) in tried:
                    continue
                tried.add((text, item, begin))
                budget, size = self.budget[item], len(self.words[item])
                low = max(int(ends[text]), begin - budget)
                high = min(int(ends[text + 1]), begin + size + budget)
                errors = nearest(self.words[item], words[low:high])
                if errors <= budget:
                    known[item] = min(errors, known.get(item, errors))
        if self.short:
            for text, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
                if b - a < PIECE_WORDS:
                    best[text].update(dict.fromkeys(self.short.get(words[a:b].tobytes(), ()), 0))
        return [sorted((self.ids[i], e) for i, e in found.items()) for found in best]


def _blocks(items: DataFrame, block_items: int):
    """Blocks of (item_id, text), one at a time."""
    rows = items.select(
        column("item_id").cast("long").alias("item_id"), column("text").alias("text")
    ).filter("item_id IS NOT NULL AND text IS NOT NULL")
    n = max(1, -(-rows.count() // block_items))
    # Items are dealt by hash; a block is a few thousand rows more or less than asked for.
    for i in range(n):
        block = rows if n == 1 else rows.filter(F.pmod(F.xxhash64("item_id"), F.lit(n)) == i)
        yield [tuple(r) for r in block.distinct().collect()]


def find_items(
    docs: DataFrame,
    items: DataFrame,
    rate: float = ERROR_RATE,
    text: str = "text",
    block_items: int = BLOCK_ITEMS,
) -> DataFrame:
    """`docs` with a column benchmark_matches: items found in the text, with their edits.

    An item is found if some part of the text differs from it by at most `error_budget` edits,
    an edit being a word too many, missing or replaced. Words are compared without ASCII case
    and ASCII punctuation. An item of under PIECE_WORDS words is no passage: it is found only
    where it is the whole text. Items without text or id, or without words, are found nowhere;
    null and empty texts contain nothing. All rows and columns are kept.
    """
    ship(docs.sparkSession)
    name = "benchmark_matches"
    docs = docs.drop(name)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T._parse_datatype_string(MATCHES))])
    at = docs.columns.index(text)
    out = docs.withColumn(name, F.array().cast(MATCHES))
    for block in _blocks(items, block_items):

        def run(batches, block=block):
            known = Items(block, rate)
            for part in batch_slices(batches, at):
                found = known.matches(utf8_values(part.column(at)))
                before = part.column(part.num_columns - 1)
                if any(found):
                    both = [
                        [*b, *({"item_id": i, "errors": e} for i, e in f)]
                        for b, f in zip(before.to_pylist(), found, strict=True)
                    ]
                    before = pa.array(both, _MATCH_TYPE)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], before], part.schema.names)

        out = out.mapInArrow(run, schema)
    return out


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """`docs` without the rows in whose text an item is found; see `find_items`."""
    found = find_items(docs, items, **options)
    return found.filter(F.size("benchmark_matches") == 0).drop("benchmark_matches")
