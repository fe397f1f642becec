"""Spelling variants: words one edit apart, each with the far more frequent form it stands for.

Words become vectors of letter counts. One inserted or deleted letter gives vectors at L1
distance one, a replaced letter at most two. So for each length a k-d tree over the vectors of
its words answers range searches: of radius two by words of that length, of radius one by words
one letter shorter. A subtree is left out if its box lies farther away; candidates are kept if
their letters stand in the right order.

The upper part of each tree is fitted on a bounded sample of words and deals all words, as index
rows to one leaf and as queries to every leaf that their range touches. Inside a leaf, which
Spark groups, a tree over its own words goes on. A leaf with very many words or queries is cut
into blocks, each pair of which meets once.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.functions.staging import BROADCAST_BYTES, stage
from paperloom.llm.common import column, ship, written

LETTERS = "[a-zÀ-ÿ]+"  # of texts whose A-Z are in lower case
LEAST_LETTERS, LEAST_COUNT = 6, 5
MORE = 5  # times a word's own count that its form has at least
EVERY = 199  # runs whose check sum it divides lose a letter
SAMPLE_WORDS = 65_536  # on which the upper trees are fitted
LONGEST_SPLIT = 64  # letters; longer words of one length share a leaf
LEAF_WORDS = 4096  # expected in a leaf of the upper trees
BLOCK_WORDS, BLOCK_QUERIES = 8192, 131_072  # of a leaf that one task holds
SMALL_LEAF = 48  # words in a leaf of the tree inside a task
# a-z have a coordinate each, all other letters share six: distances can only become smaller.
COORDINATES = 32
_COORDINATE = np.array(
    [c - 97 if 97 <= c <= 122 else 26 + c % 6 for c in range(256)], np.uint8
)


# ---- words ----


def word_counts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """word, n: words of at least six letters that occur at least five times."""
    lowered = F.translate(column(text), ascii_uppercase, ascii_lowercase)
    runs = docs.select(
        F.coalesce(column(key).cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(lowered, F.lit(LETTERS), F.lit(0))).alias("run"),
    ).filter(F.length("run") >= LEAST_LETTERS)
    run, checksum = F.col("run"), F.crc32(F.concat_ws(":", "id", "run"))
    at = F.pmod(F.col("h"), F.length(run)).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    word = F.when(F.col("h") % EVERY == 0, shorter).otherwise(run)
    return (
        runs.withColumn("h", checksum)
        .select(word.alias("word"))
        .filter(F.length("word") >= LEAST_LETTERS)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= LEAST_COUNT)
    )


def letters_of(words: list[str], length: int) -> np.ndarray:
    """Words of one length as rows of letters."""
    joined = "".join(words).encode("latin-1")
    return np.frombuffer(joined, np.uint8).reshape(len(words), length)


def letter_counts(letters: np.ndarray) -> np.ndarray:
    counts = np.zeros((len(letters), COORDINATES), np.int32)
    rows = np.arange(len(letters))
    for place in _COORDINATE[letters].T:
        counts[rows, place] += 1
    return counts


# ---- k-d trees ----


class Tree:
    """Nodes with the boxes of what is below them; leaves hold numbers of points.

    `tight` boxes are those of the points given. The others are the regions into which the
    splits cut all space, so that every point falls into exactly one leaf.
    """

    def __init__(self, points: np.ndarray, most: int, tight: bool):
        self.low, self.high, self.below, self.members = [], [], [], []
        width = points.shape[1]
        self._grow(points, np.arange(len(points)), most, tight,
                   np.full(width, -1, np.int32), np.full(width, 2**30, np.int32))

    def _grow(self, points, rows, most, tight, low, high) -> None:
        waiting = [(rows, low, high, None)]
        while waiting:
            rows, low, high, above = waiting.pop()
            number = len(self.below)
            if above is not None:
                self.below[above].append(number)
            own = points[rows]
            self.low.append(own.min(axis=0) if tight and len(rows) else low)
            self.high.append(own.max(axis=0) if tight and len(rows) else high)
            self.below.append([])
            self.members.append(rows)
            if len(rows) <= most:
                continue
            axis = int(own.var(axis=0).argmax())
            values = own[:, axis]
            smallest, largest = values.min(), values.max()
            if smallest == largest:  # all points are equal
                continue
            cut = min(int(np.median(values)), int(largest) - 1)
            left_high, right_low = high.copy(), low.copy()
            left_high[axis], right_low[axis] = cut, cut + 1
            waiting.append((rows[values <= cut], low, left_high, number))
            waiting.append((rows[values > cut], right_low, high, number))
            self.members[number] = None

    def forget_points(self) -> Tree:
        """Only the boxes: what a task needs to deal words."""
        self.members = None
        return self

    def within(self, points: np.ndarray, radius: int):
        """Leaf, and the points whose L1 ball of this radius touches its box."""
        waiting = [(0, np.arange(len(points)))]
        while waiting:
            node, rows = waiting.pop()
            own = points[rows]
            distance = np.maximum(self.low[node] - own, 0).sum(axis=1)
            distance += np.maximum(own - self.high[node], 0).sum(axis=1)
            rows = rows[distance <= radius]
            if not len(rows):
                continue
            if self.below[node]:
                waiting.extend((child, rows) for child in self.below[node])
            else:
                yield node, rows


def _upper_trees(words: DataFrame, total: int) -> dict[int, Tree]:
    """By length a tree fitted on a sample of at most SAMPLE_WORDS words, chosen by their hash."""
    sample = (
        words.filter(F.length("word") <= LONGEST_SPLIT)
        .orderBy(F.xxhash64("word"), "word")
        .limit(SAMPLE_WORDS)
        .select("word")
        .toArrow()
        .column("word")
        .to_pylist()
    )
    most = max(8, LEAF_WORDS * len(sample) // max(1, total))
    by_length: dict[int, list[str]] = {}
    for word in sample:
        by_length.setdefault(len(word), []).append(word)
    return {
        length: Tree(letter_counts(letters_of(own, length)), most, tight=False).forget_points()
        for length, own in by_length.items()
        if len(own) > most
    }


_DEALT = "length int, leaf int, shorter int, word string, n long"


def _deal(trees: dict[int, Tree]):
    """Each word as index row of its leaf (shorter: -1) and as query of the leaves in range.

    A query has the number of letters it is shorter than the leaf's words: none or one.
    """

    def run(batches):
        for batch in batches:
            words, counts = batch.column("word"), batch.column("n")
            texts = words.to_pylist()
            rows_of: dict[int, list[int]] = {}
            for row, word in enumerate(texts):
                rows_of.setdefault(len(word), []).append(row)
            for length, rows in rows_of.items():
                vectors = letter_counts(letters_of([texts[r] for r in rows], length))
                for target, shorter, radius in ((length, -1, 0), (length, 0, 2), (length + 1, 1, 1)):
                    if target in trees:
                        hits = trees[target].within(vectors, radius)
                    else:
                        hits = [(0, np.arange(len(rows)))]
                    for leaf, own in hits:
                        taken = pa.array(np.array(rows)[own])
                        n = len(own)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(n, target, np.int32)),
                                pa.array(np.full(n, leaf, np.int32)),
                                pa.array(np.full(n, shorter, np.int32)),
                                words.take(taken),
                                counts.take(taken),
                            ],
                            ["length", "leaf", "shorter", "word", "n"],
                        )

    return run


# ---- inside a leaf ----


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def one_inserted(shorter: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """Do equal letters from the front and from the back make up the shorter words?"""
    front = np.logical_and.accumulate(shorter == longer[:, :-1], axis=1).sum(axis=1)
    back = np.logical_and.accumulate((shorter == longer[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return front + back >= shorter.shape[1]


def range_pairs(words: np.ndarray, queries: np.ndarray, radius: int, same_order) -> tuple:
    """Numbers of queries and of words that are one edit apart."""
    tree = Tree(vectors := letter_counts(words), SMALL_LEAF, tight=True)
    asked = letter_counts(queries)
    found_q, found_w = [], []
    for leaf, rows in tree.within(asked, radius):
        own = tree.members[leaf]
        for start in range(0, len(rows), step := max(1, (1 << 16) // len(own))):
            part = rows[start : start + step]
            distance = np.abs(asked[part][:, None, :] - vectors[own][None, :, :]).sum(axis=2)
            q, w = np.nonzero(distance <= radius)
            q, w = part[q], own[w]
            most = max(1, (1 << 24) // words.shape[1])
            for at in range(0, len(q), most):
                near = same_order(queries[q[at : at + most]], words[w[at : at + most]])
                found_q.append(q[at : at + most][near])
                found_w.append(w[at : at + most][near])
    if not found_q:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found_q), np.concatenate(found_w)


_PAIRS = "u string, n_u long, v string, n_v long"


def _search(group: pa.Table) -> pa.Table:
    length = group.column("length")[0].as_py()
    kind = group.column("shorter").to_numpy()
    words, counts = group.column("word").combine_chunks(), group.column("n").combine_chunks()
    index = np.flatnonzero(kind == -1)
    out = []
    for shorter, radius, same_order in ((0, 2, one_replaced), (1, 1, one_inserted)):
        asked = np.flatnonzero(kind == shorter)
        if not len(index) or not len(asked):
            continue
        own = letters_of(words.take(pa.array(index)).to_pylist(), length)
        queries = letters_of(words.take(pa.array(asked)).to_pylist(), length - shorter)
        q, w = range_pairs(own, queries, radius, same_order)
        if not shorter:  # both words of a pair ask; one answer is enough
            first = [bytes(a) < bytes(b) for a, b in zip(queries[q], own[w], strict=True)]
            q, w = q[np.array(first, bool)], w[np.array(first, bool)]
        u, v = pa.array(asked[q]), pa.array(index[w])
        out.append(
            pa.table([words.take(u), counts.take(u), words.take(v), counts.take(v)],
                     ["u", "n_u", "v", "n_v"])
        )
    schema = pa.schema([("u", words.type), ("n_u", pa.int64()), ("v", words.type), ("n_v", pa.int64())])
    return pa.concat_tables(out) if out else schema.empty_table()


def near_words(words: DataFrame) -> DataFrame:
    """u, n_u, v, n_v: each two words of the table (word, n) that are one edit apart, once."""
    total = words.count()
    dealt = written(words.mapInArrow(_deal(_upper_trees(words, total)), _DEALT), "dealt-words")
    is_index = F.col("shorter") == -1
    blocks = F.ceil(F.count_if(is_index) / BLOCK_WORDS).cast("int")
    parts = F.ceil(F.count_if(~is_index) / BLOCK_QUERIES).cast("int")
    large = (
        dealt.groupBy("length", "leaf")
        .agg(blocks.alias("blocks"), parts.alias("parts"))
        .filter("blocks > 1 OR parts > 1")
    )
    large = stage(large, "large-leaves")
    if large.rows:
        sizes = F.broadcast(large.frame) if large.fits(BROADCAST_BYTES) else large.frame
        one = lambda n: F.array(F.pmod(F.xxhash64("word"), F.coalesce(n, F.lit(1))).cast("int"))
        every = lambda n: F.sequence(F.lit(0), F.coalesce(n, F.lit(1)) - 1)
        n_blocks = F.greatest(F.col("blocks"), F.lit(1))
        n_parts = F.greatest(F.col("parts"), F.lit(1))
        dealt = (
            dealt.join(sizes, ["length", "leaf"], "left")
            .withColumn("block", F.explode(F.when(is_index, one(n_blocks)).otherwise(every(n_blocks))))
            .withColumn("part", F.explode(F.when(is_index, every(n_parts)).otherwise(one(n_parts))))
        )
    else:
        dealt = dealt.withColumns({"block": F.lit(0), "part": F.lit(0)})
    return dealt.groupBy("length", "leaf", "block", "part").applyInArrow(_search, _PAIRS)


def _roots(forms: DataFrame) -> DataFrame:
    """word, root: the end of each chain of forms, by doubling. Counts rise along a chain."""
    roots = written(forms.withColumnRenamed("form", "root"), "roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = written(
            roots.join(onward, "root", "left").select(
                "word",
                F.coalesce("next", "root").alias("root"),
                F.col("next").isNotNull().alias("moved"),
            ),
            "roots",
        )
        if longer.filter("moved").isEmpty():
            return roots
        roots = longer.drop("moved")


def spelling_variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """word, form, root, n, n_near and form_n of every frequent word of `docs`.

    Words are runs of letters (A-Z in lower case, a-z, U+00C0 to U+00FF) of whole texts, n how
    often they occur. A run loses the letter h % length if EVERY divides h, the CRC-32 of
    "<doc_id>:<run>", a null doc_id being empty. Words of fewer than six letters or five
    occurrences take no part. Two words are near if exactly one inserted, deleted or replaced
    letter tells them apart. A word's form is its most frequent near word (ties: the first in
    code-point order), if it occurs at least MORE times as often; root is the last word that
    following forms leads to. Null texts have no words; repeated rows count as often as they
    stand; other columns do not matter; an empty table gives an empty result.
    """
    ship(docs.sparkSession)
    words = written(word_counts(docs, key, text), "words")
    pairs = written(near_words(words), "near-words")
    both = pairs.select(F.col("u").alias("word"), F.col("n_v").alias("n"), F.col("v").alias("near"))
    both = both.unionByName(pairs.select(F.col("v").alias("word"), F.col("n_u").alias("n"), F.col("u").alias("near")))
    most = F.min(F.struct((-F.col("n")).alias("less"), F.col("near").alias("near")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), most.alias("best"))
    has_form = -F.col("best.less") >= MORE * F.col("n")
    formed = written(
        words.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(has_form, F.col("best.near")).alias("form"),
            F.when(has_form, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(formed.filter("form IS NOT NULL").select("word", "form"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
