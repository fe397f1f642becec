"""Hard negatives by a GNAT-style tree: rows whose score falls into a window below a positive's.

Scores are integer inner products. With one more coordinate all rows get the same length, so that
the rows of a score lie on a sphere around the query, and a window of scores is an annulus. A node
of the tree has several split points; each row belongs to the nearest. For every split point the
node keeps the range of its distances to the rows below each of them. A subtree is left out if for
any split point the ranges and the query's own distance leave no room for the annulus.

The upper tree is fitted on a bounded sample; its ranges come from all rows. Its leaves are cells,
which Spark groups, in blocks of bounded size; a block builds a tree of its own and compares
exactly in the leaves. Queries first ask in their own cell, whose answers narrow the window, then
in all cells that the rest of the window touches. Queries move to the rows: a block of rows is
sent once for each block of queries that asks there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.llm.common import column, ship, written

SCALE = 256  # components become floor(SCALE * x)
SAMPLE_ROWS = 16_384  # on which the upper tree is fitted
SPLIT_POINTS = 12  # of a node
CELL_ROWS = 8192  # expected in a cell, and the most in a block
BLOCK_QUERIES = 8192
LEAF_ROWS = 64
SMALLEST_CELL = 8  # sampled rows, so that the sample bounds the number of cells
LOWEST = -(2**62)  # below all scores
_KEYS = ["dim", "cell", "block", "part"]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def lifted(x: np.ndarray, square: float) -> np.ndarray:
    """Rows with one more coordinate, which brings their squared length to `square`."""
    x = x.astype(np.float64)
    rest = np.sqrt(np.maximum(square - (x * x).sum(axis=1), 0))
    return np.column_stack([x, rest])


def asking(x: np.ndarray) -> np.ndarray:
    """Queries have zero there: inner products stay what they are."""
    return np.column_stack([x.astype(np.float64), np.zeros(len(x))])


class Gnat:
    """Nodes with split points, ranges of distances and children; leaves hold row numbers."""

    def __init__(self, points: np.ndarray, most: int):
        self.centres, self.children, self.low, self.high, self.members = [], [], [], [], []
        waiting = [(np.arange(len(points)), None, 0)]
        while waiting:
            rows, above, at = waiting.pop()
            number = len(self.centres)
            if above is not None:
                self.children[above][at] = number
            centres = self._split_points(points[rows]) if len(rows) > most else None
            leaf = centres is None or len(centres) < 2
            self.centres.append(None if leaf else centres)
            self.children.append([] if leaf else [0] * len(centres))
            self.members.append(rows if leaf else None)
            self.low.append(None)
            self.high.append(None)
            if leaf:
                continue
            away = distances(points[rows], centres)
            self.forget_ranges(number)
            nearest = away.argmin(axis=1)
            self.widen(number, away, nearest)
            waiting.extend((rows[nearest == j], number, j) for j in range(len(centres)))

    @staticmethod
    def _split_points(points: np.ndarray) -> np.ndarray:
        """Different points far from each other, picked greedily among a few."""
        few = points[np.linspace(0, len(points) - 1, min(len(points), 8 * SPLIT_POINTS)).astype(int)]
        few = np.unique(few, axis=0) if len(few) == len(points) else np.unique(
            np.concatenate([few, points[(points != points[0]).any(axis=1)][:1]]), axis=0
        )
        chosen = [0]
        away = distances(few, few[:1])[:, 0]
        while len(chosen) < min(SPLIT_POINTS, len(few)):
            chosen.append(int(away.argmax()))
            away = np.minimum(away, distances(few, few[chosen[-1:]])[:, 0])
        return np.unique(few[chosen], axis=0)

    def forget_ranges(self, node: int) -> None:
        n = len(self.centres[node])
        self.low[node], self.high[node] = np.full((n, n), np.inf), np.full((n, n), -np.inf)

    def widen(self, node: int, away: np.ndarray, child: np.ndarray) -> None:
        """Take the distances of these rows into the ranges from point i to child j."""
        for j in np.unique(child):
            own = away[child == j]
            self.low[node][:, j] = np.minimum(self.low[node][:, j], own.min(axis=0))
            self.high[node][:, j] = np.maximum(self.high[node][:, j], own.max(axis=0))

    def leaf_of(self, points: np.ndarray, seen=None) -> np.ndarray:
        """The leaf of each point; `seen` gets node, distances and children on the way."""
        leaf = np.zeros(len(points), np.int32)
        waiting = [(0, np.arange(len(points)))]
        while waiting:
            node, rows = waiting.pop()
            if self.centres[node] is None or not len(rows):
                leaf[rows] = node
                continue
            away = distances(points[rows], self.centres[node])
            nearest = away.argmin(axis=1)
            if seen:
                seen(node, away, nearest)
            waiting.extend((c, rows[nearest == j]) for j, c in enumerate(self.children[node]))
        return leaf

    def annulus(self, points: np.ndarray, near: np.ndarray, far: np.ndarray, slack: float):
        """Leaf, and the queries whose annulus may hold rows of it; `far` may shrink meanwhile."""
        waiting = [(0, np.arange(len(points)))]
        while waiting:
            node, rows = waiting.pop()
            if self.centres[node] is None:
                yield node, rows
                continue
            away = distances(points[rows], self.centres[node])
            for j in np.argsort(-away.mean(axis=0)):  # the nearest child comes first
                low, high = self.low[node][:, j], self.high[node][:, j]
                least = np.maximum(low - away, away - high).max(axis=1)
                most = (away + high).min(axis=1)
                alive = (least <= far[rows] + slack) & (most >= near[rows] - slack)
                if alive.any():
                    waiting.append((self.children[node][j], rows[alive]))


def window_radii(queries: np.ndarray, low: np.ndarray, high: np.ndarray, square: float):
    """Nearest and farthest distance of rows with scores from low to high."""
    own = (queries.astype(np.float64) ** 2).sum(axis=1) + square
    far = np.sqrt(np.maximum(own - 2.0 * low, 0))
    near = np.sqrt(np.maximum(own - 2.0 * np.minimum(high, square + own), 0))
    return near, far


def slack_of(square: float) -> float:
    """More than rounding can change a distance."""
    return 1e-5 * np.sqrt(square) + 1e-9


def best_in_window(rows, ids, labels, queries, own, own_labels, low, high, same, k, square):
    """For each query the ids and scores of its first k rows within its window; -1 where none is.

    Higher scores come first, ties by smaller id. Rows of the query's own id take no part; `same`
    says for each query whether rows of its own label are wanted, or those of all others.
    """
    exact = np.float64 if square < 2**53 else np.int64
    values, asked = rows.astype(exact), queries.astype(exact)
    best = np.full((len(queries), k), LOWEST, exact)
    best_id = np.full((len(queries), k), -1, np.int64)
    near, far = window_radii(queries, low, high, square)
    tree = Gnat(lifted(rows, square), LEAF_ROWS)
    for leaf, who in tree.annulus(asking(queries), near, far, slack_of(square)):
        members = tree.members[leaf]
        scores = asked[who] @ values[members].T
        fits = (scores >= np.maximum(low[who], best[who, -1])[:, None]) & (scores <= high[who, None])
        fits &= ids[members][None, :] != own[who, None]
        fits &= (labels[members][None, :] == own_labels[who, None]) == same[who, None]
        some = fits.any(axis=1)
        who, scores, fits = who[some], scores[some], fits[some]
        if not len(who):
            continue
        scores = np.concatenate([best[who], np.where(fits, scores, LOWEST)], axis=1)
        names = np.concatenate([best_id[who], np.where(fits, ids[members][None, :], -1)], axis=1)
        order = np.lexsort((names, -scores), axis=1)[:, :k]
        best[who] = np.take_along_axis(scores, order, axis=1)
        best_id[who] = np.take_along_axis(names, order, axis=1)
        full = best[who, -1] > LOWEST
        _, narrower = window_radii(queries[who], best[who, -1], high[who], square)
        far[who] = np.where(full, np.minimum(far[who], narrower), far[who])
    return np.where(best > LOWEST, best, 0), best_id, best > LOWEST


# ---- in Spark ----


def _matrix(values, dim: int) -> np.ndarray:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    return values.flatten().to_numpy(False).reshape(-1, dim)


def _by_dim(batch: pa.RecordBatch):
    """dim, rows and matrix for each length of vector in the batch."""
    dims = batch.column("dim").to_numpy(False)
    for dim in np.unique(dims).tolist():
        part = batch.filter(pa.array(dims == dim))
        yield dim, part, _matrix(part.column("vector"), dim)


def _ranges(trees: dict[int, Gnat], square: float):
    """Ranges of the rows of a task, for all nodes."""

    def run(batches):
        for tree in trees.values():
            for node, centres in enumerate(tree.centres):
                if centres is not None:
                    tree.forget_ranges(node)
        for batch in batches:
            for dim, _, x in _by_dim(batch):
                if dim in trees:
                    trees[dim].leaf_of(lifted(x, square), trees[dim].widen)
        for dim, tree in trees.items():
            for node, centres in enumerate(tree.centres):
                if centres is None:
                    continue
                n = len(centres)
                i, j = np.indices((n, n)).reshape(2, -1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n * n, dim, np.int32)),
                        pa.array(np.full(n * n, node, np.int32)),
                        pa.array(i.astype(np.int32)),
                        pa.array(j.astype(np.int32)),
                        pa.array(tree.low[node].ravel()),
                        pa.array(tree.high[node].ravel()),
                    ],
                    ["dim", "node", "i", "j", "low", "high"],
                )

    return run


def _upper_trees(rows: DataFrame, total: int, square: float) -> dict[int, Gnat]:
    """For each length of vectors a tree of a sample of all rows, with the ranges of all rows."""
    sample = (
        rows.orderBy(F.xxhash64("vec_id", "label", "vector"))
        .limit(SAMPLE_ROWS)
        .select("dim", "vector")
        .toArrow()
        .combine_chunks()
        .to_batches()
    )
    most = max(SMALLEST_CELL, CELL_ROWS * SAMPLE_ROWS // max(1, total))
    trees = {}
    for batch in sample:
        for dim, _, x in _by_dim(batch):
            tree = Gnat(lifted(x, square), most)
            if tree.centres[0] is not None:
                tree.members = None
                trees[dim] = tree
    if trees:
        schema = "dim int, node int, i int, j int, low double, high double"
        seen = rows.select("dim", "vector").mapInArrow(_ranges(trees, square), schema)
        seen = seen.groupBy("dim", "node", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        for r in seen.toLocalIterator():  # at most SPLIT_POINTS numbers for each cell
            trees[r.dim].low[r.node][r.i, r.j], trees[r.dim].high[r.node][r.i, r.j] = r.low, r.high
    return trees


def _to_cells(trees: dict[int, Gnat], square: float, home: bool | None):
    """Rows with their cell; queries with that of their own (`home`) or all that they touch."""

    def run(batches):
        for batch in batches:
            for dim, part, x in _by_dim(batch):
                tree = trees.get(dim)
                if tree is None:
                    hits = [(0, np.arange(len(x)))]
                elif home is None or home:
                    points = lifted(x, square) if home is None else asking(x)
                    leaf = tree.leaf_of(points)
                    hits = [(c, np.flatnonzero(leaf == c)) for c in np.unique(leaf).tolist()]
                else:
                    low, high = part.column("low").to_numpy(), part.column("high").to_numpy()
                    near, far = window_radii(x, low, high, square)
                    hits = tree.annulus(asking(x), near, far, slack_of(square))
                for cell, own in hits:
                    yield part.take(pa.array(own)).append_column(
                        "cell", pa.array(np.full(len(own), cell, np.int32))
                    )

    return run


_QUERY = "q long, own long, label long, same boolean, low long, high long, dim int, vector array<long>"
_ROW = "vec_id long, label long, dim int, vector array<long>"


def _search(k: int, square: float):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not rows.num_rows or not queries.num_rows:
            empty = pa.array([], pa.int64())
            return pa.table({"q": empty, "found": empty, "score": empty})
        dim = rows.column("dim")[0].as_py()
        at = lambda t, n: t.column(n).to_numpy()
        scores, ids, real = best_in_window(
            _matrix(rows.column("vector"), dim), at(rows, "vec_id"), at(rows, "label"),
            _matrix(queries.column("vector"), dim), at(queries, "own"), at(queries, "label"),
            at(queries, "low"), at(queries, "high"), at(queries, "same").astype(bool), k, square,
        )
        who = np.repeat(at(queries, "q"), real.sum(axis=1))
        return pa.table({"q": who, "found": ids[real], "score": scores[real].astype(np.int64)})

    return run


class Index:
    """Rows dealt to cells, and what is needed to ask them."""

    def __init__(self, rows: DataFrame, total: int, square: float):
        self.square = square
        self.trees = _upper_trees(rows, total, square)
        dealt = rows.mapInArrow(_to_cells(self.trees, square, None), f"{_ROW}, cell int")
        self.rows = written(dealt, "cells")
        blocks = F.ceil(F.count(F.lit(1)) / CELL_ROWS).cast("int")
        # As many rows as there are cells, which the sample bounds.
        self.cells = written(self.rows.groupBy("dim", "cell").agg(blocks.alias("blocks")), "blocks")

    def first(self, queries: DataFrame, k: int, home: bool) -> DataFrame:
        """q, found, score and rank: the first k rows of each query in its window."""
        deal = _to_cells(self.trees, self.square, home)
        asked = written(queries.mapInArrow(deal, f"{_QUERY}, cell int"), "asked")
        parts = F.ceil(F.count(F.lit(1)) / BLOCK_QUERIES).cast("int")
        sizes = self.cells.join(asked.groupBy("dim", "cell").agg(parts.alias("parts")), ["dim", "cell"])
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        one = lambda n, *by: F.pmod(F.xxhash64(*by), F.col(n)).cast("int")
        rows = (
            self.rows.join(F.broadcast(sizes), ["dim", "cell"])
            .withColumn("block", one("blocks", "vec_id", "vector"))
            .withColumn("part", every("parts"))
            .drop("blocks", "parts")
        )
        asked = (
            asked.join(F.broadcast(sizes), ["dim", "cell"])
            .withColumn("block", one("blocks", "q") if home else every("blocks"))
            .withColumn("part", one("parts", "q"))
            .drop("blocks", "parts")
        )
        found = (
            rows.groupBy(*_KEYS)
            .cogroup(asked.groupBy(*_KEYS))
            .applyInArrow(_search(k, self.square), "q long, found long, score long")
        )
        order = Window.partitionBy("q").orderBy(F.desc("score"), "found")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    def first_of_all(self, queries: DataFrame, k: int) -> DataFrame:
        """The same over all cells, after the home cell's answers have narrowed the windows."""
        near = self.first(queries, k, home=True).filter(F.col("rank") == k)
        near = near.select("q", F.col("score").alias("floor"))
        narrowed = queries.join(near, "q", "left").withColumn("low", F.greatest("low", F.coalesce("floor", "low")))
        return self.first(written(narrowed.drop("floor").select(*queries.columns), "narrowed"), k, home=False)


def _clean(vectors: DataFrame, vec_id: str, embedding: str, label: str) -> DataFrame:
    x = column(embedding)
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(x, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")))
    mark = column(label).cast("long")
    moved = F.when(column(vec_id) % 7 == 0, F.pmod(mark + 1, F.lit(10))).otherwise(mark)
    return (
        vectors.filter(column(vec_id).isNotNull() & column(label).isNotNull() & x.isNotNull() & (F.size(x) > 0) & fine)
        .select(
            column(vec_id).cast("long").alias("vec_id"),
            moved.alias("label"),
            F.size(x).alias("dim"),
            whole.alias("vector"),
        )
        .distinct()
    )


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    k: int = 5,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Components become floor(256 * x); a score is the integer inner product. An anchor's positives
    are its first k other rows of its label, by score and then by id; for each of them the first
    k rows of other labels are returned whose score is at most the positive's and at least four
    fifths of it. `is_anchor` is a column over vec_id. Where 7 divides vec_id, the label first
    becomes (label + 1) % 10.

    Rows without id, label or vector, with an empty vector or with a null or non-finite component
    take no part. An exact repetition of a row counts once; rows of one id that differ are rows of
    their own, but never each other's positives or negatives. Vectors are compared with those of
    their own dimension. A table whose scores could reach 2^62 is an error. Results are exact:
    what the tree leaves out cannot be in the window. Other columns do not matter; an empty table
    gives an empty result.
    """
    ship(vectors.sparkSession)
    clean = written(_clean(vectors, vec_id, embedding, label), "clean-vectors")
    # Of equal vectors of one label only the smallest ids can be among the first k.
    copies = Window.partitionBy("vector", "label").orderBy("vec_id")
    rows = clean.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= k + 1)
    rows = written(rows.drop("copy"), "vectors")
    length = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    total, square = rows.agg(F.count(F.lit(1)), F.max(length)).first()
    square = float(square or 1.0) or 1.0
    if square >= 2**62:
        raise ArithmeticError("components are too large for inner products of 64 bits")
    index = Index(rows.select("vec_id", "label", "dim", "vector"), total, square)

    def asks(rows: DataFrame, same: bool, low, high) -> DataFrame:
        return rows.select(
            F.monotonically_increasing_id().alias("q"),
            F.col("vec_id").alias("own"),
            "label",
            F.lit(same).alias("same"),
            low.cast("long").alias("low"),
            high.cast("long").alias("high"),
            "dim",
            "vector",
            *[c for c in rows.columns if c.startswith("positive_")],
        )

    bound = F.lit(-LOWEST)
    anchors = written(asks(clean.filter(is_anchor), True, -bound + 1, bound), "anchors")
    positives = index.first_of_all(anchors, k).select(
        "q", F.col("found").alias("positive_id"), F.col("score").alias("positive_score")
    )
    # Below zero no score is at least four fifths of the positive's and not above it.
    pairs = anchors.join(positives.filter("positive_score >= 0"), "q").withColumnRenamed("own", "vec_id")
    four_fifths = F.expr("positive_score - positive_score DIV 5")
    pairs = written(asks(pairs, False, four_fifths, F.col("positive_score")), "positives")
    found = index.first_of_all(pairs.drop("positive_id", "positive_score"), k)
    return found.join(pairs, "q").select(
        F.col("own").alias("anchor_id"),
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("found").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


SQL = """
WITH clean AS (
  SELECT DISTINCT vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    list_inner_product(a.v, b.v)::BIGINT AS score
  FROM clean a JOIN clean b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, positive_id,
  row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)::INTEGER AS rank,
  other_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same
WHERE 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) <= 5
"""
