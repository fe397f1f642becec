"""Hard negatives against SQL and a brute-force version."""

import math
import random

import numpy as np
import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

from paperloom.llm import negatives
from paperloom.llm.queries import ORACLE, QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int, q string, cell int"


def mined(frame):
    return negatives.hard_negatives(frame, F.pmod(F.col("vec_id"), F.lit(100)) == 0)


def expected(rows, k=5):
    clean = set()
    for i, v, label, *_ in rows:
        if i is None or not v or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        clean.add((i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * x) for x in v)))
    out = []
    for i, label, v in clean:
        if i % 100:
            continue
        scored = [(-sum(map(int.__mul__, v, w)), j, m) for j, m, w in clean if j != i and len(w) == len(v)]
        scored.sort()
        for p, j, _ in [s for s in scored if s[2] == label][:k]:
            found = [s for s in scored if s[2] != label and -80 * p <= -100 * s[0] <= -100 * p][:k]
            out += [(i, j, r + 1, s[1], -p, -s[0]) for r, s in enumerate(found)]
    return sorted(out)


def collected(frame):
    return sorted(tuple(r) for r in frame.collect())


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.1"])
def test_query_equals_sql(spark, folder):
    folder = f"/root/testdata/{folder}"
    name = "op12_hard_negatives"
    assert compare(spark, connect(folder), QUERIES[name], ORACLE[name], folder) is None


def table(n, dims=6):
    pick = random.Random(n)
    centres = [[pick.gauss(0, 1) for _ in range(dims)] for _ in range(8)]
    rows = []
    for i in range(n):
        centre = pick.choice(centres)
        rows.append((i * 10, [x + pick.gauss(0, 0.2) for x in centre], pick.randrange(10), "mine", 1))
    rows += [(5_000 + i, rows[0][1], i % 3, None, None) for i in range(60)]  # one vector, many rows
    rows += [(i * 100, [0.0] * dims, 1, None, None) for i in range(3)]  # another row of the same id
    rows += [rows[1], rows[1], (None, rows[0][1], 1, "", 0), (700, None, 1, "", 0), (800, rows[0][1], None, "", 0)]
    rows += [(900, [math.nan] * dims, 1, "", 0), (1000, [None] * dims, 1, "", 0), (1100, [math.inf] * dims, 1, "", 0), (1200, [], 1, "", 0)]
    rows += [(100 * i, [1.0 * i, 2.0], i % 2, "", 0) for i in range(8)]  # of another dimension
    rows += [(-100, rows[3][1], 4, "", 0), (-7, rows[4][1], 9, "", 0)]
    return rows


@pytest.mark.parametrize("cell, queries, sample", [(8192, 8192, 16_384), (50, 8, 200)])
def test_cells_and_blocks(spark, monkeypatch, cell, queries, sample):
    monkeypatch.setattr(negatives, "CELL_ROWS", cell)
    monkeypatch.setattr(negatives, "BLOCK_QUERIES", queries)
    monkeypatch.setattr(negatives, "SAMPLE_ROWS", sample)
    rows = table(600)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = mined(frame)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert collected(found) == expected(rows)
    assert found.count() > 100


def test_nothing_and_too_much(spark):
    frame = spark.createDataFrame(table(20), SCHEMA)
    assert mined(frame.filter("false")).collect() == []
    assert mined(frame.limit(1)).collect() == []
    with pytest.raises(ArithmeticError):
        mined(frame.withColumn("embedding", F.array(F.lit(1e30)))).collect()


@pytest.mark.parametrize("scale", [1, 10**8])
def test_windows_of_a_tree_are_exact(scale):
    random_ = np.random.default_rng(scale)
    rows = random_.integers(-9, 10, (900, 5)) * scale
    ids, labels = random_.permutation(900), random_.integers(0, 3, 900)
    queries = rows[:50]
    square = float((rows.astype(np.float64) ** 2).sum(axis=1).max())
    low = random_.integers(-100, 100, 50) * scale**2
    high = low + random_.integers(0, 120, 50) * scale**2
    same = random_.random(50) < 0.5
    scores, found, real = negatives.best_in_window(
        rows, ids, labels, queries, ids[:50], labels[:50], low, high, same, 4, square
    )
    for q in range(50):
        exact = [sum(map(int.__mul__, map(int, queries[q]), map(int, r))) for r in rows]
        wanted = sorted(
            (-s, int(i)) for s, i, m in zip(exact, ids, labels, strict=True)
            if i != ids[q] and (m == labels[q]) == same[q] and low[q] <= s <= high[q]
        )[:4]
        assert [(-int(s), int(i)) for s, i in zip(scores[q][real[q]], found[q][real[q]], strict=True)] == wanted
