"""SimHash against a brute-force version on whole tables and hand-made fingerprints."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from paperloom.llm import simhash
from paperloom.llm.queries import QUERIES


def fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = lowered.encode().split()
    runs = [words[i : i + 3] for i in range(len(words) - 2)] or ([words] if words else [])
    hashes = [xxhash.xxh64(b" ".join(r), seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def groups(values):
    """Index of the first member of each value's component."""
    label = list(range(len(values)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    order = {}
    for i, v in enumerate(values):
        order.setdefault(v, i)
    distinct = np.array(list(order), np.uint64)
    first = list(order.values())
    for i, v in enumerate(distinct):
        for j in np.flatnonzero(np.bitwise_count(distinct[: i + 1] ^ v) <= 3):
            a, b = sorted((find(first[i]), find(first[j])))
            label[b] = a
    return [find(order[v]) for v in values]


def expected(rows):
    prints = [fingerprint(t) for _, t in rows]
    label = groups(prints)
    least = {}
    for (key, _), g in zip(rows, label, strict=True):
        least[g] = min((k for k in (least.get(g), key) if k is not None), default=None)
    return sorted(
        ((key, f"{p:016x}", least[g]) for (key, _), p, g in zip(rows, prints, label, strict=True)),
        key=repr,
    )


def collected(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op13_simhash"](spark, folder)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    assert collected(found) == expected(rows)


def test_odd_rows(spark):
    pick = random.Random(1)
    base = " ".join(f"w{pick.randrange(500)}" for _ in range(300))
    rows = [(5, base), (3, base.upper()), (9, base + " more"), (None, base), (None, "alone and nameless"),
            (7, None), (8, ""), (6, " \n\t"), (2, "two words"), (1, "two  WORDS"), (4, "É é"), (5, base),
            (11, " ".join(["long", "text", "again"] * 60_000)), (12, "one")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    more = frame.withColumns({n: F.lit("mine") for n in ("fp", "prefix", "bits", "component", "place")})
    found = simhash.near_duplicates(more)
    assert collected(found) == expected(rows)
    assert {r.component_id for r in found.collect() if r.doc_id in (6, 7, 8)} == {6}
    assert simhash.near_duplicates(frame.filter("false")).collect() == []


def dense(n, seed):
    """Fingerprints at one to nine bits from a few centres, and some far from all."""
    pick = random.Random(seed)
    centres = [pick.getrandbits(64) for _ in range(4)] + [0, 2**64 - 1]
    out = set(centres)
    while len(out) < n:
        value = pick.choice(centres) if pick.random() < 0.8 else pick.getrandbits(64)
        for bit in pick.sample(range(64), pick.randrange(10)):
            value ^= 1 << bit
        out.add(value)
    return sorted(out)


@pytest.mark.parametrize("wanted, most", [(16_384, 65_536), (500, 200), (50, 40)])
def test_prefixes_of_any_length(spark, monkeypatch, wanted, most):
    monkeypatch.setattr(simhash, "FIRST_BITS", 1 if wanted < 16_384 else 10)
    monkeypatch.setattr(simhash, "GROUP_ENTRIES", wanted)
    monkeypatch.setattr(simhash, "MOST_ENTRIES", most)
    values = dense(1500, wanted)
    signed = [v - 2**64 if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fp long").repartition(3)
    links = simhash.near_fingerprints(frame).collect()
    label = np.arange(len(values))
    at = {v: i for i, v in enumerate(signed)}
    label = simhash._join_labels(label, np.array([at[r.u] for r in links]), np.array([at[r.v] for r in links]))
    assert label.tolist() == groups(values)


def test_every_distance_up_to_three_and_no_other():
    pick = random.Random(2)
    for _ in range(300):
        a, distance = pick.getrandbits(64), pick.randrange(1, 7)
        b = a
        for bit in pick.sample(range(64), distance):
            b ^= 1 << bit
        u, _ = simhash.meet(np.array([a, b], np.uint64), 0, 0)
        assert len(u) == (distance <= 3)
