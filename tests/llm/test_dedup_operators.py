"""Near-duplicates, repeated passages, boilerplate lines and benchmark passages against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.llm import decontamination, lines, minhash, repeats
from paperloom.llm.components import connected_components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [
    (None, "no id but a text of its own here", "en", "a", 1),
    (90_001, None, "en", "a", 0),
    (90_002, "", "en", None, 0),
    (90_003, " \n\t ", None, "b", 4),
    (90_004, "Few words", "en", "b", 9),
    (90_005, "few WORDS", "en", "c", 9),
]


def words(n, seed):
    pick = random.Random(seed)
    return [f"w{pick.randrange(4000)}" for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    base = [words(120, s) for s in range(30)]
    texts = [" ".join(w) for w in base]
    edited = random.Random(7)
    for w in base[:8]:  # near and exact copies, of one text very many
        for _ in range(60 if w is base[0] else 4):
            copy = list(w)
            copy[edited.randrange(120)] = f"x{edited.randrange(10**6)}"
            texts.append(" ".join(copy))
        texts += [" ".join(w).upper()] * 3
    passage = " ".join(words(50, "passage"))
    texts += [f"{' '.join(words(20, s))} {passage}\n{' '.join(words(30, -s))}" for s in range(100, 110)]
    texts.append(f"{passage} {' '.join(words(9, 1))} {passage}")
    texts.append(" ".join(words(30_000, "long")))
    made = [(i, t, "en", f"s{i % 5}", len(t)) for i, t in enumerate(texts)]
    return [*made, *ODD, made[3], made[-1]]  # repeated rows


@pytest.fixture(scope="module")
def docs(spark, rows):
    frame = spark.createDataFrame(rows, DOCS)
    # Columns with the names that the operators use themselves.
    extra = {n: F.lit("mine") for n in ("class", "key", "line", "chunk", "line_key", "near_mark")}
    return frame.withColumns(extra).repartition(3, "doc_id").persist()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.filter("false")


# ---- near-duplicates ----


def shingles(text):
    w = (text or "").encode().lower().split()
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def components(rows, percent):
    sets = [shingles(r[1]) for r in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                label[y] = x
    groups = defaultdict(list)
    for i, row in enumerate(rows):
        groups[find(i)].append(row[0])
    least = {g: min((d for d in ids if d is not None), default=None) for g, ids in groups.items()}
    return sorted(
        ((r[0], len(s), least[find(i)]) for i, (r, s) in enumerate(zip(rows, sets, strict=True))),
        key=repr,
    )


@pytest.mark.parametrize("percent, block", [(85, 1000), (80, 7)])
def test_near_duplicates(docs, rows, percent, block, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_MEMBERS", block)
    found = minhash.near_duplicates(docs, percent).collect()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=repr)
    assert got == components(rows, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_buckets_with_several_components_are_compared(docs, rows, monkeypatch):
    """Without verified proposals, blocks alone must find the same components."""
    monkeypatch.setattr(minhash, "_verify", lambda percent: lambda batches: iter(()))
    found = minhash.near_duplicates(docs, 85).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=repr) == components(
        rows, 85
    )


def test_one_of_each_group_stays(docs, rows, empty):
    kept = minhash.drop_near_duplicates(docs, 85)
    assert kept.schema == docs.schema
    ids = Counter(r[0] for r in kept.select("doc_id").collect())
    groups = components(rows, 85)
    wordless = {90_001, 90_002, 90_003}
    assert set(ids) == {c for _, n, c in groups if n} | wordless | {None}
    assert set(ids.values()) == {1}
    assert minhash.drop_near_duplicates(empty).isEmpty()
    assert minhash.near_duplicates(empty).isEmpty()


def test_one_row_stays_where_ids_repeat(spark):
    """Near copies that share an id, or have none, are one group; other texts of that id are not."""
    a, b = (" ".join(f"{w}{i}" for i in range(60)) for w in "ab")
    texts = [(7, a), (7, f"{a} x"), (9, f"{a} y"), (7, b), (None, "c " * 9), (None, "C " * 9)]
    frame = spark.createDataFrame([*texts, texts[0], texts[4]], "doc_id long, text string")
    got = Counter((r.doc_id, r.text[:1].lower()) for r in minhash.drop_near_duplicates(frame).collect())
    assert got == {(7, "a"): 1, (7, "b"): 1, (None, "c"): 1}


def test_components_of_a_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99)], "u long, v long")
    found = {r.node: r.component for r in connected_components(chain).collect()}
    assert found == {**dict.fromkeys(range(41), 0), 99: 99, 100: 99}


# ---- repeated passages ----


def without_repeats(rows, window):
    split = [(r[1] or "").encode().split() for r in rows]
    seen = Counter(
        tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1)
    )
    out = []
    for row, w in zip(rows, split, strict=True):
        keep = [True] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                keep[i : i + window] = [False] * window
        text = b" ".join(x for x, k in zip(w, keep, strict=True) if k).decode()
        out.append((row[0], len(w), keep.count(False), text))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window, chunk", [(35, 10**9), (35, 3000), (8, 500), (1, 3000)])
def test_repeats(docs, rows, window, chunk, monkeypatch):
    monkeypatch.setattr(repeats, "SHARD_BYTES", 50_000)
    if chunk < 10**9:  # chunks are made in the workers, which read the module's default
        docs = docs.repartition(12, "doc_id")
    scan = docs.cache()
    found = repeats.remove_repeats(scan, window)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == without_repeats(rows, window)


def test_repeats_digest_and_nothing(docs, rows, empty):
    found = repeats.remove_repeats(docs, 35, digest=True).collect()
    wanted = [(*r[:3], hashlib.sha256(r[3].encode()).hexdigest()) for r in without_repeats(rows, 35)]
    assert sorted((tuple(r) for r in found), key=repr) == sorted(wanted, key=repr)
    assert repeats.remove_repeats(empty).isEmpty()


# ---- boilerplate lines ----


def test_lines(spark, docs, monkeypatch):
    common = ["  shared by all ", "shared by few", ""]
    made = []
    for i in range(12):
        text = [f"own line {i} that is long enough", common[0], *(common[1:2] if i < 3 else []), ""]
        made.append((i, "\n".join(text), f"s{i}"))
    made += [(20, "shared by all", "s1"), (21, None, "s2"), (22, "", "s3"), (23, "shared by all\n\nx", None)]
    made.append(made[0])
    frame = spark.createDataFrame(made, "doc_id long, text string, source string")
    frame = frame.withColumns({"line_key": F.lit(1), "n_lines": F.lit(9)})
    expected = {}
    for i, text, _ in made[:12]:
        expected[i] = text.replace("\n  shared by all ", "")
    expected |= {20: "", 21: None, 22: "", 23: "\nx"}
    for limit in (10**9, 0):
        monkeypatch.setattr(lines, "BROADCAST_BYTES", limit)
        found = lines.remove_boilerplate(frame, min_sites=10)
        assert found.columns == ["doc_id", "text", "source", "line_key", "n_lines", "n_removed"]
        assert {r.doc_id: r.text for r in found.collect()} == expected
        assert found.count() == len(made)
        removed = {r.doc_id: (r.n_lines, r.n_removed) for r in found.collect()}
        assert removed[0] == (4, 1) and removed[20] == (1, 1) and removed[21] == (0, 0)
    assert lines.remove_boilerplate(docs.filter("false")).isEmpty()


def test_lines_of_texts_that_are_no_copies(spark, monkeypatch):
    """Boilerplate goes whatever its share. Copies keep their own lines, as they count once."""
    menu, legal = "home news sport weather shop " * 3, "all rights reserved by the owner " * 3
    made = [(i, f"{menu}\npage {i} {' '.join(words(30, i))}\n{legal}", f"s{i}") for i in range(12)]
    made += [(50, f"{menu}\na short page of its own\n{legal}", "s3"), (51, menu, "s4"), (None, menu + "\nx", None)]
    story = [" ".join(words(40, f"story {k}")) for k in range(5)]
    for i in range(12):  # near copies, on as many sites as the boilerplate
        lines_ = [*story[:4], f"{story[4]} edition {i}"]
        made.append((100 + i, "\n".join([*lines_, menu]), f"s{i}"))
    frame = spark.createDataFrame(made, "doc_id long, text string, source string").withColumn("line_copied", F.lit(1))
    for limit in (10**9, 0):
        monkeypatch.setattr(lines, "BROADCAST_BYTES", limit)
        out = lines.remove_boilerplate(frame, near_percent=80)
        assert out.columns == [*frame.columns, "n_lines", "n_removed"]
        found = {r.doc_id: r.text for r in out.collect()}
        assert len(found) == len(made)
        for i, text, _ in made:
            assert found[i] == "\n".join(x for x in text.split("\n") if x not in (menu, legal)), i
    same = [(i, f"{menu}\n{legal}", f"s{i}") for i in range(3)]  # made of shared lines alone
    frame = spark.createDataFrame(made[:12] + same, "doc_id long, text string, source string")
    found = lines.remove_boilerplate(frame, near_percent=80).filter("n_lines = 2").collect()
    assert [(r.text, r.n_removed) for r in found] == [("", 2)] * 3
    assert lines.remove_boilerplate(frame.filter("false"), near_percent=80).isEmpty()


@pytest.mark.parametrize("sites", [9, 10, 11, 400])
def test_spread_near_the_threshold_is_exact(spark, sites):
    rows = spark.range(sites).select(F.lit(1).cast("long").alias("line"), F.col("id").cast("string").alias("site"))
    found = lines.widespread_lines(rows.unionAll(rows), 10).count()
    assert found == (sites >= 10)


# ---- benchmark passages ----


def edits(pattern, text):
    before = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        now = [i] + [0] * len(text)
        for j, b in enumerate(text, 1):
            now[j] = min(before[j] + 1, now[j - 1] + 1, before[j - 1] + (a != b))
        before = now
    return min(before)


def test_myers_distance():
    pick = random.Random(3)
    for _ in range(400):
        p = [pick.randrange(4) for _ in range(pick.randrange(1, 70))]
        t = [pick.randrange(4) for _ in range(pick.randrange(90))]
        got = decontamination.nearest(np.array(p, np.uint64), np.array(t, np.uint64))
        assert got == edits(p, t)


def test_pieces_cover_every_match():
    for n in range(1, 90):
        k = decontamination.error_budget(n)
        at = decontamination.pieces(n, k)
        ends = [*at[1:], n]
        assert len(at) == k + 1 and at[0] == 0
        assert n < 4 or min(b - a for a, b in zip(at, ends, strict=True)) >= 4


def test_benchmark(spark, docs, rows, empty):
    pick = random.Random(5)
    items = [(i, " ".join(words(n, f"item{i}"))) for i, n in enumerate([4, 7, 15, 30, 60])]
    items += [(5, "Few words"), (6, None), (None, "few words"), (7, ""), (8, " ".join(rows[-1][1].split()[:40])), (3, items[3][1])]
    made = []
    for i, text in items[:5]:
        for changes in range(14):
            w = text.split()
            for _ in range(min(changes, n := len(w))):
                if len(w) < n / 2:
                    break
                at = pick.randrange(len(w))
                w[at : at + 1] = pick.choice([[], ["new"], [w[at], "more"]])
            made.append((100 * i + changes, f"{' '.join(words(5, i))}, {' '.join(w).upper()}! after"))
    frame = docs.select("doc_id", "text").unionAll(spark.createDataFrame(made, "doc_id long, text string"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    plain = {chr(b): chr(decontamination.PLAIN[b]) for b in range(128)}

    def norm(text):
        return "".join(plain.get(c, c) for c in text or "").encode().split()

    expected = Counter()
    wanted = {(i, tuple(norm(t))) for i, t in items if i is not None and t}
    for r in frame.collect():
        w = norm(r.text)
        found = []
        for i, item in sorted(wanted):
            k = decontamination.error_budget(len(item))
            if len(w) > 5000:
                hit = 0 if " ".join(x.decode() for x in item) in r.text else None
            elif len(item) < 4:
                hit = 0 if tuple(w) == item else None
            else:
                hit = e if (e := edits(item, w)) <= k else None
            if hit is not None:
                found.append((i, hit))
        expected[(r.doc_id, r.text, tuple(found))] += 1
    for block in (20_000, 2):
        got = decontamination.find_items(frame, bench, block_items=block).collect()
        assert expected == Counter(
            (r.doc_id, r.text, tuple(sorted(tuple(m) for m in r.benchmark_matches))) for r in got
        )
    kept = decontamination.decontaminate(docs, bench)
    assert kept.schema == docs.schema and kept.filter("doc_id IN (90004, 90005)").isEmpty()
    assert decontamination.decontaminate(docs, bench.filter("false")).count() == docs.count()
    assert decontamination.decontaminate(empty, bench).isEmpty()
