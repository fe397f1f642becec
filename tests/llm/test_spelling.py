"""Spelling variants against brute-force versions."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.llm import spelling
from paperloom.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows):
    found = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def near_by_patterns(words):
    """Near words by the words with one letter masked or left out."""
    masked, shorter = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            masked[w[:i] + "*" + w[i + 1 :]].add(w)
            shorter[w[:i] + w[i + 1 :]].add(w)
    near = {w: set() for w in words}
    for group in masked.values():
        for w in group:
            near[w] |= group - {w}
    for w, longer in shorter.items():
        if w in near:
            near[w] |= longer
            for x in longer:
                near[x].add(w)
    return near


def expected(words, near):
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out, key=repr)


def collected(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    words = counted(rows)
    found = QUERIES["op11_spelling_variants"](spark, folder)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert collected(found) == expected(words, near_by_patterns(words))
    assert any(r.form for r in found.collect())


def vocabulary(n, seed):
    pick = random.Random(seed)
    letters = "abcdeé÷ÿ"
    out = {"".join(pick.choice(letters) for _ in range(pick.randrange(6, 11))) for _ in range(n)}
    for w in list(out)[: n // 2]:
        i = pick.randrange(len(w))
        out.add(w[:i] + pick.choice(letters) + w[i + pick.randrange(2) :])
    out |= {"x" * 70, "x" * 71, "x" * 40 + "y" + "x" * 30, "abcdef", "fedcba"}
    return sorted(w for w in out if len(w) >= 6)


@pytest.mark.parametrize("leaf, block, queries, sample", [(4096, 8192, 10**6, 65_536), (40, 30, 50, 300)])
def test_trees_and_blocks(spark, monkeypatch, leaf, block, queries, sample):
    for name, value in (("LEAF_WORDS", leaf), ("BLOCK_WORDS", block), ("BLOCK_QUERIES", queries), ("SAMPLE_WORDS", sample)):
        monkeypatch.setattr(spelling, name, value)
    words = vocabulary(700, leaf)
    frame = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long").repartition(3)
    found = [(r.u, r.n_u, r.v, r.n_v) for r in spelling.near_words(frame).collect()]
    assert len({frozenset((u, v)) for u, _, v, _ in found}) == len(found)
    wanted = {frozenset((a, b)) for i, a in enumerate(words) for b in words[:i] if is_near(a, b)}
    assert {frozenset((u, v)) for u, _, v, _ in found} == wanted
    assert all(words[n] == u and words[m] == v for u, n, v, m in found)
    near = near_by_patterns(words)
    assert {frozenset((a, b)) for a in words for b in near[a]} == wanted


def test_chains_ties_and_odd_rows(spark):
    counts = {"harbour": 700, "harbor": 100, "harbar": 20, "harber": 20, "herber": 4, "planets": 9, "planetz": 9,
              "abcdefg": 5, "bcdefgh": 5, "Éclairs": 50, "éclairs": 5}
    rows = [(10_000 + i, f"{w}, {w.upper() if w.isascii() else w}! " * (n // 2) + f"({w})" * (n % 2))
            for i, (w, n) in enumerate(counts.items())]
    rows += [(1, None), (2, ""), (None, "harbour planets"), (3, "many words " * 40_000), rows[0], (4, "z" * 30_000)]
    rows += [(5 + i, "z" * 30_000) for i in range(5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame = frame.withColumns({n: F.lit("mine") for n in ("word", "n", "run", "id", "h", "length")})
    words = counted(rows)
    found = collected(spelling.spelling_variants(frame))
    assert found == expected(words, near_by_patterns(words))
    by_word = {r[0]: r for r in found}
    assert by_word["harber"][1:3] == ("harbor", "harbour")
    assert spelling.spelling_variants(frame.filter("false")).collect() == []


def test_boxes_never_hide_a_near_word():
    words = [w for w in vocabulary(300, 9) if len(w) == 8]
    letters = spelling.letters_of(words, 8)
    q, w = spelling.range_pairs(letters, letters, 2, spelling.one_replaced)
    got = set(zip(q.tolist(), w.tolist(), strict=True))
    assert got == {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if is_near(a, b)}
    tree = spelling.Tree(spelling.letter_counts(letters), 5, tight=False)
    leaves = [rows for _, rows in tree.within(spelling.letter_counts(letters), 0)]
    assert sorted(np.concatenate(leaves).tolist()) == list(range(len(words)))
