"""Tokens, language model, toxicity, quotations, archives, neighbours and the pipeline."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from paperloom.llm import bpe, neighbours, ngrams, quotes, toxicity, warc
from paperloom.llm.queries import ORACLE, QUERIES

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXTS = [
    "Hello  world,\n\n it's 12345   o'clock!\t ",
    "  x y　z \x1c q\u0085r",
    "naïve café – 漢字かな 🙂🙂 ́a ½²Ⅷ _under_score_",
    "", None, " ", "\n", "a" * 5000, "word " * 30_000,
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (0, TEXTS[0])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    return frame.withColumns({n: F.lit("mine") for n in ("words", "ids", "chunk", "score", "id")})


# ---- tokens ----


def test_byte_bpe(docs):
    encoder = tiktoken.Encoding(
        "t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={}
    )
    found = bpe.encode_decode(docs, RANKS, public_tokenizers.PATTERN).collect()
    wanted = [(r.doc_id, r.text or "") for r in docs.collect()]
    got = sorted(((r.doc_id, r.ids, bytes(r.decoded)) for r in found), key=repr)
    assert got == sorted(((i, encoder.encode_ordinary(t), t.encode()) for i, t in wanted), key=repr)
    digests = bpe.encode_decode(docs, RANKS, public_tokenizers.PATTERN, digest=True).collect()
    assert sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in digests), key=repr) == sorted(
        (
            (i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(b).hexdigest())
            for i, ids, b in got
        ),
        key=repr,
    )
    assert bpe.encode_decode(docs.filter("false"), RANKS, public_tokenizers.PATTERN).isEmpty()


def test_byte_bpe_of_equal_files(spark, tmp_path, setting):
    """The same file loaded several times, and repeated rows that are alone in their splits."""
    setting("spark.sql.files.openCostInBytes", str(2**27))  # each file is a split
    encoder = tiktoken.Encoding(
        "t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={}
    )
    rows = [(1, "the cat saw the dog"), (2, "a dog, a cat; and words of several buckets"), (None, "x y z"), (3, None)]
    for n, made in enumerate([rows, rows, rows, rows[:1], rows[:1]]):
        frame = spark.createDataFrame(made, "doc_id long, text string").coalesce(1)
        frame.write.mode("append").parquet(str(tmp_path / f"part={n}"))
    docs = spark.read.parquet(str(tmp_path))
    found = bpe.encode_decode(docs, RANKS, public_tokenizers.PATTERN).collect()
    wanted = [(r.doc_id, encoder.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in docs.collect()]
    assert sorted(((r.doc_id, r.ids, bytes(r.decoded)) for r in found), key=repr) == sorted(wanted, key=repr)


# ---- language model ----


def test_kneser_ney(spark, docs, monkeypatch):
    monkeypatch.setattr(ngrams, "SHARD_BYTES", 20_000)
    pick = random.Random(2)
    made = [(100 + i, " ".join(f"W{int(pick.paretovariate(0.7))}" for _ in range(60))) for i in range(80)]
    frame = docs.select("doc_id", "text").unionAll(spark.createDataFrame(made, "doc_id long, text string"))
    lower = bytes(range(256)).lower()
    texts = [(r.doc_id, (r.text or "").encode().translate(lower).split() + [None]) for r in frame.collect()]
    train = [w for d, w in texts if d is not None and zlib.crc32(str(d).encode()) % 10]
    count = Counter(w for t in train for w in t)
    pairs = Counter(p for t in train for p in zip([0, *t[:-1]], t, strict=True))
    after = Counter(b for _, b in pairs)
    contexts = defaultdict(lambda: [0, 0, 0, 0])
    for (a, _), c in pairs.items():
        contexts[a][0] += c
        contexts[a][min(c, 3)] += 1
    of = lambda counts: ngrams.discounts(*[Counter(counts.values())[k] for k in (1, 2, 3, 4)])
    d, e = of(pairs), of(after)
    off = lambda c, x: x[min(c, 3) - 1] if c else 0
    n, v, kinds = sum(count.values()), len(count), Counter(min(c, 3) for c in after.values())
    rest = sum(e[k - 1] * kinds[k] for k in (1, 2, 3)) / len(pairs) / (v + 1)

    def p(a, b):
        low = (after[b] - off(after[b], e)) / len(pairs) + rest
        if a not in contexts:
            return low
        total, *by = contexts[a]
        return (pairs[a, b] - off(pairs[a, b], d) + sum(x * y for x, y in zip(d, by, strict=True)) * low) / total

    for a in [0, *list(contexts)[:5]]:  # a distribution
        assert math.isclose(sum(p(a, b) for b in [*count, "unknown"]), 1)
    got = Counter(
        (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4), round(r.score, 4))
        for r in ngrams.held_out_scores(frame).collect()
    )
    wanted = Counter()
    for i, t in texts:
        held = None if i is None else zlib.crc32(str(i).encode()) % 10 == 0
        base = sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        score = sum(math.log10(p(a, b)) for a, b in zip([0, *t[:-1]], t, strict=True))
        wanted[i, held, len(t), sum(count[w] > 0 for w in t), n, round(base, 4), round(score, 4)] += 1
    assert got == wanted
    assert ngrams.held_out_scores(docs.filter("false")).isEmpty()
    untrained = ngrams.score(docs, ngrams.train(docs.filter("false").select("text"))).collect()
    assert {(r.n_known, r.score) for r in untrained} == {(0, 0.0)}


# ---- toxicity ----


def test_levenshtein_lexicon_equals_brute_force():
    pick = random.Random(4)
    terms = {"".join(pick.choice("abc") for _ in range(pick.randrange(3, 12))): 1.0 for _ in range(60)}
    lexicon = toxicity.FuzzyLexicon(terms)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    for _ in range(1500):
        word = "".join(pick.choice("abcd") for _ in range(pick.randrange(1, 13)))
        best = min(((k, t) for t in terms if (k := distance(word, t)) <= toxicity.edit_budget(t)), default=None)
        assert lexicon.match(word) == (best and (best[1], best[0])), word


def test_context_separates_quotation_from_abuse():
    weight = lambda w: 3.0 if w in ("idiot", "fool") else 0.0
    plain = toxicity.features("you idiot, you fool, go away now", weight)
    quoted = toxicity.features('he was called "idiot" and «a fool» by others', weight)
    assert all(a > b for a, b in zip(plain[:3], quoted[:3], strict=True)) and quoted[4] > plain[4] == 0
    assert toxicity.features("", weight) == toxicity.features("all is well", weight) == [0.0] * 5


def test_toxicity(spark, docs):
    pick = random.Random(6)
    made, labels = [], []
    for i in range(1500):
        bad = i % 5 == 0
        w = [f"word{pick.randrange(300)}" for _ in range(pick.randrange(4, 40))]
        for _ in range(2 if bad else 0):
            w.insert(pick.randrange(len(w)), pick.choice(["horrible", "dreadful", "abysmal"]))
        if bad and i % 3 == 0:
            w = [x.replace("horrible", "horribel").replace("dreadful", "dreadfuI") for x in w]
        made.append((1000 + i, " ".join(w)))
        labels.append((1000 + i, int(bad)))
    frame = docs.select("doc_id", "text").unionAll(spark.createDataFrame(made, "doc_id long, text string"))
    known = spark.createDataFrame([*labels, labels[0], (None, 1), (1000, None)], "doc_id long, toxic int")
    found = toxicity.toxic_scores(frame, known).collect()
    assert len(found) == frame.count() and all(0 <= r.score <= 1 for r in found)
    truth = dict(labels)
    held = [r for r in found if r.held_out and r.doc_id in truth]
    right = sum(r.predicted == truth[r.doc_id] for r in held) / len(held)
    assert right > 0.97 and all((r.score >= 0.7) == r.predicted for r in found)
    assert not any(r.predicted for r in found if r.doc_id is None or r.doc_id < 1000)
    model = toxicity.learn(frame, toxicity.training_labels(known))
    repeated = frame.unionAll(frame.filter("doc_id % 7 = 0"))
    again = toxicity.learn(repeated, toxicity.training_labels(known))
    assert (again["terms"], again["ordinary"]) == (model["terms"], model["ordinary"])
    kept = toxicity.drop_toxic(docs, model)
    assert kept.schema == docs.schema and kept.count() == docs.count()
    nothing = toxicity.toxic_scores(frame, known.filter("false"))
    assert nothing.filter("predicted = 1").isEmpty() and nothing.count() == frame.count()
    assert toxicity.toxic_scores(docs.filter("false"), known.filter("false")).isEmpty()


# ---- quotations ----


def test_quotations(spark):
    rows = [
        (1, 0, "user", "Hello there.\nHow are you?\n\nSecond part here"),
        (1, 1, "assistant", "On Monday A wrote:\n> Hello there.\n> How are you?\n\nFine thanks."),
        (1, 2, "user", "> > Hello there.\n> > How are\n> > you?\n> Fine thanks.\n\nGood"),
        (1, 3, "assistant", ">Good\nYes\n\n"), (1, 4, "user", None), (1, 5, "user", ""),
        (1, 6, "user", "> not said\n> Yes"), (2, 0, "user", "Good"), (2, 1, "x", "> Yes"),
        (2, 2, "x", ">> good\nok"), (None, 3, "x", "> good"), (2, None, "x", "> good"),
        (1, 6, "user", "> not said\n> Yes"), (3, 0, "x", "word " * 40_000),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    extra = {n: F.lit("mine") for n in ("conv", "lines", "unit", "level")}
    found = quotes.reply_ordered(frame.withColumns(extra))
    assert set(extra) < set(found.columns) and found.count() == len(rows)
    got = {(r.conv_id, r.turn): r for r in found.collect()}
    assert [got[1, i].reply_turn for i in range(7)] == [None, 0, 1, 2, None, None, 3]
    assert [got[1, i].thread_turn for i in range(7)] == [0, 0, 0, 0, 4, 5, 0]
    assert [got[1, i].reply_depth for i in range(7)] == [0, 1, 2, 3, 0, 0, 4]
    assert [got[1, i].text for i in range(1, 6)] == ["Fine thanks.", "Good", "Yes", None, ""]
    assert (got[1, 2].quote_levels, got[1, 2].n_quoted, got[1, 2].n_linked) == (2, 4, 2)
    assert got[2, 1].reply_turn is None and got[2, 2].n_linked == 1  # said at another level, quoted
    assert got[None, 3].thread_turn == 3 and got[2, None].thread_turn is None
    assert {r.lines for r in got.values()} == {"mine"}

    import duckdb

    conversations = (  # noqa: F841  read by the SQL
        frame.filter("conv_id IS NOT NULL AND turn IS NOT NULL").distinct().toArrow()
    )
    told = duckdb.sql(quotes.SQL).fetchall()
    names = [c[0] for c in duckdb.sql(quotes.SQL).description]
    for row in told:
        row = dict(zip(names, row, strict=True))
        mine = got[row["conv_id"], row["turn"]]
        assert {n: mine[n] for n in names} == row
    assert quotes.reply_ordered(frame.filter("false")).isEmpty()


def test_excerpts_are_linked(spark):
    """One sentence of a long line, and part of a paragraph broken at another width."""
    rows = [
        (1, 0, "Hello to all. The meeting is on Monday. Bring tea!"),
        (1, 1, "We could walk along the river\nand have lunch by the old mill, if it\nstays dry until noon."),
        (1, 2, "> The meeting is on Monday.\nNoted."),
        (1, 3, "> river and have lunch by\n> the old mill, if\nGood plan"),
        (1, 4, "> > Bring tea!\n> Noted.\n\nYes"), (1, 5, "> never said by anybody in this whole place\nNo"),
        (2, 0, "> Bring tea!\nelsewhere"),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, text string")
    got = {(r.conv_id, r.turn): r for r in quotes.reply_ordered(frame).collect()}
    assert [got[1, i].reply_turn for i in range(6)] == [None, None, 0, 1, 2, None]
    assert [got[1, i].n_linked for i in range(6)] == [0, 0, 1, 1, 2, 0]
    assert (got[1, 4].thread_turn, got[1, 4].reply_depth) == (0, 2) and got[2, 0].n_linked == 0


# ---- archives ----


@pytest.mark.parametrize("split", [700, 10**7])
def test_archive(spark, tmp_path, split):
    fake = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 30\r\n\r\n"
    trap = fake + "x" * 30 + "\r\n\r\n" + fake + "y" * 2000
    big = "é" * 700
    rows = [
        (1, "http://a/\r\nX: y", big), (2, "http://b", big), (3, None, big), (4, "u", "small"), (5, "u", "small"),
        (6, "u", trap), (7, "u", trap), (8, "u", None), (9, "u", ""), (10, "u", "z" * 200_000), (None, "u", big),
        (3, None, big), (11, "u", "\r\n\r\n" * 400),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2)
    pages = pages.withColumns({n: F.lit("mine") for n in ("payload", "digest", "bytes", "first")})
    path = f"{tmp_path}/a b"
    warc.write_archive(pages, path)
    records = warc.read_archive(spark, path, with_payload=True, split_bytes=split)
    found = warc.resolve_revisits(records).collect()
    full = {}
    for page, _, html in rows:
        if len((html or "").encode()) >= 1000 and page is not None:
            full[html] = max(page, full.get(html, 0))
    wanted = Counter()
    for page, _, html in rows:
        data, first = (html or "").encode(), full.get(html)
        again = first is not None and page is not None and page != first
        wanted[page, len(data), hashlib.sha1(data).hexdigest(), again, first if again else None] += 1
    assert wanted == Counter(
        (r.page_id, r.payload_bytes, r.payload_digest, r.record_type == "revisit", r.refers_to) for r in found
    )
    texts = {bytes(r.payload).decode() for r in found if r.payload is not None}
    assert texts == {h or "" for _, _, h in rows}


def test_archive_of_nothing(spark, tmp_path):
    warc.write_archive(spark.createDataFrame([], "page_id long, url string, html string"), f"{tmp_path}/none")
    assert warc.read_archive(spark, f"{tmp_path}/none").isEmpty()


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    """Bytes of one file with 20 records, and where each begins."""
    path = f"{tmp_path_factory.mktemp('archive')}/a"
    rows = [(i, f"http://x/{i}", f"page {i} WARC/1.1\r\n " * (i % 7 + 1)) for i in range(20)]
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), path)
    (name,) = [f for f in os.listdir(path) if f.startswith("part-")]
    with open(f"{path}/{name}", "rb") as file:
        data = file.read()
    return data, [m.start() for m in re.finditer(rb"WARC/1\.1\r\nWARC-Type", data)]


def read_bytes(spark, folder, data, split):
    folder.mkdir()
    (folder / "x.warc").write_bytes(data)
    found = warc.read_archive(spark, str(folder), split_bytes=split).collect()
    whole = sorted(r.page_id for r in found if r.record_type != "broken")
    return whole, sorted(r.broken_at for r in found if r.record_type == "broken")


@pytest.mark.parametrize("split", [700, 1 << 24])
def test_whole_records_in_front_of_a_break(spark, archive, tmp_path, split):
    data, starts = archive
    assert read_bytes(spark, tmp_path / "all", data, split) == (list(range(20)), [])
    # The last record is cut, anywhere.
    for at in (starts[19] + 20, len(data) - 5):
        assert read_bytes(spark, tmp_path / f"cut{at}", data[:at], split) == (list(range(19)), [starts[19]])
    # A record in the middle has lost bytes of its payload.
    at = starts[11] - 10
    lost = data[: at - 6] + data[at:]
    assert read_bytes(spark, tmp_path / "middle", lost, split) == (list(range(10)), [starts[10], starts[11]])
    # One byte of it has changed: its length still says where the next one begins.
    changed = data[:at] + b"#" + data[at + 1 :]
    assert read_bytes(spark, tmp_path / "changed", changed, split) == (
        [i for i in range(20) if i != 10], [starts[10]]
    )
    assert read_bytes(spark, tmp_path / "none", b"no archive at all", split) == ([], [0])


def test_long_headers_and_repeated_pages(spark, tmp_path, monkeypatch):
    a, b = "A" * 1500, "B" * 1500
    rows = [(5, "u", a), (5, "u", b), (1, "u", a), (2, "u" * 5_000_000, b), (3, None, "small")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_archive(pages, f"{tmp_path}/w")
    records = warc.read_archive(spark, f"{tmp_path}/w", split_bytes=1 << 20)
    digest = lambda h: hashlib.sha1(h.encode()).hexdigest()
    for limit in (10**9, 0):
        monkeypatch.setattr(warc, "BROADCAST_BYTES", limit)
        found = warc.resolve_revisits(records)
        assert sorted((r.page_id, r.payload_bytes, r.payload_digest, r.refers_to or 0) for r in found.collect()) == [
            (1, 1500, digest(a), 5), (2, 1500, digest(b), 5), (3, 5, digest("small"), 0),
            *sorted([(5, 1500, digest(a), 0), (5, 1500, digest(b), 0)]),
        ]


# ---- neighbours ----


def test_nearest(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "INDEX_BLOCK", 300)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 30)
    random_ = np.random.default_rng(1)
    x = random_.standard_normal((1200, 24)).astype(np.float32) * random_.uniform(0.1, 3, (1200, 1)).astype(np.float32)
    x[100:500] = x[100]  # a third of all rows
    x[700:703] = x[600]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(5000, None), (5020, [0.0] * 24), (5040, [math.nan] + [1.0] * 23), (5060, [None] + [1.0] * 23),
           (5080, [math.inf] * 24), (None, x[0].tolist()), (5100, [])]
    small = [(6000, [1.0, 2.0]), (6001, [2.0, 1.0])]
    frame = spark.createDataFrame(rows + odd + small + rows[:3], "vec_id long, embedding array<float>")
    frame = frame.withColumns({"dim": F.lit("mine"), "block": F.lit("mine")})
    is_query = F.pmod(F.col("vec_id"), F.lit(20)) == 0
    found = defaultdict(dict)
    for r in neighbours.nearest(frame, is_query, k=20).collect():
        found[r.query_id][r.rank] = (r.vec_id, r.score)
    assert {q for q in found if q >= 2000} == {6000} and found[6000] == {1: (6001, 4.0)}
    hits = 0
    for q in range(0, 1200, 20):
        scores = x.astype(float) @ x[q].astype(float)
        order = [i for i in np.lexsort((np.arange(1200), -scores)) if i != q][:20]
        assert list(sorted(found[q])) == list(range(1, 21))
        for rank, (vec, score) in found[q].items():
            assert math.isclose(score, scores[vec], rel_tol=1e-12)
            hits += order[rank - 1] == vec
    assert hits / (60 * 20) > 0.98
    assert neighbours.nearest(frame.filter("false"), is_query).isEmpty()


def test_estimates_stay_within_their_bounds():
    random_ = np.random.default_rng(2)
    x, q = random_.standard_normal((4000, 64)), random_.standard_normal((20, 64))
    turn = neighbours.rotation(64)
    found, error = neighbours.estimate(*neighbours.encode(x, turn), q, turn)
    assert (np.abs(found - q @ x.T) <= neighbours.EPSILON * error).mean() > 0.99


# ---- pipeline and registry ----


def test_pipeline(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line dedup", "near-duplicates", "decontamination", "tokens",
    ]
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (10**6, "", "en", "s", 0), (10**6, "", "en", "s", 0)], docs.schema
    )
    now = docs.unionAll(odd).withColumn("extra", F.lit("mine"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, folder)
        assert out.schema == now.schema and out.count() <= now.count()
        assert out.filter("text IS NULL OR text = ''").count() == 3
        assert stage(spark, now.filter("false"), folder).isEmpty()
        now = out
    assert corpus_pipeline.run(spark, folder).count() == now.count() - 3


def test_each_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    from oracle import compare, connect

    folder = "/root/testdata/sf0.001"
    assert compare(spark, connect(folder), QUERIES[name], ORACLE[name], folder) is None
