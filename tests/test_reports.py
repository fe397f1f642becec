"""Metrics, corpus and trends on hand-made tables."""

import pytest
from frames import FULLTEXT, paper, papers, rows, topic, work, works
from pyspark.sql import functions as F

from paperloom.functions.columns import year_bin
from paperloom.operators import corpus, trends
from paperloom.operators.metrics import compute_metrics, metrics_summary

MODEL, OTHER = "s2-fos-model", "external"


def test_field_of_study(spark):
    table = papers(
        spark,
        paper(1, fields=None),
        paper(2, fields=[]),
        paper(3, fields=[("a", OTHER)]),
        paper(4, fields=[("x", OTHER), ("a", MODEL), ("b", MODEL)], abstract=True),
        paper(5, fields=[(None, MODEL), ("b", MODEL)]),
        paper(6, fields=[("a", MODEL)], abstract=None, fulltext=False),
        paper(7, fields=[("a", MODEL)], year=None),
        paper(8, fields=[("a", MODEL)], year=1899),
        paper(9, fields=[("a", MODEL)], year=1900),
        paper(10, fields=[("a", MODEL)], year=2025, fulltext=True),
        paper(11, fields=[("a", MODEL)], year=2026),
    )
    found = [tuple(r) for r in compute_metrics(table, "field").collect()]
    assert found == [
        ("a", 1900, "total", 1),
        ("a", 2000, "has_abstract", 1),
        ("a", 2000, "total", 2),
        ("a", 2025, "has_fulltext", 1),
        ("a", 2025, "total", 1),
    ]
    summary = metrics_summary(compute_metrics(table, "field"), "field")
    assert rows(summary, "metric_type", "papers", "distinct_groups", "min_year", "max_year") == [
        ("has_abstract", 1, 1, 2000, 2000),
        ("has_fulltext", 1, 1, 2025, 2025),
        ("total", 4, 1, 1900, 2025),
    ]


def test_empty_venue_is_a_group_and_null_is_not(spark):
    table = papers(spark, paper(1, venue=""), paper(2, venue=None), paper(3, venue="v"))
    assert rows(compute_metrics(table, "venue", ordered=False), "venue", "count") == [("", 1), ("v", 1)]


def test_unknown_group(spark):
    with pytest.raises(ValueError):
        compute_metrics(papers(spark), "author")


# ---- corpus ----


@pytest.fixture(scope="module")
def texts(spark):
    long = "a\U0001f44d\U0001f3fdé"
    bodies = [(1, long), (2, None), (3, ""), (4, "t"), (5, "u"), (6, "v"), (7, "w"), (8, "x"), (9, "y")]
    table = [(i, (text, [(0, 1)])) for i, text in bodies]
    return spark.createDataFrame(table, FULLTEXT)


@pytest.fixture(scope="module")
def candidates(spark):
    has = {"arxiv": "x", "fulltext": True, "year": 1980}
    return papers(
        spark,
        *[paper(i, **has) for i in (1, 2, 3, 4, 9, 10)],
        paper(5, **{**has, "arxiv": None}),
        paper(6, **{**has, "fulltext": None}),
        paper(7, **{**has, "year": 1991}),
        paper(8, **{**has, "year": None}),
    )


@pytest.mark.parametrize("broadcast_bytes", [0, 10**6])
def test_corpus(candidates, texts, broadcast_bytes):
    build = lambda **o: corpus.fulltext_corpus(
        candidates, texts, broadcast_bytes=broadcast_bytes, **o
    )
    assert rows(build(), "corpusid", "text_length") == [(1, 4), (4, 1), (9, 1)]
    assert rows(build(year_lt=None), "corpusid") == [(1,), (4,), (7,), (8,), (9,)]
    # Half-open range: the first id is in, the last is not; one id alone works.
    assert rows(build(id_range=(1, 9)), "corpusid") == [(1,), (4,)]
    assert rows(build(id_range=(9, 10)), "corpusid", "annotations") == [(9, '[{"start":0,"end":1}]')]
    row = build(id_range=(4, 5)).first()
    assert row["created_at"] is not None and row["arxiv_id"] == "x"


def test_corpus_without_eligible_papers(candidates, texts):
    none = corpus.fulltext_corpus(candidates.filter("corpusid > 99"), texts)
    assert none.count() == 0
    assert corpus.corpus_stats(none).first()["total_papers"] == 0


def test_corpus_reports(candidates, texts):
    whole = corpus.fulltext_corpus(candidates, texts, year_lt=None)
    assert tuple(corpus.corpus_stats(whole).first()) == (5, 2, 1980, 1991, 1.6, 4, 8)
    by_year = corpus.corpus_by_year(whole, report_from=1900, n=1)
    assert [tuple(r) for r in by_year.collect()] == [(1991, 1)]
    assert corpus.corpus_by_year(whole).count() == 0
    assert tuple(corpus.corpus_key_range(candidates).first()) == (1, 10)


# ---- trends ----


@pytest.fixture(scope="module")
def counts(spark):
    def some(n, count, year, subfield=None):
        return [
            work(f"W{n}-{year}-{i}", year=year, topics=[topic(n, subfield), topic(99)])
            for i in range(count)
        ]

    table = works(
        spark,
        *some(1, 3, 2000),
        *some(1, 1, 2001),
        *some(2, 2, 2001),
        *some(3, 2, 2002),
        *some(4, 2, None),
        *some(5, 1, 2003, subfield="S 1"),
        work("N1", topics=None),
        work("N2", topics=0),
    )
    return trends.topic_counts(table).persist()


def test_topic_counts_keep_works_without_topic(counts):
    missing = counts.filter("topic_name IS NULL")
    assert rows(missing, "publication_year", "num_papers") == [(2000, 2)]
    assert tuple(trends.missing_topic_share(counts).first()) == (2, 13, 15.38)
    assert trends.missing_topic_share(counts.limit(0)).first()["pct_missing"] is None


def test_order_of_counts(spark):
    table = works(spark, work("W1", year=None), work("W2", year=2001), work("W3", year=2000, topics=1))
    ordered = trends.topic_counts(table, ordered=True)
    assert [r["publication_year"] for r in ordered.collect()] == [2000, 2001, None]


def test_top_names_break_ties_by_name(counts):
    top = [tuple(r) for r in trends.top_names(counts, "topic_name", 3).collect()]
    # Works without a year count for the ranking.
    assert top == [("T 1", 4), ("T 2", 2), ("T 3", 2)]


def test_trend_drops_null_years(counts):
    assert rows(trends.trend(counts, "topic_name", 4), "year_bin", "topic_name", "num_papers") == [
        (2000, "T 1", 4),
        (2000, "T 2", 2),
        (2002, "T 3", 2),
    ]
    assert rows(trends.trend(counts, "subfield_name", 1), "year_bin", "num_papers") == [
        (2000, 4),
        (2002, 1),
    ]


def test_shares_sum_to_one(counts):
    shares = trends.trend_share(trends.trend(counts, "topic_name", 4))
    assert rows(shares, "topic_name", F.round("share", 4)) == [
        ("T 1", 0.6667),
        ("T 2", 0.3333),
        ("T 3", 1.0),
    ]


def test_heatmap_is_ordered_by_rank(counts):
    cells = [tuple(r) for r in trends.heatmap(counts, n=3).collect()]
    assert cells == [(1, "T 1", 2000, 4), (2, "T 2", 2000, 2), (3, "T 3", 2002, 2)]


def test_year_bins_round_down(spark):
    years = spark.createDataFrame([(y,) for y in (-3, -2, -1, 0, 1, 2001, None)], "y int")
    assert [r[0] for r in years.select(year_bin(F.col("y"))).collect()] == [-4, -2, -2, 0, 0, 2000, None]


def test_explode_topics(spark):
    table = works(spark, work("W1", topics=2), work("W2", topics=0), work("W3"))
    assert rows(trends.explode_topics(table), "work_id", "topic_id", "domain_display_name") == [
        ("W1", "T0", "D 0"),
        ("W1", "T1", "D 1"),
    ]


def test_latest_works(spark):
    table = works(spark, work("W3", year=2001), work("W2", year=None), work("W1", year=2001))
    assert [r["id"] for r in trends.latest_works(table, 2).collect()] == ["W1", "W3"]
