"""What the physical plans must and must not contain."""

import re

import pytest
from frames import plan, work, works
from pyspark.sql import functions as F

from paperloom.operators import corpus, dedup, enrich, link, metrics, trends
from paperloom.registry.fixtures import Tables
from paperloom.sources import scan

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def t(spark, tmp_path_factory):
    """The derived tables as Parquet."""
    root = tmp_path_factory.mktemp("tables")
    derived = Tables(spark, SMALL)
    frames = {}
    for name in ("works", "papers", "papers_prior", "abstracts", "fulltext"):
        getattr(derived, name).write.parquet(f"{root}/{name}")
        frames[name] = spark.read.parquet(f"{root}/{name}")
    return type("T", (), frames)


@pytest.fixture(autouse=True)
def large_tables(setting):
    """Plan as for tables that are too large for Spark to broadcast by itself."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")


def count(text, operator):
    """Occurrences in the operator tree, which comes before the details."""
    tree = text.split("\n\n\n")[0]
    return len(re.findall(rf"[-+ ]{operator}\b", tree))


def scans(text):
    return re.findall(r"ReadSchema: (.*)", text)


def no_cartesian(text):
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_dedup_never_shuffles_wide_rows(t):
    text = plan(dedup.dedup_works(t.works, unique_ids=True))
    assert count(text, "Exchange") == 0 and count(text, "BroadcastHashJoin") == 1
    no_cartesian(text)


def test_looking_for_repeats_shuffles_no_ids(spark, t):
    """Without repeats the plan is that of unique ids; with them few rows pass the window."""
    text = plan(dedup.dedup_works(t.works))
    assert count(text, "Exchange") == 0 and count(text, "BroadcastHashJoin") == 1
    (doi,) = t.works.agg(F.min("doi")).first()
    copied = t.works.unionAll(t.works.filter(F.col("doi") == doi))
    text = plan(dedup.dedup_works(copied))
    assert count(text, "WindowGroupLimit") == 2 and count(text, "Exchange") == 1
    no_cartesian(text)


def test_rank_reads_one_leaf_per_list_and_sorts_counts_only(t):
    text = plan(dedup.best_records(t.works, ["publication_year"]))
    (schema,) = scans(text)
    assert "authorships:array<struct<author_position:string>>" in schema
    assert "topics:array<struct<id:string>>" in schema and "concepts" not in schema
    assert count(text, "Exchange") == 1
    for sorted_columns in re.findall(r"Sort\nInput \[\d+\]: (.*)", text):
        assert "abstract" not in sorted_columns.replace("_no_abstract", "")
        assert "authorships" not in sorted_columns


def test_ranked_route_limits_rows_before_the_shuffle(t):
    text = plan(dedup.dedup_works(t.works, unique_ids=False))
    assert count(text, "WindowGroupLimit") == 2 and count(text, "Exchange") == 1


def test_dedup_fallback_hashes_the_narrow_side(t):
    text = plan(dedup.dedup_works(t.works, unique_ids=True, broadcast_bytes=0))
    assert count(text, "ShuffledHashJoin") == 1 and count(text, "SortMergeJoin") == 0


def test_lookup_is_narrow(t):
    lookup = link.papers_lookup(t.papers, dedup.best_records(t.works, ["publication_year"]))
    text = plan(lookup)
    no_cartesian(text)
    for schema in scans(text):
        assert "venue" not in schema and "s2fieldsofstudy" not in schema
        assert "ArXiv" not in schema and "concepts" not in schema
    # Papers were scanned for the staged ids and DOIs only; works are scanned here.
    assert len(scans(text)) == 2 and "IsNotNull(doi)" in text


def test_metrics_use_one_scan_one_join_and_one_aggregate(t):
    others = {"has_abstract": t.abstracts, "has_fulltext": t.fulltext}
    for broadcast_bytes, joins in ((10**6, "BroadcastHashJoin"), (0, "SortMergeJoin")):
        flagged = enrich.flag_all(t.papers, others, broadcast_bytes=broadcast_bytes)
        text = plan(metrics.field_metrics(flagged, ordered=False))
        assert count(text, joins) == 1 and count(text, "Expand") == 1
        # The groups, and without broadcast both sides of the join.
        assert count(text, "Exchange") == (1 if broadcast_bytes else 3)
        assert len(scans(text)) == 2 and all("venue" not in s for s in scans(text))
        assert "GreaterThanOrEqual(year,1900)" in text


@pytest.mark.parametrize("stride", [1, 97, 10**9 + 7])
def test_papers_stay_in_place_for_a_million_ids(spark, t, stride):
    """Near or far apart: too many to broadcast one by one, few enough as packed words."""
    many = spark.range(1_000_000).select((F.col("id") * stride).alias("corpusid"))
    ids = t.papers.select("corpusid")
    flagged = enrich.flag_all(ids, {"flag": many})
    (above,) = re.findall(r"(?s)(.*?)BroadcastExchange", plan(flagged).split("\n\n\n")[0])
    assert "BroadcastHashJoin" in above and not re.search(r"[-+ ]Exchange\b", above)
    known = {r.corpusid for r in ids.collect()}
    hits = sum(i is not None and i % stride == 0 and i // stride < 10**6 for i in known)
    assert flagged.filter("flag").select("corpusid").distinct().count() == hits


def test_topics_in_place_for_few_papers(t):
    lookup = link.papers_lookup(t.papers, dedup.best_records(t.works, ["publication_year"]))
    prior = t.papers_prior.select("corpusid", "oa_topics")
    text = plan(enrich.enrich_topics(prior, lookup, t.works, unique_ids=True))
    # Works are scanned once, next to the broadcast; only results meet papers by key.
    assert count(text, "BroadcastHashJoin") == 1 and count(text, "Exchange") == 2
    assert sum("topics" in s and "oa_topics" not in s for s in scans(text)) == 1


def test_topics_shuffled_for_many_papers(t):
    lookup = link.papers_lookup(t.papers, dedup.best_records(t.works, ["publication_year"]))
    prior = t.papers_prior.select("corpusid", "oa_topics")
    text = plan(
        enrich.enrich_topics(prior, lookup, t.works, unique_ids=True, broadcast_bytes=0)
    )
    assert count(text, "ShuffledHashJoin") == 1 and "SortAggregate" not in text
    no_cartesian(text)


def test_repeated_ids_cost_no_extra_shuffle(t):
    lookup = link.papers_lookup(t.papers, dedup.best_records(t.works, ["publication_year"]))
    prior = t.papers_prior.select("corpusid", "oa_topics")
    exchanges = {
        unique: count(
            plan(enrich.enrich_topics(prior, lookup, t.works, "force", unique, broadcast_bytes=0)),
            "Exchange",
        )
        for unique in (True, False)
    }
    # Works and links by work, found topics and papers by paper.
    assert exchanges == {True: 4, False: 4}


def test_corpus_leaves_texts_in_place(t):
    flagged = enrich.flag_all(t.papers, {"has_fulltext": t.fulltext})
    text = plan(corpus.fulltext_corpus(flagged, t.fulltext))
    assert count(text, "Exchange") == 0 and count(text, "BroadcastHashJoin") == 1
    assert "IsNotNull(body.text), Not(EqualTo(body.text,))" in text


def test_corpus_fallback_filters_texts_before_the_shuffle(t, setting):
    setting("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "0")
    flagged = enrich.flag_all(t.papers, {"has_fulltext": t.fulltext})
    text = plan(corpus.fulltext_corpus(flagged, t.fulltext, broadcast_bytes=0))
    assert count(text, "ShuffledHashJoin") == 1 and count(text, "Sort") == 0
    assert "might_contain" in text


def test_trend_ranks_with_top_k(t):
    text = plan(trends.trend(trends.topic_counts(t.works), "topic_name"))
    assert count(text, "TakeOrderedAndProject") == 1 and count(text, "BroadcastHashJoin") == 1
    assert all("score" not in s and "concepts" not in s for s in scans(text))


def test_point_lookup_reaches_the_scan(t):
    assert "EqualTo(id,W42)" in plan(trends.work_by_id(t.works, "W42"))


def test_one_year_prunes_folders(spark, tmp_path):
    works(spark, work("W1"), work("W2", year=2001)).write.partitionBy("publication_year").parquet(
        f"{tmp_path}/w"
    )
    one = scan.year_filter(spark.read.parquet(f"{tmp_path}/w"), "publication_year", 2001)
    assert re.search(r"PartitionFilters: \[.*publication_year#\d+ = 2001", plan(one))


def test_skewed_join_without_salts_is_split_at_run_time(spark, setting):
    """Keys that should be unique are not salted; adaptive execution still splits them."""
    setting("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "10KB")
    setting("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10KB")
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    setting("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "0")
    setting("spark.sql.shuffle.partitions", "8")
    papers = spark.range(0, 40000, numPartitions=8).selectExpr(
        "if(id % 3 = 0, 7, id) AS corpusid", "id AS n"
    )
    others = {"flag": spark.range(20).toDF("corpusid")}
    flagged = enrich.flag_all(papers, others, broadcast_bytes=0)
    hits = [r["n"] for r in flagged.collect() if r["flag"]]
    assert len(hits) == 13334 + 13  # the hot key and the other keys below 20
    assert "skew=true" in flagged._jdf.queryExecution().executedPlan().toString().lower()
