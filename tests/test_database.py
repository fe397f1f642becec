"""The whole build on the smallest tables, checked against SQL over the same tables."""

import pytest
from frames import rows
from oracle import connect
from pyspark.sql import functions as F

from paperloom.operators import audit, enrich
from paperloom.plans.scholarly import Database, Inputs
from paperloom.registry.fixtures import Tables, with_tables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    raw = tmp_path_factory.mktemp("raw")
    t = Tables(spark, FOLDER)
    for name in ("works", "papers", "abstracts", "fulltext"):
        getattr(t, name).write.parquet(f"{raw}/{name}")
    t.given("supplier").selectExpr("s_name AS id", "true AS is_indexed_in_scopus").write.parquet(
        f"{raw}/sources-old"
    )
    t.given("supplier").selectExpr("s_name AS id", "'y' AS is_indexed_in_scopus").write.parquet(
        f"{raw}/sources-new"
    )
    return Inputs(
        works=f"{raw}/works",
        sources=[f"{raw}/sources-old", f"{raw}/sources-new"],
        papers=f"{raw}/papers",
        abstracts=f"{raw}/abstracts",
        fulltext=f"{raw}/fulltext",
    )


@pytest.fixture(scope="module")
def built(spark, inputs, tmp_path_factory):
    db = Database(spark, str(tmp_path_factory.mktemp("database")))
    db.build(inputs)
    return db


def sql(query, *names):
    found = connect(FOLDER).execute(with_tables(*names, query=query)).fetchall()
    return sorted((tuple(r) for r in found), key=repr)


def test_loads(spark, built):
    found = sql("SELECT count(*) FROM works WHERE publication_year BETWEEN 1900 AND 2026", "works")
    assert found == [(spark.table("oa_works").count(),)]
    assert spark.table("oa_sources").columns == ["id"] and spark.table("oa_sources").count() == 20


def test_flags_and_topics_of_loaded_papers(spark, built):
    composed = spark.table("papers")
    expected = sql(
        """SELECT corpusid, has_abstract, has_fulltext FROM flagged
           WHERE year BETWEEN 1900 AND 2026""",
        "flagged",
    )
    assert rows(composed, "corpusid", "has_abstract", "has_fulltext") == expected
    # Works outside the load bounds are not there to be linked, nor to compete for a DOI.
    assert composed.filter("oa_topics IS NOT NULL").count() > 50
    assert composed.count() == spark.table("s2_papers").count()


def test_metrics_and_corpus(spark, built):
    metrics = sql("SELECT * FROM venue_counts", "venue_counts")
    assert rows(spark.table("venue_metrics"), "venue", "year", "metric_type", "count") == metrics
    exported = spark.read.parquet(f"{built.root}/export/venue_metrics")
    assert rows(exported, "venue", "year", "metric_type", "count") == metrics
    texts = sql("SELECT corpusid, text FROM corpus WHERE year BETWEEN 1900 AND 1990", "corpus")
    assert rows(spark.table("arxiv_fulltext"), "corpusid", "text") == texts


def test_deduplicated_view(spark, built):
    view = spark.table("oa_works_deduped")
    assert view.count() == view.select("doi").distinct().count()


def test_every_job_is_logged(spark, built):
    log = audit.run_log(spark, built.log)
    assert {r["job"] for r in log.select("job").distinct().collect()} == set(built.jobs)
    last = log.filter("job = 'oa_works'").first()
    assert last["total_rows"] == spark.table("oa_works").count() and last["min_year"] >= 1900


def test_reloading_keeps_derived_data_and_flags_follow_the_mode(spark, inputs, built, tmp_path):
    before = rows(spark.table("paper_flags"), "corpusid", "has_abstract", "has_fulltext")
    topics = rows(spark.table("paper_topics").select("corpusid", F.col("oa_topics.id").alias("t")), "t")
    missing = spark.table("paper_flags").filter("NOT has_abstract").select("corpusid")
    late = missing.orderBy("corpusid").limit(1)
    (corpusid,) = late.first()
    spark.read.parquet(inputs.abstracts).unionAll(late).write.parquet(f"{tmp_path}/abstracts")
    newer = Inputs(**{**vars(inputs), "abstracts": f"{tmp_path}/abstracts"})

    again = Database(spark, built.root)
    again.load(newer)
    again.flag("incremental")
    again.enrich("incremental")
    assert rows(spark.table("paper_flags"), "corpusid", "has_abstract", "has_fulltext") == before
    now = spark.table("paper_topics").select("corpusid", F.col("oa_topics.id").alias("t"))
    assert rows(now, "t") == topics
    again.flag("recompute")
    changed = spark.table("paper_flags").filter(f"corpusid = {corpusid}").first()
    assert changed["has_abstract"] is True


def test_steps_run_in_a_session_of_their_own(spark, built):
    later = Database(spark.newSession(), built.root)
    later.link()
    later.flag()
    later.enrich()
    later.count()
    log = audit.run_log(spark, built.log).filter("job = 'has_abstract'")
    first, last = log.orderBy("run_id").first(), log.orderBy(F.desc("run_id")).first()
    assert first["rows_updated"] == first["rows_covered"] > 0 and last["rows_updated"] == 0
    shares = spark.table("topic_trend").groupBy("year_bin").agg(F.sum("share").alias("s"))
    assert all(abs(r["s"] - 1) < 1e-9 for r in shares.collect())


def test_update_counts_cost_no_second_join(spark, built):
    """The numbers come with the write: they equal the report, and few Spark jobs are needed."""
    started = lambda: spark.sparkContext._jsc.sc().statusStore().jobsList(None).size()
    later = Database(spark, built.root)
    state = later._state("paper_flags", ["has_abstract", "has_fulltext"])
    report = enrich.flag_report(state, later.table("s2_abstracts"), "corpusid", "has_abstract", "force").first()
    before = started()
    later.flag("force")
    assert started() - before <= 18  # 33 with a report for each flag and a count of the result
    last = audit.run_log(spark, built.log).filter("job = 'has_abstract'").orderBy(F.desc("run_id")).first()
    assert (last.total_rows, last.rows_updated, last.rows_covered) == tuple(report)[:3]
    files = lambda: spark.read.parquet(built.log).inputFiles()
    n = len(files())
    later.enrich()
    assert len(files()) == n + 1  # one file for all records of a step


def test_coverage_comes_from_the_log(spark, inputs, tmp_path):
    papers = spark.read.parquet(inputs.papers).filter("year BETWEEN 1900 AND 2025")
    nameless = papers.limit(3).withColumn("corpusid", F.lit(None).cast("bigint"))
    papers.unionAll(papers.limit(20)).unionAll(nameless).write.parquet(f"{tmp_path}/papers")
    newer = Inputs(**{**vars(inputs), "papers": f"{tmp_path}/papers"})
    db = Database(spark, f"{tmp_path}/database")
    with pytest.raises(Exception):
        db.coverage()
    db.load(newer)
    assert db.coverage().isEmpty()  # no side table yet
    db.link()
    db.flag()
    db.enrich()

    def check(joins):
        db.compose()
        counted, found = enrich.enrichment_coverage(spark.table("papers")), db.coverage()
        assert rows(found, "column", "total", "covered", "pct") == rows(counted, "column", "total", "covered", "pct")
        assert found.count() == 3
        text = found._jdf.queryExecution().executedPlan().toString()
        assert ("Join" in text) == joins

    check(joins=False)
    again = Inputs(**{**vars(inputs), "papers": inputs.papers})
    db.load(again)
    check(joins=True)  # counts of the other papers do not hold
    db.flag("recompute")
    check(joins=True)
    db.enrich()
    check(joins=False)


def test_repeated_and_missing_ids_keep_their_rows(spark, inputs, tmp_path):
    papers = spark.read.parquet(inputs.papers)
    repeated = papers.filter("year BETWEEN 1900 AND 2025").limit(20)
    nameless = repeated.limit(3).withColumn("corpusid", F.lit(None).cast("bigint"))
    papers.unionAll(repeated).unionAll(nameless).write.parquet(f"{tmp_path}/papers")
    db = Database(spark, f"{tmp_path}/database")
    db.load(Inputs(**{**vars(inputs), "papers": f"{tmp_path}/papers"}))
    db.link()
    n = spark.table("s2_papers").count()
    ids = spark.table("s2_papers").select("corpusid").distinct().filter("corpusid IS NOT NULL").count()
    for _ in range(3):
        db.flag()
        db.enrich()
        db.compose()
        assert spark.table("paper_flags").count() == spark.table("paper_topics").count() == ids
        whole = spark.table("papers")
        assert whole.count() == n and whole.filter("has_abstract IS NULL").count() == 0


def test_load_reads_files_at_every_depth(spark, inputs, tmp_path):
    papers = spark.read.parquet(inputs.papers)
    early = papers.filter("year < 1950")
    early.write.parquet(f"{tmp_path}/papers")
    papers.filter("year >= 1950 AND year < 1990").write.parquet(f"{tmp_path}/papers/more/deep")
    papers.filter("year >= 1990").write.partitionBy("year").parquet(f"{tmp_path}/papers/late")
    db = Database(spark, f"{tmp_path}/database")
    db.load(Inputs(**{**vars(inputs), "papers": f"{tmp_path}/papers"}))
    expected = papers.filter("year BETWEEN 1900 AND 2026")
    loaded = spark.table("s2_papers")
    assert rows(loaded, "corpusid", "year") == rows(expected, "corpusid", "year")


def test_one_year(spark, inputs, tmp_path):
    db = Database(spark, str(tmp_path))
    db.build(inputs, test_year=1980)
    assert rows(spark.table("s2_papers").select("year").distinct(), "year") == [(1980,)]
    assert rows(spark.table("oa_works").select("publication_year").distinct(), "publication_year") == [
        (1980,)
    ]
