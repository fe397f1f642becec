"""The registered queries. Each one names the SQL that states its result on the same tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paperloom.functions.columns import list_length
from paperloom.functions.nested import add_typed_column
from paperloom.functions.staging import stage
from paperloom.operators import audit, corpus, dedup, enrich, link, metrics, trends
from paperloom.plans.scholarly import topic_years
from paperloom.registry.fixtures import SQL, Tables, with_tables
from paperloom.schemas import TABLES, TOPICS, struct_of
from paperloom.session import shared_folder
from paperloom.sources import export, footers, releases, scan, tables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, *needs: str, sql: str | None = None):
    """Register a function of `Tables`; `sql` may use the derived tables in `needs`."""

    def keep(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLE[name] = with_tables(*needs, query=sql) if needs else sql
        return build

    return keep


def fresh(t: Tables, label: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(t.spark)}/{label}-{uuid.uuid4().hex}"


def written(t: Tables, df: DataFrame, label: str) -> str:
    path = fresh(t, label)
    df.write.parquet(path)
    return path


# ---- scans, loads and sinks ----------------------------------------------------------------


@register(
    "scan_parquet_glob",
    sql="""
    SELECT source, lang, count(*) AS docs, CAST(sum(n_chars) AS BIGINT) AS chars
    FROM documents GROUP BY source, lang""",
)
def _(t: Tables) -> DataFrame:
    docs = scan.scan_parquet(t.spark, t.folder, pattern="documents.parquet")
    return docs.groupBy("source", "lang").agg(
        F.count(F.lit(1)).alias("docs"), F.sum("n_chars").alias("chars")
    )


@register("scan_parquet_tree", sql="SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders")
def _(t: Tables) -> DataFrame:
    # Files at the top, files in a plain folder, and a part in folders by year.
    orders = t.given("orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    root = written(t, orders.filter("year < 1997"), "orders")
    orders.filter("year = 1997").write.parquet(f"{root}/more/deep")
    orders.filter("year > 1997").write.partitionBy("year").parquet(f"{root}/late")
    return scan.scan_parquet(t.spark, root, folder_columns=True).select("o_orderkey", "year")


_DECLARED_SQL = """
    SELECT 'W' || doc_id AS id, 1890 + doc_id % 140 AS publication_year, lang AS type,
      CAST(NULL AS VARCHAR) AS first_topic, 1 AS n_columns_missing FROM documents"""


@register("declared_works", sql=_DECLARED_SQL)
def _(t: Tables) -> DataFrame:
    """JSON lines through the declared schema of works: what a line lacks is NULL."""
    line = F.to_json(
        F.expr(
            "named_struct('id', concat('W', doc_id), 'type', lang, "
            "'publication_year', 1890 + doc_id % 140, 'no_such_column', 1)"
        )
    )
    source = fresh(t, "works-json")
    t.given("documents").select(line.alias("value")).write.text(source)
    works = struct_of(TABLES["works"])
    good, _bad = releases.ingest_json(t.spark, source, fresh(t, "works"), works)
    return good.select(
        "id",
        F.col("publication_year").cast("bigint").alias("publication_year"),
        "type",
        F.get("topics", F.lit(0))["display_name"].alias("first_topic"),
        F.when(F.col("doi").isNull(), 1).otherwise(0).alias("n_columns_missing"),
    )


def _source_vintages(t: Tables) -> list[str]:
    """Two vintages of a sources table: one lacks a column, one changes the type of another."""
    old = t.given("supplier").select(
        F.concat(F.lit("S"), "s_suppkey").alias("id"),
        F.col("s_name").alias("display_name"),
        F.col("s_nationkey").alias("works_count"),
        (F.col("s_acctbal") > 0).alias("is_indexed_in_scopus"),
    )
    new = t.given("customer").select(
        F.col("c_mktsegment").alias("type"),
        F.concat(F.lit("C"), "c_custkey").alias("id"),
        F.col("c_name").alias("display_name"),
        F.col("c_mktsegment").alias("is_indexed_in_scopus"),
    )
    return [written(t, old, "sources-old"), written(t, new, "sources-new")]


_VINTAGE_SQL = """
    SELECT 'S' || s_suppkey AS id, s_name AS display_name, s_nationkey AS works_count,
      CAST(NULL AS VARCHAR) AS type FROM supplier
    UNION ALL
    SELECT 'C' || c_custkey, c_name, NULL, c_mktsegment FROM customer"""


@register("scan_union_by_name", sql=_VINTAGE_SQL)
def _(t: Tables) -> DataFrame:
    return scan.scan_union_by_name(t.spark, _source_vintages(t), drop=["is_indexed_in_scopus"])


@register("scan_declared_schema", sql=_VINTAGE_SQL)
def _(t: Tables) -> DataFrame:
    declared = struct_of(
        "id STRING, display_name STRING, works_count INT, type STRING, is_indexed_in_scopus BOOLEAN"
    )
    return scan.scan_union_by_name(
        t.spark, _source_vintages(t), drop=["is_indexed_in_scopus"], schema=declared
    )


_RELEASE = (
    "corpusid BIGINT, externalids STRUCT<DOI: STRING, ArXiv: STRING>, venue STRING, year BIGINT, "
    "s2fieldsofstudy ARRAY<STRUCT<category: STRING, source: STRING>>"
)


def _release(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Papers as gzipped JSON lines; lines of full texts in one language are cut short."""
    lines = (
        t.papers.select("corpusid", F.to_json(F.struct("*")).alias("line"))
        .join(t.given("documents").select(F.col("doc_id").alias("corpusid"), "lang"), "corpusid")
        .select(
            F.when(F.col("lang") == "es", F.expr("left(line, length(line) - 1)"))
            .otherwise(F.col("line"))
            .alias("value")
        )
    )
    source = fresh(t, "release")
    lines.write.option("compression", "gzip").text(source)
    return releases.ingest_json(t.spark, source, fresh(t, "papers"), struct_of(_RELEASE))


@register(
    "ingest_json_gz",
    "papers",
    sql="""
    SELECT p.corpusid, p.externalids.DOI AS doi, p.externalids.ArXiv AS arxiv, p.venue, p.year,
      len(p.s2fieldsofstudy) AS n_fields
    FROM papers p JOIN documents d ON d.doc_id = p.corpusid WHERE d.lang <> 'es'""",
)
def _(t: Tables) -> DataFrame:
    good, _bad = _release(t)
    return good.select(
        "corpusid",
        F.col("externalids.DOI").alias("doi"),
        F.col("externalids.ArXiv").alias("arxiv"),
        "venue",
        "year",
        list_length("s2fieldsofstudy.source").cast("bigint").alias("n_fields"),
    )


@register(
    "ingest_json_quarantine",
    sql="SELECT count(*) AS bad_lines FROM documents WHERE lang = 'es'",
)
def _(t: Tables) -> DataFrame:
    _good, bad = _release(t)
    return bad.agg(F.count("raw_line").alias("bad_lines"))


def _loaded_works(t: Tables, **options) -> DataFrame:
    path = fresh(t, "works")
    tables.load_table(t.works, path, partition_by="publication_year", **options)
    return tables.read_back(t.works, path)


_WORK_COLUMNS = """
    SELECT id, doi, publication_year, cited_by_count, len(authorships) AS n_authors,
      abstract_inverted_index IS NOT NULL AS has_abstract, len(topics) AS n_topics"""


def _work_columns(works: DataFrame) -> DataFrame:
    return works.select(
        "id",
        "doi",
        "publication_year",
        "cited_by_count",
        list_length("authorships.author_position").cast("bigint").alias("n_authors"),
        F.col("abstract_inverted_index").isNotNull().alias("has_abstract"),
        list_length("topics.id").cast("bigint").alias("n_topics"),
    )


@register(
    "load_year_filter",
    "works",
    sql=f"{_WORK_COLUMNS} FROM works WHERE publication_year BETWEEN 1900 AND 2026",
)
def _(t: Tables) -> DataFrame:
    return _work_columns(_loaded_works(t))


@register(
    "load_test_year", "works", sql=f"{_WORK_COLUMNS} FROM works WHERE publication_year = 2000"
)
def _(t: Tables) -> DataFrame:
    return _work_columns(_loaded_works(t, test_year=2000))


@register(
    "load_unpartitioned",
    sql="SELECT count(*) AS total_rows FROM supplier",
)
def _(t: Tables) -> DataFrame:
    return tables.load_table(t.given("supplier"), fresh(t, "sources"))


@register(
    "load_stats",
    "works",
    sql="""
    SELECT count(*) AS total_rows, count(DISTINCT publication_year) AS distinct_years,
      min(publication_year) AS min_year, max(publication_year) AS max_year
    FROM works WHERE publication_year BETWEEN 1900 AND 2026""",
)
def _(t: Tables) -> DataFrame:
    return tables.load_table(t.works, fresh(t, "works"), partition_by="publication_year")


@register(
    "view_parquet", "abstracts", sql="SELECT corpusid, count(*) AS n FROM abstracts GROUP BY corpusid"
)
def _(t: Tables) -> DataFrame:
    scan.view_parquet(t.spark, "s2_abstracts", written(t, t.abstracts, "abstracts"))
    return t.spark.sql("SELECT corpusid, count(*) AS n FROM s2_abstracts GROUP BY corpusid")


@register("rebuild_table", "lookup", sql="SELECT corpusid, oa_id, publication_year FROM lookup")
def _(t: Tables) -> DataFrame:
    root = fresh(t, "papers-lookup")
    # The second refresh reads the first one through the view it replaces.
    tables.rebuild_table(_lookup(t), root, "papers_lookup")
    tables.rebuild_table(t.spark.table("papers_lookup"), root, "papers_lookup")
    return t.spark.table("papers_lookup").select("corpusid", "oa_id", "publication_year")


@register(
    "create_if_absent",
    "corpus",
    sql="""
    SELECT call, created, total_rows, distinct_years, min_year, max_year
    FROM (SELECT count(*) AS total_rows, count(DISTINCT year) AS distinct_years,
            min(year) AS min_year, max(year) AS max_year FROM corpus WHERE year < 1991),
      (VALUES (1, TRUE), (2, FALSE), (3, TRUE)) AS calls(call, created)""",
)
def _(t: Tables) -> DataFrame:
    path = fresh(t, "corpus")
    calls = []
    for call, force in ((1, False), (2, False), (3, True)):
        created, stats = tables.create_if_absent(t.spark, path, lambda: _corpus(t), force=force)
        # The rows that this call made or found, though a later one makes another version.
        kept = stage(stats, "corpus-stats").frame
        calls.append(kept.select(F.lit(call).alias("call"), F.lit(created).alias("created"), "*"))
    return calls[0].unionAll(calls[1]).unionAll(calls[2])


@register(
    "add_typed_column",
    "papers",
    sql="""
    SELECT corpusid, CAST(NULL AS BOOLEAN) AS has_abstract, 0 AS n_topics FROM papers""",
)
def _(t: Tables) -> DataFrame:
    once = add_typed_column(t.papers, "has_abstract", "boolean")
    twice = add_typed_column(once, "has_abstract", "boolean")
    typed = add_typed_column(twice, "oa_topics", TOPICS)
    n_topics = F.coalesce(list_length("oa_topics.subfield.id"), F.lit(0)).alias("n_topics")
    return typed.select("corpusid", "has_abstract", n_topics)


# ---- deduplication and linking -------------------------------------------------------------


@register("dedup_works", "deduped", sql=f"{_WORK_COLUMNS} FROM deduped")
def _(t: Tables) -> DataFrame:
    return _work_columns(dedup.dedup_works(t.works, unique_ids=True))


@register("dedup_works_repeated_ids", "deduped", sql=f"{_WORK_COLUMNS} FROM deduped")
def _(t: Tables) -> DataFrame:
    return _work_columns(dedup.dedup_works(t.works, unique_ids=False))


_HOLEY = "(SELECT * REPLACE (CASE WHEN id NOT LIKE '%3' THEN id END AS id) FROM works) AS holey"
_HOLEY_SQL = SQL["deduped"].replace("(works,", "(holey,").replace("FROM works", f"FROM {_HOLEY}")


@register("dedup_works_missing_ids", "works", sql=f"{_WORK_COLUMNS} FROM ({_HOLEY_SQL})")
def _(t: Tables) -> DataFrame:
    some = F.when(~F.col("id").like("%3"), F.col("id"))
    return _work_columns(dedup.dedup_works(t.works.withColumn("id", some), unique_ids=True))


@register(
    "best_records",
    "deduped",
    sql="""
    SELECT b.doi, b.id, b.publication_year, c.copies FROM deduped b
    JOIN (SELECT doi, count(*) AS copies FROM works GROUP BY doi) c ON b.doi = c.doi""",
)
def _(t: Tables) -> DataFrame:
    return dedup.best_records(t.works, ["publication_year"])


def _lookup(t: Tables, **options) -> DataFrame:
    best = dedup.best_records(t.works, ["publication_year"])
    return link.papers_lookup(t.papers, best, **options)


_LOOKUP_SQL = """
    SELECT corpusid, oa_id, publication_year, 'doi' AS match_method,
      CAST(1.0 AS FLOAT) AS match_confidence FROM lookup"""


@register("papers_lookup", "lookup", sql=_LOOKUP_SQL)
def _(t: Tables) -> DataFrame:
    return _lookup(t).drop("created_at")


@register(
    "papers_lookup_lower",
    "papers",
    "deduped",
    sql="""
    SELECT CAST(p.corpusid AS INTEGER) AS corpusid, w.id AS oa_id,
      CAST(w.publication_year AS SMALLINT) AS publication_year, 'doi_lower' AS match_method
    FROM papers p JOIN deduped w
      ON lower(p.externalids.DOI) = lower(replace(w.doi, 'https://doi.org/', ''))
    WHERE w.publication_year BETWEEN 1900 AND 2025""",
)
def _(t: Tables) -> DataFrame:
    return _lookup(t, normalize="lower").drop("created_at", "match_confidence")


# ---- flags and topics ----------------------------------------------------------------------

_HIT_SQL = {
    "incremental": "coalesce({flag}, corpusid IN (SELECT corpusid FROM {other}))",
    "force": "corpusid IN (SELECT corpusid FROM {other}) OR coalesce({flag}, FALSE)",
    "recompute": "corpusid IN (SELECT corpusid FROM {other})",
}


def _register_flag(flag: str, other: str, mode: str) -> None:
    after = _HIT_SQL[mode].format(flag=flag, other=other)

    @register(
        f"flag_{other.rstrip('s')}_{mode}",
        "papers_prior",
        other,
        sql=f"SELECT corpusid, {after} AS {flag} FROM papers_prior",
    )
    def _(t: Tables) -> DataFrame:
        prior = t.papers_prior.select("corpusid", flag)
        return enrich.flag_exists(prior, getattr(t, other), "corpusid", flag, mode)


for _mode in enrich.FLAG_MODES:
    _register_flag("has_abstract", "abstracts", _mode)
    _register_flag("has_fulltext", "fulltext", _mode)


def _flagged(t: Tables) -> DataFrame:
    return enrich.flag_all(t.papers, {"has_abstract": t.abstracts, "has_fulltext": t.fulltext})


_TOPIC_SQL = """
    SELECT p.corpusid,
      CASE WHEN {take} THEN array_to_string(list_transform(m.topics, lambda x: x.id), '|')
           ELSE p.old_topic END AS topic_ids,
      CASE WHEN {take} THEN m.topics[1].id ELSE p.old_topic END AS primary_topic,
      CASE WHEN {take} THEN len(m.concepts) END AS n_concepts
    FROM papers_prior p LEFT JOIN topic_match m ON m.corpusid = p.corpusid"""
_TAKE_SQL = {
    "incremental": "m.corpusid IS NOT NULL AND p.old_topic IS NULL",
    "force": "m.corpusid IS NOT NULL",
}


def _enriched(t: Tables, mode: str, **options) -> DataFrame:
    prior = t.papers_prior.select("corpusid", "oa_topics", "oa_primary_topic")
    return enrich.enrich_topics(prior, _lookup(t), t.works, mode, **options)


def _topic_columns(papers: DataFrame) -> DataFrame:
    return papers.select(
        "corpusid",
        F.array_join("oa_topics.id", "|").alias("topic_ids"),
        F.col("oa_primary_topic.id").alias("primary_topic"),
        list_length("oa_concepts.id").cast("bigint").alias("n_concepts"),
    )


def _register_topics(mode: str) -> None:
    @register(
        f"enrich_topics_{mode}",
        "papers_prior",
        "topic_match",
        sql=_TOPIC_SQL.format(take=_TAKE_SQL[mode]),
    )
    def _(t: Tables) -> DataFrame:
        return _topic_columns(_enriched(t, mode))


for _mode in enrich.TOPIC_MODES:
    _register_topics(_mode)


@register(
    "enrich_topics_shuffled",
    "papers_prior",
    "topic_match",
    sql=_TOPIC_SQL.format(take=_TAKE_SQL["force"]),
)
def _(t: Tables) -> DataFrame:
    return _topic_columns(_enriched(t, "force", broadcast_bytes=0))


_REPORT_SQL = """
    SELECT '{job}' AS job, '{mode}' AS mode, count(*) AS total,
      CAST(count_if({updated}) AS BIGINT) AS rows_updated,
      CAST(count_if({after}) AS BIGINT) AS covered,
      round(100.0 * count_if({after}) / count(*), 1) AS pct
    FROM {frame}"""


def _report_sql() -> str:
    parts = []
    for flag, other in (("has_abstract", "abstracts"), ("has_fulltext", "fulltext")):
        hit = f"corpusid IN (SELECT corpusid FROM {other})"
        for mode in ("incremental", "force"):
            pending = f" AND {flag} IS NULL" if mode == "incremental" else ""
            parts.append(
                _REPORT_SQL.format(
                    job=flag,
                    mode=mode,
                    updated=hit + pending,
                    after=_HIT_SQL[mode].format(flag=flag, other=other),
                    frame="papers_prior",
                )
            )
    for mode in ("incremental", "force"):
        take = _TAKE_SQL[mode]
        parts.append(
            _REPORT_SQL.format(
                job="oa_topics",
                mode=mode,
                updated=take,
                after=f"CASE WHEN {take} THEN m.topics IS NOT NULL ELSE p.old_topic IS NOT NULL END",
                frame="papers_prior p LEFT JOIN topic_match m ON m.corpusid = p.corpusid",
            )
        )
    return "\n    UNION ALL".join(parts)


@register(
    "rows_updated", "papers_prior", "abstracts", "fulltext", "topic_match", sql=_report_sql()
)
def _(t: Tables) -> DataFrame:
    reports = []
    for flag, other in (("has_abstract", t.abstracts), ("has_fulltext", t.fulltext)):
        for mode in ("incremental", "force"):
            report = enrich.flag_report(
                t.papers_prior.select("corpusid", flag), other, "corpusid", flag, mode
            )
            reports.append((flag, mode, report))
    prior = t.papers_prior.select("corpusid", "oa_topics")
    for mode in ("incremental", "force"):
        reports.append(
            ("oa_topics", mode, enrich.topic_report(prior, _lookup(t), t.works, mode))
        )
    result = None
    for job, mode, report in reports:
        part = report.select(F.lit(job).alias("job"), F.lit(mode).alias("mode"), "*")
        result = part if result is None else result.unionAll(part)
    return result


@register(
    "enrichment_coverage",
    "flagged",
    "topic_match",
    sql="""
    SELECT c.column_name AS "column", count(*) AS total,
      CAST(count_if(CASE c.column_name WHEN 'has_abstract' THEN has_abstract
        WHEN 'has_fulltext' THEN has_fulltext ELSE topics IS NOT NULL END) AS BIGINT) AS covered,
      round(100.0 * count_if(CASE c.column_name WHEN 'has_abstract' THEN has_abstract
        WHEN 'has_fulltext' THEN has_fulltext ELSE topics IS NOT NULL END) / count(*), 1) AS pct
    FROM flagged p LEFT JOIN topic_match m ON m.corpusid = p.corpusid,
      (VALUES ('has_abstract'), ('has_fulltext'), ('oa_topics')) AS c(column_name)
    GROUP BY c.column_name""",
)
def _(t: Tables) -> DataFrame:
    flagged = _flagged(t).select("corpusid", "has_abstract", "has_fulltext")
    return enrich.enrichment_coverage(enrich.enrich_topics(flagged, _lookup(t), t.works))


# ---- metrics -------------------------------------------------------------------------------


@register("field_metrics", "field_counts", sql="SELECT * FROM field_counts")
def _(t: Tables) -> DataFrame:
    return metrics.field_metrics(_flagged(t))


@register("venue_metrics", "venue_counts", sql="SELECT * FROM venue_counts")
def _(t: Tables) -> DataFrame:
    return metrics.venue_metrics(_flagged(t))


def _summary_sql(group: str) -> str:
    return f"""
    SELECT metric_type, CAST(sum(count) AS BIGINT) AS papers, count(*) AS metric_rows,
      count(DISTINCT {group}) AS distinct_groups, min(year) AS min_year, max(year) AS max_year
    FROM {group}_counts GROUP BY metric_type"""


@register("metrics_summary", "field_counts", sql=_summary_sql("field"))
def _(t: Tables) -> DataFrame:
    return metrics.metrics_summary(metrics.field_metrics(_flagged(t), ordered=False), "field")


@register("metrics_summary_venue", "venue_counts", sql=_summary_sql("venue"))
def _(t: Tables) -> DataFrame:
    return metrics.metrics_summary(metrics.venue_metrics(_flagged(t), ordered=False), "venue")


@register("export_metrics", "venue_counts", sql="SELECT * FROM venue_counts")
def _(t: Tables) -> DataFrame:
    path = fresh(t, "metrics")
    export.export_metrics(metrics.venue_metrics(_flagged(t), ordered=False), path=path)
    return t.spark.read.parquet(path)


# ---- full-text corpus ----------------------------------------------------------------------


def _corpus(t: Tables, year_lt: int | None = 1991, **options) -> DataFrame:
    return corpus.fulltext_corpus(_flagged(t), t.fulltext, year_lt=year_lt, **options)


_CORPUS_SQL = "SELECT * FROM corpus WHERE year < 1991"


@register("fulltext_corpus", "corpus", sql=_CORPUS_SQL)
def _(t: Tables) -> DataFrame:
    return _corpus(t).drop("created_at")


@register(
    "fulltext_corpus_range",
    "corpus",
    sql=f"{_CORPUS_SQL} AND corpusid >= 200 AND corpusid < 700",
)
def _(t: Tables) -> DataFrame:
    return _corpus(t, id_range=(200, 700)).drop("created_at")


@register("fulltext_corpus_shuffled", "corpus", sql=_CORPUS_SQL)
def _(t: Tables) -> DataFrame:
    return _corpus(t, broadcast_bytes=0).drop("created_at")


@register(
    "corpus_stats",
    "corpus",
    sql="""
    SELECT count(*) AS total_papers, count(DISTINCT year) AS unique_years,
      min(year) AS earliest_year, max(year) AS latest_year,
      round(avg(text_length), 6) AS avg_text_length, max(text_length) AS max_text_length,
      CAST(sum(text_length) AS BIGINT) AS total_text_size
    FROM corpus WHERE year < 1991""",
)
def _(t: Tables) -> DataFrame:
    stats = corpus.corpus_stats(_corpus(t))
    return stats.withColumn("avg_text_length", F.round("avg_text_length", 6))


@register(
    "corpus_by_year",
    "corpus",
    sql="""
    SELECT year, count(*) AS papers FROM corpus WHERE year < 2026 AND year >= 2015
    GROUP BY year ORDER BY year DESC LIMIT 10""",
)
def _(t: Tables) -> DataFrame:
    return corpus.corpus_by_year(_corpus(t, year_lt=2026))


@register(
    "corpus_key_range",
    "flagged",
    sql="""
    SELECT min(corpusid) AS min_corpusid, max(corpusid) AS max_corpusid
    FROM flagged WHERE externalids.ArXiv IS NOT NULL AND has_fulltext""",
)
def _(t: Tables) -> DataFrame:
    return corpus.corpus_key_range(_flagged(t))


# ---- trends --------------------------------------------------------------------------------


def _counts(t: Tables) -> DataFrame:
    """Written once: ranking and trend both read it, and the works are scanned once."""
    return stage(trends.topic_counts(t.works), "topic-counts").frame


@register("topic_counts", "topic_counts", sql="SELECT * FROM topic_counts")
def _(t: Tables) -> DataFrame:
    return trends.topic_counts(t.works, ordered=True)


@register(
    "missing_topic_share",
    "topic_counts",
    sql="""
    SELECT CAST(coalesce(sum(num_papers) FILTER (topic_name IS NULL), 0) AS BIGINT) AS n_missing,
      CAST(sum(num_papers) AS BIGINT) AS n_total,
      round(100.0 * coalesce(sum(num_papers) FILTER (topic_name IS NULL), 0) / sum(num_papers), 2)
        AS pct_missing
    FROM topic_counts""",
)
def _(t: Tables) -> DataFrame:
    return trends.missing_topic_share(_counts(t))


def _top_sql(column: str, n: int) -> str:
    return f"""
      SELECT {column}, CAST(sum(num_papers) AS BIGINT) AS num_papers FROM topic_counts
      WHERE {column} IS NOT NULL GROUP BY {column}
      ORDER BY num_papers DESC, {column} LIMIT {n}"""


def _trend_sql(column: str, n: int) -> str:
    return f"""
      SELECT CAST(floor(publication_year / 2) * 2 AS INTEGER) AS year_bin, {column},
        CAST(sum(num_papers) AS BIGINT) AS num_papers
      FROM topic_counts
      WHERE {column} IN (SELECT {column} FROM ({_top_sql(column, n)}))
        AND publication_year IS NOT NULL
      GROUP BY year_bin, {column}"""


@register("top_names", "topic_counts", sql=_top_sql("topic_name", 10))
def _(t: Tables) -> DataFrame:
    return trends.top_names(_counts(t), "topic_name", 10)


@register("subfield_trend", "topic_counts", sql=_trend_sql("subfield_name", 10))
def _(t: Tables) -> DataFrame:
    return trends.trend(_counts(t), "subfield_name", 10)


@register("topic_trend", "topic_counts", sql=_trend_sql("topic_name", 10))
def _(t: Tables) -> DataFrame:
    return trends.trend(_counts(t), "topic_name", 10)


def _share_sql(column: str) -> str:
    return f"""
    SELECT year_bin, {column}, num_papers,
      round(num_papers / sum(num_papers) OVER (PARTITION BY year_bin), 6) AS share
    FROM ({_trend_sql(column, 10)})"""


def _share(t: Tables, column: str) -> DataFrame:
    shares = trends.trend_share(trends.trend(_counts(t), column, 10))
    return shares.withColumn("share", F.round("share", 6))


@register("trend_share", "topic_counts", sql=_share_sql("subfield_name"))
def _(t: Tables) -> DataFrame:
    return _share(t, "subfield_name")


@register("trend_share_topic", "topic_counts", sql=_share_sql("topic_name"))
def _(t: Tables) -> DataFrame:
    return _share(t, "topic_name")


@register(
    "topic_heatmap",
    "topic_counts",
    sql=f"""
    SELECT CAST(r.name_rank AS INTEGER) AS name_rank, b.topic_name, b.year_bin, b.num_papers
    FROM ({_trend_sql("topic_name", 30)}) b
    JOIN (SELECT topic_name, row_number() OVER (ORDER BY num_papers DESC, topic_name) AS name_rank
          FROM ({_top_sql("topic_name", 30)})) r ON r.topic_name = b.topic_name""",
)
def _(t: Tables) -> DataFrame:
    return trends.heatmap(_counts(t))


@register(
    "explode_topics",
    "works",
    sql="""
    SELECT work_id, t.id AS topic_id, t.display_name AS topic_name,
      t.subfield.id AS subfield_id, t.subfield.display_name AS subfield_display_name,
      t.field.id AS field_id, t.field.display_name AS field_display_name,
      t.domain.id AS domain_id, t.domain.display_name AS domain_display_name, t.score AS score
    FROM (SELECT id AS work_id, unnest(topics) AS t FROM works)""",
)
def _(t: Tables) -> DataFrame:
    return trends.explode_topics(t.works)


@register("work_by_id", "works", sql=f"{_WORK_COLUMNS} FROM works WHERE id = 'W42'")
def _(t: Tables) -> DataFrame:
    return _work_columns(trends.work_by_id(t.works, "W42"))


@register(
    "latest_works",
    "works",
    sql=f"{_WORK_COLUMNS} FROM works ORDER BY publication_year DESC NULLS LAST, id LIMIT 5",
)
def _(t: Tables) -> DataFrame:
    return _work_columns(trends.latest_works(t.works))


# ---- audit ---------------------------------------------------------------------------------

_GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@register(
    "estimate_size",
    sql=f"""
    SELECT CAST(sum(n) AS BIGINT) AS total_rows, TRUE AS has_files, TRUE AS sizes_fit
    FROM ({" UNION ALL ".join(f"SELECT count(*) AS n FROM {name}" for name in _GIVEN)})""",
)
def _(t: Tables) -> DataFrame:
    # SQL cannot see files: of their number and sizes it can only say what must hold.
    size = footers.estimate_size(t.spark, t.folder)
    fit = (F.col("compressed_gb") >= 0) & (F.col("uncompressed_gb") >= F.col("compressed_gb") / 2)
    return size.select(
        "total_rows",
        (F.col("n_files") >= len(_GIVEN)).alias("has_files"),
        (fit & (F.col("estimated_memory_gb") >= 0)).alias("sizes_fit"),
    )


@register(
    "source_probe",
    sql=" UNION ALL ".join(
        f"SELECT '{name}' AS source, count(*) > 0 AS readable, "
        f"CASE WHEN count(*) > 0 THEN 'ok' ELSE 'no rows' END AS message FROM {name}"
        for name in _GIVEN
    ),
)
def _(t: Tables) -> DataFrame:
    paths = {name: f"{t.folder}/{name}.parquet" for name in _GIVEN}
    return footers.source_probe(t.spark, paths)


_STATS_SQL = """
    SELECT '{job}' AS job, 'full' AS mode, count(*) AS total_rows,
      count(DISTINCT {year}) AS distinct_years, CAST(min({year}) AS BIGINT) AS min_year,
      CAST(max({year}) AS BIGINT) AS max_year
    FROM {table} WHERE {year} BETWEEN 1900 AND 2026"""


def _logged_loads(t: Tables) -> str:
    log = fresh(t, "run-log")
    for job, frame, year in (
        ("load_works", t.works, "publication_year"),
        ("load_papers", t.papers, "year"),
    ):
        path = fresh(t, job)
        stats = tables.load_table(frame, path, partition_by=year)
        audit.append_run(log, stats, job, mode="full", source=t.folder, path=path)
    return log


@register(
    "run_log",
    "works",
    "papers",
    sql=_STATS_SQL.format(job="load_works", year="publication_year", table="works")
    + " UNION ALL "
    + _STATS_SQL.format(job="load_papers", year="year", table="papers"),
)
def _(t: Tables) -> DataFrame:
    log = audit.run_log(t.spark, _logged_loads(t))
    return log.select("job", "mode", "total_rows", "distinct_years", "min_year", "max_year")


@register(
    "recent_runs",
    "papers",
    "works",
    sql="SELECT 1 AS place, job, total_rows FROM ("
    + _STATS_SQL.format(job="load_papers", year="year", table="papers")
    + ") UNION ALL SELECT 2, job, total_rows FROM ("
    + _STATS_SQL.format(job="load_works", year="publication_year", table="works")
    + ")",
)
def _(t: Tables) -> DataFrame:
    recent = audit.recent_runs(t.spark, _logged_loads(t))
    newest = Window.orderBy(F.desc("run_id"))  # of the 20 rows of the report
    return recent.select(F.row_number().over(newest).alias("place"), "job", "total_rows")


# ---- across jobs ---------------------------------------------------------------------------


@register(
    "linked_topic_years",
    "papers",
    "topic_match",
    sql="""
    SELECT p.year, m.topics[1].display_name AS topic_name, count(*) AS num_papers
    FROM papers p JOIN topic_match m ON m.corpusid = p.corpusid
    WHERE m.topics[1] IS NOT NULL GROUP BY p.year, topic_name""",
)
def _(t: Tables) -> DataFrame:
    return topic_years(t.works, t.papers)
