import gzip
import json
import os
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest
from frames import rows
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader
from pyspark.sql import functions as F

from paperloom.operators import audit
from paperloom.registry.catalogue import QUERIES
from paperloom.schemas import TABLES, struct_of
from paperloom.sources import export, footers, manifest, releases, scan, tables

# ---- scans ----


def test_scan_finds_files_at_any_depth(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/a/b/updated_date=1")
    spark.range(2).write.parquet(f"{tmp_path}/a/c")
    (tmp_path / "a" / "notes.txt").write_text("not parquet")
    found = scan.scan_parquet(spark, f"{tmp_path}/a")
    assert found.columns == ["id"] and found.count() == 5


def test_names_fit_files_and_folders_of_files(spark, tmp_path):
    root = f"{tmp_path}/docs [1] a"
    put = lambda a, b, at: spark.range(a, b, numPartitions=2).write.parquet(f"{root}/{at}")
    put(0, 10, "docs.parquet")
    put(10, 20, "more/year=2001/docs.parquet/docs.parquet")  # the inner one belongs to the outer one
    spark.range(20, 25).coalesce(1).write.parquet(f"{root}/single")
    file = next(Path(f"{root}/single").glob("*.parquet"))
    Path(f"{root}/flat").mkdir()
    file.rename(f"{root}/flat/docs.parquet")
    put(100, 110, "mydocs.parquet")
    put(100, 110, "docs.parquet2")
    put(100, 110, "docs.parquet/_temporary/0")
    spark.sql("SELECT 'x' AS other").write.parquet(f"{root}/labels.parquet")

    escaped = root.replace("[", "\\[").replace("]", "\\]")
    ids = lambda found: [r["id"] for r in found.sort("id").collect()]
    scanned = lambda pattern, path=escaped, **o: scan.scan_parquet(spark, path, pattern, **o)
    for pattern in ("docs.parquet", "d?[!a]s.parquet", "{docs,none}.parquet"):
        assert ids(scanned(pattern)) == list(range(25))
    assert ids(scanned("docs.parquet", [f"{escaped}/more", f"{escaped}/flat/docs.parquet"])) == list(range(10, 25))
    assert ids(scanned("docs.parquet", f"{escaped}/flat")) == list(range(20, 25))  # files alone
    assert ids(scanned("docs*", f"{escaped}/more")) == list(range(10, 20))
    years = scanned("docs.parquet", folder_columns=True).groupBy("year").count()
    assert rows(years, "year", "count") == [(2001, 10), (None, 15)]
    # Names above the path do not count.
    assert scanned("labels.parquet").columns == ["other"]
    with pytest.raises(AnalysisException):
        scanned("docs ?1? a")
    assert footers.estimate_size(spark, escaped, "docs.parquet").first()["total_rows"] == 25


def test_query_by_name_takes_a_table_of_several_files(spark, tmp_path):
    texts = [(1, "a", "en", "s1", 1), (2, "b c", "en", "s1", 3), (3, None, None, None, None)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(texts, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.range(2).write.parquet(f"{tmp_path}/labels.parquet")
    found = QUERIES["scan_parquet_glob"](spark, str(tmp_path))
    assert rows(found, "source", "lang", "docs", "chars") == [("s1", "en", 2, 4), (None, None, 1, None)]


@pytest.fixture
def vintages(spark, tmp_path):
    old, new = f"{tmp_path}/old", f"{tmp_path}/new"
    spark.sql("SELECT 'a' AS id, 1 AS works, true AS scopus").write.parquet(old)
    spark.sql("SELECT 'core' AS kind, 'b' AS id, 'yes' AS scopus").write.parquet(new)
    return [old, new]


def test_vintages_are_aligned_by_name(spark, vintages):
    expected = [("a", 1, None), ("b", None, "core")]
    united = scan.scan_union_by_name(spark, vintages, ["scopus"])
    assert rows(united, "id", "works", "kind") == expected
    declared = struct_of("id STRING, works INT, kind STRING, scopus BOOLEAN")
    fixed = scan.scan_union_by_name(spark, vintages, ["scopus"], declared)
    assert fixed.columns == ["id", "works", "kind"]
    assert rows(fixed, "id", "works", "kind") == expected


def test_view_is_replaced_and_needs_files(spark, tmp_path):
    for n in (2, 3):
        spark.range(n).write.parquet(f"{tmp_path}/{n}")
        scan.view_parquet(spark, "some_view", f"{tmp_path}/{n}")
        assert spark.table("some_view").count() == n
    with pytest.raises(AnalysisException):
        scan.view_parquet(spark, "some_view", f"{tmp_path}/missing")


# ---- loads ----


@pytest.fixture(scope="module")
def dated(spark):
    years = [None, 1899, 1900, 1900, 2026, 2027]
    return spark.createDataFrame([(i, y) for i, y in enumerate(years)], "id bigint, year int")


def test_load_keeps_the_year_bounds(spark, dated, tmp_path):
    path = f"{tmp_path}/t"
    for _ in range(2):  # a second run overwrites
        stats = tables.load_table(dated, path, partition_by="year")
        assert tuple(stats.first()) == (3, 2, 1900, 2026)
    table = spark.read.parquet(path)
    assert rows(table, "id", "year") == [(2, 1900), (3, 1900), (4, 2026)]


def test_load_one_year_all_and_unpartitioned(spark, dated, tmp_path):
    load = lambda name, **o: tuple(tables.load_table(dated, f"{tmp_path}/{name}", **o).first())
    assert load("one", partition_by="year", test_year=1900) == (2, 1, 1900, 1900)
    assert load("off", partition_by="year", test_year=0) == (3, 2, 1900, 2026)
    assert load("none", partition_by="year", test_year=1950) == (0, 0, None, None)
    assert load("column", year_column="year") == (3, 2, 1900, 2026)
    assert load("all") == (6,)


def test_hot_year_is_split_over_files(spark, tmp_path, setting):
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    setting("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1KB")
    year = F.when(F.col("id") % 3 == 0, 2000 + F.col("id") % 5).otherwise(1999).cast("int")
    table = spark.range(0, 60000, numPartitions=8).select("id", year.alias("year"))
    tables.load_table(table, f"{tmp_path}/t", partition_by="year")
    files = lambda y: len(list((tmp_path / "t" / f"year={y}").glob("*.parquet")))
    assert files(1999) >= 3 and files(2000) <= 2
    assert spark.read.parquet(f"{tmp_path}/t").count() == 60000


def test_rebuild_reads_the_version_it_replaces(spark, tmp_path):
    _, first = tables.rebuild_table(spark.range(3), str(tmp_path), "refreshed")
    grown = spark.table("refreshed").unionAll(spark.range(3, 5))
    _, second = tables.rebuild_table(grown, str(tmp_path), "refreshed")
    assert first != second and rows(spark.table("refreshed"), "id") == [(i,) for i in range(5)]


def test_create_if_absent(spark, dated, tmp_path):
    path, made = f"{tmp_path}/t", []

    def make():
        made.append(1)
        return dated

    call = lambda **o: (lambda c, s: (c, *s.first()))(*tables.create_if_absent(spark, path, make, **o))
    assert call() == (True, 6, 4, 1899, 2027)
    assert call() == (False, 6, 4, 1899, 2027)
    assert len(made) == 1
    assert call(force=True) == (True, 6, 4, 1899, 2027)
    assert len(made) == 2


def test_a_killed_write_is_not_taken_as_done(spark, dated, tmp_path):
    path = f"{tmp_path}/t"
    half = f"{path}/version-00000000000000000001-killed"
    dated.write.parquet(half)
    os.remove(f"{half}/_SUCCESS")  # as it is until the committer has moved all files
    assert tables.current_version(spark, path) is None
    assert tables.create_if_absent(spark, path, lambda: dated)[0]
    first = tables.current_version(spark, path)

    def failing():
        return dated.withColumn("year", F.raise_error(F.lit("killed")).cast("int"))

    with pytest.raises(Exception, match="killed"):
        tables.create_if_absent(spark, path, failing, force=True)
    assert tables.current_version(spark, path) == first
    created, stats = tables.create_if_absent(spark, path, failing)
    assert not created and stats.first()["total_rows"] == 6
    # A version may be made from the one before, whose readers keep their files.
    reader = spark.read.parquet(first)
    assert tables.create_if_absent(spark, path, lambda: spark.read.parquet(first).limit(2), force=True)[0]
    assert reader.count() == 6
    assert spark.read.parquet(tables.current_version(spark, path)).count() == 2


def test_bucketed_tables_join_without_shuffle(spark, tmp_path, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    frames = [
        tables.write_bucketed(spark.range(50), f"bucketed_{n}", f"{tmp_path}/{n}", "id", 4)
        for n in "ab"
    ]
    joined = frames[0].join(frames[1], "id")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 50


# ---- releases ----


def test_json_release_with_bad_lines(spark, tmp_path):
    good = [
        {"corpusid": 1, "externalids": {"DOI": "d", "ArXiv": None}, "year": 2000},
        {"corpusid": 2, "s2fieldsofstudy": [{"source": "s", "category": "c"}], "unknown": 1},
        {"corpusid": 3, "externalids": None, "publicationdate": "2001-02-03"},
    ]
    bad = ['{"corpusid": 4, "year"', '{"corpusid": 5, "year": "soon"}']
    source = tmp_path / "papers"
    source.mkdir()
    for n, lines in enumerate(([*map(json.dumps, good[:2]), bad[0]], [bad[1], json.dumps(good[2])])):
        with gzip.open(source / f"papers_{n:04d}.json.gz", "wt") as file:
            file.write("\n".join(lines) + "\n")

    schema = struct_of(TABLES["papers"])
    for _ in range(2):
        table, quarantine = releases.ingest_json(spark, str(source), f"{tmp_path}/out", schema)
    assert table.schema == schema
    assert rows(table, "corpusid", "externalids.DOI", "year") == [
        (1, "d", 2000),
        (2, None, None),
        (3, None, None),
    ]
    assert table.filter("publicationdate = DATE'2001-02-03'").count() == 1
    assert rows(table.select(F.col("s2fieldsofstudy")[0]["category"].alias("c")).dropna(), "c") == [("c",)]
    assert rows(quarantine, "raw_line") == sorted([(line,) for line in bad], key=repr)
    assert quarantine.filter(F.col("file").endswith(".json.gz")).count() == 2


def test_release_without_bad_lines(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"corpusid": 1}\n')
    schema = struct_of("corpusid BIGINT")
    table, bad = releases.ingest_json(spark, f"{tmp_path}/x.json", f"{tmp_path}/out", schema)
    assert (table.count(), bad.count()) == (1, 0)


# ---- footers and probes ----


def test_size_estimate(spark, tmp_path):
    spark.range(1000).coalesce(1).write.parquet(f"{tmp_path}/t/a")
    spark.range(0).coalesce(1).write.parquet(f"{tmp_path}/t/b")
    spark.range(50_000).coalesce(1).write.parquet(f"{tmp_path}/t/c")
    files = rows(footers.parquet_footers(spark, f"{tmp_path}/t"), "rows")
    assert files == [(0,), (1000,), (50_000,)]
    row = footers.estimate_size(spark, f"{tmp_path}/t").first()
    assert (row["n_files"], row["total_rows"]) == (3, 51_000)
    exact = footers.parquet_footers(spark, f"{tmp_path}/t").agg(F.sum("uncompressed")).first()[0]
    assert row["uncompressed_gb"] == round(exact / 2**30, 2)


def test_workers_need_not_have_the_package(spark, tmp_path):
    spark.range(10).coalesce(1).write.parquet(f"{tmp_path}/t")
    repo = Path(footers.__file__).parents[2]
    code = f"""
import sys; sys.path.insert(0, {str(repo)!r})
from pyspark.sql import SparkSession
from paperloom.sources.footers import estimate_size
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
assert estimate_size(spark, {f"{tmp_path}/t"!r}).first()["total_rows"] == 10
"""
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=180)


def test_size_estimate_of_empty_sample_and_folder(spark, tmp_path):
    spark.range(0).coalesce(1).write.parquet(f"{tmp_path}/t")
    row = footers.estimate_size(spark, f"{tmp_path}/t").first()
    assert (row["total_rows"], row["estimated_memory_gb"]) == (0, 0.0)
    (tmp_path / "empty").mkdir()
    with pytest.raises(Exception, match="no Parquet files"):
        footers.estimate_size(spark, f"{tmp_path}/empty").collect()


def test_footers_agree_with_another_reader(spark, tmp_path):
    for i in range(4):
        spark.range(i * 1000).select("id", F.col("id").cast("string").alias("s")).coalesce(2).write.parquet(f"{tmp_path}/t/{i}")
    found = footers.parquet_footers(spark, f"{tmp_path}/t").withColumn("path", F.regexp_replace("path", "^file:/+", "/"))
    sql = f"""
        SELECT f.file_name AS path, s.size AS compressed, f.num_rows AS rows, coalesce(g.bytes, 0) AS uncompressed
        FROM parquet_file_metadata('{tmp_path}/t/*/*.parquet') f
        JOIN read_blob('{tmp_path}/t/*/*.parquet') s ON s.filename = f.file_name
        LEFT JOIN (SELECT file_name, CAST(sum(total_uncompressed_size) AS BIGINT) AS bytes
          FROM parquet_metadata('{tmp_path}/t/*/*.parquet') GROUP BY ALL) g ON g.file_name = f.file_name"""
    expected = sorted(duckdb.sql(sql).fetchall())
    assert rows(found, "path", "compressed", "rows", "uncompressed") == expected
    gib, first = 1024.0**3, expected[0]
    total = sum(r[2] for r in expected)
    row = footers.estimate_size(spark, f"{tmp_path}/t").first()
    assert (row.n_files, row.total_rows) == (len(expected), total)
    per_row = first[3] / first[2] if first[2] else 0
    assert row.estimated_memory_gb == round(total * per_row / gib, 1)
    assert row.compressed_gb == round(sum(r[1] for r in expected) / gib, 2)
    assert row.uncompressed_gb == round(sum(r[3] for r in expected) / gib, 2)


def test_load_of_a_mixed_tree_merges_one_file_per_schema(spark, tmp_path, monkeypatch):
    root = f"{tmp_path}/a tree [1]"
    for year in range(30):
        spark.range(2).withColumn("n", F.lit(year)).write.parquet(f"{root}/year={2000 + year}/x")
    spark.range(3).select("id", F.lit(1990).cast("bigint").alias("year")).write.parquet(f"{root}/flat")
    spark.range(1).select(F.lit("z").alias("extra"), "id").write.parquet(f"{root}/year=__HIVE_DEFAULT_PARTITION__/code=0a")
    escaped = root.replace("[", "\\[").replace("]", "\\]")
    listed = []
    monkeypatch.setattr(DataFrame, "inputFiles", lambda frame: listed.append(frame))
    found = scan.scan_parquet(spark, escaped, folder_columns=True)
    assert not listed
    assert dict(found.dtypes) == {"id": "bigint", "n": "int", "year": "bigint", "extra": "string", "code": "string"}
    years = found.groupBy("year").count()
    assert rows(years.filter("year < 2002"), "year", "count") == [(1990, 3), (2000, 2), (2001, 2)]
    assert found.filter("extra = 'z' AND code = '0a' AND year IS NULL").count() == 1
    assert found.filter("n = year - 2000").count() == 60
    merged = []
    read = DataFrameReader.parquet
    monkeypatch.setattr(DataFrameReader, "parquet", lambda r, *p, **o: merged.append(p) or read(r, *p, **o))
    manifest.merged_schema(spark, escaped)
    assert [len(p) for p in merged] == [3]
    assert manifest.folder_columns(spark, escaped) == {"code": "string", "year": "int"}


def test_probe(spark, tmp_path):
    spark.range(2).write.parquet(f"{tmp_path}/some")
    spark.range(0).write.parquet(f"{tmp_path}/none")
    spark.range(2).write.parquet(f"{tmp_path}/nested/a b/c")
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "x.parquet").write_bytes(b"no table")
    names = ("some", "none", "missing", "nested", "broken")
    probe = footers.source_probe(spark, {name: f"{tmp_path}/{name}" for name in names})
    found = {r["source"]: r["readable"] for r in probe.collect()}
    assert found["nested"] is True and found["broken"] is False
    assert footers.estimate_size(spark, f"{tmp_path}/nested").first()["total_rows"] == 2
    assert rows(
        probe.filter("source NOT IN ('nested', 'broken')"), "source", "readable", "message"
    ) == [
        ("missing", False, "PATH_NOT_FOUND"),
        ("none", False, "no rows"),
        ("some", True, "ok"),
    ]
    assert footers.all_readable(probe).first()[0] is False
    assert footers.all_readable(probe.filter("source = 'some'")).first()[0] is True


# ---- export and run log ----


def test_export(spark, tmp_path):
    export.export_metrics(spark.range(3), path=f"{tmp_path}/out")
    with pytest.raises(ValueError):
        export.export_metrics(spark.range(0), path=f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3
    assert export.jdbc_options("jdbc:x", "t")["batchsize"] == "10000"


def test_run_log(spark, tmp_path):
    log = f"{tmp_path}/log"
    stats = spark.sql("SELECT 7L AS total_rows, 1900 AS min_year")
    for n in range(22):
        audit.append_run(log, stats, f"job{n}", mode="full", path=f"p{n}", elapsed_seconds=0.5)
    recent = audit.recent_runs(spark, log).collect()
    assert [r["job"] for r in recent] == [f"job{n}" for n in range(21, 1, -1)]
    assert recent[0]["total_rows"] == 7 and recent[0]["min_year"] == 1900
    assert recent[0]["recorded_at"] is not None and recent[0]["rows_updated"] is None
    assert audit.latest_path(spark, log, "job3") == "p3"
    assert audit.latest_path(spark, log, "other") is None


def test_declared_schemas():
    sizes = {name: len(struct_of(ddl)) for name, ddl in TABLES.items()}
    assert sizes == {"works": 42, "sources": 27, "authors": 17, "papers": 16}
