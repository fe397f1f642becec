import pytest
from frames import paper, papers, plan, rows, work, works
from pyspark.sql import functions as F

from paperloom.operators.link import papers_lookup

DOI = "https://doi.org/10.1/"


def linked(p, w, **options):
    return rows(papers_lookup(p, w, **options), "corpusid", "oa_id")


def test_years_nulls_and_case(spark):
    w = works(
        spark,
        *[work(f"W{year}", doi=f"{DOI}{year}", year=year) for year in (1899, 1900, 2025, 2026)],
        work("Wx", doi=f"{DOI}abc"),
        work("Wnull", doi=None),
        work("Wnoyear", doi=f"{DOI}ny", year=None),
    )
    p = papers(
        spark,
        *[paper(i, doi=f"10.1/{year}") for i, year in enumerate((1899, 1900, 2025, 2026))],
        paper(10, doi="10.1/ABC"),
        paper(11, doi=None),
        paper(12, doi="10.1/abc"),
        paper(13, doi="10.1/abc"),
        paper(14, doi="10.1/ny"),
    )
    exact = [(1, "W1900"), (12, "Wx"), (13, "Wx"), (2, "W2025")]
    assert linked(p, w) == exact
    assert linked(p, w, normalize="lower") == sorted([*exact, (10, "Wx")], key=repr)
    assert {r[0] for r in rows(papers_lookup(p, w, normalize="lower"), "match_method")} == {"doi_lower"}
    assert papers_lookup(p, w).dtypes == [
        ("corpusid", "int"),
        ("oa_id", "string"),
        ("publication_year", "smallint"),
        ("match_method", "string"),
        ("match_confidence", "float"),
        ("created_at", "timestamp"),
    ]
    with pytest.raises(ValueError):
        papers_lookup(p, w, normalize="upper")


def test_prefix_is_removed_wherever_it_occurs(spark):
    w = works(spark, work("W1", doi=f"{DOI}a"), work("W2", doi=f"{DOI}https://doi.org/10.1/a"))
    p = papers(spark, paper(1, doi="10.1/a"), paper(2, doi="10.1/10.1/a"))
    assert linked(p, w) == [(1, "W1"), (2, "W2")]


def test_two_spellings_of_one_doi_give_two_rows(spark):
    w = works(spark, work("W1", doi=f"{DOI}a"), work("W2", doi="10.1/a"))
    assert linked(papers(spark, paper(1, doi="10.1/a")), w) == [(1, "W1"), (1, "W2")]


def test_id_too_large_for_int_is_an_error_only_if_linked(spark):
    w = works(spark, work("W1", doi=f"{DOI}a"))
    assert linked(papers(spark, paper(2**31, doi="10.1/b"), paper(1, doi="10.1/a")), w) == [(1, "W1")]
    with pytest.raises(Exception, match="OVERFLOW"):
        linked(papers(spark, paper(2**31, doi="10.1/a")), w)


@pytest.mark.parametrize("rows_per_task", [1, 7, 1_000_000])
def test_hot_doi_is_complete(spark, rows_per_task):
    w = works(spark, work("W1", doi=f"{DOI}hot"), work("W2", doi=f"{DOI}cold"))
    p = papers(spark, *[paper(i, doi="10.1/hot" if i % 3 else "10.1/cold") for i in range(90)])
    got = linked(p, w, rows_per_task=rows_per_task)
    assert got == sorted(((i, "W1" if i % 3 else "W2") for i in range(90)), key=repr)


def test_papers_are_scanned_once(spark, tmp_path):
    papers(spark, *[paper(None if i % 2 else i, doi="10.1/hot") for i in range(300)]).write.parquet(f"{tmp_path}/p")
    p, w = spark.read.parquet(f"{tmp_path}/p"), works(spark, work("W1", doi=f"{DOI}hot"))
    pairs = papers_lookup(p, w, rows_per_task=50)
    assert f"{tmp_path}/p" not in plan(pairs)  # only what was staged is read again
    assert len(linked(p, w, rows_per_task=50)) == 300
    salts = [r["n"] for r in pairs.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(salts) == 300
