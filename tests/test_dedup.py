import random

import pytest
from frames import rows, work, works

from paperloom.operators.dedup import best_records, dedup_works

ROUTES = {
    "broadcast": {"unique_ids": True},
    "shuffled": {"unique_ids": True, "broadcast_bytes": 0},
    "salted": {"unique_ids": True, "broadcast_bytes": 0, "rows_per_task": 2},
    "ranked": {"unique_ids": False},
    "checked": {},
}


def kept(df):
    return [r[0] for r in rows(df, "id")]


# Winner first, as what `work` takes after id and DOI.
TIES = {
    "citations": ({"cited": 2}, {"cited": 1}),
    "citations unknown": ({"cited": 0}, {}),
    "authors": ({"cited": 1, "authors": 2}, {"cited": 1, "authors": 1}),
    "authors unknown": ({"authors": 0}, {}),
    "abstract": ({"abstract": "a"}, {}),
    "topics": ({"abstract": "a", "topics": 2}, {"abstract": "b", "topics": 1}),
    "topics unknown": ({"topics": 0}, {}),
    "id": ({}, {}),
}


@pytest.mark.parametrize("route", ROUTES)
def test_each_tie_break(spark, route):
    table = []
    for number, (doi, (winner, loser)) in enumerate(TIES.items()):
        # The loser has the smaller id, except where the id decides.
        ids = ("A", "B") if doi == "id" else ("B", "A")
        table += [work(f"{i}{number}", doi, **kind) for i, kind in zip(ids, (winner, loser))]
    result = dedup_works(works(spark, *table), **ROUTES[route])
    expected = sorted((f"{'A' if doi == 'id' else 'B'}{n}",) for n, doi in enumerate(TIES))
    assert rows(result, "id") == expected


def test_ids_compare_as_text(spark):
    assert kept(dedup_works(works(spark, work("W9"), work("W10")))) == ["W10"]


@pytest.mark.parametrize("route", ROUTES)
def test_no_doi_single_and_triple(spark, route):
    table = works(
        spark,
        work("W1", doi=None, cited=9),
        work("W2", doi=None),
        work("W3", doi="d"),
        work("W4", doi="e", cited=1),
        work("W5", doi="e", cited=3),
        work("W6", doi="e", cited=2),
    )
    result = dedup_works(table, **ROUTES[route])
    assert kept(result) == ["W3", "W5"]
    assert result.columns == table.columns


def brute_force(table):
    best = {}
    for row in table:
        id, doi, _, cited, authors, abstract, topics, _ = row
        if doi is None:
            continue
        last = float("-inf")
        key = (
            -(last if cited is None else cited),
            -(last if authors is None else len(authors)),
            abstract is None,
            -(last if topics is None else len(topics)),
            id,
        )
        best[doi] = min(best.get(doi, (key, id)), (key, id))
    return sorted(id for _, id in best.values())


@pytest.mark.parametrize("route", ROUTES)
def test_random_tables_with_a_hot_doi(spark, route):
    rng = random.Random(7)
    pick = rng.choice
    table = [
        work(
            f"W{i}",
            doi="hot" if i < 100 else pick([None, "x", f"d{i % 90}"]),
            cited=pick([None, 0, 1]),
            authors=pick([None, 0, 2]),
            abstract=pick([None, "a"]),
            topics=pick([None, 0, 1]),
        )
        for i in range(300)
    ]
    rng.shuffle(table)
    assert kept(dedup_works(works(spark, *table), **ROUTES[route])) == brute_force(table)


def test_repeated_ids_leave_one_row_per_doi(spark):
    table = works(
        spark, work("W1", doi="a"), work("W1", doi="a"), work("W1", doi="b"), work("W2", doi="a")
    )
    assert rows(dedup_works(table), "doi", "id") == [("a", "W1"), ("b", "W1")]


@pytest.mark.parametrize("limit", [10**9, 0])
def test_repeats_within_a_doi(spark, limit):
    """Ids shared by several DOIs or by losers alone are no repeats; those of a winner are."""
    table = [work("W1", doi="a", cited=5), work("W1", doi="a", cited=5), work("W1", doi="b")]
    table += [work("W2", doi="a"), work("W3", doi="c", cited=9), work("W4", doi="c"), work("W4", doi="c")]
    table += [work("W5", doi="d", cited=1), work("W5", doi="d", cited=7), work(None, doi="e"), work(None, doi="e")]
    table += [work("W6", doi="f"), work("W7", doi="f"), work("W6", doi=None)]
    frame = works(spark, *table)
    kept = dedup_works(frame, broadcast_bytes=limit, rows_per_task=2)
    assert rows(kept, "doi", "id") == [("a", "W1"), ("b", "W1"), ("c", "W3"), ("d", "W5"), ("f", "W6")]
    assert kept.filter("doi = 'd'").first()["cited_by_count"] == 7
    assert kept.columns == frame.columns


def test_best_records_carries_columns(spark):
    table = works(spark, work("W1", year=1999), work("W2", year=2001, cited=5), work("W3", doi="z"))
    assert rows(best_records(table, ["publication_year"]), "id", "publication_year", "copies") == [
        ("W2", 2001, 2),
        ("W3", 2000, 1),
    ]
