from itertools import product

import pytest
from frames import papers, paper, rows, topic, work, works
from pyspark.sql import Observation
from pyspark.sql import functions as F

from paperloom.functions.nested import add_typed_column, by_name
from paperloom.operators.enrich import (
    enrich_topics,
    enrichment_coverage,
    flag_all,
    flag_exists,
    flag_report,
    topic_report,
)
from paperloom.schemas import TOPICS, type_of

STATES = [None, True, False]
CASES = list(product(STATES, [True, False]))  # flag before, present in the other table
AFTER = {
    "incremental": lambda flag, hit: hit if flag is None else flag,
    "force": lambda flag, hit: True if hit else bool(flag),
    "recompute": lambda flag, hit: hit,
}


@pytest.fixture(scope="module")
def flags(spark):
    table = [(i, flag) for i, (flag, _) in enumerate(CASES)]
    return spark.createDataFrame(table, "corpusid bigint, flag boolean")


@pytest.fixture(scope="module")
def other(spark):
    present = [(i,) for i, (_, hit) in enumerate(CASES) if hit]
    return spark.createDataFrame([*present, *present, (99,)], "corpusid bigint")


@pytest.mark.parametrize("mode", AFTER)
def test_flag_state_by_presence_and_mode(flags, other, mode):
    expected = [(i, AFTER[mode](*case)) for i, case in enumerate(CASES)]
    once = flag_exists(flags, other, "corpusid", "flag", mode)
    assert rows(once, "corpusid", "flag") == expected
    assert once.columns == ["corpusid", "flag"]
    again = flag_exists(once, other, "corpusid", "flag", mode, broadcast_bytes=0)
    assert rows(again, "corpusid", "flag") == expected


def test_several_flags_at_once(spark, flags, other):
    nothing = spark.createDataFrame([(None,)], "corpusid bigint")
    both = flag_all(flags, {"flag": other, "never": nothing}, mode="force")
    single = flag_exists(flags, other, "corpusid", "flag", "force")
    assert rows(both, "corpusid", "flag") == rows(single, "corpusid", "flag")
    assert rows(both, "never") == [(False,)] * 6


@pytest.mark.parametrize("stride", [1, 3, 64, 10**9 + 7])
@pytest.mark.parametrize("limit", [10**8, 60_000, 0])
def test_ids_near_and_far_in_every_form(spark, stride, limit):
    """Broadcast words, packed words, shuffled words; negative, null and repeated ids."""
    table = spark.range(-3000, 3000).select((F.col("id") * stride).alias("corpusid"))
    table = table.unionAll(spark.createDataFrame([(None,), (None,), (0,)], "corpusid bigint"))
    table = table.withColumn("_word", F.lit("mine"))
    a = spark.range(-900, 900).select((F.col("id") * 3 * stride).cast("bigint").alias("corpusid"))
    b = spark.createDataFrame([(0,), (0,), (5 * stride,), (None,), (-(2**63),)], "corpusid bigint")
    found = flag_all(table, {"a": a, "b": b}, broadcast_bytes=limit)
    assert found.columns == ["corpusid", "_word", "a", "b"] and found.count() == 6003
    got = {r.corpusid: (r.a, r.b) for r in found.filter("a OR b").collect()}
    ids = {3 * i * stride for i in range(-900, 900)}
    assert found.filter("_word = 'mine'").count() == 6003
    assert got == {i: (i in ids, i in (0, 5 * stride)) for i in ids | {5 * stride}}


def test_keys_that_are_no_numbers(spark):
    table = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "corpusid string, n int")
    other = spark.createDataFrame([("b",), ("c",), (None,)], "corpusid string")
    for limit in (10**6, 0):
        assert rows(flag_exists(table, other, "corpusid", "f", broadcast_bytes=limit), "n", "f") == [
            (1, False), (2, True), (3, False)
        ]


@pytest.mark.parametrize("mode", ["incremental", "force"])
def test_numbers_of_a_report_ride_along(flags, other, targets, lookup, topic_works, mode, tmp_path):
    seen = Observation()
    flag_all(flags, {"flag": other}, mode=mode, seen=seen).write.parquet(f"{tmp_path}/flags")
    report = flag_report(flags, other, "corpusid", "flag", mode).first()
    assert tuple(report)[:3] == tuple(seen.get[n] for n in ("total", "flag_updated", "flag_covered"))
    seen = Observation()
    enrich_topics(targets, lookup, topic_works, mode, seen=seen).write.parquet(f"{tmp_path}/topics")
    report = topic_report(targets, lookup, topic_works, mode).first()
    assert tuple(report)[:3] == tuple(seen.get[n] for n in ("total", "updated", "covered"))


def test_flag_reports(flags, other):
    report = lambda mode: tuple(flag_report(flags, other, "corpusid", "flag", mode).first())
    assert report("incremental") == (6, 1, 3, 50.0)
    assert report("force") == (6, 3, 4, 66.7)
    settled = flag_exists(flags, other, "corpusid", "flag")
    assert flag_report(settled, other, "corpusid", "flag").first()["rows_updated"] == 0


def test_report_of_an_empty_table(flags, other):
    assert tuple(flag_report(flags.limit(0), other, "corpusid", "flag").first()) == (0, 0, 0, None)


def test_flag_column_is_added(flags, other):
    result = flag_exists(flags.select("corpusid"), other, "corpusid", "fresh")
    assert rows(result, "fresh") == [(False,)] * 3 + [(True,)] * 3


def test_unknown_modes(flags, other):
    with pytest.raises(ValueError):
        flag_exists(flags, other, "corpusid", "flag", "sometimes")
    with pytest.raises(ValueError):
        enrich_topics(flags, other, other, "recompute")


# ---- topics ----

ROUTES = {
    "broadcast": {},
    "broadcast, unique": {"unique_ids": True},
    "shuffled": {"broadcast_bytes": 0},
    "shuffled, unique": {"broadcast_bytes": 0, "unique_ids": True},
    "salted": {"broadcast_bytes": 0, "rows_per_task": 1},
}


@pytest.fixture(scope="module")
def topic_works(spark):
    return works(
        spark,
        work("W1", topics=2, concepts=[("C1", None, "c", 0, 0.2)]),
        work("W2", topics=0),
        work("W3"),
        work("W4", topics=[topic(4)]),
    )


@pytest.fixture(scope="module")
def lookup(spark):
    links = [(1, "W1"), (2, "W2"), (3, "W3"), (4, "W4"), (4, "W1"), (5, "gone"), (6, "W4"), (6, "gone")]
    return spark.createDataFrame([*links, *links], "corpusid int, oa_id string")


@pytest.fixture(scope="module")
def targets(spark):
    """Papers 1 to 7, once without and (from 11) once with an old topic; 5 and 7 stay unlinked."""
    old = [topic(9)]
    table = [(i, None, None) for i in range(1, 8)]
    frame = spark.createDataFrame(
        [*table, (11, old, old[0])], f"corpusid bigint, oa_topics {TOPICS}, oa_primary_topic {TOPICS[6:-1]}"
    )
    return frame


def ids(df):
    found = df.select(
        "corpusid",
        F.col("oa_topics.id").alias("t"),
        F.col("oa_primary_topic.id").alias("p"),
        F.col("oa_concepts.id").alias("c"),
    )
    return {r["corpusid"]: (r["t"], r["p"], r["c"]) for r in found.collect()}


@pytest.mark.parametrize("route", ROUTES)
def test_topics_by_kind_of_match(targets, lookup, topic_works, route):
    options = ROUTES[route]
    links = lookup.unionAll(lookup.sparkSession.sql("SELECT 11, 'W1'"))
    both = {
        1: (["T0", "T1"], "T0", ["C1"]),
        2: ([], None, None),
        3: (None, None, None),
        4: (["T0", "T1"], "T0", ["C1"]),  # the smaller work id of two
        5: (None, None, None),
        6: (["T4"], "T4", None),  # the other link leads nowhere
        7: (None, None, None),
    }
    incremental = enrich_topics(targets, links, topic_works, "incremental", **options)
    assert ids(incremental) == {**both, 11: (["T9"], "T9", None)}
    forced = enrich_topics(targets, links, topic_works, "force", **options)
    assert ids(forced) == {**both, 11: (["T0", "T1"], "T0", ["C1"])}


def test_force_overwrites_with_null_and_keeps_unlinked(spark, targets, topic_works):
    old = targets.filter("corpusid = 11")
    to_null = spark.createDataFrame([(11, "W3")], "corpusid int, oa_id string")
    assert ids(enrich_topics(old, to_null, topic_works, "force")) == {11: (None, None, None)}
    unlinked = to_null.limit(0)
    assert ids(enrich_topics(old, unlinked, topic_works, "force")) == {11: (["T9"], "T9", None)}


@pytest.mark.parametrize("broadcast_bytes", [0, 10**6])
def test_copies_of_a_work_prefer_topics(spark, targets, lookup, broadcast_bytes):
    copies = works(spark, work("W1"), work("W1", topics=1), work("W1"))
    result = enrich_topics(targets, lookup, copies, broadcast_bytes=broadcast_bytes)
    assert ids(result)[1] == (["T0"], "T0", None)
    assert result.count() == targets.count()


def test_topic_reports(targets, lookup, topic_works):
    report = lambda t, mode: tuple(topic_report(t, lookup, topic_works, mode).first())
    assert report(targets, "incremental") == (8, 5, 5, 62.5)
    done = enrich_topics(targets, lookup, topic_works)
    # The paper whose work has no topics counts as updated again.
    assert report(done, "incremental") == (8, 1, 5, 62.5)
    assert report(done, "force") == (8, 5, 5, 62.5)


def test_fields_in_another_order_are_matched_by_name(spark, lookup):
    swapped = spark.sql("""
        SELECT 'W1' AS id, array(named_struct(
            'display_name', 'n', 'id', 'T', 'domain', named_struct('display_name', 'dn', 'id', 'D'),
            'extra', 1)) AS topics,
          array(named_struct('level', 3, 'id', 'C')) AS concepts""")
    one = spark.createDataFrame([(1,)], "corpusid bigint")
    row = enrich_topics(one, lookup, swapped).first()
    assert row["oa_topics"][0]["id"] == "T" and row["oa_topics"][0]["display_name"] == "n"
    assert row["oa_topics"][0]["domain"]["id"] == "D"
    assert row["oa_topics"][0]["subfield"] is None and row["oa_topics"][0]["score"] is None
    assert row["oa_concepts"][0]["level"] == 3 and row["oa_concepts"][0]["id"] == "C"


def test_by_name_keeps_null_lists_entries_and_structs(spark):
    kind = type_of("array<struct<a: int, b: struct<c: int>>>")
    target = type_of("array<struct<b: struct<c: bigint>, a: int>>")
    frame = spark.createDataFrame(
        [(None,), ([],), ([None, (1, None), (2, (3,))],)], "v array<struct<a: int, b: struct<c: int>>>"
    )
    out = frame.select(by_name(F.col("v"), kind, target).alias("v"))
    assert out.schema["v"].dataType.simpleString() == target.simpleString()
    assert rows(out.select(F.to_json("v").alias("v")), "v") == sorted(
        [(None,), ("[]",), ('[null,{"a":1},{"b":{"c":3},"a":2}]',)], key=repr
    )


def test_add_typed_column_twice(spark):
    frame = spark.range(1)
    once = add_typed_column(frame, "oa_topics", TOPICS)
    assert add_typed_column(once, "OA_TOPICS", "boolean").schema == once.schema
    assert once.schema["oa_topics"].dataType == type_of(TOPICS)


def test_coverage(spark):
    table = papers(spark, paper(1, abstract=True), paper(2, abstract=False, fulltext=True), paper(3))
    assert rows(enrichment_coverage(table), "column", "total", "covered", "pct") == [
        ("has_abstract", 3, 1, 33.3),
        ("has_fulltext", 3, 1, 33.3),
    ]
