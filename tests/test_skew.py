import pytest
from frames import rows
from pyspark.sql import functions as F

from paperloom.functions import skew
from paperloom.functions.skew import SALT, hot_keys, replicate, salted_join, spread
from paperloom.functions.staging import has_repeated, stage


@pytest.fixture(scope="module")
def left(spark):
    """A third of all rows under one key, a tenth under NULL."""
    key = (
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 10 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 50))
    )
    return spark.range(3000).select("id", key.alias("key")).persist()


@pytest.fixture(scope="module")
def right(spark):
    return spark.createDataFrame(
        [("hot", 1), ("hot", 2), ("k1", 3), ("k2", 4), ("none", 5), (None, 6)], "key string, v int"
    )


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("rows_per_task", [1, 100, 10_000])
@pytest.mark.parametrize("hash_right", [False, True])
def test_same_rows_as_a_plain_join(left, right, how, rows_per_task, hash_right):
    salted = salted_join(left, right, "key", F.col("id"), how, rows_per_task, hash_right)
    assert rows(salted, "id", "key", "v") == rows(left.join(right, "key", how), "id", "key", "v")


def test_salts_bound_the_rows_per_key_and_salt(left):
    hot = hot_keys(left, "key", 100)
    assert hot.count() == 2  # the hot key and NULL
    sizes = spread(left, "key", F.col("id"), hot).groupBy("key", SALT).count()
    assert sizes.agg(F.max("count")).first()[0] < 200


def test_only_hot_keys_are_replicated(left, right):
    copies = replicate(right, "key", hot_keys(left, "key", 100)).groupBy("key", "v").count()
    assert {(r["key"], r["v"]): r["count"] for r in copies.collect()} == {
        ("hot", 1): 10, ("hot", 2): 10, ("k1", 3): 1, ("k2", 4): 1, ("none", 5): 1, (None, 6): 2,
    }


def test_more_hot_keys_than_may_be_broadcast(left, right, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 1)
    hot = {r["_salts"] for r in hot_keys(left, "key", 20).collect()}
    assert 50 in hot and len(hot) > 1  # the 1000 rows of the hot key, and every other one
    salted = salted_join(left, right, "key", F.col("id"), "left", 20)
    plain = left.join(right, "key", "left")
    assert rows(salted, "id", "key", "v") == rows(plain, "id", "key", "v")


def test_stage_measures_and_keeps_rows(left):
    staged = stage(left, "left")
    assert staged.rows == 3000 and 3000 * 48 < staged.bytes < 3000 * 120
    assert staged.fits(10**6) and not staged.fits(1000)
    assert rows(staged.frame, "id", "key") == rows(left, "id", "key")


def test_stage_of_nothing(left):
    staged = stage(left.filter("id < 0"), "nothing")
    assert (staged.rows, staged.bytes, staged.frame.count()) == (0, 0, 0)


def test_has_repeated(left):
    assert has_repeated(left, "key") and not has_repeated(left, "id")


@pytest.mark.parametrize("rows_per_task, exact", [(100, False), (100, True), (10_000, False)])
def test_hot_keys_sketched_during_the_write(left, rows_per_task, exact, monkeypatch):
    if exact:  # more rows than the sketch can tell apart
        monkeypatch.setattr(skew, "SKETCH_KEYS", 1)
    frame, hot = skew.staged_with_hot_keys(left, "key", "keys", rows_per_task)
    assert rows(frame, "id", "key") == rows(left, "id", "key")
    counted = hot_keys(left, "key", rows_per_task)
    if counted is None:
        assert hot is None
    else:  # the sketch leaves NULL out, which no equality join can match
        null = left.select(F.xxhash64(F.lit(None).cast("string")).alias("h")).first()["h"]
        listed = {r[0]: r[1] for r in counted.collect() if r[0] != null}
        assert {r[0]: r[1] for r in hot.collect() if r[0] != null} == listed
    assert skew.staged_with_hot_keys(left.filter("false"), "key", "none")[1] is None
