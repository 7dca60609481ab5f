from contextlib import contextmanager

import pytest
from conftest import collected
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from areastats.config import KEY
from areastats.operators.combine import (
    concat_by_name,
    fill_missing,
    join_all,
    merge_pages,
    natural_join,
    union_all,
)
from areastats.operators.eager import partial_sums, roll_up, totals
from areastats.operators.filters import (
    drop_missing,
    keep_keys,
    listed,
    nonblank,
    not_listed,
    present,
    without_territories,
)
from areastats.operators.measures import count_by_key, distinct_values, key_count, mean_by_key, school_shares
from areastats.operators.project import drop_present, inputs_first, pages, pick, rename, require_columns
from areastats.operators.skew import hot_keys, join_unique, measured, salted_join

KEYED = f"`{KEY}` string, Name string"


def test_projection(rows):
    df = rows("a int, B int, s struct<x: int>", [(1, 2, (3,))])
    assert collected(pick(df, {"y": "s.x"})) == [(3,)]
    assert rename(df, {"a": "c", "absent": "d"}).columns == ["c", "B", "s"]
    assert drop_present(df, ["A", "b", "absent"]).columns == ["s"]
    assert inputs_first(df, ["s", "B"]).columns == ["s", "B", "a"]
    with pytest.raises(ValueError, match="SVI"):
        require_columns(df, ["SVI"])


def test_filters_and_null(rows):
    df = rows("a string", [("x",), ("",), (None,)])
    assert collected(df.where(nonblank("a"))) == [("x",)]
    assert collected(df.where(present("a"))) == [("",), ("x",)]
    assert collected(drop_missing(df, ["a"])) == [("",), ("x",)]
    assert collected(df.where(not_listed("a", ["x"]))) == [("",)]
    assert collected(df.where(listed("a", ["x", "y"]))) == [("x",)]
    states = rows("State string", [("Ohio",), ("Puerto Rico",), ("District of Columbia",)])
    assert collected(without_territories(states, "State")) == [("Ohio",)]


def test_allow_list_as_table(rows):
    df = rows("k string, v int", [("a", 1), ("a", 2), ("b", 3), (None, 4)])
    assert collected(keep_keys(df, rows("k string", [("a",), ("a",), (None,)]), "k")) == [("a", 1), ("a", 2)]


def test_join_all(rows):
    a = rows(f"`{KEY}` string, A int", [("x", 1), ("x", 2), ("y", 3), (None, 4)])
    b = rows(f"`{KEY}` string, B int", [("x", 5), ("z", 6), (None, 7)])
    joined = join_all([a, b])
    assert joined.columns == [KEY, "A", "B"]
    assert collected(joined) == [("x", 1, 5), ("x", 2, 5)]
    assert join_all([a, b], how="full").count() == 6
    with pytest.raises(ValueError, match="in more than one"):
        join_all([a, a.withColumnRenamed("A", "a")])
    with pytest.raises(ValueError, match="nothing"):
        join_all([])


def test_fill_missing(rows):
    base = rows(KEYED, [("A", "base"), (None, "base null")])
    first = rows(KEYED, [("A", "1"), ("B", "1"), ("B", "1b")])
    second = rows(KEYED, [("B", "2"), ("C", "2"), (None, "2")])
    expected = [("A", "base"), ("B", "1"), ("B", "1b"), ("C", "2"), (None, "base null")]
    assert collected(fill_missing(base, [first, second])) == sorted([*expected, ("B", "2")], key=repr)
    assert collected(fill_missing(base, [first, second], sequential=True)) == sorted(expected, key=repr)


@settings(max_examples=6, deadline=None)
@given(st.data())
def test_fill_missing_keeps_base_and_adds_all_other_keys(spark, data):
    keyed = st.lists(st.tuples(st.sampled_from("ABCDEF"), st.sampled_from("xy")), min_size=1, max_size=8)
    base, *fillers = (data.draw(keyed) for _ in range(3))
    frames = [spark.createDataFrame(r, KEYED) for r in (base, *fillers)]
    keys = {k for k, _ in base}
    expected = base + [r for f in fillers for r in f if r[0] not in keys]
    assert collected(fill_missing(frames[0], frames[1:])) == sorted(expected, key=repr)


def test_natural_join_matches_null(rows):
    a = rows("id int, s string, x int", [(1, None, 10), (2, "b", 20)])
    b = rows("id int, s string, y int", [(1, None, 11), (2, "c", 21)])
    assert collected(natural_join(a, b)) == [(1, None, 10, 11)]
    with pytest.raises(ValueError, match="share"):
        natural_join(a.select("x"), b.select("y"))


def test_pages_come_back_together(rows):
    df = rows("id int, a int, b int, c string, d int, e int, f int", [(1, 2, 3, None, 5, 6, 7), (2, 0, 0, "x", 0, 0, 0)])
    parts = pages(df, "id", 5)
    assert [p.columns for p in parts] == [["id", "a", "b", "c", "d", "e"], ["id", "f"]]
    assert collected(merge_pages(parts).select(df.columns)) == collected(df)


def test_pages_with_a_repeated_or_missing_key_are_an_error(rows):
    for keys in ((1, 1), (1, None)):
        df = rows("id int, a int, b int", [(k, i, i) for i, k in enumerate(keys)])
        with pytest.raises(ValueError, match="row key"):
            merge_pages(pages(df, "id", 1))


def test_unions(rows):
    a, b = rows("x int, y int", [(1, 2)]), rows("y int, x int", [(4, 3)])
    assert collected(union_all([a, b])) == [(1, 2), (3, 4)]
    assert collected(concat_by_name([a, b.select("y")])) == [(1, 2), (None, 4)]
    for f in (union_all, concat_by_name):
        with pytest.raises(ValueError, match="nothing"):
            f([])


def test_measures(rows):
    df = rows(f"`{KEY}` string, v double", [("a", 1.0), ("a", 4.0), ("b", None), (None, 2.0)])
    assert collected(count_by_key(df, "n")) == [("a", 2), ("b", 1), (None, 1)]
    assert collected(mean_by_key(df, F.col("v"), "m")) == [("a", 2.5), ("b", None), (None, 2.0)]
    assert collected(distinct_values(df, KEY)) == [("a",), ("b",), (None,)]
    assert collected(key_count(df)) == [(4, 3, 2)]


def test_shares(rows):
    df = rows(f"`{KEY}` string, Public string, Private string", [("a", "3", "1"), ("b", "0", "0"), ("c", "1", None)])
    assert collected(school_shares(df)) == [("a", 0.25, 0.75), ("b", None, None), ("c", None, None)]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of 30,000 rows has one key; one in ten has none."""
    key = "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 10 = 1 THEN NULL ELSE CONCAT('k', id % 4000) END AS k"
    return spark.range(30_000).selectExpr("id", key)


HOWS = ["inner", "left", "left_semi", "left_anti"]


def equal(a, b):
    return a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_hot_keys_are_found(skewed):
    hot = {r.k: r.salts for r in hot_keys(skewed, "k", task_bytes=100_000).collect()}
    assert set(hot) == {"hot"} and 50 < hot["hot"] < 100


@pytest.mark.parametrize("how", HOWS)
@pytest.mark.parametrize("broadcast_bytes", [0, 10_000_000])
def test_join_unique_equals_plain_join(spark, skewed, how, broadcast_bytes):
    right = spark.range(1000).selectExpr("CONCAT('k', id) AS k", "id AS v")
    for extra in ("'hot' AS k, -1L AS v", "'other' AS k, -1L AS v", "CAST(NULL AS STRING) AS k, -1L AS v"):
        side = right.unionByName(spark.range(1).selectExpr(*extra.split(", ")))
        joined = join_unique(skewed, side, "k", how, broadcast_bytes=broadcast_bytes, task_bytes=50_000)
        assert equal(joined, skewed.join(side, "k", how))


@pytest.mark.parametrize("how", HOWS)
def test_salted_join_with_keys_repeated_on_both_sides(spark, skewed, how):
    left = skewed.where("id < 3000").selectExpr("id AS salt", "k", "id % 3 AS `salt count`")
    right = spark.range(300).selectExpr("IF(id < 20, 'hot', CONCAT('k', id % 90)) AS k", "id AS v", "1 AS salt_")
    assert equal(salted_join(left, right, "k", how, task_bytes=5_000), left.join(right, "k", how))
    assert equal(salted_join(left.limit(0), right, "k", how), left.limit(0).join(right, "k", how))
    assert equal(salted_join(left, right.limit(0), "k", how), left.join(right.limit(0), "k", how))


@contextmanager
def settings_of(spark, conf):
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


PLAIN_PLANS = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}


def tasks(df):
    """Rows of each partition, largest first."""
    return sorted((r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()), reverse=True)


def test_hot_rows_do_not_meet_in_one_task(spark):
    """One key with a third of the rows, then 40 keys of 1.9 % each; one scan of the large side."""
    with settings_of(spark, PLAIN_PLANS):
        right = spark.range(-1, 5000).selectExpr("id AS k", "id * 2 AS v")
        for key in ("IF(id % 3 = 0, -1, id % 5000)", "IF(id % 100 < 76, id % 40, id % 5000)"):
            left = spark.range(0, 200_000, 1, 16).selectExpr("id", f"{key} AS k")
            plain = tasks(left.join(right, "k"))
            joined = join_unique(left, right, "k", broadcast_bytes=0, task_bytes=200_000 * 32 // 16)
            even = tasks(joined)
            assert plain[0] > 2 * plain[8] and even[0] < 2 * even[8] and sum(even) == sum(plain)
            assert joined._jdf.queryExecution().executedPlan().toString().count("Range (0, 200000") == 1


def test_join_unique_survives_duplicates(spark, skewed):
    right = spark.range(200).selectExpr("'hot' AS k", "id AS v")
    assert join_unique(skewed, right, "k", broadcast_bytes=0, task_bytes=100_000).count() == 10_000 * 200
    with pytest.raises(ValueError, match="full"):
        join_unique(skewed, right, "k", "full")


def test_fill_in_turn_starts_no_job_while_it_is_planned(spark, rows):
    frames = [spark.range(n).selectExpr(f"CONCAT('k', id) AS `{KEY}`", "'x' AS Name", "1 AS source") for n in (3, 5, 9)]
    spark.sparkContext.setJobGroup("planning", "")
    filled = fill_missing(frames[0], frames[1:], sequential=True)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup("planning") in ((), [])
    spark.sparkContext.setJobGroup("other", "")
    assert filled.count() == 9 and filled.columns == [KEY, "Name", "source"]
    assert fill_missing(frames[0], [], sequential=True) is frames[0]


def test_roll_up_equals_joins(spark, rows):
    items = rows("o int, v int", [(1, 2), (1, 3), (2, 5), (None, 7), (9, 11), (3, None)])
    orders = rows("o int, c int, n int", [(1, 10, 1), (2, 10, 1), (3, 20, 1), (4, 20, 1), (None, 30, 1), (5, None, 1)])
    people = rows("c int, a string, m int", [(10, "x", 1), (20, "y", 1), (30, "x", 1), (40, "z", 1), (None, "y", 1)])
    per_customer = roll_up(items, orders, "o", "c")
    out = collected(totals(roll_up(per_customer, people, "c", "a"), "a").select("a", "m", "n", "v"))
    assert out == [("x", 2, 3, 10), ("y", 2, 2, None), ("z", 1, None, None)]
    with pytest.raises(Exception, match="repeats"):
        roll_up(items, orders.unionByName(orders), "o", "c").collect()
    with pytest.raises(ValueError, match="same name"):
        roll_up(items, orders.withColumnRenamed("n", "v"), "o", "c")
    sums = partial_sums(items, "o", {"twice": F.col("v") * 2})
    assert collected(totals(sums, "o")) == [(1, 10), (2, 10), (3, None), (9, 22), (None, 14)]


def test_measured(rows):
    df = rows("a string, b int, c array<int>, d binary", [("xyz", 1, [1], None), (None, None, None, bytearray(b"12"))])
    n, size = measured(df)
    assert n == 2 and 2 * 4 * 16 + 3 + 2 < size < 160
    assert measured(df.limit(0)) == (0, 0)
