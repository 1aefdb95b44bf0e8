import datetime as dt

import pytest
from pyspark.sql import functions as F

from stateline.operators import ids


@pytest.fixture(params=[1, 4, 40])
def ranges(request, monkeypatch):
    monkeypatch.setattr(ids, "shuffle_partitions", lambda spark: request.param)
    return request.param


def test_small_example_in_any_layout(spark, ranges):
    data = [(dt.date(2020, 3, d), s) for d, s in [(3, "B"), (1, "A"), (3, "A"), (2, "C"), (1, "B"), (2, "A")]]
    df = spark.createDataFrame(data, "day date, state string")
    expected = [(i, *row) for i, row in enumerate(sorted(data))]
    for frame in (df.coalesce(1), df.repartition(7)):
        found = ids.dense_ids(frame, ["day", "state"], "id")
        assert found.columns == ["id", "day", "state"]
        assert sorted(map(tuple, found.collect())) == expected


def test_hot_leading_key(spark, ranges):
    """A third of the rows have one day; the ids stay dense."""
    start = F.lit(dt.date(2020, 1, 1))
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, start).otherwise(F.date_add(start, (F.col("id") % 90).cast("int"))).alias("day"),
        (F.col("id") * 7919 % 6007).alias("number"),
    ).repartition(5)
    found = ids.dense_ids(df, ["day", "number"], "id").orderBy("id").collect()
    assert [r.id for r in found] == list(range(6000))
    assert [(r.day, r.number) for r in found] == sorted((r.day, r.number) for r in found)


@pytest.mark.parametrize("copies", [False, True])
def test_ranges_split_a_hot_key(spark, monkeypatch, copies):
    """Also if its rows are copies of each other."""
    monkeypatch.setattr(ids, "shuffle_partitions", lambda spark: 40)
    number = F.lit(0) if copies else F.col("id")
    df = spark.range(20000).select((F.col("id") % 3).cast("string").alias("k"), number.alias("v"))
    sizes = [r["count"] for r in ids.placed(df, ["k"]).groupBy("_range").count().collect()]
    assert sum(sizes) == 20000
    assert len(sizes) >= 35
    assert max(sizes) < 4 * 20000 / 40


def test_ties_follow_the_other_columns(spark, ranges):
    kinds = "s string, t timestamp, n timestamp_ntz, x double, d decimal(20,4), i int"
    at = dt.datetime(2020, 1, 1)
    data = [
        (None if i % 5 == 0 else f"é{i % 4}", at + dt.timedelta(microseconds=i % 11),
         at - dt.timedelta(microseconds=i % 13), float("nan") if i % 17 == 0 else i / 7, None, -i)
        for i in range(400)
    ]
    df = spark.createDataFrame(data, kinds).repartition(3)
    found = [tuple(map(str, r[1:])) for r in ids.dense_ids(df, ["s"], "id").orderBy("id").collect()]
    assert found == [tuple(map(str, r)) for r in df.orderBy(*df.columns).collect()]


def test_copies_are_numbered(spark, ranges):
    df = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("k"),
        F.lit(None).cast("double").alias("v"),
    )
    found = ids.dense_ids(df.repartition(4), ["k"], "id").orderBy("id").collect()
    assert [r.id for r in found] == list(range(900))
    assert [r.k for r in found] == sorted(r.k for r in df.collect())


@pytest.mark.parametrize("weight", ["w", None])
def test_running_weight_within(spark, ranges, weight):
    """The group without a name and the rows without an order key or a weight are rows like others."""
    df = spark.range(1000).select(
        F.when(F.col("id") < 300, None).when(F.col("id") < 700, "a").otherwise("b").alias("g"),
        F.when(F.col("id") % 300 != 0, F.col("id")).alias("o"),
        F.when(F.col("id") % 7 != 0, F.col("id") % 5).alias("w"),
    )
    found = ids.running_weight(df.repartition(3), ["g", "o"], "before", weight=weight, within=["g"]).collect()
    assert len(found) == 1000
    expected, sums = [], {}
    for r in sorted(df.collect(), key=lambda r: (r.g or "", r.o is not None, r.o or 0)):
        before = sums.get(r.g, 0)
        expected.append((r.g, r.o, before))
        sums[r.g] = before + (1 if weight is None else r.w or 0)
    key = lambda r: tuple(map(str, r))
    assert sorted(((r.g, r.o, r.before) for r in found), key=key) == sorted(expected, key=key)


def test_many_keys_without_a_group(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 10 != 0, F.col("id") % 4).alias("g"), F.col("id").alias("o"))
    assert ids.running_weight(df, ["g", "o"], "before", within=["g"]).count() == 30_000


def test_order_must_start_with_within(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(ValueError):
        ids.running_weight(df, ["b", "a"], "n", within=["a"])


def test_empty_input(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert ids.dense_ids(df, ["a"], "id").count() == 0
    assert ids.running_weight(df, ["a"], "n", within=["a"]).count() == 0


def test_numbered_union(spark, rows):
    a = spark.createDataFrame([("x",), ("b",)], "n string")
    b = spark.createDataFrame([("a",), ("a",)], "n string")
    found = ids.numbered_union({"first": a, "second": b}, "source", ["n"], "id")
    assert rows(found, "id", "source", "n") == [
        (0, "first", "b"), (1, "first", "x"), (2, "second", "a"), (3, "second", "a")
    ]


def test_plan_has_one_shuffle_and_one_numbering(spark):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"), "id")
    plan = ids.dense_ids(df, ["k"], "id2")._jdf.queryExecution().executedPlan().toString()
    # The rows themselves are written; what is left are the counts of the ranges and a broadcast.
    assert plan.count("Window [") == 1
    assert "SortMergeJoin" not in plan and "hashpartitioning(k" not in plan
