import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from stateline.functions import lookup
from stateline.functions.codes import CODE_TO_NAME, NAME_TO_ID, STATES
from stateline.functions.exact import correlation, mean, total
from stateline.functions.scalars import (
    blank_to_null,
    cut,
    day_from_int,
    day_from_text,
    number,
    ratio,
    season,
)


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_code_list():
    assert [number for _, _, number in STATES] == list(range(1, 60))
    assert len(CODE_TO_NAME) == 59 and len(NAME_TO_ID) == 60
    assert set(CODE_TO_NAME.values()) <= set(NAME_TO_ID)
    assert NAME_TO_ID["District of Columbia"] == NAME_TO_ID["District Of Columbia"] == 10


def test_lookup_strict(spark):
    name = lookup.strict(F.lit("AL"), CODE_TO_NAME, "code")
    assert one(spark, name) == "Alabama"
    assert one(spark, lookup.strict(name, NAME_TO_ID)) == 1
    for bad in (F.lit("ZZ"), F.lit(None).cast("string")):
        with pytest.raises(PySparkException, match="unknown code"):
            one(spark, lookup.strict(bad, CODE_TO_NAME, "code"))


def test_lookup_default_and_count(spark):
    df = spark.createDataFrame([("AL",), ("ZZ",), (None,)], "code string")
    name = lookup.with_default(F.col("code"), CODE_TO_NAME, "Alaska")
    assert [r[0] for r in df.select(name).collect()] == ["Alabama", "Alaska", "Alaska"]
    missed = df.agg(F.count_if(lookup.is_unmatched(F.col("code"), CODE_TO_NAME))).first()[0]
    assert missed == 2


def test_lookup_quotes(spark):
    pairs = {"it's": "a \\ b", 'say "x"': "c"}
    for key, value in pairs.items():
        assert one(spark, lookup.get(F.lit(key), pairs)) == value
    assert one(spark, lookup.with_default(F.lit(3), {1: 10, 2: 20}, 0)) == 0


def test_dates(spark):
    assert one(spark, day_from_int(F.lit(20200307))) == dt.date(2020, 3, 7)
    assert one(spark, day_from_text(F.lit("1970-01-01"))) == dt.date(1970, 1, 1)
    assert one(spark, day_from_int(F.lit("2020x"), lenient=True)) is None
    assert one(spark, day_from_text(F.lit("x"), lenient=True)) is None
    with pytest.raises(PySparkException):
        one(spark, day_from_int(F.lit("2020x")))
    with pytest.raises(PySparkException):
        one(spark, day_from_text(F.lit("07/03/2020")))


def test_season_edges(spark):
    days = {
        "1970-01-01": "winter", "1970-03-31": "winter", "1970-04-01": "spring", "1970-06-30": "spring",
        "1970-07-01": "summer", "1970-09-30": "summer", "1970-10-01": "autumn", "1970-12-31": "autumn",
    }
    df = spark.createDataFrame([(dt.date.fromisoformat(d),) for d in days], "d date")
    assert [r[0] for r in df.select(season(F.col("d"))).collect()] == list(days.values())
    assert one(spark, season(F.lit(None).cast("date"))) is None


def test_ratio(spark):
    df = spark.createDataFrame([(10.0, 2.0), (1.0, 0.0), (None, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(ratio(F.col("a"), F.col("b"))).collect()] == [5.0, None, None]


def test_text_and_numbers(spark):
    assert one(spark, blank_to_null(F.lit("  "))) is None
    assert one(spark, blank_to_null(F.lit(" a "))) == " a "
    assert len(one(spark, cut(F.lit("x" * 300)))) == 256
    assert one(spark, number(F.lit("5039877"))) == 5039877
    assert one(spark, number(F.lit("x"), lenient=True)) is None
    with pytest.raises(PySparkException):
        one(spark, number(F.lit("x")))


def test_exact_measures_do_not_depend_on_layout(spark):
    df = spark.range(20000).select(((F.col("id") * 7919 % 100003) / 100 - 300).alias("x"))
    results = {
        tuple(df.repartition(n).agg(total(F.col("x"), 2), mean(F.col("x"), 2)).first()) for n in (1, 3, 7)
    }
    assert len(results) == 1
    cents = sum(i * 7919 % 100003 - 30000 for i in range(20000))
    assert results.pop() == (cents / 100, cents / 100 / 20000)


def test_exact_sums_are_exact_or_fail(spark):
    def sum_of(scale, *values):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        return df.repartition(3).agg(total(F.col("x"), scale)).first()[0]

    assert sum_of(3, *[0.001] * 1000) == 1.0
    assert sum_of(2, 0.1, 0.2, -0.3) == 0.0
    assert sum_of(3, 5.787999999999999, None) == 5.788
    assert sum_of(2, 1e20, 1.0) == 1e20
    for scale, value in ((2, 0.001), (2, 0.005), (0, 0.5), (2, float("nan")), (2, float("inf")), (2, 1e27)):
        with pytest.raises(PySparkException, match="not an amount with"):
            sum_of(scale, 1.0, value)


def test_exact_mean_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert tuple(df.agg(mean(F.col("x"), 2), mean(F.col("x"))).first()) == (None, None)


def test_correlation(spark):
    data = [("a", 1.0, 2.0), ("a", 2.0, 4.0), ("a", 5.0, None), ("b", 1.0, 3.0), ("b", 1.0, 5.0), ("c", None, 1.0)]
    df = spark.createDataFrame(data, "k string, x double, y double")
    found = dict(tuple(r) for r in df.groupBy("k").agg(correlation(F.col("x"), F.col("y"))).collect())
    assert found["a"] == pytest.approx(1.0)
    assert found["b"] is None and found["c"] is None
