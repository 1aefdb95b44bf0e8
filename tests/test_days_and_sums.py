"""Missing days, groups of equal size, sums in any order, ids as bits."""

import datetime as dt
import math
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from stateline.operators import aggregate, ids, period_profile, profile, quality, sums
from stateline.operators.calendar import on_calendar
from stateline.plans import reports


def day(d, month=3):
    return dt.date(2020, month, d)


def cases(spark):
    """110 on 2 March and 220 on the 12th, ten days later; state 2 falls, state 3 starts at nothing."""
    rows = [(1, day(1), 100.0), (1, day(2), 110.0), (1, day(12), 220.0), (1, day(13), 330.0)]
    rows += [(2, day(1), 50.0), (2, day(4), 20.0), (3, day(1), 0.0), (3, day(3), 6.0)]
    rows = [(i, d, s, p, 0.0) for i, (s, d, p) in enumerate(rows)]
    return spark.createDataFrame(rows, "id_covid_data long, day_date date, id_state long, positive double, death double").repartition(3)


@pytest.mark.parametrize(
    "gap, expected",
    [
        ("per_day", [(None, None), (10.0, 0.1), (11.0, 0.1), (110.0, 0.5), (None, None), (0.0, 0.0), (None, None), (3.0, None)]),
        ("unknown", [(None, None), (10.0, 0.1), (None, None), (110.0, 0.5), (None, None), (None, None), (None, None), (None, None)]),
        ("last", [(None, None), (10.0, 0.1), (110.0, 1.0), (110.0, 0.5), (None, None), (0.0, 0.0), (None, None), (6.0, None)]),
    ],
)
def test_growth_over_gaps(spark, rows, gap, expected):
    found = rows(reports.growth_over_gaps(cases(spark), gap), "id_state", "day_date", "days_between", "new_positive", "growth")
    assert [r[2] for r in found] == [None, 1, 10, 1, None, 3, None, 2]
    assert [r[3:] for r in found] == expected


def test_growth_of_new_counts_over_gaps(spark, rows):
    found = rows(reports.growth_over_gaps(cases(spark), cumulative=False), "id_state", "day_date", "new_positive", "growth")
    assert [r[2] for r in found] == [100.0, 110.0, 220.0, 330.0, 50.0, 20.0, 0.0, 6.0]
    assert [r[3] for r in found][4:6] == [None, -0.2]
    last = reports.growth_over_gaps(cases(spark), reports.LAST, zero_is_unknown=True).drop("days_between")
    assert rows(last) == rows(reports.daily_growth(cases(spark), zero_is_unknown=True))
    with pytest.raises(ValueError, match="no rule never"):
        reports.growth_over_gaps(cases(spark), "never")


def test_calendar(spark, rows):
    df = spark.createDataFrame([("a", day(28, 2), 1.0), ("a", day(3), None), ("a", day(5), 2.0), ("b", day(1), 7.0), (None, day(1), 3.0), (None, day(2), 4.0)], "k string, d date, v double")
    found = rows(on_calendar(df, ["k"], "d", ["v"]))
    assert [(r[0], r[1].day, r[2], r[3].day, r[4]) for r in found] == [
        ("a", 28, 1.0, 28, 0), ("a", 29, 1.0, 28, 1), ("a", 1, 1.0, 28, 2), ("a", 2, 1.0, 28, 3), ("a", 3, None, 3, 0), ("a", 4, None, 3, 1),
        ("a", 5, 2.0, 5, 0), ("b", 1, 7.0, 1, 0), (None, 1, 3.0, 1, 0), (None, 2, 4.0, 2, 0),
    ]
    assert [r[2] for r in rows(on_calendar(df, ["k"], "d", ["v"], most=1))][:4] == [1.0, 1.0, None, None]
    assert rows(on_calendar(df.limit(0), ["k"], "d", ["v"])) == []


@pytest.mark.parametrize("n, groups", [(10, 3), (9, 3), (2, 5), (1, 1), (0, 4), (1000, 7)])
def test_tiles(spark, n, groups):
    """As ntile over one partition; equal values follow the other columns."""
    df = spark.range(n).select((F.col("id") * 7 % 13).alias("v"), "id")
    found = sorted((r["v"], r["id"], r["tile"]) for r in ids.tiles(df.repartition(5), ["v"], groups, "tile").collect())
    df.createOrReplaceTempView("tiled")
    expected = spark.sql(f"select v, id, ntile({groups}) over (order by v, id) from tiled").collect()
    assert found == sorted(map(tuple, expected))
    with pytest.raises(ValueError, match="one group or more"):
        ids.tiles(df, ["v"], 0, "tile")


def numbers(kind: str, n: int) -> list[float]:
    found = {
        "mixed": [(-1) ** i * (i * 7919 % 1013 + 0.1) * 2.0 ** (i * 37 % 90 - 45) for i in range(n)],
        "huge": [(-1) ** i * (1 + i / 7) * 2.0 ** (1000 - i % 40) for i in range(n)],
        "tiny": [(i % 11 - 5) * 2.0 ** -(1074 - i % 30) for i in range(n)],
        "cancelling": [x for i in range(n // 2) for x in (1e16 + i, -1e16)],
        "powers": [math.nextafter(2.0**e, d) for e in range(-60, 60, 1) for d in (0, math.inf)],
    }
    return found[kind]


@pytest.mark.parametrize("kind", ["mixed", "huge", "tiny", "cancelling", "powers"])
def test_sums_of_any_doubles(spark, kind):
    """To the last bit the same over 1 and 200 partitions, and the exact sum, rounded once."""
    values = numbers(kind, 3000)
    df = spark.createDataFrame([(i % 3, x) for i, x in enumerate(values)], "k long, x double")
    results = [
        sorted(tuple(r) for r in sums.reproducible_sums(df.repartition(n), ["k"], "x", "total", "mean").collect()) for n in (1, 7, 200)
    ]
    assert results[0] == results[1] == results[2]
    for k, total, mean in results[0]:
        exact = float(sum((Fraction(x) for i, x in enumerate(values) if i % 3 == k), Fraction(0)))
        assert total == exact
        assert mean == exact / len(values[k::3])


def test_sums_of_what_is_no_number(spark):
    inf, nan = float("inf"), float("nan")
    rows = [("a", 1.0), ("a", inf), ("b", inf), ("b", -inf), ("c", nan), ("c", 1.0), ("d", None), ("e", None), ("e", 0.0), ("f", -inf)]
    df = spark.createDataFrame(rows, "k string, x double")
    found = {r["k"]: (r["total"], r["mean"]) for r in sums.reproducible_sums(df, ["k"], "x", "total", "mean").collect()}
    assert found["a"] == (inf, inf) and found["f"] == (-inf, -inf)
    assert all(map(math.isnan, (*found["b"], *found["c"])))
    assert found["d"] == (None, None) and found["e"] == (0.0, 0.0)


def test_measures_of_any_scale(spark, rows):
    df = spark.createDataFrame([("a", "s", 0.1), ("a", "s", 0.2), ("a", "t", 0.3), ("b", "t", None), (None, "s", 1.0)], "k string, c string, x double")
    mean = rows(aggregate.mean_pivot(df, ["k"], "c", "x", {"s": "s", "t": "t"}, "all", scale=aggregate.ANY))
    assert mean == [("a", pytest.approx(0.2), pytest.approx(0.15), 0.3), ("b", None, None, None)]
    assert rows(aggregate.group_sum(df, ["k"], "x", "total", aggregate.ANY)) == [("a", pytest.approx(0.6)), ("b", 0.0)]
    assert rows(aggregate.group_mean(df, ["k"], "x", "mean", aggregate.ANY)) == [("a", pytest.approx(0.2)), ("b", None)]
    both = aggregate.ratio_of_means(df, ["k"], ("x", "p"), ("x", "q"), "r", scale=aggregate.ANY)
    assert rows(both, "k", "r") == [("a", 1.0), ("b", None)]


@pytest.mark.parametrize(
    "values, surplus, missing",
    [
        ([0, 1, 2, 3], 0, 0), ([], 0, 0), ([0, 1, 1, 2], 1, 1), ([1, 2, 3], 0, 1), ([0, None, None], 1, 2), ([5], 0, 5),
        ([-1, 0, 1], 0, 1), (list(range(70000)), 0, 0), ([*range(70000), 5, 5, 70001], 2, 2), ([-40000, -32768, 0, 32768, 32769], 0, 72765),
    ],
)
def test_ids_as_bits(spark, values, surplus, missing):
    df = spark.createDataFrame([(v,) for v in values], "id long").repartition(4)
    assert quality.check_unique_ids(df, "t", "id").first()["failures"] == quality.check_unique(df, "t", "id").first()["failures"] == surplus
    assert quality.check_dense(df, "t", "id").first()["failures"] == missing


def test_mean_weighs_parts(spark):
    """Invariant of the published temperatures: 129 months of autumn, 132 of the others."""
    rule = quality.weighted_mean_off("m", {"a": 129, "b": 132, "c": 132, "d": 132})
    parts = (12.0, 18.0, 27.0, 9.0)
    whole = (129 * 12.0 + 132 * (18.0 + 27.0 + 9.0)) / 525
    df = spark.createDataFrame([(whole, *parts), (whole + 0.01, *parts), (None, *parts), (whole, None, *parts[1:])], "m double, a double, b double, c double, d double")
    report = quality.check_rows(df, "t", extra=rule).first()
    assert (report["rule"], report["failures"]) == ("m_weighs_parts", 1)


def test_profile_of_odd_columns(spark, rows):
    """Nulls alone, copies of one value, infinities and NaN; periods without values; distinct values nearly counted."""
    inf = float("inf")
    data = [("m1", None, 5.0, 1.0 * i, i % 7) for i in range(40)] + [("m2", None, 5.0, -inf, 3), ("m3", None, None, inf, None)]
    df = spark.createDataFrame(data, "month string, none double, same double, x double, n int").repartition(3)
    names = ["none", "same", "x", "n"]
    found = period_profile.profile_of_periods(period_profile.sketched(df, ["month"], names), df, names)
    expected = {r["column_name"]: r for r in profile.numeric_profile(df, names).collect()}
    for r in found.collect():
        theirs = expected[r["column_name"]]
        for c in ("count", "min", "q25", "q50", "q75", "max"):
            assert r[c] == theirs[c], (r["column_name"], c)
    counted = {r["column_name"]: r["distinct"] for r in found.collect()}
    assert counted == {"none": 0, "same": 1, "x": 42, "n": 7}
    assert rows(period_profile.profile_of_periods(period_profile.sketched(df.limit(0), ["month"], ["x"]), df.limit(0), ["x"])) == []
