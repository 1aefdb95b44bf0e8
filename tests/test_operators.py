import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stateline.operators import aggregate, clean, columns, joins, profile, quality, sets


# Projections.


def test_projections(spark, rows):
    df = spark.createDataFrame([(1, "a", 2.0)], "x int, y string, z double")
    assert columns.keep(df, "z", "x").columns == ["z", "x"]
    assert columns.drop(df, "y").columns == ["x", "z"]
    assert columns.rename(df, {"y": "name"}).columns == ["x", "name", "z"]
    assert columns.rename_all(df, ["a", "b", "c"]).columns == ["a", "b", "c"]
    assert columns.promote(df, "z").columns == ["z", "x", "y"]
    assert rows(columns.tag(df, "t", "public")) == [(1, "a", 2.0, "public")]
    wanted = T.StructType([T.StructField("z", T.DoubleType()), T.StructField("new", T.LongType())])
    shaped = columns.reindex(df, wanted)
    assert shaped.dtypes == [("z", "double"), ("new", "bigint")]
    assert rows(shaped) == [(2.0, None)]


def test_unknown_names_raise(spark):
    df = spark.createDataFrame([(1,)], "x int")
    for call in (
        lambda: columns.keep(df, "q"),
        lambda: columns.drop(df, "q"),
        lambda: columns.rename(df, {"q": "x"}),
        lambda: columns.promote(df, "q"),
        lambda: columns.replace_value(df, "q", {1: 2}),
        lambda: columns.rename_all(df, ["a", "b"]),
    ):
        with pytest.raises(ValueError):
            call()


def test_replace_value(spark, rows):
    df = spark.createDataFrame([("Georgia (State)",), ("Ohio",), (None,)], "s string")
    assert rows(columns.replace_value(df, "s", {"Georgia (State)": "Georgia"})) == [
        ("Georgia",), ("Ohio",), (None,)
    ]


# Filters and null handling.


def test_filters(spark, rows):
    df = spark.createDataFrame([("American Samoa",), ("Alabama",), (None,)], "s string")
    assert rows(clean.not_equal(df, "s", "American Samoa")) == [("Alabama",), (None,)]
    assert rows(clean.equal(df, "s", "Alabama")) == [("Alabama",)]
    assert rows(clean.is_null(df, "s")) == [(None,)]
    days = spark.createDataFrame([(dt.date(1969, 12, 31),), (dt.date(1970, 1, 1),), (None,)], "d date")
    assert rows(clean.after(days, "d", dt.date(1969, 12, 31))) == [(dt.date(1970, 1, 1),)]
    pairs = spark.createDataFrame([(-999, 1), (1, -999), (1, None), (None, -999)], "a int, b int")
    assert len(rows(clean.any_equal(pairs, ["a", "b"], -999))) == 3


def test_fill_zero(spark, rows):
    df = spark.createDataFrame([(None, None, None)], "n int, x double, s string")
    assert rows(clean.fill_zero(df)) == [(0, 0.0, None)]
    assert rows(clean.fill_zero(df, ["n"])) == [(0, None, None)]


@pytest.mark.parametrize("scale", [None, 2])
def test_impute_sentinel(spark, rows, scale):
    df = spark.createDataFrame([(10, 1), (0, 2), (-999, 3), (None, 4), (30, 5)], "v long, k int")
    fixed = clean.impute_sentinel(df.repartition(3), ["v"], scale)
    assert fixed.dtypes[0] == ("v", "double")
    assert rows(fixed.select("k", "v")) == [(1, 10.0), (2, 0.0), (3, 20.0), (4, None), (5, 30.0)]


def test_impute_before_drop(spark, rows):
    df = spark.createDataFrame([(100, None), (20, "X"), (-999, "X")], "v long, county string")
    kept = clean.drop_incomplete(clean.impute_sentinel(df, ["v"]))
    assert rows(kept) == [(20.0, "X"), (60.0, "X")]


def test_blanks(spark, rows):
    df = spark.createDataFrame([("  ", 1), ("", 2), (" a", 3)], "s string, n int")
    assert rows(clean.blanks_to_null(df), "n", "s") == [(1, None), (2, None), (3, " a")]
    assert rows(clean.drop_incomplete(clean.blanks_to_null(df), ["s"]), "n") == [(3,)]


# Groups.

SHARES = [("A", "x", 1), ("A", "y", 3), ("B", "x", 2), (None, "x", 5), ("B", None, 7)]


def test_share_pivot(spark, rows):
    df = spark.createDataFrame(SHARES, "k string, c string, n long")
    for frame in (df, df.repartition(7)):
        shares = aggregate.share_pivot(frame, "k", "c", "n", {"x": "sx", "y": "sy"})
        assert rows(shares) == [("A", 0.25, 0.75), ("B", 1.0, None)]
        assert rows(aggregate.share_rows(frame, "k", "c", "n", "share")) == [
            ("A", "x", 0.25), ("A", "y", 0.75), ("B", "x", 1.0)
        ]


def test_share_of_undeclared_value(spark, rows):
    df = spark.createDataFrame(SHARES, "k string, c string, n long")
    assert rows(aggregate.share_pivot(df, "k", "c", "n", {"x": "sx"})) == [("A", 0.25), ("B", 1.0)]
    assert rows(aggregate.undeclared(df, "c", ["x"])) == [("y", 1)]


def test_group_of_nulls(spark, rows):
    df = spark.createDataFrame([("A", None), ("B", 1.0), (None, 2.0)], "k string, v double")
    assert rows(aggregate.group_sum(df, ["k"], "v", "s")) == [("A", 0.0), ("B", 1.0)]
    assert rows(aggregate.group_mean(df, ["k"], "v", "m")) == [("A", None), ("B", 1.0)]
    assert rows(aggregate.group_count(df, ["k"], "v", "n")) == [("A", 0), ("B", 1)]
    nothing = spark.createDataFrame([("A", "x", None)], "k string, c string, n long")
    assert rows(aggregate.share_pivot(nothing, "k", "c", "n", {"x": "sx"})) == [("A", None)]


def test_mean_pivot_skips_nulls(spark, rows):
    df = spark.createDataFrame(
        [("A", "summer", 10.0), ("A", "summer", None), ("A", "summer", 20.0), ("A", "winter", 0.0)],
        "k string, s string, v double",
    )
    means = aggregate.mean_pivot(
        df, ["k"], "s", "v", {"summer": "summer", "winter": "winter", "spring": "spring"}, "mean"
    )
    assert rows(means) == [("A", 10.0, 15.0, 0.0, None)]


def test_crosstab_fills_zero(spark, rows):
    df = spark.createDataFrame([("A", "x"), ("A", "x"), ("B", "y"), (None, "x")], "k string, c string")
    assert rows(aggregate.crosstab(df, "k", "c", {"x": "x", "y": "y"})) == [("A", 2, 0), ("B", 0, 1)]


def test_group_keys_are_columns(spark):
    df = spark.createDataFrame([("A", "x", 1.0)], "k string, c string, v double")
    assert aggregate.group_sum(df, ["k", "c"], "v", "s").columns == ["k", "c", "s"]


def test_ratio_of_means_is_not_mean_of_ratios(spark, rows):
    df = spark.createDataFrame([("A", 10.0, 1.0), ("A", 10.0, 4.0), ("B", 1.0, 0.0)], "k string, a double, b double")
    result = aggregate.ratio_of_means(df, ["k"], ("a", "ma"), ("b", "mb"), "r")
    assert rows(result) == [("A", 10.0, 2.5, 4.0), ("B", 1.0, 0.0, None)]


def test_group_total_with_hot_and_null_keys(spark, rows):
    # One key holds a third of the rows, one is null, the rest are small.
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") % 100 == 1, None).otherwise(F.col("id") % 500).alias("k"),
        (F.col("id") % 7).cast("double").alias("v"),
        F.col("id"),
    )
    found = aggregate.with_group_total(df.repartition(5), ["k"], {"t": "v"})
    data = [tuple(r) for r in df.collect()]
    sums = {}
    for k, v, _ in data:
        sums[k] = sums.get(k, 0.0) + v
    expected = sorted((i, k, None if k is None else sums[k]) for k, v, i in data)
    assert sorted((r.id, r.k, r.t) for r in found.collect()) == expected


# Joins.


def test_outer_join(spark, rows):
    a = spark.createDataFrame([("A", 1.0), ("B", 2.0)], "k string, x double")
    b = spark.createDataFrame([("B", 3), ("C", 4)], "k string, y long")
    assert rows(joins.outer_on(a, b, "k")) == [("A", 1.0, None), ("B", 2.0, 3), ("C", None, 4)]
    assert rows(joins.inner_on(a, b, "k")) == [("B", 2.0, 3)]


def test_lookup_join(spark, rows):
    df = spark.createDataFrame([("DC", 1), ("ZZ", 2), (None, 3)], "k string, n int")
    dim = spark.createDataFrame([("DC", 10), ("Columbia", 10)], "name string, id long")
    assert rows(joins.lookup_join(df, "k", dim, "name", "id", default=0)) == [
        ("DC", 1, 10), ("ZZ", 2, 0), (None, 3, 0)
    ]
    known = df.where("k = 'DC'")
    assert rows(joins.lookup_join(known, "k", dim, "name", "id", strict=True)) == [("DC", 1, 10)]
    with pytest.raises(PySparkException, match="unknown k"):
        joins.lookup_join(df, "k", dim, "name", "id", strict=True).collect()


def test_lookup_join_needs_a_dictionary(spark, rows):
    """A key twice in the dictionary is refused; a known key without a value keeps it."""
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    dim = spark.createDataFrame([("a", None), ("b", 5), ("c", 1), (None, 3), (None, 4)], "name string, id long")
    assert rows(joins.lookup_join(df, "k", dim, "name", "id", default=0)) == [("a", 1, None), ("b", 2, 5)]
    twice = dim.unionByName(dim.where("name = 'b'"))
    for strict in (False, True):
        with pytest.raises(PySparkException, match="name is not unique: b"):
            joins.lookup_join(df, "k", twice, "name", "id", default=0, strict=strict).collect()


def test_orphans(spark, rows):
    fact = spark.createDataFrame([(1,), (14,), (14,), (None,)], "id int")
    dim = spark.createDataFrame([(1,), (2,)], "id int")
    assert rows(joins.orphans(fact, dim, ["id"])) == [(14, 2)]


# Sets, sorts, limits.


def test_tagged_union_with_differing_columns(spark):
    public = spark.createDataFrame([("a", "PK")], "NAME string, ST_GRADE string")
    private = spark.createDataFrame([("b", 1, "KG")], "NAME string, FID int, START_GRAD string")
    private = columns.rename(columns.drop(private, "FID"), {"START_GRAD": "ST_GRADE"})
    both = sets.tagged_union({"public": public, "private": private}, "kind")
    assert both.columns == ["NAME", "ST_GRADE", "kind"]
    assert sorted(map(tuple, both.collect())) == [("a", "PK", "public"), ("b", "KG", "private")]


def test_union_keeps_copies_and_fills(spark, rows):
    a = spark.createDataFrame([(1,), (1,)], "x int")
    b = spark.createDataFrame([(1, "q")], "x int, y string")
    assert rows(sets.union_all(a, b)) == [(1, "q"), (1, None), (1, None)]
    assert rows(sets.distinct_rows(sets.union_all(a, b), "x")) == [(1,)]


def test_sorts(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 3)], "k string, n int").repartition(3)
    assert [r.k for r in sets.sort_by(df, "k").collect()] == ["a", "b", "c"]
    assert [r.k for r in sets.rank_by(df, "n", "k").collect()] == ["c", "a", "b"]
    assert [r.k for r in sets.first_rows(df, 2, [F.col("n").desc(), "k"]).collect()] == ["c", "a"]


# Profiles.


def test_numeric_profile(spark, rows):
    df = spark.createDataFrame([(1.0, 5), (2.0, 5), (3.0, 5), (4.0, None), (None, None)], "x double, y int")
    found = rows(profile.numeric_profile(df, ["x", "y"]))
    assert found[0][:3] == ("x", 4, 2.5) and found[0][4:] == (1.0, 1.75, 2.5, 3.25, 4.0)
    assert found[1] == ("y", 3, 5.0, 0.0, 5.0, 5.0, 5.0, 5.0, 5.0)


def test_numeric_profile_of_an_empty_column(spark, rows):
    df = spark.createDataFrame([(None,)], "x double")
    assert rows(profile.numeric_profile(df, ["x"])) == [("x", 0, None, None, None, None, None, None, None)]


@pytest.mark.parametrize("kept, accuracy", [(50_000, 10_000), (30, 50), (1, 10)])
def test_exact_quantiles_with_a_hot_value(spark, monkeypatch, kept, accuracy):
    monkeypatch.setattr(profile, "KEPT_VALUES", kept)
    monkeypatch.setattr(profile, "SKETCH_ACCURACY", accuracy)
    values = [7.25 if i % 3 == 0 else (i * 7919 % 1009) / 4 for i in range(2000)]
    df = spark.createDataFrame([(v, -v) for v in values], "x double, y double").repartition(5)
    at = [0.0, 0.1, 0.25, 0.333, 0.5, 0.75, 0.99, 1.0]
    found = {(r.column_name, r.p): r.value for r in profile.exact_quantiles(df, ["x", "y"], at).collect()}

    def quantile(numbers, p):
        numbers = sorted(numbers)
        rank = p * (len(numbers) - 1)
        low = int(rank)
        high = min(low + 1, len(numbers) - 1)
        return numbers[low] + (numbers[high] - numbers[low]) * (rank - low)

    for p in at:
        assert found["x", p] == pytest.approx(quantile(values, p), abs=1e-9)
        assert found["y", p] == pytest.approx(quantile([-v for v in values], p), abs=1e-9)


@pytest.mark.parametrize("kept", [50_000, 2])
def test_quantiles_of_infinities_and_large_numbers(spark, monkeypatch, kept):
    monkeypatch.setattr(profile, "KEPT_VALUES", kept)
    monkeypatch.setattr(profile, "SKETCH_ACCURACY", 10)
    inf = float("inf")
    large = [2**53 + i for i in range(1, 40, 2)]
    data = [(inf if i < 12 else -inf if i < 15 else float(i), n, n % 2 == 1) for i, n in enumerate(large)]
    df = spark.createDataFrame(data, "x double, n long, odd boolean").repartition(3)
    at = [0.0, 0.5, 1.0]
    found = {(r.column_name, r.p): r.value for r in profile.exact_quantiles(df, ["x", "n"], at).collect()}
    assert found["x", 0.0] == -inf and found["x", 0.5] == inf and found["x", 1.0] == inf
    # 2^53 + 1 and the like are ranked as they are; only the result is a double.
    assert found["n", 0.5] == float(sorted(large)[9]) + 1.0
    assert found["n", 1.0] == float(large[-1])
    assert sorted(r.column_name for r in profile.numeric_profile(df).collect()) == ["n", "x"]


def test_profile_in_four_scans(spark, monkeypatch):
    monkeypatch.setattr(profile, "KEPT_VALUES", 2000)
    calls = []
    monkeypatch.setattr(profile, "_counted", lambda df, b, real=profile._counted: calls.append("counts") or real(df, b))
    monkeypatch.setattr(profile, "_narrow", lambda df, b, real=profile._narrow: calls.append("sketch") or real(df, b))
    df = spark.range(20_000).select((F.col("id") * 7919 % 100_003).alias("x"), (F.col("id") % 11).alias("few"))
    found = {r.column_name: r for r in profile.numeric_profile(df, ["x", "few"]).collect()}
    values = sorted(i * 7919 % 100_003 for i in range(20_000))
    assert found["x"].q50 == (values[9999] + values[10000]) / 2
    assert found["few"].q25 == 2.0
    assert calls == ["sketch", "counts"]


def test_column_profiles(spark, rows):
    df = spark.createDataFrame([(1, "a"), (None, "a")], "x int, y string")
    assert rows(profile.column_profile(df)) == [("x", "int", 1), ("y", "string", 2)]
    assert rows(profile.distinct_counts(df)) == [("x", 1), ("y", 1)]
    assert rows(profile.distinct_counts(df, ["y"], approximate=True)) == [("y", 1)]
    assert rows(profile.distinct_values(df, "x")) == [(1,), (None,)]


def test_schema_diff(spark, rows):
    a = spark.createDataFrame([(1, "a", 2)], "n int, g string, f int")
    b = spark.createDataFrame([(1, "a")], "n long, h string")
    assert profile.schema_diff(a, b) == [
        ("n", "int", "bigint"), ("g", "string", None), ("f", "int", None), ("h", None, "string")
    ]
    verdicts = rows(profile.compare_profiles(a, b), "column_name", "verdict")
    assert verdicts == [("f", "left only"), ("g", "left only"), ("h", "right only"), ("n", "types differ")]


# Quality.


def test_quality_failures_are_named(spark):
    education = spark.createDataFrame(
        [(1, -5.0, 1), (1, 3.0, 14), (None, None, 1)], "id_institution int, n_students double, id_state int"
    )
    state = spark.createDataFrame([(1,), (2,)], "id_state int")
    report = quality.all_checks(
        quality.check_not_null(education, "education", "id_institution"),
        quality.check_non_negative(education, "education", "n_students"),
        quality.check_unique(education, "education", "id_institution"),
        quality.check_references(education, "education", state, "id_state"),
    )
    found = {(r.rule, r.column_name): r.failures for r in report.collect()}
    assert found == {
        ("not_null", "id_institution"): 1,
        ("non_negative", "n_students"): 1,
        ("primary_key", "id_institution"): 1,
        ("foreign_key", "id_state"): 1,
    }
    with pytest.raises(quality.QualityError) as error:
        quality.enforce(report)
    assert "education.n_students: non_negative, 1 rows" in str(error.value)
    assert "foreign_key" not in str(error.value)
    with pytest.raises(quality.QualityError, match="foreign_key"):
        quality.enforce(report, reported_only=())


def test_clean_tables_pass(spark):
    state = spark.createDataFrame([(1, 0.25, 0.75), (2, None, None)], "id_state int, a double, b double")
    report = quality.all_checks(
        quality.check_not_null(state, "state", "id_state"),
        quality.check_unique(state, "state", "id_state"),
        quality.check_shares(state, "state", ["a", "b"]),
    )
    assert [r.failures for r in quality.enforce(report)] == [0, 0, 0]


def test_share_check(spark):
    state = spark.createDataFrame([(0.25, 0.70), (0.5, None)], "a double, b double")
    assert quality.check_shares(state, "state", ["a", "b"]).first().failures == 2


def test_mean_between_parts(spark):
    state = spark.createDataFrame([(2.0, 1.0, 3.0), (4.0, 1.0, 3.0), (None, 1.0, 3.0), (2.0, None, 2.0)], "m double, a double, b double")
    assert quality.check_mean_between(state, "state", "m", ["a", "b"]).first().failures == 1
