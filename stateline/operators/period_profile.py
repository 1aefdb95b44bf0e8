"""Profiles of growing tables, kept by period and put together when they are read (AGG-9, AGG-10).

A period's rows are read once, for its counts, sums, extremes and two mergeable sketches: of quantiles (KLL)
and of distinct values (HLL). Merged over all periods the sketches enclose each quartile by two values,
and one scan that counts and ranks what lies between makes it exact. The sketch never decides a result:
what it encloses wrongly, or too widely to rank at once, is left to ``exact_quantiles``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stateline.functions.exact import exact_sum
from stateline.operators.columns import require, unpivot
from stateline.operators.profile import KEPT_VALUES, QUARTILES, Bracket, exact_quantiles

#: Size of the quantile sketches, and by how much of all rows a merged one may be wrong, generously.
ACCURACY = 4096
SLACK = 8 / ACCURACY
LABELS = {0.25: "q25", 0.5: "q50", 0.75: "q75"}


def sketched(df: DataFrame, period: Sequence[str], names: Sequence[str], scale: int | None = None) -> DataFrame:
    """One row for each period and column: what its profile needs, in a few kilobytes."""
    require(df, [*period, *names])
    cells = []
    for n in names:
        number = F.col(n).cast("double")
        known = F.when(~F.isnan(number), number)
        cells += [
            F.count(n).alias(f"count_{n}"),
            exact_sum(F.col(n), scale).alias(f"total_{n}"),
            F.avg(number).alias(f"mean_{n}"),
            (F.var_pop(number) * F.count(n)).alias(f"off_{n}"),
            F.min(number).alias(f"min_{n}"),
            F.max(number).alias(f"max_{n}"),
            F.kll_sketch_agg_double(known, ACCURACY).alias(f"ranks_{n}"),
            F.hll_sketch_agg(F.when(number.isNotNull(), F.xxhash64(number))).alias(f"distinct_{n}"),
        ]
    grouped = df.groupBy(*period).agg(*cells)
    parts = ("count", "total", "mean", "off", "min", "max", "ranks", "distinct")
    return unpivot(grouped, {n: {p: F.col(f"{p}_{n}") for p in parts} for n in names}, "column_name", list(period))


def merged(sketches: DataFrame) -> DataFrame:
    """The rows of ``sketched`` over all periods: one for each column, with ``std`` and estimated ``distinct``."""
    moments = F.collect_list(F.when(F.col("count") > 0, F.struct("count", "mean", "off")))
    rows = sketches.groupBy("column_name").agg(
        F.sum("count").alias("count"),
        F.sum("total").cast("double").alias("total"),
        moments.alias("moments"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.kll_merge_agg_double(F.when(F.col("count") > 0, F.col("ranks"))).alias("ranks"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct"),
    )
    rows = rows.withColumn("mean", F.try_divide("total", F.col("count").cast("double")))

    def off(acc: Column, m: Column) -> Column:
        return acc + m["off"] + m["count"] * (m["mean"] - F.col("mean")) * (m["mean"] - F.col("mean"))

    spread = F.aggregate("moments", F.lit(0.0), off)
    std = F.when(F.col("count") > 1, F.sqrt(F.try_divide(spread, (F.col("count") - 1).cast("double"))))
    return rows.withColumn("std", std).drop("moments", "total")


def enclosed(rows: DataFrame) -> list[Bracket]:
    """For each column with values and each quartile the two values that enclose it, by the sketches."""

    def value(share: float) -> Column:
        return F.when(F.col("count") > 0, F.kll_sketch_get_quantile_double("ranks", F.lit(share)))

    ends = [value(p + d).alias(f"e{i}{j}") for i, p in enumerate(QUARTILES) for j, d in enumerate((-SLACK, SLACK))]
    found = rows.select("column_name", "count", *ends).collect()
    return [
        Bracket(r["column_name"], p, r["count"], r[f"e{i}0"], r[f"e{i}1"], inside=r["count"])
        for r in found if r["count"] for i, p in enumerate(QUARTILES)
    ]


def ranked_quantiles(df: DataFrame, brackets: Sequence[Bracket]) -> dict[tuple[str, float], float | None]:
    """The quantile of each bracket, from one scan; None where the bracket does not hold it.

    Rows below a bracket are one row for each task that counts them, rows in it are folded by value, rows
    above it go nowhere.
    """
    below, inside = [], []
    for i, b in enumerate(brackets):
        number = F.col(b.column).cast("double")
        below.append(F.when(number < b.lo, F.struct(F.lit(i).alias("of"), F.lit(0).alias("part"), F.lit(None).cast("double").alias("value"))))
        inside.append(F.when((number >= b.lo) & (number <= b.hi), F.struct(F.lit(i).alias("of"), F.lit(1).alias("part"), number.alias("value"))))
    wanted = reduce(or_, [F.col(b.column).cast("double") <= b.hi for b in brackets])
    rows = df.where(wanted).select(F.inline(F.array_compact(F.array(*below, *inside))))
    folded = rows.groupBy("of", "part", "value").agg(F.count(F.lit(1)).alias("n"))
    upto = W.partitionBy("of").orderBy("part", "value").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = folded.withColumn("end", F.sum("n").over(upto))

    def at(i: int, rank: int) -> Column:
        here = (F.col("of") == i) & (F.col("end") > rank) & (F.col("end") - F.col("n") <= rank)
        return F.max(F.when(here, F.col("value")))

    ends = [c for i, b in enumerate(brackets) for c in (at(i, int(b.rank // 1)), at(i, int(-(-b.rank // 1))))]
    found = placed.agg(*[c.alias(f"r{i}") for i, c in enumerate(ends)]).first()
    result = {}
    for i, b in enumerate(brackets):
        low, high = found[2 * i], found[2 * i + 1]
        exact = None if low is None or high is None else low if low == high else low + (high - low) * (b.rank - b.rank // 1)
        result[b.column, b.p] = exact
    return result


def profile_of_periods(sketches: DataFrame, df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``numeric_profile`` of ``df`` from the sketches of its periods and one scan, with ``distinct``, an estimate.

    ``sketches`` are those of all periods of ``df``. Further scans are needed only where equal values or
    very many rows make too much of what a sketch encloses, and where it encloses the wrong values.
    """
    rows = merged(sketches)
    rows = rows.where(F.col("column_name").isin(*names))
    brackets = enclosed(rows)
    expected = {(b.column, b.p): 2 * SLACK * b.rows for b in brackets}
    narrow = [b for b in brackets if expected[b.column, b.p] <= KEPT_VALUES and b.lo is not None]
    known = ranked_quantiles(df, narrow) if narrow else {}
    left = list(dict.fromkeys(b.column for b in brackets if known.get((b.column, b.p)) is None))
    if left:
        for r in exact_quantiles(df, left).collect():
            known[r["column_name"], r["p"]] = r["value"]
    kinds = "column_name string, p double, value double"
    found = df.sparkSession.createDataFrame([(n, p, v) for (n, p), v in known.items()], kinds)
    quartiles = found.groupBy("column_name").agg(*[F.max(F.when(F.col("p") == p, F.col("value"))).alias(label) for p, label in LABELS.items()])
    return rows.join(quartiles, "column_name", "left").select("column_name", "count", "mean", "std", "min", *LABELS.values(), "max", "distinct")
