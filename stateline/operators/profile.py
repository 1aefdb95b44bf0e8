"""Column profiles and scalar measures (AGG-7…12, AGG-14)."""

from __future__ import annotations

import math
import sys
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from stateline.functions.exact import mean
from stateline.operators.clean import positive
from stateline.operators.columns import require, unpivot

QUARTILES = (0.25, 0.5, 0.75)
KEPT_VALUES = 50_000
SKETCH_ACCURACY = 10_000
SKETCHED_VALUES = 2_000_000
LEAST_DRAWN = 0.001


def mean_where_positive(df: DataFrame, names: Sequence[str], scale: int | None = None) -> DataFrame:
    return df.agg(*[mean(positive(F.col(n)), scale).alias(n) for n in names])


def count_where(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """All predicate counts in one scan."""
    return df.agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])


def distinct_values(df: DataFrame, name: str) -> DataFrame:
    return df.select(name).distinct()


def distinct_counts(
    df: DataFrame, names: Sequence[str] | None = None, approximate: bool = False
) -> DataFrame:
    """Distinct non-null values per column, exact unless asked otherwise."""
    names = list(names or df.columns)
    count = F.approx_count_distinct if approximate else F.count_distinct
    counts = df.agg(*[count(F.col(n)).alias(n) for n in names])
    return unpivot(counts, {n: {"distinct_values": F.col(n)} for n in names}, "column_name")


def column_profile(df: DataFrame) -> DataFrame:
    """Type and non-null count of every column, from one scan."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    counts = df.agg(*[F.count(n).alias(n) for n in kinds])
    rows = {n: {"data_type": F.lit(kind), "non_null": F.col(n)} for n, kind in kinds.items()}
    return unpivot(counts, rows, "column_name")


@dataclass(frozen=True)
class Bracket:
    """Values from ``lo`` to ``hi`` of a column (None: no bound), known to hold the wanted ranks of a quantile.

    Both are values of the column, in its own type.
    """

    column: str
    p: float
    rows: int
    lo: Any = None
    hi: Any = None
    below: int = 0
    inside: int = 0
    distinct: int | None = None

    @property
    def span(self) -> tuple:
        return self.column, repr(self.lo), repr(self.hi)

    @property
    def rank(self) -> float:
        return self.p * (self.rows - 1)

    @property
    def holds(self) -> bool:
        return self.below <= math.floor(self.rank) and math.ceil(self.rank) < self.below + self.inside

    @property
    def is_large(self) -> bool:
        """Too many different values to rank in one task; copies of a value are folded first."""
        return self.inside > KEPT_VALUES and (self.distinct is None or self.distinct > max(KEPT_VALUES, 2))

    def under(self) -> Column:
        return F.lit(False) if self.lo is None else F.col(self.column) < F.lit(self.lo)

    def covers(self) -> Column:
        inside = F.col(self.column).isNotNull()
        if self.lo is not None:
            inside = inside & (F.col(self.column) >= F.lit(self.lo))
        return inside if self.hi is None else inside & (F.col(self.column) <= F.lit(self.hi))


def _by_span(brackets: list[Bracket]) -> dict[tuple, list[Bracket]]:
    """Brackets of the same values of the same column."""
    spans: dict[tuple, list[Bracket]] = {}
    for b in brackets:
        spans.setdefault(b.span, []).append(b)
    return spans


def _narrow(df: DataFrame, brackets: list[Bracket]) -> dict[Bracket, Bracket]:
    """Two scans: sketches of a sample inside the brackets, then exact counts around the new ends.

    A new bracket counts only if it holds the wanted ranks, so neither the sample nor the sketch
    decides a result.
    """
    sketches, ends = {}, {}
    for span, members in _by_span(brackets).items():
        size = members[0].inside
        drawn = min(1.0, max(SKETCHED_VALUES / size, LEAST_DRAWN))
        slack = 2 / SKETCH_ACCURACY + 3 / math.sqrt(size * drawn)
        shares = [(b.rank - b.below) / size for b in members]
        ends[span] = [min(max(s + d, 0.0), 1.0) for s in shares for d in (-slack, slack)]
        value = F.when(members[0].covers() & (F.col("_draw") < drawn), F.col(members[0].column))
        sketches[span] = F.percentile_approx(value, F.array(*map(F.lit, ends[span])), SKETCH_ACCURACY)
    drawn_rows = df.withColumn("_draw", F.rand(17))
    found = drawn_rows.agg(*[c.alias(f"s{i}") for i, c in enumerate(sketches.values())]).first()
    tried = []
    for members, values in zip(_by_span(brackets).values(), found, strict=True):
        # An empty draw leaves a bracket as it is.
        values = values or [end for b in members for end in (b.lo, b.hi)]
        tried += [replace(b, lo=values[2 * i], hi=values[2 * i + 1]) for i, b in enumerate(members)]
    brackets = [b for members in _by_span(brackets).values() for b in members]
    return {old: new if new.holds else old for old, new in zip(brackets, _counted(df, tried), strict=True)}


def _counted(df: DataFrame, brackets: list[Bracket]) -> list[Bracket]:
    """The brackets with exact counts, from one scan; only the number of different values is a sketch."""
    counts = []
    for b in brackets:
        different = F.approx_count_distinct(F.when(b.covers(), F.col(b.column)))
        counts += [F.count_if(b.under()), F.count_if(b.covers()), different]
    found = df.agg(*[c.alias(f"n{i}") for i, c in enumerate(counts)]).first()
    return [
        replace(b, below=found[3 * i], inside=found[3 * i + 1], distinct=found[3 * i + 2])
        for i, b in enumerate(brackets)
    ]


def _middle(lo: Any, hi: Any) -> Any:
    if not isinstance(lo, float):
        return lo + (hi - lo) // 2
    if math.isnan(hi):
        return math.inf
    lo, hi = max(lo, -sys.float_info.max), min(hi, sys.float_info.max)
    return lo / 2 + hi / 2


def _halve(df: DataFrame, brackets: list[Bracket]) -> dict[Bracket, Bracket]:
    """Two scans: the values on both sides of the middle of each bracket, then exact counts of the half that counts.

    Slower than sketches, but no luck is needed: the range of values halves each time.
    """
    cells = []
    for b in brackets:
        value = F.when(b.covers(), F.col(b.column))
        low = value <= F.lit(_middle(b.lo, b.hi))
        cells += [F.count_if(low), F.max(F.when(low, value)), F.min(F.when(~low, value))]
    found = df.agg(*[c.alias(f"n{i}") for i, c in enumerate(cells)]).first()
    halves = []
    for i, b in enumerate(brackets):
        n, last_low, first_high = found[3 * i : 3 * i + 3]
        if math.ceil(b.rank) < b.below + n:
            halves.append(replace(b, hi=last_low))
        elif math.floor(b.rank) >= b.below + n:
            halves.append(replace(b, lo=first_high))
        else:
            halves.append(replace(b, lo=last_low, hi=first_high))
    return dict(zip(brackets, _counted(df, halves), strict=True))


def exact_quantiles(
    df: DataFrame, names: Sequence[str], at: Sequence[float] = QUARTILES, sizes: Mapping[str, int] | None = None
) -> DataFrame:
    """Exact, linearly interpolated quantiles: rows of (column_name, p, value).

    The built-in ``percentile`` gathers all distinct values of a column in one buffer. Here each
    quantile is enclosed by two values, narrowed with bounded sketches until few different values lie
    between them, by a factor of a hundred to some thousand per round. Only those rows are shuffled,
    equal values folded first, and ranked in their own type; the result is a double. ``sizes``, the
    numbers of values, saves a scan where it is known.
    """
    require(df, names)
    spark = df.sparkSession
    sizes = sizes or df.agg(*[F.count(n).alias(n) for n in names]).first().asDict()
    brackets = [Bracket(n, float(p), sizes[n], inside=sizes[n]) for n in names if sizes[n] for p in at]
    while large := [b for b in brackets if b.is_large]:
        narrowed = _narrow(df, large)
        stalled = [b for b in large if narrowed[b].is_large and 2 * narrowed[b].inside > b.inside]
        if again := list(dict.fromkeys(narrowed[b] for b in stalled if narrowed[b].lo is not None)):
            halves = _halve(df, again)
            narrowed |= {b: halves.get(narrowed[b], narrowed[b]) for b in stalled}
        brackets = [narrowed.get(b, b) for b in brackets]
    if not brackets:
        return spark.createDataFrame([], "column_name string, p double, value double")

    # Quantiles enclosed by the same values share their rows. A row has a cell per span.
    spans = [members[0] for members in _by_span(brackets).values()]
    parts = []
    for i, b in enumerate(spans):
        own = [
            (F.col(n) if n == b.column else F.lit(None).cast(df.schema[n].dataType)).alias(f"v_{n}") for n in names
        ]
        parts.append(F.when(b.covers(), F.struct(F.lit(i).alias("span"), *own)))
    covered = reduce(or_, [b.covers() for b in spans])
    values = df.where(covered).select(F.inline(F.array_compact(F.array(*parts))))
    columns = [f"v_{n}" for n in names]
    folded = values.groupBy("span", *columns).agg(F.count(F.lit(1)).alias("n"))
    # At most KEPT_VALUES or so different values in a span.
    upto = W.partitionBy("span").orderBy(*columns).rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = folded.withColumn("end", F.sum("n").over(upto))

    def at_rank(b: Bracket, rank: int) -> Column:
        span = next(i for i, s in enumerate(spans) if s.span == b.span)
        place = F.lit(rank - b.below)
        covers = (F.col("end") - F.col("n") <= place) & (F.col("end") > place)
        return F.max(F.when((F.col("span") == span) & covers, F.col(f"v_{b.column}")))

    ends = ranked.agg(
        *[at_rank(b, math.floor(b.rank)).alias(f"low{i}") for i, b in enumerate(brackets)],
        *[at_rank(b, math.ceil(b.rank)).alias(f"high{i}") for i, b in enumerate(brackets)],
    )
    cells = {}
    for i, b in enumerate(brackets):
        low, high = F.col(f"low{i}"), F.col(f"high{i}")
        # Equal ends, infinities among them, are the value; large numbers are not rounded before.
        between = low.cast("double") + (high - low).cast("double") * F.lit(b.rank - math.floor(b.rank))
        value = F.when(low == high, low.cast("double")).otherwise(between)
        cells[i] = {"column_name": F.lit(b.column), "p": F.lit(b.p), "value": value}
    return unpivot(ends, cells, "_label").drop("_label")


def numeric_profile(
    df: DataFrame, names: Sequence[str] | None = None, scale: int | None = None
) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles per column.

    Without ``names`` all numeric columns are profiled. One scan for all but the quartiles, and three
    more for these (one, where the values are few).
    """
    names = list(names or [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)])
    measures = {
        "count": lambda c: F.count(c),
        "mean": lambda c: mean(c, scale).cast("double"),
        "std": lambda c: F.stddev_samp(c),
        "min": lambda c: F.min(c).cast("double"),
        "max": lambda c: F.max(c).cast("double"),
    }
    stats = df.agg(
        *[F.struct(*[f(F.col(n)).alias(m) for m, f in measures.items()]).alias(n) for n in names]
    )
    row = stats.first()
    kinds = "column_name string, count bigint, mean double, std double, min double, max double"
    stats = df.sparkSession.createDataFrame([(n, *row[n]) for n in names], kinds)

    labels = {0.25: "q25", 0.5: "q50", 0.75: "q75"}
    found = exact_quantiles(df, names, sizes={n: row[n]["count"] for n in names})
    quartiles = found.groupBy("column_name").agg(
        *[F.max(F.when(F.col("p") == p, F.col("value"))).alias(label) for p, label in labels.items()]
    )
    return stats.join(quartiles, "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", *labels.values(), "max"
    )


def schema_diff(left: DataFrame, right: DataFrame) -> list[tuple[str, str | None, str | None]]:
    """Columns that only one side has or whose types differ: (name, left type, right type)."""
    a = {f.name: f.dataType.simpleString() for f in left.schema.fields}
    b = {f.name: f.dataType.simpleString() for f in right.schema.fields}
    names = [*a, *[n for n in b if n not in a]]
    return [(n, a.get(n), b.get(n)) for n in names if a.get(n) != b.get(n)]


def compare_profiles(left: DataFrame, right: DataFrame) -> DataFrame:
    """Column profiles of two tables side by side, with where each column occurs."""
    a = column_profile(left).select(
        "column_name", F.col("data_type").alias("left_type"), F.col("non_null").alias("left_non_null")
    )
    b = column_profile(right).select(
        "column_name", F.col("data_type").alias("right_type"), F.col("non_null").alias("right_non_null")
    )
    verdict = (
        F.when(F.col("right_type").isNull(), "left only")
        .when(F.col("left_type").isNull(), "right only")
        .when(F.col("left_type") != F.col("right_type"), "types differ")
        .otherwise("same")
    )
    return a.join(b, "column_name", "full_outer").withColumn("verdict", verdict)
