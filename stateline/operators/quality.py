"""Quality checks (DQ-1…5, AGG-8, JN-4, RE-2).

A check yields rows of (table_name, rule, column_name, failures). ``enforce`` turns failures into
an error; foreign keys are reported and, unless asked for, not enforced.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stateline.operators.columns import unpivot
from stateline.operators.joins import orphans

REPORTED_ONLY = ("foreign_key",)


class QualityError(ValueError):
    """At least one quality rule is broken."""


def _report(table: str, counts: DataFrame, rules: dict[str, tuple[str, str]]) -> DataFrame:
    cells = {
        name: {
            "table_name": F.lit(table),
            "rule": F.lit(rule),
            "column_name": F.lit(column),
            "failures": F.coalesce(F.col(name), F.lit(0)).cast("bigint"),
        }
        for name, (rule, column) in rules.items()
    }
    return unpivot(counts, cells, "_label").drop("_label")


def check_rows(
    df: DataFrame,
    table: str,
    not_null: Sequence[str] = (),
    non_negative: Sequence[str] = (),
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """Row rules of one table, all counted in one scan.

    A null passes ``non_negative``. ``extra`` maps a rule name to the condition a bad row meets.
    """
    bad: dict[str, Column] = {}
    rules: dict[str, tuple[str, str]] = {}

    def add(rule: str, column: str, condition: Column) -> None:
        name = f"c{len(rules)}"
        rules[name] = (rule, column)
        bad[name] = condition

    for column in not_null:
        add("not_null", column, F.col(column).isNull())
    for column in non_negative:
        add("non_negative", column, F.col(column) < 0)
    for rule, condition in (extra or {}).items():
        add(rule, "", condition)
    counts = df.agg(*[F.count_if(c).alias(name) for name, c in bad.items()])
    return _report(table, counts, rules)


def check_not_null(df: DataFrame, table: str, *columns: str) -> DataFrame:
    return check_rows(df, table, not_null=columns)


def check_non_negative(df: DataFrame, table: str, *columns: str) -> DataFrame:
    return check_rows(df, table, non_negative=columns)


def surplus_rows(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with the number of rows beyond the first."""
    grouped = df.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("surplus"))
    return grouped.where(F.col("surplus") > 0)


def check_unique(df: DataFrame, table: str, *keys: str) -> DataFrame:
    counts = surplus_rows(df, *keys).agg(F.sum("surplus").alias("n"))
    return _report(table, counts, {"n": ("primary_key", ",".join(keys))})


def check_unique_ids(df: DataFrame, table: str, key: str) -> DataFrame:
    """``check_unique`` for whole numbers that lie close together, as ids do.

    Each number is a bit in the bitmap of its bucket of 32,768; maps are made where the rows are, and one
    row for each bucket is shuffled instead of each key. Rows without a key count as one key.
    """
    id = F.col(key).cast("bigint")
    rows = df.select(F.bitmap_bucket_number(id).alias("bucket"), F.bitmap_bit_position(id).alias("bit"))
    maps = rows.groupBy("bucket").agg(
        F.bitmap_count(F.bitmap_construct_agg(F.coalesce("bit", F.lit(0)))).alias("keys"), F.count(F.lit(1)).alias("rows")
    )
    counts = maps.agg(F.sum(F.col("rows") - F.col("keys")).alias("n"))
    return _report(table, counts, {"n": ("primary_key", key)})


def check_dense(df: DataFrame, table: str, key: str, start: int = 0) -> DataFrame:
    """The rule that the ids are ``start``, ``start`` + 1, … once each: how many of these numbers are missing."""
    id = F.col(key).cast("bigint")
    rows = df.select(F.bitmap_bucket_number(id).alias("bucket"), F.bitmap_bit_position(id).alias("bit"), id.alias("id"))
    maps = rows.groupBy("bucket").agg(
        F.bitmap_count(F.bitmap_construct_agg(F.coalesce("bit", F.lit(0)))).alias("keys"),
        F.count(F.lit(1)).alias("rows"), F.min("id").alias("least"), F.max("id").alias("most"), F.count("id").alias("ids"),
    )
    facts = maps.agg(*[F.sum(c).alias(c) for c in ("rows", "ids")], F.min("least").alias("least"), F.max("most").alias("most"),
                     F.sum(F.when(F.col("ids") > 0, F.col("keys"))).alias("keys"))
    # Numbers from `start` on that no row has, up to the number of rows or the greatest id.
    end = F.greatest(F.col("rows") - 1 + start, F.coalesce("most", F.lit(start - 1)))
    begin = F.least(F.lit(start).cast("bigint"), F.coalesce("least", F.lit(start)))
    missing = F.when(F.col("rows") > 0, end - begin + 1 - F.coalesce("keys", F.lit(0)))
    return _report(table, facts.select(missing.alias("n")), {"n": ("dense_ids", key)})


def check_references(fact: DataFrame, table: str, dim: DataFrame, *keys: str) -> DataFrame:
    counts = orphans(fact, dim, keys).agg(F.sum("rows").alias("n"))
    return _report(table, counts, {"n": ("foreign_key", ",".join(keys))})


def shares_off(shares: Sequence[str], tolerance: float = 1e-9) -> dict[str, Column]:
    """The rule that shares add to 1 in every row that has any of them, for ``extra`` of ``check_rows``."""
    whole = reduce(lambda a, b: a + b, [F.coalesce(F.col(s), F.lit(0.0)) for s in shares])
    present = F.coalesce(*[F.col(s) for s in shares]).isNotNull()
    return {"shares_sum_to_1": present & (F.abs(whole - 1) > tolerance)}


def mean_outside(mean: str, parts: Sequence[str], tolerance: float = 1e-9) -> dict[str, Column]:
    """The rule that an overall mean lies between the least and the greatest mean of its parts."""
    low, high = (f(*[F.col(p) for p in parts]) for f in (F.least, F.greatest))
    off = (F.col(mean) < low - tolerance) | (F.col(mean) > high + tolerance)
    return {f"{mean}_between_parts": off}


def weighted_mean_off(mean: str, weights: Mapping[str, float], tolerance: float = 1e-9) -> dict[str, Column]:
    """The rule that an overall mean is the mean of its parts, each weighed by how many values it holds.

    For means by season: the number of months of each season in the period. Rows that lack a part or the
    mean say nothing.
    """
    whole = reduce(lambda a, b: a + b, [F.col(part) * F.lit(float(w)) for part, w in weights.items()])
    off = F.abs(whole / F.lit(float(sum(weights.values()))) - F.col(mean)) > tolerance
    return {f"{mean}_weighs_parts": off}


def check_shares(df: DataFrame, table: str, shares: Sequence[str], tolerance: float = 1e-9) -> DataFrame:
    return check_rows(df, table, extra=shares_off(shares, tolerance))


def check_mean_between(
    df: DataFrame, table: str, mean: str, parts: Sequence[str], tolerance: float = 1e-9
) -> DataFrame:
    return check_rows(df, table, extra=mean_outside(mean, parts, tolerance))


def all_checks(*reports: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def enforce(report: DataFrame, reported_only: Sequence[str] = REPORTED_ONLY) -> list:
    """Runs the checks and raises on a broken rule; returns all rows (one per rule)."""
    rows = report.collect()
    broken = [r for r in rows if r.failures > 0 and r.rule not in reported_only]
    if broken:
        lines = [f"{r.table_name}.{r.column_name}: {r.rule}, {r.failures} rows" for r in broken]
        raise QualityError("; ".join(lines))
    return rows
