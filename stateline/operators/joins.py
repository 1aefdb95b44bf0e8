"""Joins (JN-1…4).

None of them forces a broadcast: Spark broadcasts a side only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and sorts and merges otherwise, with skewed partitions of
the large side split by adaptive execution.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def outer_on(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Full outer join with one key column.

    Skew in a full outer join cannot be split, so both sides should hold one row per key, as
    grouped results do.
    """
    return left.join(right, list(keys), "full_outer")


def inner_on(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    return left.join(right, list(keys), "inner")


def lookup_join(
    df: DataFrame,
    key: str,
    dim: DataFrame,
    dim_key: str,
    value: str,
    default=None,
    strict: bool = False,
) -> DataFrame:
    """Adds ``value`` of the dictionary table ``dim``, whose ``dim_key`` must be unique.

    A key that the dictionary has twice fails the job; rows are never multiplied. With ``strict`` an
    unknown key fails it, too; otherwise it gets ``default``. A known key keeps its value, also null.
    """
    entries = dim.where(F.col(dim_key).isNotNull()).groupBy(F.col(dim_key).alias("_key"))
    twice = F.raise_error(F.concat(F.lit(f"{dim_key} is not unique: "), F.col("_key").cast("string")))
    kind = dim.schema[value].dataType
    entries = entries.agg(F.count(F.lit(1)).alias("_n"), F.first(value).alias("_value")).select(
        "_key", F.when(F.col("_n") > 1, twice.cast(kind)).otherwise(F.col("_value")).alias("_value")
    )
    joined = df.join(entries, F.col(key) == F.col("_key"), "left")
    if strict:
        text = F.concat(F.lit(f"unknown {key}: "), F.coalesce(F.col(key).cast("string"), F.lit("null")))
        unknown = F.raise_error(text)
    else:
        unknown = F.lit(default)
    found = F.when(F.col("_key").isNull(), unknown).otherwise(F.col("_value"))
    return joined.select(*[F.col(n) for n in df.columns if n != value], found.alias(value))


def orphans(fact: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of ``fact`` without a row in ``dim``, with their number of rows.

    Keys are counted before the join, so a frequent key travels as one row. Null keys refer to
    nothing and are left out.
    """
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    counted = fact.where(known).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return counted.join(dim.select(*keys), list(keys), "left_anti")
