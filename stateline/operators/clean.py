"""Filters and null handling (FLT-1…7, NUL-1…4)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stateline.functions.exact import mean
from stateline.functions.scalars import blank_to_null
from stateline.operators.columns import require


def equal(df: DataFrame, name: str, value) -> DataFrame:
    return df.where(F.col(name) == F.lit(value))


def not_equal(df: DataFrame, name: str, *values) -> DataFrame:
    """Rows whose value is none of ``values``; a null stays."""
    hit = F.col(name).isin(*values)
    return df.where(F.col(name).isNull() | ~hit)


def after(df: DataFrame, name: str, day: dt.date) -> DataFrame:
    return df.where(F.col(name) > F.lit(day))


def any_equal(df: DataFrame, names: Sequence[str], value) -> DataFrame:
    """Rows with ``value`` in at least one of the columns."""
    hit = F.lit(False)
    for name in names:
        hit = hit | F.coalesce(F.col(name) == F.lit(value), F.lit(False))
    return df.where(hit)


def is_null(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col(name).isNull())


def positive(value: Column) -> Column:
    return F.when(value > 0, value)


def fill_zero(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Null numbers become 0; text stays null."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return df.fillna(0, subset=numeric if names is None else list(names))


def impute_sentinel(df: DataFrame, names: Sequence[str], scale: int | None = None) -> DataFrame:
    """Negative values become the mean of the positive ones, column by column.

    All means come from one aggregate, read back as a one-row scalar subquery. Zero and null stay.
    The mean is taken over ``df`` as given, so impute before dropping rows.
    """
    require(df, names)
    means = df.agg(
        F.struct(*[mean(positive(F.col(n)), scale).cast("double").alias(n) for n in names])
    ).scalar()

    def repaired(name: str) -> Column:
        value = F.col(name).cast("double")
        return F.when(value < 0, means.getField(name)).otherwise(value).alias(name)

    return df.select(*[repaired(n) if n in names else F.col(n) for n in df.columns])


def drop_incomplete(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    return df.dropna("any", subset=None if names is None else list(names))


def blanks_to_null(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    chosen = text if names is None else names
    return df.withColumns({n: blank_to_null(F.col(n)) for n in chosen})
