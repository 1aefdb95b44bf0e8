"""Unions, distinct rows, sorts and limits (SET-1…3, SRT-1…3, AGG-12)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stateline.operators.columns import tag


def union_all(*frames: DataFrame) -> DataFrame:
    """Union by name; columns one side lacks are null. Copies stay."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def tagged_union(frames: Mapping[str, DataFrame], name: str) -> DataFrame:
    return union_all(*[tag(frame, name, label) for label, frame in frames.items()])


def distinct_rows(df: DataFrame, *names: str) -> DataFrame:
    """Copies collapse on the map side before the shuffle."""
    return df.select(*(names or df.columns)).distinct()


def sort_by(df: DataFrame, *names: str) -> DataFrame:
    return df.orderBy(*names)


def rank_by(df: DataFrame, measure: str, *ties: str) -> DataFrame:
    """Highest first, ties in the order of the key columns."""
    return df.orderBy(F.col(measure).desc(), *ties)


def first_rows(df: DataFrame, n: int, order: Sequence) -> DataFrame:
    """The first ``n`` rows of an order: each task keeps only ``n`` rows."""
    return df.orderBy(*order).limit(n)
