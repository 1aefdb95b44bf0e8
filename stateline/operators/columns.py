"""Projections (PRJ-1…6, PRJ-8, PRJ-12)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def require(df: DataFrame, names: Sequence[str]) -> None:
    unknown = [name for name in names if name not in df.columns]
    if unknown:
        raise ValueError(f"no such column: {', '.join(unknown)}")


def keep(df: DataFrame, *names: str) -> DataFrame:
    require(df, names)
    return df.select(*names)


def drop(df: DataFrame, *names: str) -> DataFrame:
    """Unlike ``df.drop``, an unknown name is an error."""
    require(df, names)
    return df.drop(*names)


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    require(df, list(names))
    return df.withColumnsRenamed(dict(names))


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename by position: only for a frame whose column order is known."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def reindex(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``, cast to its types; absent ones are null."""

    def cell(field: T.StructField) -> Column:
        source = F.col(field.name) if field.name in df.columns else F.lit(None)
        return source.cast(field.dataType).alias(field.name)

    return df.select(*map(cell, schema.fields))


def tag(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def replace_value(df: DataFrame, name: str, changes: Mapping) -> DataFrame:
    require(df, [name])
    return df.replace(dict(changes), subset=[name])


def promote(df: DataFrame, *first: str) -> DataFrame:
    """The named columns first, the others after them in their order."""
    require(df, first)
    return df.select(*first, *[name for name in df.columns if name not in first])


def unpivot(
    df: DataFrame, rows: Mapping[str, Mapping[str, Column]], label: str, keep: Sequence[str] = ()
) -> DataFrame:
    """One output row per entry of ``rows``, labelled with its key."""
    structs = [
        F.struct(F.lit(key).alias(label), *[c.alias(name) for name, c in cells.items()])
        for key, cells in rows.items()
    ]
    return df.select(*keep, F.inline(F.array(*structs)))
