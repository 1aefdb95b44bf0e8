"""Grouped measures and reshaping (AGG-1…6, AGG-13, WIN-1).

Rows with a null key belong to no group and are dropped. Pivot values are always declared, so the
result schema does not depend on the data and a pivot costs one aggregate.

``scale`` is the number of decimals of the amounts, which are then added exactly; ``ANY`` adds any doubles
so that sums and means do not depend on how rows are spread; None adds them as they come.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stateline.functions.exact import exact_sum, mean, total
from stateline.functions.scalars import ratio
from stateline.operators import sums
from stateline.session import shuffle_partitions

#: For ``scale``: doubles without a fixed number of decimals.
ANY = "any"


def known(keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).isNotNull()
    return condition


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def measure(kind: str, value: str, scale: int | None = None) -> Column:
    """``sum`` (a group of nulls sums to 0), ``mean`` or ``count`` of a column."""
    if kind == "sum":
        return total(or_zero(F.col(value)), scale)
    if kind == "mean":
        return mean(F.col(value), scale)
    if kind == "count":
        return F.count(value)
    raise ValueError(f"no measure {kind}")


def group_measures(
    df: DataFrame, keys: Sequence[str], measures: Mapping[str, tuple[str, str]], scale: int | None = None
) -> DataFrame:
    """Several measures of one grouping in one aggregate: result name to (kind, column)."""
    cells = [measure(kind, value, scale).alias(name) for name, (kind, value) in measures.items()]
    return df.where(known(keys)).groupBy(*keys).agg(*cells)


def group_sum(
    df: DataFrame, keys: Sequence[str], value: str, name: str, scale: int | str | None = None
) -> DataFrame:
    if scale == ANY:
        rows = df.where(known(keys)).withColumn(value, or_zero(F.col(value)))
        return sums.reproducible_sums(rows, keys, value, name)
    return group_measures(df, keys, {name: ("sum", value)}, scale)


def group_mean(
    df: DataFrame, keys: Sequence[str], value: str, name: str, scale: int | str | None = None
) -> DataFrame:
    if scale == ANY:
        return sums.reproducible_sums(df.where(known(keys)), keys, value, "_total", name).drop("_total")
    return group_measures(df, keys, {name: ("mean", value)}, scale)


def group_count(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    return group_measures(df, keys, {name: ("count", value)})


def share_rows(
    df: DataFrame, key: str, category: str, value: str, name: str, scale: int | None = None
) -> DataFrame:
    """Share of each category in its key's total, one row per key and category.

    The window runs over grouped rows: one per category, however many input rows there are.
    """
    summed = exact_sum(or_zero(F.col(value)), scale)
    grouped = df.where(known([key, category])).groupBy(key, category).agg(summed.alias("_part"))
    whole = F.sum("_part").over(W.partitionBy(key)).cast("double")
    return grouped.select(key, category, ratio(F.col("_part").cast("double"), whole).alias(name))


def share_pivot(
    df: DataFrame,
    key: str,
    category: str,
    value: str,
    names: Mapping[str, str],
    scale: int | None = None,
) -> DataFrame:
    """Share of each declared category in its key's total, one column per category.

    One conditional aggregate, one shuffle. A category the key does not have is null. Categories
    outside ``names`` count in the total only; ``undeclared`` lists them.
    """
    amount = or_zero(F.col(value))
    whole = exact_sum(amount, scale).cast("double")
    shares = [
        ratio(exact_sum(F.when(F.col(category) == v, amount), scale).cast("double"), whole).alias(name)
        for v, name in names.items()
    ]
    return df.where(known([key, category])).groupBy(key).agg(*shares)


def undeclared(df: DataFrame, category: str, declared: Sequence[str]) -> DataFrame:
    """Values of ``category`` that a pivot on ``declared`` would leave out, with row counts."""
    left_out = df.where(F.col(category).isNotNull() & ~F.col(category).isin(*declared))
    return left_out.groupBy(category).agg(F.count(F.lit(1)).alias("rows"))


def mean_pivot(
    df: DataFrame,
    keys: Sequence[str],
    category: str,
    value: str,
    names: Mapping[str, str],
    overall: str | None = None,
    scale: int | str | None = None,
) -> DataFrame:
    """Mean per declared category as columns, with the mean over all rows beside them.

    The overall mean and the category means share one aggregate. Nulls are skipped, and the
    overall mean is over rows, not over category means.
    """
    if scale == ANY:
        return sums.reproducible_means(df.where(known(keys)), keys, category, value, names, overall)
    cells = [
        mean(F.when(F.col(category) == v, F.col(value)), scale).alias(name)
        for v, name in names.items()
    ]
    if overall is not None:
        cells.insert(0, mean(F.col(value), scale).alias(overall))
    return df.where(known(keys)).groupBy(*keys).agg(*cells)


def crosstab(df: DataFrame, row: str, column: str, names: Mapping[str, str]) -> DataFrame:
    """Two-way counts; an absent pair is 0."""
    cells = [F.count_if(F.col(column) == v).alias(name) for v, name in names.items()]
    return df.where(known([row, column])).groupBy(row).agg(*cells)


def ratio_of_means(
    df: DataFrame,
    keys: Sequence[str],
    top: tuple[str, str],
    bottom: tuple[str, str],
    name: str,
    scale: int | str | None = None,
) -> DataFrame:
    """Two means per group and their ratio; ``top`` and ``bottom`` are (column, result name)."""
    if scale == ANY:
        means = group_mean(df, keys, *top, ANY).join(group_mean(df, keys, *bottom, ANY), list(keys))
        return means.withColumn(name, ratio(F.col(top[1]), F.col(bottom[1])))
    means = df.where(known(keys)).groupBy(*keys).agg(
        mean(F.col(top[0]), scale).alias(top[1]), mean(F.col(bottom[0]), scale).alias(bottom[1])
    )
    return means.withColumn(name, ratio(F.col(top[1]), F.col(bottom[1])))


def with_group_total(
    df: DataFrame, keys: Sequence[str], totals: Mapping[str, str], scale: int | None = None
) -> DataFrame:
    """Every row with totals of its group (rows with a null key: null).

    ``totals`` maps a result name to the column it sums.

    A window would put a whole group into one task. Instead the totals are grouped first, with
    map-side partial sums, and brought back in two ways. A key is hot when it holds more than the
    average shuffle partition; by that definition there are fewer hot keys than shuffle
    partitions, so their totals can be broadcast and their rows are never shuffled. The rows of
    all other keys are joined by key.
    """
    keys, names = list(keys), list(totals)
    parts = shuffle_partitions(df.sparkSession)
    rows = df.where(known(keys))
    grouped = rows.groupBy(*keys).agg(
        *[total(or_zero(F.col(value)), scale).alias(name) for name, value in totals.items()],
        F.count(F.lit(1)).alias("_rows"),
    )
    is_hot = F.col("_rows") * F.lit(parts) > grouped.agg(F.sum("_rows")).scalar()
    hot, cold = grouped.where(is_hot), grouped.where(~is_hot)

    marked = df.join(F.broadcast(hot), keys, "left")
    settled = F.col("_rows").isNotNull() | ~known(keys)
    direct = marked.where(settled).select(*df.columns, *names)
    open_rows = marked.where(~settled)
    cold = cold.select(*keys, *[F.col(n).alias(f"_{n}") for n in names], F.col("_rows").alias("_n"))
    found = [F.coalesce(F.col(n), F.col(f"_{n}")).alias(n) for n in names]
    return direct.unionByName(open_rows.join(cold, keys).select(*df.columns, *found))
