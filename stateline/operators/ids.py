"""Running weights and dense ids over a global order, without a global sort (WIN-2, SET-2).

A window without partitions would sort every row in one task, and a window per leading key (per
day, say) would do the same for a key that holds a third of the rows. So rows are dealt to ranges of
the *whole* order by Spark's own range partitioner, sorted inside them and written with their place.
The rows of the ranges before a range give its offset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stateline.operators.columns import require
from stateline.operators.sets import tagged_union
from stateline.session import shuffle_partitions, written

#: Spark's numbers for rows: the range in the upper bits, the place inside the range in the lower 33.
PLACE_BITS = 33


def placed(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` in written ranges: adds ``_range`` and ``_place``, both ascending with the order.

    Rows that are equal in ``order`` follow the other columns. Rows equal in all of them are copies:
    each also carries a number of its own, so that a row with very many copies is cut into ranges
    like any other. One shuffle and one write; besides, Spark reads ``df`` once for a sample of its keys.
    """
    require(df, order)
    total = [*order, *[c for c in df.columns if c not in order]]
    numbered = df.withColumn("_copy", F.monotonically_increasing_id())
    ranged = numbered.repartitionByRange(shuffle_partitions(df.sparkSession), *total, "_copy")
    place = F.monotonically_increasing_id()
    rows = ranged.sortWithinPartitions(*total, "_copy").drop("_copy").withColumn("_number", place)
    rows = written(rows, "placed")
    return rows.select(
        *df.columns,
        F.shiftright("_number", PLACE_BITS).alias("_range"),
        F.col("_number").bitwiseAND((1 << PLACE_BITS) - 1).alias("_place"),
    )


def running_weight(
    df: DataFrame,
    order: Sequence[str],
    name: str,
    weight: str | None = None,
    within: Sequence[str] = (),
) -> DataFrame:
    """Adds ``name``: the summed weight (or the number) of the rows before a row.

    Ties of ``order`` follow the other columns. With ``within``, whose columns must lead the order,
    the count restarts for each of their values, null being one of them. A null weight adds nothing.
    """
    within = list(within)
    if list(order[: len(within)]) != within:
        raise ValueError("the order must start with the columns of `within`")
    rows = placed(df, order)
    amount = F.lit(1) if weight is None else F.coalesce(F.col(weight), F.lit(0))
    # Inside a range a value of `within` is one run of places, and its first one starts at 0.
    sizes = rows.groupBy(*within, "_range").agg(F.sum(amount).alias("_n"), F.min("_place").alias("_start"))
    ahead = W.partitionBy(*within).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_offset")
    sizes = sizes.select(*[F.col(c).alias(f"_{c}") for c in within], F.col("_range").alias("_of"), "_start", offset)

    same = F.col("_range") == F.col("_of")
    for column in within:
        same = same & F.col(column).eqNullSafe(F.col(f"_{column}"))
    if weight is None:
        before = F.col("_place") - F.col("_start")
    else:
        upto = W.partitionBy(*within, "_range").orderBy("_place").rowsBetween(W.unboundedPreceding, -1)
        rows = rows.withColumn("_before", F.coalesce(F.sum(amount).over(upto), F.lit(0)))
        before = F.col("_before")
    position = (F.col("_offset") + before).cast("bigint")
    return rows.join(sizes, same).select(*df.columns, position.alias(name))


def dense_ids(df: DataFrame, order: Sequence[str], name: str, start: int = 0) -> DataFrame:
    """Ids ``start``, ``start`` + 1, … in the given order, as the leading column.

    Ties follow the other columns, so only exact copies are interchangeable.
    """
    rows = placed(df, order)
    counts = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    ahead = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(F.col("_range"), F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_offset"))
    # One row per range, and there are as many ranges as shuffle partitions.
    numbered = rows.join(F.broadcast(offsets), "_range")
    position = F.col("_offset") + F.col("_place") + start
    return numbered.select(position.alias(name), *df.columns)


def numbered_union(
    frames: dict[str, DataFrame], label: str, order: Sequence[str], name: str
) -> DataFrame:
    """Union of tagged frames, numbered frame by frame and in ``order`` inside each."""
    ranked = {rank: df.withColumn(label, F.lit(tag)) for rank, (tag, df) in enumerate(frames.items())}
    united = tagged_union(ranked, "_rank")
    return dense_ids(united, ["_rank", *order], name).drop("_rank")


def tiles(df: DataFrame, order: Sequence[str], n: int, name: str) -> DataFrame:
    """Adds ``name``: 1 … ``n``, groups of consecutive rows of as equal sizes as there can be, larger ones first.

    What ``ntile`` gives over the whole order, without moving all rows to one task. Ties of ``order`` follow
    the other columns. With fewer rows than ``n`` each row is a group.
    """
    if n < 1:
        raise ValueError("there must be one group or more")
    rows = dense_ids(df, order, "_at")
    total = rows.agg(F.count(F.lit(1))).scalar()
    size, larger = F.floor(total / F.lit(n)), total % F.lit(n)
    in_larger = larger * (size + 1)
    at = F.col("_at")
    tile = F.when(at < in_larger, F.floor(at / (size + 1))).otherwise(larger + F.floor(F.try_divide(at - in_larger, size)))
    return rows.select(*df.columns, (tile + 1).cast("int").alias(name))
