"""Sums and means of any doubles that do not depend on how rows are spread (AGG-1, AGG-2, AGG-5, AGG-13).

Adding doubles in another order changes the last digits, and amounts without a fixed number of decimals
cannot be added as whole units. So each value goes, by its exponent, to a bin of ``BIN_BITS`` powers of two.
In its bin it is a whole number, cut into three pieces of ``PIECE_BITS`` bits, which are added as longs: exact in
any order, and far from overflow with 2^40 rows. The few bins of a group are then put together in one order,
with what each addition rounds off carried along.

The bin is one more grouping key of the first aggregate, so partial sums combine before the shuffle as
ever; the second aggregate sees one row for each group and bin.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stateline.functions.scalars import ratio

BIN_BITS, PIECE_BITS = 10, 22
#: In its bin a value is multiplied by 2^(SPARE - BIN_BITS * bin): its 53 bits are whole, with two to spare
#: for logarithms that are rounded up to the next bin.
SPARE = 54
#: Longs beyond 53 bits are not exact as doubles, so sums are halved here.
HALF = 32
PIECES = ("_high", "_mid", "_low")


def _shifted(value: Column, power: Column) -> Column:
    """The value times two to a power that one double may not hold."""
    half = F.floor(power / 2)
    return value * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), power - half)


def _power(bin: Column) -> Column:
    return F.lit(SPARE) - F.lit(BIN_BITS) * bin


def binned(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """One row for each value of ``by`` and bin: sums of pieces, counts of values and of those that are no numbers."""
    number = F.col(value).cast("double")
    finite = F.when(F.abs(number) < float("inf"), number).when(number.isNotNull(), F.lit(0.0))
    rows = df.select(*by, number.alias("_x"), finite.alias("_f"))
    rows = rows.withColumn("_bin", F.coalesce(F.floor(F.log2(F.abs("_f")) / BIN_BITS), F.lit(0)).cast("int"))
    rows = rows.withColumn("_whole", _shifted(F.col("_f"), _power(F.col("_bin"))))
    rows = rows.withColumn("_high", F.floor(F.col("_whole") * 2.0 ** (-2 * PIECE_BITS)))
    rows = rows.withColumn("_rest", F.col("_whole") - F.col("_high") * 2.0 ** (2 * PIECE_BITS))
    rows = rows.withColumn("_mid", F.floor(F.col("_rest") * 2.0**-PIECE_BITS))
    rows = rows.withColumn("_low", (F.col("_rest") - F.col("_mid") * 2.0**PIECE_BITS).cast("bigint"))
    return rows.groupBy(*by, "_bin").agg(
        *[F.sum(p).alias(p) for p in PIECES],
        F.count("_x").alias("_n"),
        F.count_if(F.isnan("_x")).alias("_nan"),
        F.count_if(F.col("_x") == float("inf")).alias("_up"),
        F.count_if(F.col("_x") == float("-inf")).alias("_down"),
    )


def _terms(part: Column) -> Column:
    """What a bin adds, as doubles that are exact."""
    power = _power(part["_bin"])
    terms = []
    for i, piece in enumerate(PIECES):
        shift = F.lit((len(PIECES) - 1 - i) * PIECE_BITS) - power
        upper = F.shiftright(part[piece], HALF)
        lower = part[piece] - F.shiftleft(upper, HALF)
        terms += [_shifted(upper.cast("double"), shift + HALF), _shifted(lower.cast("double"), shift)]
    return F.array(*terms)


def _added(acc: Column, term: Column) -> Column:
    total = acc["total"] + term
    there = total - acc["total"]
    lost = (acc["total"] - (total - there)) + (term - there)
    return F.struct(total.alias("total"), (acc["lost"] + lost).alias("lost"))


def binned_total(condition: Column | None = None) -> Column:
    """Aggregate over rows of ``binned``: the sum of all values, or those for which ``condition`` holds; null for none."""

    def only(value: Column) -> Column:
        return value if condition is None else F.when(condition, value)

    part = F.struct(-F.col("_bin"), F.col("_bin").alias("_bin"), *PIECES)
    parts = F.array_sort(F.collect_list(only(part)))
    nothing = F.struct(F.lit(0.0).alias("total"), F.lit(0.0).alias("lost"))
    total = F.aggregate(F.flatten(F.transform(parts, _terms)), nothing, _added, lambda acc: acc["total"] + acc["lost"])
    nan, up, down = (F.sum(only(F.col(c))) for c in ("_nan", "_up", "_down"))
    no_number = (nan > 0) | ((up > 0) & (down > 0))
    total = F.when(no_number, F.lit(float("nan"))).when(up > 0, F.lit(float("inf"))).when(down > 0, F.lit(float("-inf"))).otherwise(total)
    return F.when(binned_count(condition) > 0, total)


def binned_count(condition: Column | None = None) -> Column:
    """Aggregate over rows of ``binned``: how many values there are."""
    return F.sum(F.col("_n") if condition is None else F.when(condition, F.col("_n")))


def binned_mean(condition: Column | None = None) -> Column:
    return ratio(binned_total(condition), binned_count(condition).cast("double"))


def reproducible_sums(df: DataFrame, keys: Sequence[str], value: str, total: str, mean: str | None = None) -> DataFrame:
    """Sum and mean of a column by group, the same to the last bit however rows are spread.

    Nulls are skipped; a group of nulls has null. Infinities and NaN give what adding them gives.
    """
    cells = [binned_total().alias(total), *([binned_mean().alias(mean)] if mean else [])]
    return binned(df, keys, value).groupBy(*keys).agg(*cells)


def reproducible_means(
    df: DataFrame, keys: Sequence[str], category: str, value: str, names: Mapping[str, str], overall: str | None = None
) -> DataFrame:
    """Means by declared category as columns, and that over all rows beside them."""
    cells = [binned_mean(F.col(category) == v).alias(name) for v, name in names.items()]
    if overall is not None:
        cells.insert(0, binned_mean().alias(overall))
    return binned(df, [*keys, category], value).groupBy(*keys).agg(*cells)
