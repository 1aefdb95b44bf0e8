"""Sums and means whose value does not depend on how rows are spread over tasks.

Adding doubles in another order changes the last digits. For amounts with a fixed number of
decimals, ``scale`` adds whole units of the last decimal instead, as two sums of longs, which is
exact. A value that has more decimals, that is not a number, or that is too large for a decimal fails
the job; so does a sum beyond its digits. Amounts of any size and any number of decimals are added by
``stateline.operators.sums``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A double may miss the decimal it stands for by this part of the last place.
SLACK = 1e-3
PRECISION = 28
#: Units are added in two parts, the lower one of so many bits: with 2^43 rows neither overflows a long.
LOW_BITS = 20
#: Doubles below this are exact as whole numbers.
WHOLE = 2.0**53


def exact_sum(value: Column, scale: int | None = None) -> Column:
    """A sum, as a decimal with ``scale``; a sum beyond its digits fails the job."""
    if scale is None:
        return F.sum(value)
    scaled = value.cast("double") * 10.0**scale
    small = F.abs(scaled) < WHOLE
    units = F.rint(scaled)
    miss = F.abs(scaled - units)
    wrong = F.raise_error(F.concat(F.lit(f"not an amount with {scale} decimals: "), value.cast("string"))).cast("bigint")
    # Few amounts are so large that their digits are counted one by one. All of this stays behind `small`.
    step = F.lit(Decimal(1 << LOW_BITS))
    large = value.try_cast(T.DecimalType(PRECISION, scale)) * F.lit(Decimal(10) ** scale)
    whole = units.cast("bigint")
    high = F.when(small, F.shiftright(whole, LOW_BITS)).otherwise(F.floor(large / step).cast("bigint"))
    low = F.when(small, F.when((miss <= SLACK) | (miss <= F.abs(scaled) * 1e-15), whole.bitwiseAND((1 << LOW_BITS) - 1)).otherwise(wrong))
    low = low.when(value.isNotNull(), F.coalesce((large - F.floor(large / step) * step).cast("bigint"), wrong))
    added = F.sum(high).cast("decimal(20,0)") * step + F.sum(low).cast("decimal(20,0)")
    return (added * F.lit(Decimal(1).scaleb(-scale))).cast(T.DecimalType(38, scale))


def total(value: Column, scale: int | None = None) -> Column:
    return F.sum(value) if scale is None else exact_sum(value, scale).cast("double")


def mean(value: Column, scale: int | None = None) -> Column:
    if scale is None:
        return F.avg(value)
    return F.try_divide(total(value, scale), F.count(value).cast("double"))


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation over the pairs; null, not an error, where one side is constant."""
    paired_x, paired_y = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    spread = F.sqrt(F.var_pop(paired_x) * F.var_pop(paired_y))
    return F.try_divide(F.covar_pop(x, y), spread)
