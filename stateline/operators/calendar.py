"""Days that are missing between known ones (BQ-1…4): what was known before, and how long ago."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stateline.operators.columns import require

KNOWN_DAY, DAYS_SINCE = "known_day", "days_since"


def with_day_before(df: DataFrame, keys: Sequence[str], day: str, value: str) -> DataFrame:
    """Adds ``<value>_before`` and ``days_between``: the last known value before a row's day, and how many days ago.

    One row for each day of a key is expected, so a key has no more rows than the calendar has days.
    """
    before = W.partitionBy(*keys).orderBy(day)
    return df.withColumns(
        {f"{value}_before": F.lag(value).over(before), "days_between": F.datediff(F.col(day), F.lag(day).over(before))}
    )


def on_calendar(df: DataFrame, keys: Sequence[str], day: str, values: Sequence[str], most: int | None = None) -> DataFrame:
    """A row for every day from a key's first to its last, with the values of the last known day at or before it.

    ``known_day`` is that day and ``days_since`` how long ago it was, 0 on known days. With ``most``, values
    known longer ago are null. Each row becomes the days up to the next one of its key: an as-of join
    with the calendar, without the calendar.
    """
    require(df, [*keys, day, *values])
    following = F.lead(day).over(W.partitionBy(*keys).orderBy(day))
    rows = df.select(*keys, F.col(day).alias(KNOWN_DAY), *values, following.alias("_next"))
    until = F.coalesce(F.date_sub("_next", 1), F.col(KNOWN_DAY))
    rows = rows.withColumn(day, F.explode(F.sequence(F.col(KNOWN_DAY), until)))
    since = F.datediff(day, KNOWN_DAY)
    carried = [F.col(v) if most is None else F.when(since <= most, F.col(v)).alias(v) for v in values]
    return rows.select(*keys, day, *carried, KNOWN_DAY, since.alias(DAYS_SINCE))
