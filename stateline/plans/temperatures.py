"""Seasonal mean temperatures by state and by city (PIP-4, PIP-9)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stateline.functions import lookup
from stateline.functions.codes import NAME_TO_ID
from stateline.functions.scalars import SEASONS, day_from_text, season
from stateline.operators.aggregate import mean_pivot
from stateline.operators.clean import after, equal
from stateline.operators.columns import replace_value
from stateline.sources.manifest import STAGING_TEMPERATURE

# Fixed values.
COUNTRY = "United States"
BEFORE_FIRST_DAY = dt.date(1969, 12, 31)
SPELLINGS = {"Georgia (State)": "Georgia"}


def seasonal_means_by(
    df: DataFrame,
    key: str,
    country: str = COUNTRY,
    since: dt.date = BEFORE_FIRST_DAY,
    scale: int | None = None,
) -> DataFrame:
    """Overall and seasonal mean temperature per ``key``, from one aggregate."""
    rows = equal(df, "Country", country).withColumn("day", day_from_text(F.col("dt")))
    rows = after(rows, "day", since).withColumn("season", season(F.col("day")))
    names = {name: name for name in SEASONS}
    return mean_pivot(rows, [key], "season", "AverageTemperature", names, "avg_temp", scale)


def seasonal_means(
    df: DataFrame,
    country: str = COUNTRY,
    since: dt.date = BEFORE_FIRST_DAY,
    spellings: Mapping[str, str] = SPELLINGS,
    ids: Mapping[str, int] = NAME_TO_ID,
    scale: int | None = None,
) -> DataFrame:
    """Monthly state temperatures → rows of the staging table."""
    means = seasonal_means_by(replace_value(df, "State", spellings), "State", country, since, scale)
    means = means.withColumnRenamed("State", "name_state")
    number = lookup.strict(F.col("name_state"), ids, "state name").cast("bigint")
    return means.withColumn("id_state", number).select(*STAGING_TEMPERATURE.names)


def seasonal_means_by_city(df: DataFrame, country: str = COUNTRY) -> DataFrame:
    return seasonal_means_by(df, "City", country)
