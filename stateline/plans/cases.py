"""Daily case counts by state and by county (PIP-1, PIP-7, PIP-10)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stateline.functions import lookup
from stateline.functions.codes import CODE_TO_NAME, NAME_TO_ID
from stateline.functions.scalars import day_from_int, day_from_text
from stateline.operators.clean import fill_zero, not_equal
from stateline.operators.columns import drop, keep
from stateline.operators.ids import dense_ids
from stateline.operators.profile import numeric_profile
from stateline.sources.manifest import COVID, STAGING_COVID

# The one territory left out, as it reported no positives.
LEFT_OUT = ("American Samoa",)


def tidy_daily_cases(
    df: DataFrame,
    names: Mapping[str, str] = CODE_TO_NAME,
    ids: Mapping[str, int] = NAME_TO_ID,
    left_out: Sequence[str] = LEFT_OUT,
    missing_as_zero: bool = True,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Everything but the row ids: a narrow plan, usable on a batch and on a micro-batch.

    Columns named in ``carry`` pass through.
    """
    rows = df.select(
        *carry,
        day_from_int(F.col("date")).alias("day_date"),
        lookup.strict(F.col("state"), names, "state code").alias("name_state"),
        F.col("positive").cast("double").alias("positive"),
        F.col("hospitalizedCurrently").cast("double").alias("hospitalized_curr"),
        F.col("hospitalizedCumulative").cast("double").alias("hospitalized_acum"),
        F.col("death").cast("double").alias("death"),
    )
    rows = not_equal(rows, "name_state", *left_out)
    if missing_as_zero:
        rows = fill_zero(rows)
    return rows.withColumn(
        "id_state", lookup.strict(F.col("name_state"), ids, "state name").cast("bigint")
    )


#: Rows follow day and state; the other columns order equal pairs.
CASE_ORDER = ("day_date", "name_state", "positive", "hospitalized_curr", "hospitalized_acum", "death")


def number_cases(rows: DataFrame) -> DataFrame:
    """Ids in the order of day and state."""
    return dense_ids(rows, CASE_ORDER, "id_covid_data").select(*STAGING_COVID.names)


def clean_daily_cases(df: DataFrame, **options) -> DataFrame:
    """Raw daily cases → rows of the staging table."""
    return number_cases(tidy_daily_cases(df, **options))


def build_covid(staged: DataFrame) -> DataFrame:
    return keep(staged, *COVID.names)


def county_cases(df: DataFrame, unused: Sequence[str] = ("fips",)) -> DataFrame:
    return drop(df.withColumn("date", day_from_text(F.col("date"))), *unused)


def county_profile(df: DataFrame, measures: Sequence[str] = ("cases", "deaths")) -> DataFrame:
    """Numeric profile of the county counts."""
    return numeric_profile(county_cases(df), measures)
