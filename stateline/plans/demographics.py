"""Race shares and population by state (PIP-3)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stateline.functions import lookup
from stateline.functions.codes import NAME_TO_ID
from stateline.operators.aggregate import share_pivot
from stateline.operators.joins import outer_on
from stateline.sources.manifest import STAGING_DEMOGRAPHIC

# Race labels of the source and the columns they become.
RACES = {
    "American Indian and Alaska Native": "american_native",
    "Asian": "asian",
    "Black or African-American": "african_american",
    "Hispanic or Latino": "hispanic",
    "White": "white",
}


def state_shares(
    cities: DataFrame,
    population: DataFrame,
    races: Mapping[str, str] = RACES,
    ids: Mapping[str, int] = NAME_TO_ID,
    scale: int | None = None,
) -> DataFrame:
    """City race counts and state population → rows of the staging table.

    Shares are shares of the counted city population. A state known to one side only stays, with
    nulls for the other.
    """
    shares = share_pivot(cities, "state", "race", "count", races, scale)
    people = population.select(
        F.col("NAME").alias("state"), F.col("POP_2021").cast("bigint").alias("total_population")
    )
    joined = outer_on(shares, people, "state").withColumnRenamed("state", "name_state")
    number = lookup.strict(F.col("name_state"), ids, "state name").cast("bigint")
    return joined.withColumn("id_state", number).select(*STAGING_DEMOGRAPHIC.names)
