"""Reports on the model (BQ-1…6).

Each side is grouped to its state before the two facts meet, so no join multiplies rows. The counted
side keeps all its rows: what the other side does not know is null, and counts still add up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stateline.functions.exact import correlation, total
from stateline.functions.scalars import SEASONS, ratio, season
from stateline.operators.calendar import with_day_before
from stateline.operators.columns import unpivot
from stateline.operators.ids import tiles
from stateline.plans.model import SHARES

COUNTS = ("positive", "death")


def daily_counts(covid: DataFrame, scale: int | None = None) -> DataFrame:
    """One row per state and day."""
    return covid.groupBy("id_state", "day_date").agg(
        *[total(F.col(c), scale).alias(c) for c in COUNTS]
    )


def daily_growth(
    covid: DataFrame,
    cumulative: bool = True,
    zero_is_unknown: bool = False,
    scale: int | None = None,
) -> DataFrame:
    """New positives per state and day, and their ratio to the day before.

    ``cumulative`` counts are differenced and a fall counts as 0; otherwise the counts are new
    ones already. ``zero_is_unknown`` leaves out days whose count was filled with 0. The window
    runs over grouped rows, at most one per day for a state. A day is compared with the last one known,
    however long ago: ``growth_over_gaps`` tells days that follow each other from others.
    """
    days = daily_counts(covid, scale)
    if zero_is_unknown:
        days = days.where(F.col("positive") != 0)
    before = F.lag("positive").over(W.partitionBy("id_state").orderBy("day_date"))
    days = days.withColumn("positive_before", before)
    rise = F.col("positive") - F.col("positive_before")
    fresh = F.when(rise < 0, 0.0).otherwise(rise) if cumulative else F.col("positive")
    change = fresh if cumulative else rise
    return days.select(
        "id_state",
        "day_date",
        "positive",
        "positive_before",
        fresh.cast("double").alias("new_positive"),
        ratio(change, F.col("positive_before")).alias("growth"),
    )


#: What a day after a gap is compared with: the last known day as it is, that day by the number of days
#: since, or nothing.
LAST, PER_DAY, UNKNOWN = "last", "per_day", "unknown"


def growth_over_gaps(
    covid: DataFrame,
    gap: str = PER_DAY,
    cumulative: bool = True,
    zero_is_unknown: bool = False,
    scale: int | None = None,
) -> DataFrame:
    """``daily_growth`` where days are missing, with ``days_between`` a day and the last known one.

    ``gap`` says what holds after a gap. ``per_day`` (the default): new positives and growth are those of an
    average day since the last known one. ``unknown``: both are null. ``last``: as in ``daily_growth``. New
    positives that are counted as such, not differenced, are never divided.
    """
    if gap not in (LAST, PER_DAY, UNKNOWN):
        raise ValueError(f"no rule {gap} for gaps")
    days = daily_counts(covid, scale)
    if zero_is_unknown:
        days = days.where(F.col("positive") != 0)
    days = with_day_before(days, ["id_state"], "day_date", "positive")
    rise = F.col("positive") - F.col("positive_before")
    change = F.when(rise < 0, 0.0).otherwise(rise) if cumulative else rise
    between = F.col("days_between")
    if gap == PER_DAY:
        change = change / between
    elif gap == UNKNOWN:
        change = F.when(between == 1, change)
    fresh = change if cumulative else F.col("positive")
    return days.select(
        "id_state",
        "day_date",
        "positive",
        "positive_before",
        "days_between",
        fresh.cast("double").alias("new_positive"),
        ratio(change, F.col("positive_before")).alias("growth"),
    )


def state_growth(growth: DataFrame) -> DataFrame:
    """Mean growth per state."""
    return growth.groupBy("id_state").agg(F.avg("growth").alias("mean_growth"))


def _weighted_growth(groups: DataFrame, per_state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean of state growth over institutions, from counts per state; states without growth only count."""
    joined = groups.join(per_state, "id_state", "left")
    known = F.when(F.col("mean_growth").isNotNull(), F.col("n_institutions"))
    return joined.groupBy(*keys).agg(
        F.sum("n_institutions").alias("n_institutions"),
        ratio(F.sum(F.col("mean_growth") * known), F.sum(known).cast("double")).alias("mean_growth"),
    )


def growth_by_availability(education: DataFrame, per_state: DataFrame) -> DataFrame:
    """BQ-1: growth of the states where institutions of each availability are."""
    groups = education.groupBy("id_state", "availability").agg(
        F.count(F.lit(1)).alias("n_institutions")
    )
    return _weighted_growth(groups, per_state, ["availability"])


def availability_mix(
    education: DataFrame, per_state: DataFrame, kinds: dict[str, str]
) -> DataFrame:
    """BQ-1 by state: share of each availability beside the growth of the state."""
    whole = F.count(F.lit(1)).cast("double")
    shares = [
        ratio(F.count_if(F.col("availability") == kind).cast("double"), whole).alias(name)
        for kind, name in kinds.items()
    ]
    mix = education.groupBy("id_state").agg(F.count(F.lit(1)).alias("n_institutions"), *shares)
    return mix.join(per_state, "id_state", "left")


def bucket_start(value: Column, width: float) -> Column:
    return F.floor(value / F.lit(float(width))).cast("double") * F.lit(float(width))


def growth_by_staff(education: DataFrame, per_state: DataFrame, width: float) -> DataFrame:
    """BQ-2: the same by availability and number of employees, in steps of ``width``."""
    staff = bucket_start(F.col("n_employees"), width).alias("employees_from")
    groups = education.groupBy("id_state", "availability", staff).agg(
        F.count(F.lit(1)).alias("n_institutions")
    )
    return _weighted_growth(groups, per_state, ["availability", "employees_from"])


def growth_by_season(growth: DataFrame, state: DataFrame) -> DataFrame:
    """BQ-3: new positives per season beside that season's mean temperature, and how they relate.

    Days of states without a known temperature count in ``n_days`` and ``mean_new_positive``;
    ``n_known`` says how many days the other two measures rest on.
    """
    temperature = F.coalesce(
        *[F.when(F.col("season") == s, F.col(f"avg_{s}_temp")) for s in SEASONS]
    )
    seasons = growth.withColumn("season", season(F.col("day_date")))
    dims = state.select("id_state", *[f"avg_{s}_temp" for s in SEASONS])
    rows = seasons.join(dims, "id_state", "left").withColumn("temperature", temperature)
    known = F.when(F.col("temperature").isNotNull(), F.col("new_positive"))
    return rows.groupBy("season").agg(
        F.count("new_positive").alias("n_days"),
        F.count(known).alias("n_known"),
        F.avg("new_positive").alias("mean_new_positive"),
        F.avg(F.when(F.col("new_positive").isNotNull(), F.col("temperature"))).alias("mean_temp"),
        correlation(F.col("temperature"), F.col("new_positive")).alias("correlation"),
    )


def growth_by_temperature(per_state: DataFrame, state: DataFrame, width: float) -> DataFrame:
    """BQ-4: growth by overall mean temperature, in steps of ``width``; null where it is not known."""
    rows = state.select("id_state", bucket_start(F.col("avg_temp"), width).alias("temp_from"))
    return per_state.join(rows, "id_state", "left").groupBy("temp_from").agg(
        F.count("mean_growth").alias("n_states"), F.avg("mean_growth").alias("mean_growth")
    )


def growth_by_temperature_rank(per_state: DataFrame, state: DataFrame, groups: int) -> DataFrame:
    """BQ-4: growth of equally many states each, from the coldest to the warmest.

    States of unknown temperature are group null. Equal temperatures follow the id.
    """
    known = state.where(F.col("avg_temp").isNotNull()).select("avg_temp", "id_state")
    ranked = tiles(known, ["avg_temp", "id_state"], groups, "temp_group")
    return per_state.join(ranked, "id_state", "left").groupBy("temp_group").agg(
        F.min("avg_temp").alias("temp_from"),
        F.max("avg_temp").alias("temp_to"),
        F.count("mean_growth").alias("n_states"),
        F.avg("mean_growth").alias("mean_growth"),
    )


def state_rates(
    covid: DataFrame, state: DataFrame, cumulative: bool = True, scale: int | None = None
) -> DataFrame:
    """Positives and deaths per inhabitant over the whole period; null for a state of unknown population."""
    if cumulative:
        days = daily_counts(covid, scale)
        counts = days.groupBy("id_state").agg(*[F.max(c).alias(c) for c in COUNTS])
    else:
        counts = covid.groupBy("id_state").agg(*[total(F.col(c), scale).alias(c) for c in COUNTS])
    people = F.col("total_population").cast("double")
    return counts.join(state, "id_state", "left").select(
        "id_state", *SHARES, *[ratio(F.col(c), people).alias(f"{c}_rate") for c in COUNTS]
    )


def rate_by_share(rates: DataFrame) -> DataFrame:
    """BQ-5: how the share of each race relates to the positive and the death rate.

    ``n_states`` counts states with both a share and a rate, ``n_reported`` all with cases.
    """
    rows = unpivot(rates, {s: {"share": F.col(s)} for s in SHARES}, "race", ["positive_rate", "death_rate"])
    return rows.groupBy("race").agg(
        F.count(F.lit(1)).alias("n_reported"),
        F.count(F.when(F.col("positive_rate").isNotNull(), F.col("share"))).alias("n_states"),
        correlation(F.col("share"), F.col("positive_rate")).alias("positive_correlation"),
        correlation(F.col("share"), F.col("death_rate")).alias("death_correlation"),
    )


def rate_by_population(covid: DataFrame, state: DataFrame, scale: int | None = None) -> DataFrame:
    """BQ-6: positives per inhabitant by state and day; null for a state of unknown population."""
    people = state.select("id_state", "name_state", "total_population")
    return daily_counts(covid, scale).join(people, "id_state", "left").select(
        "id_state",
        "name_state",
        "day_date",
        "positive",
        "total_population",
        ratio(F.col("positive"), F.col("total_population").cast("double")).alias("positive_rate"),
    )
