"""The cleaning plans, the model and its reports, on tables in the shape of the raw files."""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql import functions as F

from stateline.functions.codes import STATES
from stateline.functions.exact import total
from stateline.operators.calendar import on_calendar
from stateline.operators.sets import union_all
from stateline.plans import reports
from stateline.plans.cases import build_covid, clean_daily_cases, county_profile
from stateline.plans.demographics import state_shares
from stateline.plans.institutions import build_education, clean_institutions
from stateline.plans.model import SHARES, build_state, model_checks, run_all
from stateline.plans.temperatures import seasonal_means
from stateline.queries.grouping import (
    INSTITUTIONS_SQL,
    _seasonal_sql,
    institutions,
    nation_temperatures,
)
from stateline.queries.profiling import _profile_sql, _rounded
from stateline.queries.registry import (
    NATIONS,
    SEGMENTS,
    SQL,
    query,
    sql_case,
    sql_mean,
    sql_total,
    table,
)
from stateline.session import scratch_path, written
from stateline.sources.manifest import RAW
from stateline.sources.snapshots import Snapshots
from stateline.streaming import incremental

RACE_NAMES = dict(zip(SEGMENTS, SHARES, strict=True))
SINCE = dt.date(1995, 6, 30)


def nation_cities(spark, folder):
    """Customers in the shape of the city file: nation, segment, balance."""
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    customer = table(spark, folder, "customer")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("state"),
        F.col("c_mktsegment").alias("race"),
        F.col("c_acctbal").alias("count"),
    )


def nation_population(spark, folder, party="supplier", key="s_nationkey"):
    """Parties per nation in the shape of the population matrix."""
    counts = table(spark, folder, party).groupBy(key).agg(F.count(F.lit(1)).alias("POP_2021"))
    nation = table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("NAME"))
    return counts.join(nation, F.col(key) == F.col("n_nationkey")).select("POP_2021", "NAME")


def nation_state(spark, folder, party="supplier", key="s_nationkey"):
    shares = state_shares(
        nation_cities(spark, folder), nation_population(spark, folder, party, key), RACE_NAMES, NATIONS, scale=2
    )
    means = seasonal_means(nation_temperatures(spark, folder), since=SINCE, ids=NATIONS, scale=2)
    return build_state(shares, means)


def _state_sql(party: str, key: str) -> str:
    whole = sql_total("c_acctbal")
    shares = ", ".join(
        f"{sql_total(f"case when c_mktsegment = '{s}' then c_acctbal end")} / {whole} as {name}"
        for s, name in RACE_NAMES.items()
    )
    means = _seasonal_sql(
        "c_nationkey", "o_totalprice", "o_orderdate",
        f"(select c_nationkey, o_totalprice, o_orderdate from orders join customer on o_custkey = c_custkey"
        f" where o_orderdate > timestamp '{SINCE}')",
        "avg_temp",
    )
    return f"""
        select cast(n_nationkey as bigint) as id_state, n_name as name_state, {", ".join(SHARES)},
               total_population, avg_temp, autumn as avg_autumn_temp, spring as avg_spring_temp,
               summer as avg_summer_temp, winter as avg_winter_temp
        from (select coalesce(a.c_nationkey, b.{key}) as n_key, {", ".join(SHARES)}, total_population
              from (select c_nationkey, {shares} from customer group by c_nationkey) a
              full join (select {key}, count(*) as total_population from {party} group by {key}) b
              on a.c_nationkey = b.{key}) d
        join ({means}) t on d.n_key = t.c_nationkey
        join nation on n_key = n_nationkey
    """


STATE_SQL = _state_sql("customer", "c_nationkey")


@query(_state_sql("supplier", "s_nationkey"))
def nation_profile(spark, folder):
    return nation_state(spark, folder)


def state_table(spark, folder):
    return nation_state(spark, folder, "customer", "c_nationkey")


# Daily cases: orders per day and state, the state taken from the customer key.
CODES = [code for code, _, _ in STATES]
CASE_STATE = dict(enumerate(CODES))
STATE_NAMES = {code: name for code, name, _ in STATES}
STATE_IDS = {name: number for _, name, number in STATES}


def daily_cases(spark, folder):
    """Orders in the shape of the daily case file."""
    code = F.element_at(F.array(*[F.lit(c) for c in CODES]), (F.col("o_custkey") % len(CODES) + 1).cast("int"))
    return table(spark, folder, "orders").select(
        F.date_format("o_orderdate", "yyyyMMdd").cast("bigint").alias("date"),
        code.alias("state"),
        F.col("o_totalprice").alias("positive"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") / 2).alias("hospitalizedCurrently"),
        F.col("o_orderkey").cast("double").alias("hospitalizedCumulative"),
        (F.col("o_custkey") % 100).cast("double").alias("death"),
    )


TIDY_CASES_SQL = f"""
    select day_date, name_state, positive, hospitalized_curr, hospitalized_acum, death,
           cast({sql_case("name_state", STATE_IDS)} as bigint) as id_state
    from (
        select cast(o_orderdate as date) as day_date,
               {sql_case(f"o_custkey % {len(CODES)}", {i: STATE_NAMES[c] for i, c in CASE_STATE.items()})}
               as name_state,
               o_totalprice as positive,
               case when o_orderstatus <> 'P' then o_totalprice / 2 else 0 end as hospitalized_curr,
               cast(o_orderkey as double) as hospitalized_acum, cast(o_custkey % 100 as double) as death
        from orders
    )
    where name_state is distinct from 'American Samoa'
"""
NUMBERED = """cast(row_number() over (order by day_date, name_state, positive, hospitalized_curr,
    hospitalized_acum, death) - 1 as bigint) as id_covid_data"""


@query(f"select {NUMBERED}, * from ({TIDY_CASES_SQL})")
def clean_cases(spark, folder):
    return clean_daily_cases(daily_cases(spark, folder))


@query(f"select * exclude (name_state) from (select {NUMBERED}, * from ({TIDY_CASES_SQL}))")
def covid_table(spark, folder):
    return build_covid(clean_daily_cases(daily_cases(spark, folder)))


def school_frames(spark, folder):
    """Customers, suppliers and parts in the shape of the three institution files."""
    customer, supplier, part = (table(spark, folder, n) for n in ("customer", "supplier", "part"))

    def code(key):
        return F.element_at(F.array(*[F.lit(c) for c in [*CODES, "BI"]]), (F.col(key) % (len(CODES) + 1) + 1).cast("int"))

    public = customer.select(
        F.col("c_name").alias("NAME"), F.col("c_mktsegment").alias("CITY"),
        code("c_custkey").alias("STATE"),
        F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_mktsegment")).alias("COUNTY"),
        F.lit("USA").alias("COUNTRY"), F.col("c_acctbal").alias("ENROLLMENT"),
        (F.col("c_custkey") % 50 - 1).cast("double").alias("FT_TEACHER"),
        F.lit("PK").alias("ST_GRADE"),
    )
    private = supplier.select(
        F.col("s_name").alias("NAME"), F.lit("TOWN").alias("CITY"), code("s_suppkey").alias("STATE"),
        F.lit("COUNTY").alias("COUNTY"), F.lit("USA").alias("COUNTRY"),
        F.col("s_acctbal").alias("ENROLLMENT"),
        (F.col("s_suppkey") % 50 - 1).cast("double").alias("FT_TEACHER"),
        F.lit("KG").alias("START_GRAD"), F.col("s_suppkey").alias("FID"),
    )
    colleges = part.select(
        F.col("p_name").alias("NAME"), F.col("p_brand").alias("CITY"), code("p_partkey").alias("STATE"),
        F.col("p_type").alias("COUNTY"), F.lit("USA").alias("COUNTRY"),
        F.col("p_retailprice").alias("TOT_ENROLL"), F.col("p_size").cast("double").alias("TOT_EMPLOY"),
    )
    return public, private, colleges


def _institutions_sql(kept: str = "true") -> str:
    def state(key: str) -> str:
        pairs = {i: STATE_NAMES[c] for i, c in CASE_STATE.items()}
        return sql_case(f"{key} % {len(CODES) + 1}", pairs, "'Alaska'")

    def repaired(name: str) -> str:
        return (
            f"case when {name} < 0 then (select {sql_mean(name)} from schools where {name} > 0) "
            f"else {name} end as {name}"
        )

    return f"""
        with schools as (
            select 0 as source, c_name as institution_name, c_mktsegment as city,
                   {state('c_custkey')} as name_state, c_acctbal as n_students,
                   cast(c_custkey % 50 - 1 as double) as n_employees, 'public' as availability,
                   nullif(c_mktsegment, 'FURNITURE') as county
            from customer
            union all
            select 1, s_name, 'TOWN', {state('s_suppkey')}, s_acctbal,
                   cast(s_suppkey % 50 - 1 as double), 'private', 'COUNTY'
            from supplier
        ), merged as (
            select source, institution_name, city, name_state, {repaired('n_students')},
                   {repaired('n_employees')}, availability
            from schools where county is not null
            union all
            select 2, p_name, p_brand, {state('p_partkey')}, p_retailprice, cast(p_size as double),
                   'No data'
            from part
        )
        select cast(row_number() over (order by source, name_state, city, institution_name, n_students,
               n_employees) - 1 as bigint) as id_institution, institution_name, city, name_state,
               n_students, n_employees, availability,
               cast({sql_case('name_state', STATE_IDS)} as bigint) as id_state
        from merged where {kept}
    """


EDUCATION_SQL = _institutions_sql()


@query(EDUCATION_SQL)
def clean_schools(spark, folder):
    return clean_institutions(*school_frames(spark, folder), scale=2)


@query(_institutions_sql("n_employees > 0"))
def employed_schools(spark, folder):
    return clean_institutions(*school_frames(spark, folder), employed_only=True, scale=2)


@query(
    f"""
    select distinct id_institution, institution_name, city, id_state, n_students, n_employees, availability
    from ({EDUCATION_SQL})
    """
)
def education_table(spark, folder):
    return build_education(clean_institutions(*school_frames(spark, folder), scale=2))


COUNTY = """(select event_id, value as cases, cast(user_id as double) as deaths from events)"""


@query(_profile_sql(COUNTY, ["cases", "deaths"]))
def daily_profile(spark, folder):
    events = table(spark, folder, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("date"), F.col("event_type").alias("county"),
        F.lit("00000").alias("fips"), F.col("value").alias("cases"),
        F.col("user_id").cast("double").alias("deaths"),
    )
    profile = county_profile(events)
    return _rounded(profile).withColumn("mean", F.round("mean", 8))


def case_table(spark, folder):
    """Orders in the shape of the case fact, the state being the customer's nation."""
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, folder, "orders")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("id_covid_data"),
        F.to_date("o_orderdate").alias("day_date"),
        F.col("c_nationkey").cast("bigint").alias("id_state"),
        F.col("o_totalprice").alias("positive"),
        F.lit(0.0).alias("hospitalized_curr"),
        F.lit(0.0).alias("hospitalized_acum"),
        (F.col("o_custkey") % 100).cast("double").alias("death"),
    )


CASES_SQL = """
    select o_orderkey as id_covid_data, cast(o_orderdate as date) as day_date,
           cast(c_nationkey as bigint) as id_state, o_totalprice as positive,
           cast(o_custkey % 100 as double) as death
    from orders join customer on o_custkey = c_custkey
"""
DAYS_SQL = f"""
    select id_state, day_date, {sql_total('positive')} as positive, {sql_total('death')} as death
    from ({CASES_SQL}) group by id_state, day_date
"""
GROWTH_SQL = f"""
    select id_state, day_date, positive, positive_before,
           greatest(positive - positive_before, 0) as new_positive,
           greatest(positive - positive_before, 0) / nullif(positive_before, 0) as growth
    from (select *, lag(positive) over (partition by id_state order by day_date) as positive_before
          from ({DAYS_SQL}))
"""
GROWTH_SQL = GROWTH_SQL.replace(
    "greatest(positive - positive_before, 0)",
    "(case when positive - positive_before < 0 then 0 else positive - positive_before end)",
)
STATE_GROWTH_SQL = f"select id_state, avg(growth) as mean_growth from ({GROWTH_SQL}) group by id_state"


def growth_rows(spark, folder):
    return reports.daily_growth(case_table(spark, folder), scale=2)


def state_growth(spark, folder):
    return reports.state_growth(growth_rows(spark, folder))


def _round(df, digits, *names):
    return df.withColumns({n: F.round(n, digits) for n in names})


@query(GROWTH_SQL)
def daily_growth(spark, folder):
    return growth_rows(spark, folder)


@query(
    f"""
    select id_state, day_date, positive, positive_before, positive as new_positive,
           (positive - positive_before) / positive_before as growth
    from (select *, lag(positive) over (partition by id_state order by day_date) as positive_before
          from ({DAYS_SQL}))
    """
)
def daily_growth_of_new_counts(spark, folder):
    return reports.daily_growth(case_table(spark, folder), cumulative=False, scale=2)


GAPS_SQL = f"""
    select *, case when positive - positive_before < 0 then 0 else positive - positive_before end as rise
    from (select id_state, day_date, positive,
                 lag(positive) over (partition by id_state order by day_date) as positive_before,
                 cast(day_date - lag(day_date) over (partition by id_state order by day_date) as integer) as days_between
          from ({DAYS_SQL}))
"""


@query(
    f"""
    select * exclude rise, cast(rise as double) / days_between as new_positive,
           cast(rise as double) / days_between / nullif(positive_before, 0) as growth
    from ({GAPS_SQL})
    """
)
def growth_over_gaps(spark, folder):
    """Growth a day since the last known day; states lack many days."""
    return reports.growth_over_gaps(case_table(spark, folder), scale=2)


@query(
    f"""
    select * exclude rise, case when days_between = 1 then cast(rise as double) end as new_positive,
           case when days_between = 1 then cast(rise as double) end / nullif(positive_before, 0) as growth
    from ({GAPS_SQL})
    """
)
def growth_of_following_days(spark, folder):
    """Growth where the day before is known."""
    return reports.growth_over_gaps(case_table(spark, folder), reports.UNKNOWN, scale=2)


@query(
    f"""
    with known as ({DAYS_SQL}),
    days as (
        select id_state, cast(unnest(generate_series(least, most, interval 1 day)) as date) as day_date
        from (select id_state, min(day_date) as least, max(day_date) as most from known group by id_state))
    select d.id_state, d.day_date, k.day_date as known_day, cast(d.day_date - k.day_date as integer) as days_since,
           case when d.day_date - k.day_date <= 3 then k.positive end as positive,
           case when d.day_date - k.day_date <= 3 then k.death end as death
    from days d asof join known k on d.id_state = k.id_state and d.day_date >= k.day_date
    """
)
def cases_on_calendar(spark, folder):
    """Every day of every state, with what was known at most three days ago."""
    days = reports.daily_counts(case_table(spark, folder), scale=2)
    return on_calendar(days, ["id_state"], "day_date", ["positive", "death"], most=3)


WEIGHTED = "round(sum(mean_growth * n) / sum(n) filter (where mean_growth is not null), 8) as mean_growth"

@query(
    f"""
    select availability, cast(sum(n) as bigint) as n_institutions, {WEIGHTED}
    from (select id_state, availability, count(*) as n from ({INSTITUTIONS_SQL}) group by all)
    left join ({STATE_GROWTH_SQL}) using (id_state) group by availability
    """
)
def growth_by_type(spark, folder):
    result = reports.growth_by_availability(institutions(spark, folder), state_growth(spark, folder))
    return _round(result, 8, "mean_growth")


KINDS = {s: s.lower() for s in SEGMENTS}


@query(
    f"""
    select id_state, count(*) as n_institutions,
           {", ".join(f"cast(count(*) filter (where availability = '{k}') as double) / count(*) as {n}"
                      for k, n in KINDS.items())},
           round(any_value(mean_growth), 8) as mean_growth
    from ({INSTITUTIONS_SQL}) left join ({STATE_GROWTH_SQL}) using (id_state) group by id_state
    """
)
def type_mix_and_growth(spark, folder):
    mix = reports.availability_mix(institutions(spark, folder), state_growth(spark, folder), KINDS)
    return _round(mix, 8, "mean_growth")


@query(
    f"""
    select availability, employees_from, cast(sum(n) as bigint) as n_institutions, {WEIGHTED}
    from (select id_state, availability, floor(n_employees / 20) * 20 as employees_from, count(*) as n
          from ({INSTITUTIONS_SQL}) group by all)
    left join ({STATE_GROWTH_SQL}) using (id_state) group by availability, employees_from
    """
)
def by_staff_and_type(spark, folder):
    result = reports.growth_by_staff(institutions(spark, folder), state_growth(spark, folder), 20)
    return _round(result, 8, "mean_growth")


@query(
    f"""
    select season, count(new_positive) as n_days,
           count(case when temperature is not null then new_positive end) as n_known, round(avg(new_positive), 4) as mean_new_positive,
           round(avg(case when new_positive is not null then temperature end), 4) as mean_temp,
           round(corr(temperature, new_positive), 8) as correlation
    from (
        select season, new_positive,
               case season when 'winter' then avg_winter_temp when 'spring' then avg_spring_temp
                    when 'summer' then avg_summer_temp else avg_autumn_temp end as temperature
        from (select *, case when month(day_date) <= 3 then 'winter' when month(day_date) <= 6 then 'spring'
                             when month(day_date) <= 9 then 'summer' else 'autumn' end as season
              from ({GROWTH_SQL}))
        left join ({STATE_SQL}) using (id_state)
    )
    group by season
    """
)
def by_season(spark, folder):
    result = reports.growth_by_season(growth_rows(spark, folder), state_table(spark, folder))
    result = _round(result, 4, "mean_new_positive", "mean_temp")
    return _round(result, 8, "correlation")


@query(
    f"""
    select temp_from, count(mean_growth) as n_states, round(avg(mean_growth), 8) as mean_growth
    from ({STATE_GROWTH_SQL})
    left join (select id_state, floor(avg_temp / 1000) * 1000 as temp_from from ({STATE_SQL}))
    using (id_state) group by temp_from
    """
)
def mean_by_bucket(spark, folder):
    result = reports.growth_by_temperature(state_growth(spark, folder), state_table(spark, folder), 1000)
    return _round(result, 8, "mean_growth")


@query(
    f"""
    with ranked as (
        select id_state, avg_temp, ntile(4) over (order by avg_temp, id_state) as temp_group
        from ({STATE_SQL}) where avg_temp is not null)
    select temp_group, min(avg_temp) as temp_from, max(avg_temp) as temp_to,
           count(mean_growth) as n_states, round(avg(mean_growth), 8) as mean_growth
    from ({STATE_GROWTH_SQL}) left join ranked using (id_state) group by temp_group
    """.replace("ntile(4)", "cast(ntile(4)").replace("id_state) as temp_group", "id_state) as integer) as temp_group")
)
def mean_by_rank(spark, folder):
    """Growth of equally many nations each, from the least to the greatest mean temperature."""
    result = reports.growth_by_temperature_rank(state_growth(spark, folder), state_table(spark, folder), 4)
    return _round(result, 8, "mean_growth")


@query(
    "with counts as (select id_state, max(positive) as positive, max(death) as death"
    f" from ({DAYS_SQL}) group by id_state), rates as (select *, positive / total_population as p,"
    f" death / total_population as d from counts left join ({STATE_SQL}) using (id_state)) "
    + " union all ".join(
        f"select '{s}' as race, count(*) as n_reported, count({s}) as n_states, round(corr({s}, p), 8) as positive_correlation,"
        f" round(corr({s}, d), 8) as death_correlation from rates"
        for s in SHARES
    )
)
def rate_by_share(spark, folder):
    rates = reports.state_rates(case_table(spark, folder), state_table(spark, folder), scale=2)
    return _round(reports.rate_by_share(rates), 8, "positive_correlation", "death_correlation")


@query(
    f"""
    select id_state, name_state, day_date, positive, total_population,
           positive / cast(total_population as double) as positive_rate
    from ({DAYS_SQL}) left join ({STATE_SQL}) using (id_state)
    """
)
def rate_by_population(spark, folder):
    return reports.rate_by_population(case_table(spark, folder), state_table(spark, folder), scale=2)


#: The reports by the names they had beside others with one side cut.
for _report in (growth_by_type, type_mix_and_growth, by_staff_and_type, by_season, mean_by_bucket, rate_by_share, rate_by_population):
    _named = partial(_report)
    _named.__name__ = f"{_report.__name__}_whole"
    query(SQL[_report.__name__])(_named)


@query(
    f"""
    with state as ({STATE_SQL}), education as ({INSTITUTIONS_SQL}), covid as ({CASES_SQL})
    select 'education' as table_name, 'not_null' as rule, 'id_institution' as column_name,
           count(*) filter (where id_institution is null) as failures from education
    union all select 'education', 'non_negative', 'n_students', count(*) filter (where n_students < 0) from education
    union all select 'state', 'not_null', 'id_state', count(*) filter (where id_state is null) from state
    union all select 'covid', 'not_null', 'id_covid_data', count(*) filter (where id_covid_data is null) from covid
    union all select 'education', 'primary_key', 'id_institution',
                     count(*) - count(distinct id_institution) from education
    union all select 'state', 'primary_key', 'id_state', count(*) - count(distinct id_state) from state
    union all select 'covid', 'primary_key', 'id_covid_data', count(*) - count(distinct id_covid_data) from covid
    union all select 'education', 'foreign_key', 'id_state', count(*) from education
                     where id_state not in (select id_state from state)
    union all select 'covid', 'foreign_key', 'id_state', count(*) from covid
                     where id_state not in (select id_state from state)
    union all select 'state', 'shares_sum_to_1', '', count(*) filter (where abs(
                     american_native + asian + african_american + hispanic + white - 1) > 1e-9) from state
    union all select 'state', 'avg_temp_between_parts', '', count(*) filter (where
                     avg_temp < least(avg_autumn_temp, avg_spring_temp, avg_summer_temp, avg_winter_temp) - 1e-9
                     or avg_temp > greatest(avg_autumn_temp, avg_spring_temp, avg_summer_temp,
                                            avg_winter_temp) + 1e-9) from state
    """
)
def model_quality(spark, folder):
    """State and cases are written first, as in a full run: each rule scans them again."""
    state = written(state_table(spark, folder), "state")
    cases = written(case_table(spark, folder), "cases")
    return model_checks(state, institutions(spark, folder), cases)


def reported_cases(spark, folder, settled_only):
    """Daily counts by state as one report states them; the early report lacks pending orders."""
    cases = daily_cases(spark, folder)
    if settled_only:
        cases = cases.where(F.col("hospitalizedCurrently").isNotNull())
    return cases.groupBy("date", "state").agg(
        total(F.col("positive"), 2).alias("positive"),
        total(F.col("hospitalizedCurrently"), 3).alias("hospitalizedCurrently"),
        F.max("hospitalizedCumulative").alias("hospitalizedCumulative"),
        F.sum("death").alias("death"),
    )


@query(
    f"""
    select {NUMBERED}, *, cast({sql_case("name_state", STATE_IDS)} as bigint) as id_state
    from (
        select day_date, name_state, {sql_total('positive')} as positive,
               coalesce(cast(sum(cast(current as decimal(28, 3))) as double), 0) as hospitalized_curr,
               max(hospitalized_acum) as hospitalized_acum, sum(death) as death
        from (select *, nullif(hospitalized_curr, 0) as current from ({TIDY_CASES_SQL}))
        group by day_date, name_state
    )
    """
)
def incremental_equals_batch(spark, folder):
    """Daily reports landed and ingested in two runs; the second one corrects the first.

    Orders still pending come in with the second report only, so most of its rows replace a row
    of the first. The result must be what the second report alone says.
    """
    landing = scratch_path(spark, "landing")
    log, checkpoint = scratch_path(spark, "log"), scratch_path(spark, "progress")
    for settled_only in (True, False):
        report = reported_cases(spark, folder, settled_only)
        report.write.mode("append").option("header", True).csv(landing)
        incremental.ingest_daily_cases(spark, landing, log, checkpoint)
    return incremental.current_cases(spark, log)


def write_raw_files(spark, folder, root):
    """The test tables as the raw files of the manifest, in their formats."""

    def put(df, name, kind, **options):
        getattr(df.write.options(**options), kind)(f"{root}/{RAW[name].path}")

    cities = nation_cities(spark, folder).withColumn("count", F.floor("count"))
    put(cities.select(F.lit("cities").alias("datasetid"), F.struct("*").alias("fields")), "cities", "json")
    people = nation_population(spark, folder).select(F.array(F.col("POP_2021").cast("string"), "NAME").alias("row"))
    # One web answer: a header and a row per nation.
    header = F.array(F.array(F.lit("POP_2021"), F.lit("NAME")))
    answer = people.agg(F.to_json(F.concat(header, F.collect_list("row"))).alias("value"))
    put(answer.coalesce(1), "population", "text")
    for name, df in zip(("public_schools", "private_schools", "colleges"), school_frames(spark, folder), strict=True):
        put(df, name, "csv", header=True)
    put(nation_temperatures(spark, folder), "temperatures", "csv", header=True)
    put(daily_cases(spark, folder), "daily_cases", "csv", header=True)


def _after_full_run(spark, folder, read):
    """What ``read`` makes of the published tables, written before they are dropped."""
    root, result = scratch_path(spark, "raw"), scratch_path(spark, "published")
    prefix = f"stateline_{root.rsplit('-', 1)[1]}_"
    write_raw_files(spark, folder, root)
    nations = {"ids": NATIONS}
    try:
        run_all(
            spark,
            root,
            prefix,
            decimals={"people": 0, "staff": 2, "temperature": 2},
            reader_options={"cities": {"lines": True}},
            plan_options={
                "staging_demographic": nations | {"races": RACE_NAMES},
                "staging_temperature": nations | {"since": SINCE},
            },
        )
        read(lambda name: spark.table(prefix + name)).write.parquet(result)
    finally:
        Snapshots(spark, prefix).drop()
    return spark.read.parquet(result)


@query(
    f"""
    select 'covid' as table_name, count(*) as rows, {sql_total('positive')} as total from ({TIDY_CASES_SQL})
    union all select 'education', count(*), round(sum(n_students), 2) from ({EDUCATION_SQL})
    union all select 'state', count(*), {sql_total('total_population')} from ({_state_sql("supplier", "s_nationkey")})
    """
)
def full_run(spark, folder):
    """Raw files → staging → model → checks → published tables, as a nightly run does it."""
    measured = {"covid": "positive", "education": "n_students", "state": "total_population"}

    def totals(published):
        parts = [
            published(name).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("rows"), total(F.col(column), None).alias("total"))
            for name, column in measured.items()
        ]
        return union_all(*[p.withColumn("total", F.round(F.col("total").cast("double"), 2)) for p in parts])

    return _after_full_run(spark, folder, totals)


@query(
    f"""
    select 'covid' as table_name, id_covid_data as id, id_state, cast(day_date as varchar) as name, positive as amount
    from (select {NUMBERED}, * from ({TIDY_CASES_SQL}))
    union all
    select 'education', id_institution, id_state, institution_name, round(n_students, 6) from ({EDUCATION_SQL})
    union all
    select 'state', id_state, id_state, name_state, cast(total_population as double) from ({_state_sql("supplier", "s_nationkey")})
    """
)
def full_run_rows(spark, folder):
    """The same run by its rows: every published row with its id, its state and an amount."""
    rows = {
        "covid": ("id_covid_data", F.col("day_date").cast("string"), F.col("positive")),
        "education": ("id_institution", F.col("institution_name"), F.round("n_students", 6)),
        "state": ("id_state", F.col("name_state"), F.col("total_population").cast("double")),
    }

    def listed(published):
        parts = [
            published(name).select(F.lit(name).alias("table_name"), F.col(id).alias("id"), "id_state", text.alias("name"), amount.alias("amount"))
            for name, (id, text, amount) in rows.items()
        ]
        return union_all(*parts)

    return _after_full_run(spark, folder, listed)
