"""Shares, seasonal means, counts and rankings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from stateline.functions.scalars import ratio, season
from stateline.operators import aggregate, clean, sets, sums
from stateline.plans.institutions import (
    availability_per_state,
    institutions_per_state,
    students_per_employee,
)
from stateline.plans.temperatures import seasonal_means_by
from stateline.queries.registry import (
    SEGMENTS,
    query,
    sql_mean,
    sql_season,
    sql_total,
    table,
)

SHARE_NAMES = {s: f"share_{s.lower()}" for s in SEGMENTS}
COUNT_NAMES = {s: f"n_{s.lower()}" for s in SEGMENTS}
SHARES_SQL = "select c_nationkey, " + ", ".join(
    f"{sql_total(f"case when c_mktsegment = '{s}' then c_acctbal end")} / {sql_total('c_acctbal')} as {name}"
    for s, name in SHARE_NAMES.items()
) + " from customer group by c_nationkey"


def segment_shares(spark, folder):
    customer = table(spark, folder, "customer")
    return aggregate.share_pivot(
        customer, "c_nationkey", "c_mktsegment", "c_acctbal", SHARE_NAMES, scale=2
    )


@query(SHARES_SQL)
def segment_share_pivot(spark, folder):
    return segment_shares(spark, folder)


@query(
    """
    with g as (
        select c_nationkey, c_mktsegment, sum(cast(c_acctbal as decimal(28, 2))) as part
        from customer group by all
    )
    select c_nationkey, c_mktsegment,
           cast(part as double) / cast(sum(part) over (partition by c_nationkey) as double) as share
    from g
    """
)
def segment_share_rows(spark, folder):
    customer = table(spark, folder, "customer")
    return aggregate.share_rows(customer, "c_nationkey", "c_mktsegment", "c_acctbal", "share", scale=2)


@query(
    f"select count(*) filter (where abs({' + '.join(f'coalesce({n}, 0)' for n in SHARE_NAMES.values())} - 1) > 1e-9)"
    f" as off, count(*) as nations from ({SHARES_SQL})"
)
def share_sums(spark, folder):
    shares = segment_shares(spark, folder)
    whole = sum((F.coalesce(F.col(n), F.lit(0.0)) for n in SHARE_NAMES.values()), F.lit(0.0))
    return shares.agg(
        F.count_if(F.abs(whole - 1) > 1e-9).alias("off"), F.count(F.lit(1)).alias("nations")
    )


@query(
    """
    select o_orderkey, o_custkey, o_totalprice / customer_total as share from (
        select o_orderkey, o_custkey, o_totalprice,
               cast(sum(cast(o_totalprice as decimal(28, 2))) over (partition by o_custkey) as double)
               as customer_total
        from orders
    )
    """
)
def row_share(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    rows = aggregate.with_group_total(
        orders, ["o_custkey"], {"customer_total": "o_totalprice"}, scale=2
    )
    share = ratio(F.col("o_totalprice"), F.col("customer_total"))
    return rows.select("o_orderkey", "o_custkey", share.alias("share"))


@query(
    """
    select l_returnflag, l_linestatus,
           cast(count(*) over (partition by l_returnflag, l_linestatus) as double) as flag_rows,
           l_extendedprice, l_orderkey, l_linenumber, l_partkey, l_suppkey,
           cast(sum(cast(l_quantity as decimal(28, 2))) over (partition by l_returnflag, l_linestatus)
                as double) as flag_quantity
    from lineitem
    """
)
def row_total_of_large_groups(spark, folder):
    """Six groups hold all rows: every key is hot."""
    lines = table(spark, folder, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "l_quantity", "l_extendedprice", F.lit(1).alias("one"),
    )
    keys = ["l_returnflag", "l_linestatus"]
    totals = {"flag_quantity": "l_quantity", "flag_rows": "one"}
    return aggregate.with_group_total(lines, keys, totals, scale=2).drop("l_quantity", "one")


def _seasonal_sql(key: str, value: str, day: str, source: str, overall: str) -> str:
    cells = ", ".join(
        f"{sql_mean(f'(case when s = {chr(39)}{s}{chr(39)} then {value} end)')} as {s}"
        for s in ("autumn", "spring", "summer", "winter")
    )
    return (
        f"select {key}, {sql_mean(value)} as {overall}, {cells} "
        f"from (select *, {sql_season(day)} as s from {source}) group by {key}"
    )


@query(
    _seasonal_sql(
        "l_returnflag", "l_extendedprice", "l_shipdate",
        "lineitem where l_shipdate > timestamp '1995-12-31'", "mean_price",
    )
)
def seasonal_means(spark, folder):
    lines = clean.after(table(spark, folder, "lineitem"), "l_shipdate", dt.date(1995, 12, 31))
    lines = lines.withColumn("season", season(F.col("l_shipdate")))
    names = {s: s for s in ("autumn", "spring", "summer", "winter")}
    return aggregate.mean_pivot(
        lines, ["l_returnflag"], "season", "l_extendedprice", names, "mean_price", scale=2
    )


_MEANS = ("mean_price", "autumn", "spring", "summer", "winter")


@query(
    f"select l_returnflag, {', '.join(f'round({m}, 6) as {m}' for m in _MEANS)} from ("
    + _seasonal_sql(
        "l_returnflag", "l_extendedprice", "l_shipdate",
        "lineitem where l_shipdate > timestamp '1995-12-31'", "mean_price",
    )
    + ")"
)
def seasonal_means_of_any(spark, folder):
    """The same without saying that prices have two decimals: the doubles as they are, added exactly."""
    lines = clean.after(table(spark, folder, "lineitem"), "l_shipdate", dt.date(1995, 12, 31))
    lines = lines.withColumn("season", season(F.col("l_shipdate")))
    names = {s: s for s in _MEANS[1:]}
    means = aggregate.mean_pivot(
        lines, ["l_returnflag"], "season", "l_extendedprice", names, "mean_price", scale=aggregate.ANY
    )
    return means.withColumns({m: F.round(m, 6) for m in _MEANS})


def nation_temperatures(spark, folder):
    """Orders in the shape of the monthly temperature file: one reading per order."""
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, folder, "orders")
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    rows = orders.join(customer, orders.o_custkey == customer.c_custkey)
    rows = rows.join(nation, rows.c_nationkey == nation.n_nationkey)
    return rows.select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt"),
        F.col("o_totalprice").alias("AverageTemperature"),
        F.lit(0.0).alias("AverageTemperatureUncertainty"),
        F.col("n_name").alias("State"),
        F.col("c_nationkey").alias("City"),
        F.lit("United States").alias("Country"),
    )


@query(
    _seasonal_sql(
        '"City"', "o_totalprice", "o_orderdate",
        '(select c_nationkey as "City", o_totalprice, o_orderdate from orders '
        "join customer on o_custkey = c_custkey where o_orderdate > timestamp '1996-06-30')",
        "avg_temp",
    )
)
def seasonal_means_by_city_key(spark, folder):
    rows = nation_temperatures(spark, folder)
    return seasonal_means_by(rows, "City", since=dt.date(1996, 6, 30), scale=2)


@query(
    "select c_nationkey, "
    + ", ".join(
        f"count(*) filter (where c_mktsegment = '{s}') as {name}" for s, name in COUNT_NAMES.items()
    )
    + " from customer group by c_nationkey"
)
def crosstab_counts(spark, folder):
    return aggregate.crosstab(table(spark, folder, "customer"), "c_nationkey", "c_mktsegment", COUNT_NAMES)


@query(
    f"""
    select *, mean_price / mean_quantity as price_per_unit from (
        select l_returnflag, {sql_mean('l_extendedprice')} as mean_price,
               {sql_mean('l_quantity')} as mean_quantity
        from lineitem group by l_returnflag
    )
    """
)
def ratio_of_means(spark, folder):
    return aggregate.ratio_of_means(
        table(spark, folder, "lineitem"), ["l_returnflag"], ("l_extendedprice", "mean_price"),
        ("l_quantity", "mean_quantity"), "price_per_unit", scale=2,
    )


@query(
    """
    with parts as (
        select user_id % 50 as k, event_type, cast(value as double) / 3 as x from events)
    select k, round(fsum(x), 6) as total, round(favg(x), 6) as mean from parts group by k
    """
)
def sums_of_thirds(spark, folder):
    """Numbers without an end to their decimals, added in no order."""
    rows = table(spark, folder, "events").select((F.col("user_id") % 50).alias("k"), (F.col("value") / 3).alias("x"))
    found = sums.reproducible_sums(rows, ["k"], "x", "total", "mean")
    return found.withColumns({n: F.round(n, 6) for n in ("total", "mean")})


@query(
    f"""
    select o_orderpriority, {sql_total('o_totalprice')} as spend, {sql_mean('o_totalprice')} as mean_price,
           count(o_orderkey) as n_orders
    from orders group by o_orderpriority
    """
)
def group_measures(spark, folder):
    measures = {
        "spend": ("sum", "o_totalprice"), "mean_price": ("mean", "o_totalprice"), "n_orders": ("count", "o_orderkey"),
    }
    return aggregate.group_measures(table(spark, folder, "orders"), ["o_orderpriority"], measures, scale=2)


@query("select o_orderpriority, count(o_orderkey) as n_orders from orders group by 1 order by 2 desc, 1")
def ranked_groups(spark, folder):
    counts = aggregate.group_count(
        table(spark, folder, "orders"), ["o_orderpriority"], "o_orderkey", "n_orders"
    )
    return sets.rank_by(counts, "n_orders", "o_orderpriority")


@query(
    f"""
    select o_custkey, {sql_total('o_totalprice')} as spend from orders
    group by o_custkey order by spend desc, o_custkey limit 20
    """
)
def top_n(spark, folder):
    spend = aggregate.group_sum(table(spark, folder, "orders"), ["o_custkey"], "o_totalprice", "spend", scale=2)
    return sets.first_rows(spend, 20, [F.col("spend").desc(), "o_custkey"])


def institutions(spark, folder):
    """Customers in the shape of the institution table."""
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id_institution"),
        F.col("c_name").alias("institution_name"),
        F.col("c_mktsegment").alias("city"),
        F.col("c_nationkey").cast("bigint").alias("id_state"),
        F.col("c_acctbal").alias("n_students"),
        (F.col("c_custkey") % 97).cast("double").alias("n_employees"),
        F.col("c_mktsegment").alias("availability"),
    )


INSTITUTIONS_SQL = """
    select c_custkey as id_institution, c_name as institution_name, c_mktsegment as city,
           cast(c_nationkey as bigint) as id_state, c_acctbal as n_students,
           cast(c_custkey % 97 as double) as n_employees, c_mktsegment as availability
    from customer
"""


@query(
    f"""
    select id_state, count(institution_name) as n_institutions,
           {sql_mean('n_employees')} as mean_employees, {sql_mean('n_students')} as mean_students
    from ({INSTITUTIONS_SQL}) group by id_state
    """
)
def group_profile(spark, folder):
    return institutions_per_state(institutions(spark, folder), "id_state", scale=2)


@query(
    "select id_state, "
    + ", ".join(f"count(*) filter (where availability = '{s}') as {name}" for s, name in COUNT_NAMES.items())
    + f" from ({INSTITUTIONS_SQL}) group by id_state"
)
def group_profile_by_type(spark, folder):
    return availability_per_state(institutions(spark, folder), COUNT_NAMES, "id_state")


@query(
    f"""
    select *, mean_students / mean_employees as proportion from (
        select availability, {sql_mean('n_students')} as mean_students,
               {sql_mean('n_employees')} as mean_employees
        from ({INSTITUTIONS_SQL}) group by availability
    )
    """
)
def group_profile_ratio(spark, folder):
    return students_per_employee(institutions(spark, folder), scale=2)
