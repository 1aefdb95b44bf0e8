"""Profiles and quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from stateline.operators import period_profile, profile, quality
from stateline.queries.registry import query, sql_mean, table
from stateline.session import scratch_path


def _profile_sql(table_name: str, names: list[str]) -> str:
    return " union all ".join(
        f"""
        select '{n}' as column_name, count({n}) as count, {sql_mean(n)} as mean,
               round(stddev_samp({n}), 4) as std, cast(min({n}) as double) as min,
               round(quantile_cont({n}, 0.25), 4) as q25, round(quantile_cont({n}, 0.5), 4) as q50,
               round(quantile_cont({n}, 0.75), 4) as q75, cast(max({n}) as double) as max
        from {table_name}
        """
        for n in names
    )


def _rounded(df):
    return df.withColumns({n: F.round(n, 4) for n in ("std", "q25", "q50", "q75")})


@query(_profile_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount"]))
def numeric_profile(spark, folder):
    lines = table(spark, folder, "lineitem")
    return _rounded(profile.numeric_profile(lines, ["l_quantity", "l_extendedprice", "l_discount"], scale=2))


@query(_profile_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount"]))
def profile_of_months(spark, folder):
    """The same from sketches of months, in two loads: the second sketches only the months that are new."""
    names = ["l_quantity", "l_extendedprice", "l_discount"]
    lines = table(spark, folder, "lineitem").withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))
    path = scratch_path(spark, "sketches")
    for months in (F.col("month") < "1996-01", F.col("month") >= "1996-01"):
        period_profile.sketched(lines.where(months), ["month"], names, scale=2).write.mode("append").parquet(path)
    return _rounded(period_profile.profile_of_periods(spark.read.parquet(path), lines, names).drop("distinct"))


@query(
    """
    select cast(ts as date) as day, count(*) as n, count(value) as n_values, min(value) as low,
           max(value) as high, round(avg(value), 4) as mean
    from events group by 1
    """
)
def daily_measures(spark, folder):
    events = table(spark, folder, "events").drop("props").withColumn("day", F.to_date("ts"))
    return events.groupBy("day").agg(
        F.count(F.lit(1)).alias("n"), F.count("value").alias("n_values"), F.min("value").alias("low"),
        F.max("value").alias("high"), F.round(F.avg("value"), 4).alias("mean"),
    )


def _columns_sql(table_name: str, kinds: dict[str, str]) -> str:
    return " union all ".join(
        f"select '{n}' as column_name, '{kind}' as data_type, count({n}) as non_null from {table_name}"
        for n, kind in kinds.items()
    )


ORDER_KINDS = {
    "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
    "o_totalprice": "double", "o_orderdate": "timestamp_ntz", "o_orderpriority": "string",
}


@query(_columns_sql("orders", ORDER_KINDS))
def column_profile(spark, folder):
    return profile.column_profile(table(spark, folder, "orders"))


@query(
    " union all ".join(
        f"select '{n}' as column_name, count(distinct {n}) as distinct_values from orders" for n in ORDER_KINDS
    )
)
def distinct_counts(spark, folder):
    return profile.distinct_counts(table(spark, folder, "orders"))


@query(
    """
    select 'name' as column_name, 'string' as left_type, (select count(c_name) from customer) as left_non_null,
           'string' as right_type, (select count(s_name) from supplier) as right_non_null, 'same' as verdict
    union all
    select 'nationkey', 'int', (select count(c_nationkey) from customer), 'bigint',
           (select count(s_nationkey) from supplier), 'types differ'
    union all
    select 'mktsegment', 'string', (select count(c_mktsegment) from customer), null, null, 'left only'
    union all
    select 'suppkey', null, null, 'bigint', (select count(s_suppkey) from supplier), 'right only'
    """
)
def schema_diff(spark, folder):
    customer = table(spark, folder, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"),
        F.col("c_mktsegment").alias("mktsegment"),
    )
    supplier = table(spark, folder, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_nationkey").cast("bigint").alias("nationkey"),
        F.col("s_suppkey").alias("suppkey"),
    )
    return profile.compare_profiles(customer, supplier)


@query(f"select {sql_mean('c_acctbal')} as c_acctbal from customer where c_acctbal > 0")
def mean_of_positive(spark, folder):
    return profile.mean_where_positive(table(spark, folder, "customer"), ["c_acctbal"], scale=2)


@query(
    """
    select count(*) filter (where c_acctbal < 0) as negative, count(*) filter (where c_acctbal > 9000) as large,
           count(*) filter (where c_name is null) as nameless
    from customer
    """
)
def conditional_counts(spark, folder):
    return profile.count_where(
        table(spark, folder, "customer"),
        {
            "negative": F.col("c_acctbal") < 0,
            "large": F.col("c_acctbal") > 9000,
            "nameless": F.col("c_name").isNull(),
        },
    )


@query(
    """
    select 'orders' as table_name, 'not_null' as rule, 'o_orderkey' as column_name,
           count(*) filter (where o_orderkey is null) as failures from orders
    union all select 'orders', 'not_null', 'o_custkey', count(*) filter (where o_custkey is null) from orders
    union all select 'customer', 'not_null', 'c_custkey', count(*) filter (where c_custkey is null) from customer
    """
)
def dq_nulls(spark, folder):
    return quality.all_checks(
        quality.check_not_null(table(spark, folder, "orders"), "orders", "o_orderkey", "o_custkey"),
        quality.check_not_null(table(spark, folder, "customer"), "customer", "c_custkey"),
    )


@query(
    """
    select 'customer' as table_name, 'non_negative' as rule, 'c_acctbal' as column_name,
           count(*) filter (where c_acctbal < 0) as failures from customer
    """
)
def dq_negatives(spark, folder):
    return quality.check_non_negative(table(spark, folder, "customer"), "customer", "c_acctbal")


@query(
    """
    select 'lineitem' as table_name, 'primary_key' as rule, 'l_orderkey,l_linenumber' as column_name,
           count(*) - count(distinct (l_orderkey, l_linenumber)) as failures from lineitem
    union all
    select 'orders', 'primary_key', 'o_orderkey', count(*) - count(distinct o_orderkey) from orders
    """
)
def dq_unique(spark, folder):
    return quality.all_checks(
        quality.check_unique(table(spark, folder, "lineitem"), "lineitem", "l_orderkey", "l_linenumber"),
        quality.check_unique(table(spark, folder, "orders"), "orders", "o_orderkey"),
    )


@query(
    """
    select 'customer' as table_name, 'dense_ids' as rule, 'c_custkey' as column_name,
           greatest(count(*) - 1, max(c_custkey)) - least(0, min(c_custkey)) + 1 - count(distinct c_custkey) as failures from customer
    union all
    select 'lineitem', 'dense_ids', 'l_orderkey',
           greatest(count(*) - 1, max(l_orderkey)) - least(0, min(l_orderkey)) + 1 - count(distinct l_orderkey) from lineitem
    union all
    select 'lineitem', 'primary_key', 'l_orderkey', count(*) - count(distinct l_orderkey) from lineitem
    union all
    select 'customer', 'mean_weighs_parts', '', 0
    """
)
def dq_dense_ids(spark, folder):
    """Ids as bits in maps; and a mean of three parts, weighed by how many values each has."""
    customer, lines = table(spark, folder, "customer"), table(spark, folder, "lineitem")
    third = F.col("c_custkey") % 3
    counts = customer.groupBy(third.alias("part")).count()
    weights = {f"part_{r['part']}": r["count"] for r in counts.collect()}
    parts = [F.avg(F.when(third == i, F.col("c_acctbal"))).alias(f"part_{i}") for i in range(3)]
    means = customer.agg(F.avg("c_acctbal").alias("mean"), *parts)
    return quality.all_checks(
        quality.check_dense(customer, "customer", "c_custkey"),
        quality.check_dense(lines, "lineitem", "l_orderkey"),
        quality.check_unique_ids(lines, "lineitem", "l_orderkey"),
        quality.check_rows(means, "customer", extra=quality.weighted_mean_off("mean", weights)),
    )


@query(
    """
    select 'orders' as table_name, 'foreign_key' as rule, 'custkey' as column_name,
           count(*) as failures
    from orders where o_custkey not in (select c_custkey from customer where c_acctbal > 0)
    """
)
def dq_orphans(spark, folder):
    orders = table(spark, folder, "orders").select(F.col("o_custkey").alias("custkey"))
    solvent = table(spark, folder, "customer").where("c_acctbal > 0")
    return quality.check_references(
        orders, "orders", solvent.select(F.col("c_custkey").alias("custkey")), "custkey"
    )
