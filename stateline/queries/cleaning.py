"""Projections, filters, null handling, lookups and joins."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stateline.functions import lookup
from stateline.functions.scalars import day_from_int, day_from_text, number, ratio
from stateline.operators import clean, columns, joins, sets
from stateline.queries.registry import query, sql_case, sql_mean, table

STATUS = {"F": "fulfilled", "O": "open", "P": "pending"}


@query(
    """
    select p_partkey as part, p_brand as brand, cast(substr(p_brand, 7) as bigint) as brand_number,
           cast(null as double) as weight, p_size / p_retailprice as size_per_price,
           cast(p_size as bigint) as size
    from part
    """
)
def project_shape(spark, folder):
    part = columns.keep(table(spark, folder, "part"), "p_brand", "p_partkey", "p_size", "p_retailprice", "p_type")
    part = columns.rename(columns.drop(part, "p_type"), {"p_size": "size"})
    part = columns.rename_all(part, ["brand", "part", "size", "price"])
    part = part.withColumn("size_per_price", ratio(F.col("size").cast("double"), F.col("price")))
    part = part.withColumn("brand_number", number(F.substring("brand", 7, 10)))
    kinds = [("part", T.LongType()), ("brand", T.StringType()), ("brand_number", T.LongType()),
             ("size_per_price", T.DoubleType()), ("weight", T.DoubleType()), ("size", T.LongType())]
    shaped = columns.reindex(part, T.StructType([T.StructField(*kind) for kind in kinds]))
    return columns.promote(shaped, "part")


@query("select r_regionkey, replace(r_name, 'MIDDLE EAST', 'MIDEAST') as r_name, c_custkey from customer "
       "join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey")
def replace_value(spark, folder):
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    rows = table(spark, folder, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    rows = rows.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    rows = columns.keep(rows, "r_regionkey", "r_name", "c_custkey")
    return columns.replace_value(rows, "r_name", {"MIDDLE EAST": "MIDEAST"})


@query("select o_orderkey, o_orderstatus from orders where o_orderstatus is distinct from 'P'")
def not_equal_filter(spark, folder):
    return clean.not_equal(table(spark, folder, "orders"), "o_orderstatus", "P").select(
        "o_orderkey", "o_orderstatus"
    )


@query("select o_orderkey from orders where o_orderstatus = 'F' and o_orderpriority = '5-LOW'")
def equal_filter(spark, folder):
    orders = clean.equal(table(spark, folder, "orders"), "o_orderstatus", "F")
    return clean.equal(orders, "o_orderpriority", "5-LOW").select("o_orderkey")


@query("select l_orderkey, l_linenumber, l_tax, l_discount from lineitem where l_tax = 0.0 or l_discount = 0.0")
def either_zero(spark, folder):
    lines = clean.any_equal(table(spark, folder, "lineitem"), ["l_tax", "l_discount"], 0.0)
    return lines.select("l_orderkey", "l_linenumber", "l_tax", "l_discount")


@query("select p_partkey from part where nullif(p_type, 'PROMO') is null")
def null_filter(spark, folder):
    part = table(spark, folder, "part").withColumn("kind", F.nullif("p_type", F.lit("PROMO")))
    return clean.is_null(part, "kind").select("p_partkey")


@query(
    """
    select p_partkey, p_type as kind, p_name from part
    where nullif(p_type, 'PROMO') is not null and nullif(p_name, '') is not null
    """
)
def drop_incomplete(spark, folder):
    part = table(spark, folder, "part").select(
        "p_partkey", F.when(F.col("p_type") == "PROMO", "  ").otherwise(F.col("p_type")).alias("kind"), "p_name"
    )
    return clean.drop_incomplete(clean.blanks_to_null(part), ["kind", "p_name"])


@query(
    f"""
    select c_custkey, case when c_acctbal < 0 then
        (select {sql_mean('c_acctbal')} from customer where c_acctbal > 0) else c_acctbal end as c_acctbal
    from customer
    """
)
def sentinel_impute(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return clean.impute_sentinel(customer, ["c_acctbal"], scale=2)


@query(
    """
    select coalesce(o.day, l.day) as day, coalesce(ordered, 0) as ordered, coalesce(shipped, 0) as shipped
    from (select cast(o_orderdate as date) as day, count(*) as ordered from orders group by 1) o
    full join (select cast(l_shipdate as date) as day, count(*) as shipped from lineitem group by 1) l
    on o.day = l.day
    """
)
def null_fill_outer(spark, folder):
    orders = table(spark, folder, "orders").groupBy(F.to_date("o_orderdate").alias("day"))
    lines = table(spark, folder, "lineitem").groupBy(F.to_date("l_shipdate").alias("day"))
    ordered = orders.agg(F.count(F.lit(1)).alias("ordered"))
    shipped = lines.agg(F.count(F.lit(1)).alias("shipped"))
    return clean.fill_zero(joins.outer_on(ordered, shipped, "day"))


@query(f"select o_orderkey, {sql_case('o_orderstatus', STATUS)} as status from orders")
def lookup_strict(spark, folder):
    status = lookup.strict(F.col("o_orderstatus"), STATUS, "order status")
    return table(spark, folder, "orders").select("o_orderkey", status.alias("status"))


KNOWN = {k: v for k, v in STATUS.items() if k != "P"}


@query(
    f"""
    select status, count(*) as n, count(*) filter (where o_orderstatus not in ('F', 'O')) as defaulted
    from (select o_orderstatus, {sql_case('o_orderstatus', KNOWN, "'other'")} as status from orders)
    group by status
    """
)
def lookup_default(spark, folder):
    key = F.col("o_orderstatus")
    rows = table(spark, folder, "orders").select(
        lookup.with_default(key, KNOWN, "other").alias("status"),
        lookup.is_unmatched(key, KNOWN).alias("unmatched"),
    )
    return rows.groupBy("status").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("unmatched").alias("defaulted")
    )


@query(
    """
    select l_orderkey, l_linenumber, l_suppkey, coalesce(n_name, 'none') as n_name from lineitem
    join supplier on l_suppkey = s_suppkey
    left join (select * from nation where n_regionkey <> 3) on s_nationkey = n_nationkey
    """
)
def lookup_table(spark, folder):
    """Two dictionary tables: the first must know every key, the second may not."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    supplier = table(spark, folder, "supplier")
    nation = table(spark, folder, "nation").where("n_regionkey <> 3")
    rows = joins.lookup_join(lines, "l_suppkey", supplier, "s_suppkey", "s_nationkey", strict=True)
    rows = joins.lookup_join(rows, "s_nationkey", nation, "n_nationkey", "n_name", default="none")
    return rows.drop("s_nationkey")


@query(
    """
    select o_orderkey, cast(strptime(strftime(o_orderdate, '%Y%m%d'), '%Y%m%d') as date) as from_int,
           cast(o_orderdate as date) as from_text, cast(month(o_orderdate) as bigint) as month
    from orders
    """
)
def parse_int_date(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("number"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("text"),
    )
    return orders.select(
        "o_orderkey",
        day_from_int(F.col("number")).alias("from_int"),
        day_from_text(F.col("text")).alias("from_text"),
        F.month(day_from_int(F.col("number"))).cast("bigint").alias("month"),
    )


@query(
    """
    select 'customer' as party, c_custkey as id, c_name as name, c_acctbal as balance,
           c_mktsegment as segment from customer
    union all
    select 'supplier', s_suppkey, s_name, s_acctbal, null from supplier
    """
)
def tagged_union(spark, folder):
    customer = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"),
    )
    supplier = table(spark, folder, "supplier")
    names = {"s_suppkey": "id", "s_name": "name", "s_acctbal": "balance"}
    supplier = columns.rename(columns.drop(supplier, "s_nationkey"), names)
    return sets.tagged_union({"customer": customer, "supplier": supplier}, "party")


@query("select distinct o_custkey, o_orderstatus from orders")
def distinct_rows(spark, folder):
    return sets.distinct_rows(table(spark, folder, "orders"), "o_custkey", "o_orderstatus")


@query("select distinct event_type from events")
def distinct_values(spark, folder):
    return sets.distinct_rows(table(spark, folder, "events"), "event_type")
