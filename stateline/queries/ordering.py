"""Dense ids over a global order."""

from __future__ import annotations

from pyspark.sql import functions as F

from stateline.operators import ids
from stateline.queries.registry import query, table


@query(
    """
    select cast(row_number() over (order by o_orderdate, o_orderkey) - 1 as bigint) as id,
           o_orderkey, o_orderdate
    from orders
    """
)
def dense_ids(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return ids.dense_ids(orders, ["o_orderdate", "o_orderkey"], "id")


@query(
    """
    select cast(row_number() over (order by l_returnflag, l_linestatus, l_quantity) - 1 as bigint) as id,
           l_returnflag, l_linestatus, l_quantity
    from lineitem
    """
)
def dense_ids_of_copies(spark, folder):
    """Very few distinct rows: the copies share them."""
    lines = table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    return ids.dense_ids(lines, ["l_returnflag"], "id")


@query(
    """
    select cast(row_number() over (order by rank, name) - 1 as bigint) as id, party, name, balance
    from (select 0 as rank, 'supplier' as party, s_name as name, s_acctbal as balance from supplier
          union all select 1, 'customer', c_name, c_acctbal from customer)
    """
)
def numbered_union(spark, folder):
    supplier = table(spark, folder, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance")
    )
    customer = table(spark, folder, "customer").select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")
    )
    return ids.numbered_union({"supplier": supplier, "customer": customer}, "party", ["name"], "id")


@query(
    """
    select event_id, event_type,
           cast(row_number() over (partition by event_type order by ts, event_id) - 1 as bigint) as before
    from events
    """
)
def running_position(spark, folder):
    """Position inside each of a few large groups."""
    events = table(spark, folder, "events").select("event_type", "ts", "event_id")
    rows = ids.running_weight(events, ["event_type", "ts", "event_id"], "before", within=["event_type"])
    return rows.drop("ts")


@query(
    """
    select event_id, kind,
           cast(row_number() over (partition by kind order by user_id, event_id) - 1 as bigint) as before
    from (select event_id, user_id, nullif(event_type, (select min(event_type) from events)) as kind from events)
    """
)
def running_position_of_unknown(spark, folder):
    """The same where one of the groups has no name."""
    events = table(spark, folder, "events")
    least = events.agg(F.min("event_type")).scalar()
    rows = events.select(F.nullif("event_type", least).alias("kind"), "user_id", "event_id")
    return ids.running_weight(rows, ["kind", "user_id", "event_id"], "before", within=["kind"]).drop("user_id")


@query(
    """
    select l_orderkey, l_linenumber, l_extendedprice, l_shipdate,
           cast(ntile(7) over (order by l_extendedprice, l_orderkey, l_linenumber, l_shipdate) as integer) as tile
    from lineitem
    """
)
def price_tiles(spark, folder):
    """All lines in seven groups of equal size, by price; ties are plenty."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate")
    return ids.tiles(lines, ["l_extendedprice"], 7, "tile")
