"""Readers and writers: whole tables written in the shapes of the raw files and read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stateline.functions.exact import total
from stateline.queries.registry import query, table
from stateline.session import scratch_path
from stateline.sources import readers, sinks
from stateline.sources.snapshots import Snapshots

ROWS_PER_MATRIX = 500


@query(
    """
    select event_id, user_id, cast(json_extract_string(props, '$.k') as bigint) as k from events
    """
)
def json_field(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "props")
    return readers.open_envelope(events, "props", T.StructType([T.StructField("k", T.LongType())]))


@query("select event_id, event_type, value from events")
def enveloped_json(spark, folder):
    path = scratch_path(spark, "enveloped")
    events = table(spark, folder, "events")
    events.select(
        F.lit("events").alias("datasetid"), F.struct("event_id", "event_type", "value", "user_id").alias("fields")
    ).write.json(path)
    payload = T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("event_type", T.StringType()),
            T.StructField("value", T.DoubleType()),
        ]
    )
    return readers.read_enveloped_json(spark, path, payload, lines=True)


@query("select o_orderkey, o_custkey, o_orderpriority from orders")
def json_matrix(spark, folder):
    """Orders packed into matrices of a fixed number of rows, with a header each, and back.

    The columns stand in another order in every second matrix.
    """
    orders = table(spark, folder, "orders")
    names = ["o_orderkey", "o_custkey", "o_orderpriority"]
    matrix = F.floor(F.col("o_orderkey") / ROWS_PER_MATRIX)

    def packed(order):
        header = F.array(*[F.lit(n) for n in order])
        rows = F.collect_list(F.array(*[F.col(n).cast("string") for n in order]))
        return F.to_json(F.concat(F.array(header), rows))

    texts = orders.groupBy(matrix.alias("matrix")).agg(
        F.when(F.first(matrix) % 2 == 0, packed(names)).otherwise(packed(names[::-1])).alias("text")
    )
    schema = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("o_custkey", T.LongType()),
            T.StructField("o_orderpriority", T.StringType()),
        ]
    )
    return readers.matrix_rows(texts, "text", schema)


LINE_SCHEMA = T.StructType(
    [
        T.StructField("l_orderkey", T.LongType()),
        T.StructField("l_linenumber", T.LongType()),
        T.StructField("l_extendedprice", T.DoubleType()),
        T.StructField("l_returnflag", T.StringType()),
        T.StructField("l_shipdate", T.DateType()),
    ]
)
LINES_SQL = """
    select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, l_extendedprice, l_returnflag,
           cast(l_shipdate as date) as l_shipdate
    from lineitem
"""


def _lines(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn("l_shipdate", F.to_date("l_shipdate"))
    return sinks.conform(lines, LINE_SCHEMA)


@query(LINES_SQL)
def staged_roundtrip(spark, folder):
    """Written as CSV, loaded by position."""
    path = scratch_path(spark, "staged")
    sinks.write_csv(_lines(spark, folder), path, LINE_SCHEMA)
    return readers.stage_csv(spark, path, LINE_SCHEMA)


@query(LINES_SQL)
def csv_by_name(spark, folder):
    """Written with more columns in another order, read by name."""
    path = scratch_path(spark, "by-name")
    lines = _lines(spark, folder).withColumn("extra", F.lit("x"))
    lines.select(*reversed(lines.columns)).write.options(**readers.CSV_OPTIONS).csv(path)
    return readers.read_csv(spark, path, LINE_SCHEMA)


@query("select doc_id, text, lang, n_chars from documents")
def csv_with_breaks(spark, folder):
    """Texts with line breaks, quotes and separators, written as CSV and read by as many tasks as the file has parts."""
    path = scratch_path(spark, "breaks")
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("n_chars", T.LongType())]
    )
    sinks.write_csv(table(spark, folder, "documents"), path, schema)
    return readers.read_csv(spark, path, schema, quoted_breaks=True)


@query(LINES_SQL)
def staged_json(spark, folder):
    path = scratch_path(spark, "json")
    _lines(spark, folder).write.json(path)
    return readers.stage_json(spark, path, LINE_SCHEMA)


@query("select o_orderpriority, 2 * count(*) as rows from orders group by 1")
def append_and_refresh(spark, folder):
    """Two appends to a fresh table, a full refresh made from it, then counts."""
    schema = T.StructType(
        [T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderpriority", T.StringType())]
    )
    path = scratch_path(spark, "appended")
    tables = [f"{name}_{path.rsplit('-', 1)[1]}" for name in ("stateline_appended", "stateline_refreshed")]
    orders = table(spark, folder, "orders").select(*schema.names)
    try:
        sinks.reset_tables(spark, {tables[0]: schema})
        sinks.load_table(orders, tables[0])
        sinks.load_table(orders, tables[0])
        sinks.replace_table(spark.table(tables[0]), tables[1], schema)
        sinks.write_parquet(spark.table(tables[1]), path)
    finally:
        for name in tables:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.read.parquet(path).groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("rows"))


@query(
    """
    select o_orderpriority, count(*) as rows, cast(sum(cast(o_totalprice as decimal(28, 2))) as double) as spend
    from (select * from orders union all select * from orders where o_orderpriority = (select min(o_orderpriority) from orders))
    group by 1
    """
)
def batches_loaded_once(spark, folder):
    """Orders loaded a month at a time, some months twice, one batch after it died half-way with other rows.

    The orders of one priority are loaded again under another name: equal rows of another batch count.
    """
    schema = T.StructType(
        [T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderpriority", T.StringType()), T.StructField("o_totalprice", T.DoubleType())]
    )
    path = scratch_path(spark, "batches")
    name = f"stateline_batches_{path.rsplit('-', 1)[1]}"
    orders = table(spark, folder, "orders")
    halves = {half: orders.where((F.month("o_orderdate") <= 6) == (half == "first")) for half in ("first", "second")}
    least = orders.agg(F.min("o_orderpriority")).scalar()
    try:
        sinks.create_batch_table(spark, name, schema)
        sinks.load_batch(halves["second"].limit(10), name, "second")
        for half in ("first", "second", "first"):
            sinks.load_batch(halves[half], name, half)
        sinks.load_batch(orders.where(F.col("o_orderpriority") == least), name, "again/é")
        assert sinks.loaded_batches(spark, name) == ["again/é", "first", "second"]
        sinks.write_parquet(sinks.batch_rows(spark, name), path)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    grouped = spark.read.parquet(path).groupBy("o_orderpriority")
    return grouped.agg(F.count(F.lit(1)).alias("rows"), total(F.col("o_totalprice"), 2).alias("spend"))


@query("select p_partkey, substr(p_type, 1, 8) as p_type from part")
def cut_text(spark, folder):
    """Text cells cut to a length when a file is loaded."""
    schema = T.StructType([T.StructField("p_partkey", T.LongType()), T.StructField("p_type", T.StringType())])
    path = scratch_path(spark, "cut")
    sinks.write_csv(table(spark, folder, "part"), path, schema)
    return readers.stage_csv(spark, path, schema, cut_text=8)


@query(
    """
    with o as (select o_custkey, o_totalprice, cast(o_orderdate as date) as day from orders),
    seen as (
        select 1 as snapshot, * from o where day < date '1996-01-01'
        union all select 2, * from o)
    select snapshot, c_mktsegment, count(*) as orders, count(*) as counted,
           case when snapshot = 2 then cast(sum(cast(o_totalprice as decimal(28, 2))) as double) end as spent
    from seen join customer on c_custkey = o_custkey group by snapshot, c_mktsegment
    """
)
def snapshot_refresh(spark, folder):
    """Orders, and customers with the number of their orders, published together twice.

    The first pair is opened before the second, with one more column, is published, and read after it; a
    third is prepared and never published. Rows of a pair fit each other: ``orders`` are counted in one
    table and ``counted`` in the other.
    """
    result = scratch_path(spark, "snapshots-read")
    store = Snapshots(spark, f"stateline_{result.rsplit('-', 1)[1]}_")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("day"))
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")

    def prepared(orders, *more):
        counts = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_orders"), *more)
        return {"orders": store.prepare(orders, "orders"), "customers": store.prepare(customers.join(counts, "c_custkey"), "customers")}

    def measured(number, orders, customers):
        segments = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("orders"))
        spent = total(F.col("spent"), 2) if "spent" in customers.columns else F.lit(None).cast("double")
        counted = customers.groupBy("c_mktsegment").agg(F.sum("n_orders").alias("counted"), spent.alias("spent"))
        return segments.join(counted, "c_mktsegment").select(F.lit(number).alias("snapshot"), "c_mktsegment", "orders", "counted", "spent")

    try:
        first = store.publish(prepared(orders.where("day < date'1996-01-01'")))
        held = [first.table(name) for name in ("orders", "customers")]
        store.publish(prepared(orders, total(F.col("o_totalprice"), 2).alias("spent")))
        prepared(orders.limit(0))
        store.sweep()
        second = [store.current().table(name) for name in ("orders", "customers")]
        measured(1, *held).unionByName(measured(2, *second)).write.parquet(result)
    finally:
        store.drop()
    return spark.read.parquet(result)
