"""Writers (SNK-1…3)."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stateline.operators.columns import require
from stateline.session import delete
from stateline.sources.manifest import TABLES
from stateline.sources.readers import CSV_OPTIONS


#: Between the place of a table and the name of a version.
VERSION_MARK = "__v_"


def write_csv(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Header and columns in the order of the staging table."""
    require(df, schema.names)
    df.select(*schema.names).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, by name, in its order and types."""
    require(df, schema.names)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def reset_tables(
    spark: SparkSession, tables: Mapping[str, T.StructType] = TABLES, prefix: str = ""
) -> None:
    """Drop and recreate empty tables."""
    for name, schema in tables.items():
        spark.sql(f"DROP TABLE IF EXISTS {prefix}{name}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE {prefix}{name} ({columns}) USING parquet")


def load_table(df: DataFrame, table: str) -> None:
    """Append by position, as INSERT … SELECT does. A second run adds the rows again: see ``load_batch``."""
    df.write.insertInto(table)


#: The partition column of tables that remember which batches they hold.
BATCH = "batch"
#: ``dynamic`` replaces only the partitions that are written, and only when all of them are.
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def create_batch_table(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """An empty table for ``load_batch``, if it is not there."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {BATCH} string) USING parquet PARTITIONED BY ({BATCH})")


def load_batch(df: DataFrame, table: str, batch: str) -> None:
    """Append by name, once for each batch name, however often the load runs.

    The rows of a batch are a partition of their own, written whole and put in place of what the partition
    had: a rerun, also after a crash, replaces its own rows and no others. A batch without rows leaves
    what it had. The partitions are the ledger of what was loaded.
    """
    if not batch:
        raise ValueError("a batch needs a name")
    spark = df.sparkSession
    names = [n for n in spark.table(table).columns if n != BATCH]
    require(df, names)
    named = df.select(*names).withColumn(BATCH, F.lit(batch))
    mode = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        named.write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(OVERWRITE_MODE, mode)


def loaded_batches(spark: SparkSession, table: str) -> list[str]:
    """The names of the batches a table holds, from its partitions alone."""
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return sorted(unquote(r[0].partition("=")[2]) for r in rows)


def batch_rows(spark: SparkSession, table: str) -> DataFrame:
    """The rows of all batches, without their names."""
    return spark.table(table).drop(BATCH)


def _table(spark: SparkSession, table: str) -> T.StructType | None:
    return spark.table(table).schema if spark.catalog.tableExists(table) else None


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"].rstrip("/")


def same_columns(a: T.StructType, b: T.StructType) -> bool:
    """Names and types in order, whatever may be null."""
    return [(f.name, f.dataType) for f in a] == [(f.name, f.dataType) for f in b]


def prepare_table(df: DataFrame, table: str, schema: T.StructType | None = None, new_columns: bool = False) -> str:
    """Writes the next version of a table beside the one in use, and returns its folder.

    Until ``publish_tables`` the table is what it was. Other columns than it has are refused, unless
    ``new_columns``.
    """
    spark = df.sparkSession
    result = df if schema is None else conform(df, schema)
    if _table(spark, table) is None:
        # Without rows: the first version is published like any other.
        result.limit(0).write.format("parquet").saveAsTable(table)
    elif not new_columns and not same_columns(_table(spark, table), result.schema):
        raise ValueError(f"{table} has other columns; drop it first")
    base = _location(spark, table).partition(VERSION_MARK)[0]
    folder = f"{base}{VERSION_MARK}{uuid.uuid4().hex}"
    result.write.parquet(folder)
    return folder


def switch_table(spark: SparkSession, table: str, folder: str, schema: T.StructType | None = None) -> str | None:
    """Points a table to a folder by one change of its metadata; returns the folder it had, if another.

    A table that has other columns than ``schema`` is made anew, and one that is not there is made;
    rows in its old folder stay in either case.
    """
    had = _table(spark, table)
    old = None if had is None else _location(spark, table)
    if old == folder.rstrip("/"):
        return None
    if had is not None and (schema is None or same_columns(had, schema)):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    else:
        if had is not None:
            # Dropping a table may delete its folder: it gets one without rows first.
            empty = f"{old.partition(VERSION_MARK)[0]}{VERSION_MARK}{uuid.uuid4().hex}"
            spark.createDataFrame([], had).write.parquet(empty)
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{empty}'")
            spark.sql(f"DROP TABLE {table}")
            delete(spark, empty)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet LOCATION '{folder}'")
    spark.catalog.refreshTable(table)
    return old


def publish_tables(spark: SparkSession, folders: Mapping[str, str]) -> None:
    """Switches each table to its prepared folder by one change of its metadata, then deletes the old folders.

    There is no moment without a table, but one with some tables old and some new, and a job that reads
    an old folder while it goes fails. ``stateline.sources.snapshots`` avoids both.
    """
    old = [switch_table(spark, table, folder) for table, folder in folders.items()]
    for folder in old:
        if folder is not None:
            delete(spark, folder)


def replace_table(df: DataFrame, table: str, schema: T.StructType | None = None) -> None:
    """Full refresh. The old table stays until the new rows are completely written."""
    publish_tables(df.sparkSession, {table: prepare_table(df, table, schema)})


def table_counts(spark: SparkSession, tables: Iterable[str]) -> DataFrame:
    parts = [
        spark.table(t).agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("rows")) for t in tables
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
