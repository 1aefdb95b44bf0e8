"""CSV files with quoted line breaks, read by many tasks (SRC-1).

Spark splits text at line ends wherever they are, and reads a file with ``multiLine`` in one task. A line
end is inside a cell if the quotes before it in the file are odd in number. So the lines with an odd number
of quotes are counted for each part of a file, and the sums over the parts before say how each part begins.
Parts without such a line are whole records, line by line; only in the others are lines put in order, and
only the lines of records that go over several are put together. Spark parses the records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

FILE, PART, TEXT = "_file", "_part", "_text"


def _text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, the offset of their part, their order in it, and whether their quotes are odd."""
    lines = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return lines.select(
        F.col("value").alias(TEXT),
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(PART),
        F.monotonically_increasing_id().alias("_at"),
        (quotes % 2 == 1).alias("_odd"),
    )


def _joined(order: str) -> Column:
    """The texts of a group, one below the other."""
    texts = F.array_sort(F.collect_list(F.struct(order, TEXT)))
    return F.array_join(F.transform(texts, lambda x: x[TEXT]), "\n").alias(TEXT)


def records(spark: SparkSession, path: str) -> DataFrame:
    """The records of CSV files without their headers: one row with ``_text`` for each, quoted line ends inside.

    Empty lines are none. A file in which a quote is not closed fails the job.
    """
    lines = _text_lines(spark, path)
    parts = lines.groupBy(FILE, PART).agg(F.count_if("_odd").alias("_n"))
    before = W.partitionBy(FILE).orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    parts = parts.withColumn("_all", F.sum("_n").over(W.partitionBy(FILE)))
    open_ = F.raise_error(F.concat(F.lit("a quote is not closed in "), F.col(FILE))).cast("boolean")
    parts = parts.where(F.when(F.col("_all") % 2 == 1, open_).otherwise(F.lit(True))).drop("_all")

    # One row for each part: sent to all tasks, so that the lines stay where they are.
    rows = lines.join(F.broadcast(parts), [FILE, PART])
    # The first part holds the header, so its lines are put in order, too.
    plain = (F.col("_n") == 0) & (F.col("_before") % 2 == 0) & (F.col(PART) > 0)
    alone = rows.where(plain).select(TEXT)
    order = W.partitionBy(FILE, PART).orderBy("_at")
    earlier = F.coalesce(F.sum(F.col("_odd").cast("int")).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    others = rows.where(~plain).withColumn("_toggles", F.col("_before") + earlier)
    header = (F.col(PART) == 0) & (F.row_number().over(order) == 1)
    others = others.withColumn("_header", header).where(~F.col("_header"))
    # A record begins where the quotes so far are even; with an odd line it goes on to the next odd one.
    inside = F.col("_odd") | (F.col("_toggles") % 2 == 1)
    single = others.where(~inside).select(TEXT)
    # Lines are put together where they have been put in order; only records over several parts move once more.
    pieces = others.where(inside).groupBy(FILE, PART, F.floor(F.col("_toggles") / 2).alias("_record"))
    pieces = pieces.agg(_joined("_at"), F.count_if("_odd").alias("_ends"))
    within = pieces.where(F.col("_ends") == 2).select(TEXT)
    across = pieces.where(F.col("_ends") < 2).groupBy(FILE, "_record").agg(_joined(PART)).select(TEXT)
    found = alone.unionByName(single).unionByName(within).unionByName(across)
    # Generated rows: else Spark moves filters on the cells, and their errors, before the join, to lines inside cells.
    found = found.select(F.explode(F.array(F.regexp_replace(TEXT, r"\r\z", ""))).alias(TEXT))
    return found.where(F.trim(TEXT) != "")


def parsed(found: DataFrame, columns: T.StructType, options: dict) -> DataFrame:
    """The cells of records, in the given columns."""
    text = {name: str(value).lower() if isinstance(value, bool) else str(value) for name, value in options.items()}
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.fields)
    return found.select(F.from_csv(TEXT, kinds, text | {"multiLine": "true", "header": "false"}).alias("_cells")).select("_cells.*")
