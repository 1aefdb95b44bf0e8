"""Readers (SRC-1…5). Schemas are given, never inferred from values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stateline.functions.scalars import blank_to_null, body_of, cell_named, cut, header_of
from stateline.sources.manifest import RAW
from stateline.sources.splitting import parsed, records

# Cells that mean "no value" in the raw files.
NULL_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
BAD_COLUMNS = "_bad_columns"
#: What ``_bad_columns`` calls cells beyond the last column.
SURPLUS = "_surplus"
# Without pruning every line is parsed whole, or its number of cells would not be known.
CSV_OPTIONS = {"header": True, "escape": '"', "columnNameOfCorruptRecord": "_line", "columnPruning": False}
#: The text of a line whose number of cells is not that of the columns.
LINE = T.StructField("_line", T.StringType())


def csv_header(spark: SparkSession, path: str, schema: T.StructType) -> T.StructType:
    """The columns of the file, all text; those of ``schema`` must be among them."""
    header = spark.read.options(**CSV_OPTIONS).csv(path).columns
    missing = [name for name in schema.names if name not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return T.StructType([T.StructField(name, T.StringType()) for name in header])


def cell(name: str) -> Column:
    """Text of a cell, null where the text means that there is no value."""
    return F.when(~F.col(name).isin(*NULL_TEXTS), F.col(name))


def too_long(columns: int, sep: str = ",") -> Column:
    """Whether a line has more cells than columns, and any of those beyond holds something, however many there are.

    Only lines with a wrong number of cells are looked at again: shorter ones are padded with null. A
    quoted cell becomes one letter (an empty one nothing), so that separators and breaks within it do not count.
    """
    mark = rf"\Q{sep}\E"
    empty = F.regexp_replace(F.col(LINE.name), rf'(?<=^|{mark})""(?={mark}|$)', "")
    plain = F.regexp_replace(empty, rf'(?<=^|{mark})"(?:[^"]++|"")*+(?:"|$)', "q")
    surplus = F.slice(F.split(plain, mark), columns + 1, F.greatest(F.size(F.split(plain, mark)) - columns, F.lit(0)))
    return F.when(F.col(LINE.name).isNotNull(), F.exists(surplus, lambda c: c != "")).otherwise(F.lit(False))


def refusing_long(lines: DataFrame, schema: T.StructType, sep: str = ",") -> DataFrame:
    """``lines`` without ``_line``; one with too many cells fails the job, whatever columns are used."""
    # Spark wants a column besides the line to be used.
    first = F.coalesce(F.col(schema.names[0]), F.lit(""))
    text = F.concat(F.lit(f"more than {len(schema)} cells: "), F.col(LINE.name), F.lit(", beginning with "), first)
    fits = F.when(too_long(len(schema), sep), F.raise_error(text).cast("boolean")).otherwise(F.lit(True))
    return lines.where(fits).drop(LINE.name)


def typed(lines: DataFrame, schema: T.StructType, carry: Sequence[str] = ()) -> DataFrame:
    """Text columns as those of ``schema``; a value of the wrong type fails the job."""
    return lines.select(*carry, *[cell(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    lenient: bool = False,
    multi_line: bool = False,
    quoted_breaks: bool = False,
) -> DataFrame:
    """CSV with a header, columns found by name.

    A value of the wrong type fails the job, and so does a line with more cells than the header. With
    ``lenient`` such values are null and ``_bad_columns`` names their columns, ``_surplus`` standing
    for the cells beyond the header, so that they can be counted. Shorter lines are padded with null.
    Files whose headers differ are refused. Quoted line breaks need ``multi_line``, which gives up
    splitting the file, or ``quoted_breaks``, which reads the lines twice and keeps splitting it; then the
    files must have one header, which is not checked.
    """
    header = csv_header(spark, path, schema)
    reader = spark.read.schema(T.StructType([*header.fields, LINE])).options(
        enforceSchema=False, multiLine=multi_line, **CSV_OPTIONS
    )
    if quoted_breaks:
        lines = parsed(records(spark, path), T.StructType([*header.fields, LINE]), CSV_OPTIONS)
    else:
        lines = reader.csv(path)
    if not lenient:
        return typed(refusing_long(lines, header), schema)
    values = {f.name: cell(f.name).try_cast(f.dataType) for f in schema.fields}
    bad = [F.when(cell(n).isNotNull() & values[n].isNull(), F.lit(n)) for n in schema.names]
    bad.append(F.when(too_long(len(header)), F.lit(SURPLUS)))
    return lines.select(
        *[value.alias(name) for name, value in values.items()],
        F.array_compact(F.array(*bad)).alias(BAD_COLUMNS),
    )


def stage_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sep: str = ",",
    cut_text: int | None = None,
) -> DataFrame:
    """Positional load of a CSV with one header line.

    Short lines are padded with null, blank and empty cells become null, and the casts are strict. A
    line with more cells than ``schema`` fails the job. ``cut_text`` limits the length of text cells.
    """
    raw = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    reader = spark.read.schema(T.StructType([*raw.fields, LINE])).options(sep=sep, **CSV_OPTIONS)
    lines = refusing_long(reader.csv(path), raw, sep)

    def staged(field: T.StructField) -> Column:
        value = blank_to_null(F.col(field.name))
        if isinstance(field.dataType, T.StringType):
            value = value if cut_text is None else cut(value, cut_text)
        else:
            value = F.trim(value).cast(field.dataType)
        return value.alias(field.name)

    return lines.select(*map(staged, schema.fields))


def stage_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines, columns found by key name."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_enveloped_json(
    spark: SparkSession,
    path: str,
    payload: T.StructType,
    field: str = "fields",
    lines: bool = False,
) -> DataFrame:
    """Objects whose payload sits under ``field``.

    A file holding one JSON array is read by one task, so large data should come as many files, or
    as one object per line (``lines``), which Spark splits.
    """
    envelope = T.StructType([T.StructField(field, payload)])
    reader = spark.read.schema(envelope).option("mode", "FAILFAST")
    return reader.option("multiLine", not lines).json(path).select(f"{field}.*")


def open_envelope(df: DataFrame, text: str, payload: T.StructType) -> DataFrame:
    """The same for a text column that holds the payload: its fields become columns."""
    parsed = F.from_json(F.col(text), payload, {"mode": "FAILFAST"})
    others = [name for name in df.columns if name != text]
    return df.select(*others, parsed.alias("_payload")).select(*others, "_payload.*")


def matrix_rows(df: DataFrame, text: str, schema: T.StructType) -> DataFrame:
    """Rows of JSON matrices (arrays of arrays of text whose first row is the header).

    Columns are picked by header name, so matrices may order them differently.
    """
    matrix = F.from_json(F.col(text), "array<array<string>>", {"mode": "FAILFAST"})
    parsed = df.select(matrix.alias("_matrix"))
    rows = parsed.select(
        header_of(F.col("_matrix")).alias("_header"), F.explode(body_of(F.col("_matrix"))).alias("_row")
    )
    return rows.select(
        *[
            cell_named(F.col("_row"), F.col("_header"), f.name).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def read_json_matrix(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One matrix per file, as a web service answers it."""
    return matrix_rows(spark.read.text(path, wholetext=True), "value", schema)


READERS = {
    "csv": read_csv,
    "enveloped_json": read_enveloped_json,
    "json_matrix": read_json_matrix,
}


def read_raw(spark: SparkSession, root: str, name: str, **options) -> DataFrame:
    """A raw data set by its name in the manifest. ``options`` go to its reader (``lines``, ``multi_line`` …)."""
    raw = RAW[name]
    return READERS[raw.kind](spark, f"{root.rstrip('/')}/{raw.path}", raw.schema, **options)
