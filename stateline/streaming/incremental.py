"""Daily files as they land, and ids that grow with them (RE-1, WIN-2).

The current rows are kept by month. A micro-batch is parsed once, puts what is newer into the months its
rows fall into and writes these months anew, in a folder of its own version, each row with its place in
the month's order; other months' files are neither read nor moved. A small index, one file for each
version, names the version and the number of rows of every month. Appearing whole, it is what commits a
batch. An id is the number of rows in the months before plus the place in the month, so reading the
current rows is a scan with a broadcast of one offset for each month: nothing is sorted or shuffled.

Per state and day the row of the newest file counts: a maximum, which Spark combines before the
shuffle, however often a pair was reported. A batch that is run again after a failure starts from the
index before it and writes its own version again, so nothing is lost or doubled.

The file source remembers paths. A correction must land under a new name.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stateline.operators.ids import running_weight
from stateline.plans.cases import CASE_ORDER, number_cases, tidy_daily_cases
from stateline.session import delete, names_in, read_text, scratch_deleted, write_text_once, written
from stateline.sources.manifest import DAILY_CASES, STAGING_COVID
from stateline.sources.readers import CSV_OPTIONS, LINE, csv_header, refusing_long, typed

KEYS = ("id_state", "day_date")
FILE_TIME, FILE_NAME = "_file_time", "_file_name"
VERSION, MONTH = "version", "month"
#: A row's place in its month; folder of the index.
PLACE, INDEX = "place", "index"


def with_file(df: DataFrame) -> DataFrame:
    """Adds modification time and path of the file a row came from: its version."""
    return df.select(
        "*",
        F.col("_metadata.file_modification_time").alias(FILE_TIME),
        F.col("_metadata.file_path").alias(FILE_NAME),
    )


def newest(df: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Per key the row of the newest file; inside one file the greatest row."""
    values = [name for name in df.columns if name not in (*keys, FILE_TIME, FILE_NAME)]
    version = F.max(F.struct(FILE_TIME, FILE_NAME, *values)).alias("_row")
    return df.groupBy(*keys).agg(version).select(*keys, "_row.*")


def tidy_with_file(raw: DataFrame) -> DataFrame:
    """Cleaned case rows with the version of their file."""
    versions = raw.select(F.struct(FILE_TIME, FILE_NAME).alias("_version"), *DAILY_CASES.names)
    tidy = tidy_daily_cases(versions, carry=("_version",))
    return tidy.select("*", "_version.*").drop("_version")


def typed_cases(lines: DataFrame, header: T.StructType) -> DataFrame:
    """Landed text lines, of a batch or of a stream, as cleaned rows."""
    lines = refusing_long(with_file(lines), header)
    return tidy_with_file(typed(lines, DAILY_CASES, carry=(FILE_TIME, FILE_NAME)))


def month_of(day: str) -> Column:
    return F.date_format(day, "yyyy-MM")


def versions(spark: SparkSession, target: str) -> dict[str, list[int]]:
    """The months there are and the versions of each that are kept, oldest first."""
    found: dict[str, list[int]] = {}
    for folder in names_in(spark, target):
        if folder.startswith(f"{VERSION}="):
            for name in names_in(spark, f"{target}/{folder}"):
                if name.startswith(f"{MONTH}="):
                    found.setdefault(name.partition("=")[2], []).append(int(folder.partition("=")[2]))
    return {month: sorted(numbers) for month, numbers in found.items()}


def _index_file(target: str, number: int) -> str:
    return f"{target}/{INDEX}/{number:012d}.json"


def index(spark: SparkSession, target: str, before: int | None = None) -> dict[str, dict[str, int]]:
    """For each month its ``version`` and number of ``rows``, as of the newest batch (``before`` that number)."""
    names = [n.removesuffix(".json") for n in names_in(spark, f"{target}/{INDEX}") if n.endswith(".json")]
    numbers = [int(n) for n in names if n.isdigit() and (before is None or int(n) < before)]
    return json.loads(read_text(spark, _index_file(target, max(numbers)))) if numbers else {}


def months(spark: SparkSession, target: str) -> dict[str, int]:
    """The months there are and the newest version of each."""
    return {month: entry["version"] for month, entry in index(spark, target).items()}


def offsets(found: Mapping[str, Mapping[str, int]]) -> dict[str, int]:
    """How many rows the months before each month have."""
    result, total = {}, 0
    for month in sorted(found):
        result[month] = total
        total += found[month]["rows"]
    return result


def _month_folder(target: str, month: str, number: int) -> str:
    return f"{target}/{VERSION}={number}/{MONTH}={month}"


def read_months(spark: SparkSession, target: str, wanted: Mapping[str, int]) -> DataFrame | None:
    """The rows of the given months and versions; None for no month."""
    paths = [_month_folder(target, month, number) for month, number in sorted(wanted.items())]
    return spark.read.parquet(*paths) if paths else None


def upsert(batch: DataFrame, target: str, number: int) -> None:
    """Puts a batch of cleaned rows into the months it touches, as version ``number``.

    What the index before this batch names stays until the next batch is through: if this one must run
    again, it starts from there again. Older versions of the touched months are deleted.
    """
    spark = batch.sparkSession
    with scratch_deleted(spark):
        # Written once: parsing and checks run once, and corrections within the batch are settled.
        fresh = written(newest(batch.withColumn(MONTH, month_of("day_date")), (*KEYS, MONTH)), "batch")
        # A month is seven letters, and a batch of daily files touches few.
        touched = [r[MONTH] for r in fresh.select(MONTH).distinct().collect()]
        base = index(spark, target, before=number)
        if not touched:
            return
        old = read_months(spark, target, {m: base[m]["version"] for m in touched if m in base})
        merged = fresh
        if old is not None:
            old = old.drop(PLACE).withColumn(MONTH, month_of("day_date"))
            merged = newest(fresh.unionByName(old), (*KEYS, MONTH))
        # Rows lie in ranges of the whole order, so a file holds one month or a few, however large one is.
        placed = running_weight(merged, [MONTH, *CASE_ORDER], PLACE, within=[MONTH])
        folder = f"{target}/{VERSION}={number}"
        placed.write.mode("overwrite").partitionBy(MONTH).parquet(folder)
    counts = spark.read.parquet(folder).groupBy(F.col(MONTH).cast("string").alias(MONTH)).count().collect()
    found = base | {r[MONTH]: {"version": number, "rows": r["count"]} for r in counts}
    delete(spark, _index_file(target, number))  # of a run of this batch before
    write_text_once(spark, _index_file(target, number), json.dumps(found, indent=1))
    kept = versions(spark, target)
    for month in touched:
        for version in kept[month]:
            if version not in (number, base.get(month, {}).get("version")):
                delete(spark, _month_folder(target, month, version))


def ingest_daily_cases(
    spark: SparkSession,
    landing: str,
    target: str,
    checkpoint: str,
    files_per_batch: int | None = None,
) -> None:
    """Merges the files that are new in ``landing`` into the months in ``target``, then returns.

    The files share one header, which may have more columns than the table needs. A fresh checkpoint
    belongs to an empty target: with one that has rows it is refused, as versions would start anew.
    """
    fresh = not names_in(spark, f"{checkpoint}/offsets")
    if fresh and months(spark, target):
        raise ValueError(f"{target} holds rows of another checkpoint than {checkpoint}")
    header = csv_header(spark, landing, DAILY_CASES)
    reader = spark.readStream.schema(T.StructType([*header.fields, LINE])).options(
        enforceSchema=False, **CSV_OPTIONS
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    query = (
        typed_cases(reader.csv(landing), header)
        .writeStream.foreachBatch(lambda batch, number: upsert(batch, target, number))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def current_cases(spark: SparkSession, target: str) -> DataFrame:
    """The staging table as of the last ingested file: a scan, and a broadcast of one offset for each month."""
    found = index(spark, target)
    if not found:
        raise ValueError(f"nothing was ingested into {target}")
    rows = read_months(spark, target, {month: entry["version"] for month, entry in found.items()})
    before = spark.createDataFrame(list(offsets(found).items()), f"_{MONTH} string, _before bigint")
    rows = rows.join(F.broadcast(before), month_of("day_date") == F.col(f"_{MONTH}"))
    return rows.withColumn("id_covid_data", F.col("_before") + F.col(PLACE)).select(*STAGING_COVID.names)


def batch_cases(spark: SparkSession, landing: str) -> DataFrame:
    """The same from all files at once."""
    header = csv_header(spark, landing, DAILY_CASES)
    reader = spark.read.schema(T.StructType([*header.fields, LINE])).options(enforceSchema=False, **CSV_OPTIONS)
    return number_cases(newest(typed_cases(reader.csv(landing), header)).drop(FILE_TIME, FILE_NAME))
