"""The profile of ingested cases, kept by month beside them (AGG-9, AGG-10 with RE-1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from stateline.operators.period_profile import profile_of_periods, sketched
from stateline.session import delete, names_in
from stateline.streaming.incremental import MONTH, VERSION, index, month_of, read_months

MEASURES = ("positive", "hospitalized_curr", "hospitalized_acum", "death")


def kept_sketches(spark: SparkSession, store: str) -> dict[str, set[int]]:
    """The months that are sketched, and which versions of them."""
    found: dict[str, set[int]] = {}
    for folder in names_in(spark, store):
        month, _, number = folder.partition(f".{VERSION}=")
        if number.isdigit() and "_SUCCESS" in names_in(spark, f"{store}/{folder}"):
            found.setdefault(month.removeprefix(f"{MONTH}="), set()).add(int(number))
    return found


def _folder(store: str, month: str, number: int) -> str:
    return f"{store}/{MONTH}={month}.{VERSION}={number}"


def refresh_sketches(spark: SparkSession, target: str, store: str, measures: Sequence[str] = MEASURES) -> list[str]:
    """Sketches the months that changed since they were sketched, and returns them; the others are not read."""
    current = {month: entry["version"] for month, entry in index(spark, target).items()}
    kept = kept_sketches(spark, store)
    changed = {m: v for m, v in current.items() if v not in kept.get(m, ())}
    for month, number in sorted(changed.items()):
        rows = read_months(spark, target, {month: number}).withColumn(MONTH, month_of("day_date"))
        sketched(rows, [MONTH], measures).coalesce(1).write.mode("overwrite").parquet(_folder(store, month, number))
        for old in kept.get(month, ()):
            delete(spark, _folder(store, month, old))
    return sorted(changed)


def profile_cases(spark: SparkSession, target: str, store: str, measures: Sequence[str] = MEASURES) -> DataFrame:
    """The numeric profile of the current cases: changed months are sketched, then all rows scanned once."""
    refresh_sketches(spark, target, store, measures)
    current = {month: entry["version"] for month, entry in index(spark, target).items()}
    if not current:
        raise ValueError(f"nothing was ingested into {target}")
    sketches = spark.read.parquet(*[_folder(store, m, v) for m, v in sorted(current.items())])
    return profile_of_periods(sketches, read_months(spark, target, current), measures)
