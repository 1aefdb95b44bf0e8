"""Dates, seasons, ratios and text helpers (SCL-1…4, SCL-7…10, PRJ-7, PRJ-11, NUL-4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEASONS = ("autumn", "spring", "summer", "winter")


def day_from_int(value: Column, lenient: bool = False) -> Column:
    """20200307 → 2020-03-07. Bad text raises, or is null when ``lenient``."""
    text = value.cast("string")
    return F.try_to_date(text, "yyyyMMdd") if lenient else F.to_date(text, "yyyyMMdd")


def day_from_text(value: Column, lenient: bool = False) -> Column:
    return F.try_to_date(value, "yyyy-MM-dd") if lenient else F.to_date(value, "yyyy-MM-dd")


def season(day: Column) -> Column:
    """Calendar quarter as a season; a null day has no season."""
    month = F.month(day)
    return (
        F.when(month <= 3, "winter")
        .when(month <= 6, "spring")
        .when(month <= 9, "summer")
        .when(month <= 12, "autumn")
    )


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient, null where the divisor is 0."""
    return F.try_divide(top, bottom)


def blank_to_null(value: Column) -> Column:
    return F.when(F.trim(value) != "", value)


def cut(value: Column, length: int = 256) -> Column:
    return F.substring(value, 1, length)


def number(value: Column, kind: str = "bigint", lenient: bool = False) -> Column:
    return value.try_cast(kind) if lenient else value.cast(kind)


def header_of(matrix: Column) -> Column:
    """First row of an array of arrays."""
    return F.get(matrix, F.lit(0))


def body_of(matrix: Column) -> Column:
    return F.slice(matrix, F.lit(2), F.greatest(F.size(matrix) - 1, F.lit(0)))


def cell_named(row: Column, header: Column, name: str) -> Column:
    """Cell of ``row`` under the header ``name``; an absent name raises."""
    place = F.array_position(header, name)
    missing = F.raise_error(F.lit(f"the matrix has no column {name}"))
    return F.when(place > 0, F.get(row, (place - 1).cast("int"))).otherwise(missing.cast("string"))
