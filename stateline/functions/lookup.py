"""Dictionary lookups as map literals (PRJ-9, PRJ-10, SCL-5).

Meant for code lists of fixed size. Dictionaries that are tables go through
``operators.joins.lookup_join``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _literal(cell: str | int) -> str:
    if isinstance(cell, str):
        return "'" + cell.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(cell)


def as_map(pairs: Mapping[str | int, str | int]) -> Column:
    """A map literal, parsed in one call rather than built from a call per cell."""
    return F.expr(f"map({', '.join(_literal(cell) for pair in pairs.items() for cell in pair)})")


def get(key: Column, pairs: Mapping) -> Column:
    """Value for ``key``, null when there is none."""
    return F.element_at(as_map(pairs), key)


def strict(key: Column, pairs: Mapping, what: str = "key") -> Column:
    """Value for ``key``; an unknown or null key fails the job."""
    text = F.concat(F.lit(f"unknown {what}: "), F.coalesce(key.cast("string"), F.lit("null")))
    return F.coalesce(get(key, pairs), F.raise_error(text))


def with_default(key: Column, pairs: Mapping, default) -> Column:
    return F.coalesce(get(key, pairs), F.lit(default))


def is_unmatched(key: Column, pairs: Mapping) -> Column:
    """True where a lookup falls through, so that a quality check can count it."""
    return get(key, pairs).isNull()
