"""Several tables published together (SNK-3, PIP-8).

A snapshot is one small file that names the folder and the columns of each table. The newest one is what
is published, and it appears by one rename: whoever reads through a snapshot sees tables that were
published together, whatever fails or runs at the same time. Folders are written once and never changed.
Those that no snapshot names any more stay for a grace period, so that readers which opened them can finish,
and are then swept.

The tables of the catalog follow a snapshot one by one. A run that dies between two of them leaves the
snapshot as it is, and the next publication, or ``follow``, brings the catalog up to it.
"""

from __future__ import annotations

import json
import time
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stateline.session import WAREHOUSE_DIR, delete, modified, names_in, read_text, write_text_once
from stateline.sources.sinks import VERSION_MARK, conform, prepare_table, switch_table

#: Seconds that folders and snapshots out of use stay: longer than any job that reads or writes them.
GRACE = 24 * 3600.0


class Conflict(RuntimeError):
    """Another run has published in between."""


@dataclass(frozen=True)
class Snapshot:
    """Tables published together: name to folder and columns. Number 0 is that before any was published."""

    spark: SparkSession
    number: int
    tables: Mapping[str, Mapping] = field(default_factory=dict)

    def schema(self, name: str) -> T.StructType:
        return T.StructType.fromJson(self.tables[name]["schema"])

    def table(self, name: str) -> DataFrame:
        """The table as it was published; later publications do not change what is read."""
        if name not in self.tables:
            raise KeyError(f"snapshot {self.number} has no table {name}")
        return self.spark.read.schema(self.schema(name)).parquet(self.tables[name]["folder"])

    def register(self, prefix: str = "") -> None:
        """Temporary views of all tables, for SQL in this session."""
        for name in self.tables:
            self.table(name).createOrReplaceTempView(f"{prefix}{name}")


class Snapshots:
    """The snapshots of the tables whose names in the catalog begin with ``prefix``, kept in ``root``."""

    def __init__(self, spark: SparkSession, prefix: str = "", root: str | None = None):
        self.spark, self.prefix = spark, prefix
        self.root = root or f"{spark.conf.get(WAREHOUSE_DIR).rstrip('/')}/_snapshots/{prefix.strip('._') or 'default'}"

    def numbers(self) -> list[int]:
        names = [name.removesuffix(".json") for name in names_in(self.spark, self.root) if name.endswith(".json")]
        return sorted(int(name) for name in names if name.isdigit())

    def _file(self, number: int) -> str:
        return f"{self.root}/{number:012d}.json"

    def at(self, number: int) -> Snapshot:
        return Snapshot(self.spark, number, json.loads(read_text(self.spark, self._file(number))))

    def current(self) -> Snapshot:
        numbers = self.numbers()
        return self.at(numbers[-1]) if numbers else Snapshot(self.spark, 0)

    def prepare(self, df: DataFrame, name: str, schema: T.StructType | None = None) -> dict:
        """Writes a table's next version; nothing is published. Its columns may be others than before."""
        result = df if schema is None else conform(df, schema)
        return {"folder": prepare_table(result, self.prefix + name, new_columns=True), "schema": result.schema.jsonValue()}

    def discard(self, prepared: Mapping[str, Mapping]) -> None:
        for entry in prepared.values():
            delete(self.spark, entry["folder"])

    def commit(self, prepared: Mapping[str, Mapping], read: Snapshot | None = None) -> Snapshot:
        """Publishes prepared tables together; tables not among them stay as they are.

        Tables made from those of a snapshot are only published if that is still the newest: with ``read``
        a ``Conflict`` is raised else. Without, a snapshot that another run adds meanwhile is built upon.
        """
        while True:
            base = self.current()
            if read is not None and base.number != read.number:
                raise Conflict(f"made from snapshot {read.number}, but {base.number} is published")
            tables = {**base.tables, **prepared}
            if write_text_once(self.spark, self._file(base.number + 1), json.dumps(tables, indent=1)):
                return Snapshot(self.spark, base.number + 1, tables)

    def follow(self) -> Snapshot:
        """Points the catalog's tables to the newest snapshot."""
        current = self.current()
        for name in current.tables:
            old = switch_table(self.spark, self.prefix + name, current.tables[name]["folder"], current.schema(name))
            if old is not None and VERSION_MARK not in old:
                delete(self.spark, old)  # what a table has before its first publication: no rows
        return current

    def publish(self, prepared: Mapping[str, Mapping], read: Snapshot | None = None, grace: float = GRACE) -> Snapshot:
        """Commits, lets the catalog follow, and sweeps."""
        self.commit(prepared, read)
        followed = self.follow()
        self.sweep(grace)
        return followed

    def sweep(self, grace: float = GRACE) -> list[str]:
        """Deletes snapshots that were replaced more than ``grace`` seconds ago, and folders of their tables that
        no other snapshot names and that have not changed for as long. Returns the folders.

        ``grace`` must be longer than the longest job that reads a snapshot or prepares one.
        """
        before = time.time() - grace
        numbers = self.numbers()
        written = modified(self.spark, self.root)
        # A snapshot is out of use from when the next one was written.
        out = [n for n, following in zip(numbers, numbers[1:], strict=False) if written[f"{following:012d}.json"] <= before]
        kept = {entry["folder"] for n in numbers if n not in out for entry in self.at(n).tables.values()}
        bases = {entry["folder"].partition(VERSION_MARK)[0] for n in numbers for entry in self.at(n).tables.values()}
        swept = []
        for base in sorted(bases):
            parent, _, name = base.rpartition("/")
            for folder, changed in modified(self.spark, parent).items():
                path = f"{parent}/{folder}"
                if folder.startswith(f"{name}{VERSION_MARK}") and path not in kept and changed <= before:
                    delete(self.spark, path)
                    swept.append(path)
        for number in out:
            delete(self.spark, self._file(number))
        return swept

    def drop(self) -> None:
        """Deletes all tables, from the catalog too, with all their versions."""
        names = {name for n in self.numbers() for name in self.at(n).tables}
        bases = {entry["folder"].partition(VERSION_MARK)[0] for n in self.numbers() for entry in self.at(n).tables.values()}
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.prefix}{name}")
        for base in bases:
            parent, _, name = base.rpartition("/")
            for folder in names_in(self.spark, parent):
                if folder.startswith(f"{name}{VERSION_MARK}"):
                    delete(self.spark, f"{parent}/{folder}")
        delete(self.spark, self.root)
