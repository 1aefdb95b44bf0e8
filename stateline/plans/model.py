"""The state dimension, the two facts and the full run that makes them (PIP-5, PIP-8, RE-3)."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from stateline.operators import quality
from stateline.operators.joins import inner_on
from stateline.plans.cases import build_covid, clean_daily_cases
from stateline.plans.demographics import state_shares
from stateline.plans.institutions import build_education, clean_institutions
from stateline.plans.temperatures import seasonal_means
from stateline.session import scratch_deleted
from stateline.sources.manifest import STATE, TABLES
from stateline.sources.readers import read_raw
from stateline.sources.snapshots import Snapshot, Snapshots

SHARES = ("american_native", "asian", "african_american", "hispanic", "white")
SEASON_MEANS = ("avg_autumn_temp", "avg_spring_temp", "avg_summer_temp", "avg_winter_temp")


def build_state(demographic: DataFrame, temperature: DataFrame, how: str = "inner") -> DataFrame:
    """Both staging tables joined on the id (the two spell some names differently).

    The default keeps only states known to both.
    """
    means = temperature.drop("name_state").withColumnsRenamed(
        {
            "autumn": "avg_autumn_temp",
            "spring": "avg_spring_temp",
            "summer": "avg_summer_temp",
            "winter": "avg_winter_temp",
        }
    )
    if how == "inner":
        return inner_on(demographic, means, "id_state").select(*STATE.names)
    return demographic.join(means, "id_state", how).select(*STATE.names)


def model_checks(state: DataFrame, education: DataFrame, covid: DataFrame) -> DataFrame:
    """All rules of the model as one report: one scan for a table's row rules, one for each key."""
    return quality.all_checks(
        quality.check_rows(education, "education", ["id_institution"], ["n_students"]),
        quality.check_rows(
            state,
            "state",
            ["id_state"],
            extra=quality.shares_off(SHARES) | quality.mean_outside("avg_temp", SEASON_MEANS),
        ),
        quality.check_rows(covid, "covid", ["id_covid_data"]),
        quality.check_unique_ids(education, "education", "id_institution"),
        quality.check_unique_ids(state, "state", "id_state"),
        quality.check_unique_ids(covid, "covid", "id_covid_data"),
        quality.check_references(education, "education", state, "id_state"),
        quality.check_references(covid, "covid", state, "id_state"),
    )


#: Decimals of the raw amounts; sums of them do not depend on how rows are spread.
DECIMALS = {"people": 0, "staff": 2, "temperature": 3}

Tables = dict[str, Callable[[], DataFrame]]


@dataclass(frozen=True)
class Run:
    """Where a run reads and writes: the raw folder and a table prefix such as ``db.``.

    Tables are published together, as snapshots; steps read one snapshot each. ``decimals`` are those of the raw amounts (None adds doubles), ``reader_options`` go to the readers
    of the raw data sets, by name, ``plan_options`` to the cleaning plans, by staging table.
    """

    spark: SparkSession
    root: str
    prefix: str = ""
    decimals: Mapping[str, int | None] = field(default_factory=lambda: dict(DECIMALS))
    reader_options: Mapping[str, Mapping] = field(default_factory=dict)
    plan_options: Mapping[str, Mapping] = field(default_factory=dict)

    @property
    def snapshots(self) -> Snapshots:
        return Snapshots(self.spark, self.prefix)

    def raw(self, name: str) -> DataFrame:
        return read_raw(self.spark, self.root, name, **self.reader_options.get(name, {}))

    def staging(self) -> Tables:
        raw, exact = self.raw, self.decimals.get

        def options(name: str) -> Mapping:
            return self.plan_options.get(name, {})

        return {
            "staging_demographic": lambda: state_shares(
                raw("cities"), raw("population"), scale=exact("people"), **options("staging_demographic")
            ),
            "staging_education": lambda: clean_institutions(
                raw("public_schools"), raw("private_schools"), raw("colleges"), scale=exact("staff"),
                **options("staging_education"),
            ),
            "staging_temperature": lambda: seasonal_means(
                raw("temperatures"), scale=exact("temperature"), **options("staging_temperature")
            ),
            "staging_covid": lambda: clean_daily_cases(raw("daily_cases"), **options("staging_covid")),
        }

    def model(self, table: Callable[[str], DataFrame]) -> Tables:
        return {
            "state": lambda: build_state(table("staging_demographic"), table("staging_temperature")),
            "education": lambda: build_education(table("staging_education")),
            "covid": lambda: build_covid(table("staging_covid")),
        }

    def prepare(self, tables: Tables) -> dict[str, dict]:
        """Next versions of independent tables, written at the same time."""
        store = self.snapshots

        def write(name: str) -> dict:
            return store.prepare(tables[name](), name, TABLES[name])

        with ThreadPoolExecutor(len(tables)) as pool:
            return dict(zip(tables, pool.map(write, tables), strict=True))

    def stage(self) -> None:
        with scratch_deleted(self.spark):
            self.snapshots.publish(self.prepare(self.staging()))

    def build(self) -> None:
        """From the staging tables of one snapshot; refused if they are staged anew meanwhile."""
        read = self.snapshots.current()
        with scratch_deleted(self.spark):
            self.snapshots.publish(self.prepare(self.model(read.table)), read)

    def check(self) -> DataFrame:
        read = self.snapshots.current()
        return model_checks(read.table("state"), read.table("education"), read.table("covid"))

    def everything(self) -> list:
        """Clean → stage → build → check → publish; raises ``QualityError`` before anything is published."""
        prepared: dict[str, dict] = {}
        try:
            with scratch_deleted(self.spark):
                prepared |= self.prepare(self.staging())
                prepared |= self.prepare(self.model(Snapshot(self.spark, 0, prepared).table))
                made = Snapshot(self.spark, 0, prepared)
                report = quality.enforce(model_checks(*map(made.table, ("state", "education", "covid"))))
        except BaseException:
            self.snapshots.discard(prepared)
            raise
        self.snapshots.publish(prepared)
        return report


def run_all(spark: SparkSession, root: str, prefix: str = "", **options) -> list:
    """Clean → stage → build → check → publish. Raises ``QualityError`` when a rule is broken.

    Each step ends in written folders, so a lost executor costs a retry of a task. The tables change
    only after all checks of the new rows have passed, and all at once for whoever reads a snapshot: a
    failed run leaves those of the run before.
    """
    return Run(spark, root, prefix, **options).everything()
