"""``spark-submit``-able steps: ``python -m stateline run|stage|build|check ROOT [PREFIX]``,
``report NAME [PREFIX] [--gap …]``, ``county ROOT`` ``ingest LANDING LOG PROGRESS`` and ``profile LOG SKETCHES``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from stateline.operators import quality
from stateline.plans import reports
from stateline.plans.cases import county_profile
from stateline.plans.institutions import COLLEGE, PRIVATE, PUBLIC
from stateline.plans.model import Run, run_all
from stateline.sources.readers import read_raw
from stateline.streaming.incremental import ingest_daily_cases
from stateline.streaming.profiles import profile_cases


#: Steps of the staff and of the temperature report.
STAFF_STEP, DEGREES = 50, 5
#: Groups of equally many states in the report by rank of temperature.
GROUPS = 4
KINDS = {PUBLIC: "public", PRIVATE: "private", COLLEGE: "no_data"}


def report(run: Run, name: str, gap: str = reports.LAST) -> DataFrame:
    """One of the six questions, over the tables of one snapshot."""
    covid, state, education = map(run.snapshots.current().table, ("covid", "state", "education"))
    growth = reports.growth_over_gaps(covid, gap, zero_is_unknown=True)
    per_state = reports.state_growth(growth)
    questions = {
        "availability": lambda: reports.growth_by_availability(education, per_state),
        "mix": lambda: reports.availability_mix(education, per_state, KINDS),
        "staff": lambda: reports.growth_by_staff(education, per_state, STAFF_STEP),
        "season": lambda: reports.growth_by_season(growth, state),
        "temperature": lambda: reports.growth_by_temperature(per_state, state, DEGREES),
        "temperature_rank": lambda: reports.growth_by_temperature_rank(per_state, state, GROUPS),
        "race": lambda: reports.rate_by_share(reports.state_rates(covid, state)),
        "population": lambda: reports.rate_by_population(covid, state),
    }
    return questions[name]()


REPORTS = ("availability", "mix", "staff", "season", "temperature", "temperature_rank", "race", "population")


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="stateline")
    steps = parser.add_subparsers(dest="step", required=True)
    for name in ("run", "stage", "build", "check"):
        step = steps.add_parser(name)
        step.add_argument("root", help="folder of the raw files")
        step.add_argument("prefix", nargs="?", default="", help="table prefix, such as `health.`")
    answer = steps.add_parser("report")
    answer.add_argument("name", choices=REPORTS)
    answer.add_argument("prefix", nargs="?", default="")
    answer.add_argument("--gap", choices=(reports.LAST, reports.PER_DAY, reports.UNKNOWN), default=reports.LAST, help="growth after missing days")
    steps.add_parser("county").add_argument("root", help="folder of the raw files")
    ingest = steps.add_parser("ingest")
    for name in ("landing", "log", "progress"):
        ingest.add_argument(name)
    profile = steps.add_parser("profile")
    for name in ("log", "sketches"):
        profile.add_argument(name)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    given = arguments(argv)
    spark = SparkSession.builder.appName(f"stateline {given.step}").getOrCreate()
    if given.step == "ingest":
        ingest_daily_cases(spark, given.landing, given.log, given.progress)
        return
    if given.step == "profile":
        profile_cases(spark, given.log, given.sketches).show(truncate=False)
        return
    if given.step == "county":
        county_profile(read_raw(spark, given.root, "county_cases")).show(truncate=False)
        return
    if given.step == "report":
        report(Run(spark, "", given.prefix), given.name, given.gap).show(1000, truncate=False)
        return
    run = Run(spark, given.root, given.prefix)
    if given.step == "stage":
        run.stage()
    elif given.step == "build":
        run.build()
    else:
        rows = run_all(spark, given.root, given.prefix) if given.step == "run" else quality.enforce(run.check())
        for row in rows:
            print(f"{row.table_name:12} {row.rule:24} {row.column_name:16} {row.failures}")


if __name__ == "__main__":
    main()
