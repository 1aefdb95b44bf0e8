"""The cleaning plans and the full run on hand-made raw files with hand-computed results."""

import datetime as dt
import json
from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.errors import PySparkException

from stateline.__main__ import REPORTS
from stateline.__main__ import main as command
from stateline.operators.quality import QualityError
from stateline.plans import cases, demographics, institutions, model, reports, temperatures
from stateline.sources.manifest import CITIES, COLLEGES, DAILY_CASES, POPULATION, RAW, SCHOOLS, STATE_TEMPERATURES, TABLES
from stateline.operators import period_profile
from stateline.operators.profile import numeric_profile
from stateline.streaming import incremental, profiles

SCHOOL_COLUMNS = "NAME string, CITY string, STATE string, COUNTY string, COUNTRY string, ENROLLMENT double, FT_TEACHER double"
RACE = {v: k for k, v in demographics.RACES.items()}


def frame(spark, kinds, *data):
    return spark.createDataFrame(list(data), kinds)


# Daily cases.

CASES = [
    (20200302, "WA", 18.0, None, None, 6.0),
    (20200301, "WA", 10.0, 1.0, 2.0, None),
    (20200301, "AS", 0.0, None, None, None),
    (20200301, "AL", None, None, None, None),
]


def test_clean_daily_cases(spark, rows):
    found = cases.clean_daily_cases(frame(spark, DAILY_CASES, *CASES).repartition(3))
    assert found.columns == [
        "id_covid_data", "day_date", "name_state", "positive", "hospitalized_curr", "hospitalized_acum",
        "death", "id_state",
    ]
    first, second = dt.date(2020, 3, 1), dt.date(2020, 3, 2)
    assert rows(found) == [
        (0, first, "Alabama", 0.0, 0.0, 0.0, 0.0, 1),
        (1, first, "Washington", 10.0, 1.0, 2.0, 0.0, 56),
        (2, second, "Washington", 18.0, 0.0, 0.0, 6.0, 56),
    ]
    assert cases.build_covid(found).columns == [
        "id_covid_data", "day_date", "id_state", "positive", "hospitalized_curr", "hospitalized_acum", "death"
    ]


def test_cases_options(spark, rows):
    df = frame(spark, DAILY_CASES, *CASES)
    kept = cases.clean_daily_cases(df, left_out=(), missing_as_zero=False)
    assert kept.count() == 4
    assert kept.where("positive is null").count() == 1
    with pytest.raises(PySparkException, match="unknown state code: ZZ"):
        cases.clean_daily_cases(frame(spark, DAILY_CASES, (20200301, "ZZ", 1.0, 1.0, 1.0, 1.0))).collect()


def test_county_cases(spark, rows):
    df = frame(
        spark, "date string, county string, fips string, cases double, deaths double",
        ("2020-01-21", "Snohomish", "53061", 1.0, 0.0), ("2020-01-22", "Snohomish", "53061", 3.0, 0.0),
    )
    assert rows(cases.county_cases(df))[0] == (dt.date(2020, 1, 21), "Snohomish", 1.0, 0.0)
    assert rows(cases.county_profile(df), "column_name", "count", "mean", "q50") == [
        ("cases", 2, 2.0, 2.0), ("deaths", 2, 0.0, 0.0)
    ]


# Institutions.

PUBLIC = [
    ("B school", "Town", "AL", "C", "USA", 100.0, 10.0),
    ("A school", "Town", "AL", "C", "USA", -999.0, -999.0),
    ("No county", "Town", "AL", None, "USA", 400.0, 0.0),
]
PRIVATE = [("P1", "City", "GU", "C", "USA", 40.0, 4.0), ("P2", "City", "BI", "C", "USA", 0.0, 4.0)]
COLLEGE = [("U1", "Burg", "WA", "C", "USA", -999.0, 5.0), ("U2", "Burg", "WY", None, "USA", 900.0, 90.0)]


def test_clean_institutions(spark, rows):
    public, private = frame(spark, SCHOOLS, *PUBLIC), frame(spark, SCHOOLS, *PRIVATE)
    found = institutions.clean_institutions(public.repartition(3), private, frame(spark, COLLEGES, *COLLEGE))
    students, teachers = (100 + 400 + 40) / 3, (10 + 4 + 4) / 3
    expected = [
        (0, "A school", "Town", "Alabama", students, teachers, "public", 1),
        (1, "B school", "Town", "Alabama", 100.0, 10.0, "public", 1),
        (2, "P2", "City", "Alaska", 0.0, 4.0, "private", 2),
        (3, "P1", "City", "Guam", 40.0, 4.0, "private", 14),
        (4, "U1", "Burg", "Washington", -999.0, 5.0, "No data", 56),
        (5, "U2", "Burg", "Wyoming", 900.0, 90.0, "No data", 59),
    ]
    assert rows(found) == expected
    assert rows(institutions.defaulted_states(private)) == [(1,)]
    twice = found.unionAll(found)
    assert rows(institutions.build_education(twice)) == [(r[0], r[1], r[2], r[7], *r[4:7]) for r in expected]


def test_institutions_employed_only(spark):
    unstaffed = ("Q", "Town", "AL", "C", "USA", 5.0, 0.0)
    frames = [frame(spark, SCHOOLS, *PUBLIC, unstaffed), frame(spark, SCHOOLS, *PRIVATE), frame(spark, COLLEGES, *COLLEGE)]
    assert institutions.clean_institutions(*frames).count() == 7
    assert institutions.clean_institutions(*frames, employed_only=True).count() == 6


def test_same_institution_twice_gets_two_ids(spark):
    public = frame(spark, SCHOOLS, PUBLIC[0], PUBLIC[0], PUBLIC[0])
    found = institutions.clean_institutions(public, frame(spark, SCHOOLS, PRIVATE[0]), frame(spark, COLLEGES, COLLEGE[0]))
    assert sorted(r.id_institution for r in found.collect()) == [0, 1, 2, 3, 4]


def test_institution_profiles(spark):
    staged = frame(
        spark, "institution_name string, name_state string, n_students double, n_employees double, availability string",
        ("a", "Ohio", 10.0, 1.0, "public"), ("b", "Ohio", 20.0, 2.0, "private"), ("c", "Utah", 30.0, 3.0, "public"),
    )
    top = institutions.institutions_per_state(staged).collect()
    assert [tuple(r) for r in top] == [("Ohio", 2, 1.5, 15.0), ("Utah", 1, 3.0, 30.0)]
    kinds = {"public": "public", "private": "private"}
    table = {tuple(r) for r in institutions.availability_per_state(staged, kinds).collect()}
    assert table == {("Ohio", 1, 1), ("Utah", 1, 0)}
    ratios = institutions.students_per_employee(staged).collect()
    assert [tuple(r) for r in ratios] == [("private", 20.0, 2.0, 10.0), ("public", 20.0, 2.0, 10.0)]


# Shares and temperatures.


def test_state_shares(spark, rows):
    cities = frame(
        spark, CITIES,
        ("Alabama", RACE["white"], 30), ("Alabama", RACE["white"], 30), ("Alabama", RACE["asian"], 40),
        ("Puerto Rico", RACE["hispanic"], 5), (None, RACE["white"], 9),
    )
    people = frame(spark, POPULATION, (1000, "Alabama"), (500, "Wyoming"), (700, "District of Columbia"))
    found = rows(demographics.state_shares(cities, people))
    assert found == [
        (1, "Alabama", None, 0.4, None, None, 0.6, 1000),
        (10, "District of Columbia", None, None, None, None, None, 700),
        (46, "Puerto Rico", None, None, None, 1.0, None, None),
        (59, "Wyoming", None, None, None, None, None, 500),
    ]


def readings(*states):
    """Two years of monthly readings whose value is the month, one of them missing."""
    return [
        (f"{year}-{month:02d}-01", None if (year, month) == (1971, 8) else float(month), 0.1, state, country)
        for state, country in states
        for year in (1969, 1970, 1971)
        for month in range(1, 13)
    ]


def test_seasonal_means(spark, rows):
    data = readings(("Georgia (State)", "United States"), ("Acre", "Brazil"), ("District Of Columbia", "United States"))
    found = temperatures.seasonal_means(frame(spark, STATE_TEMPERATURES, *data).repartition(4))
    total = (2 * 78 - 8) / 23
    expected = (total, 11.0, 5.0, (7 + 7 + 8 + 9 + 9) / 5, 2.0)
    assert found.columns == ["id_state", "name_state", "avg_temp", "autumn", "spring", "summer", "winter"]
    assert rows(found) == [(10, "District Of Columbia", *expected), (13, "Georgia", *expected)]


def test_seasonal_means_by_city(spark, rows):
    data = [(*r[:3], "Miami" if r[3] == "Georgia" else "Rio", r[4]) for r in readings(("Georgia", "United States"), ("x", "Brazil"))]
    df = frame(
        spark, "dt string, AverageTemperature double, AverageTemperatureUncertainty double, City string, Country string",
        *data,
    )
    assert [r[0] for r in rows(temperatures.seasonal_means_by_city(df))] == ["Miami"]


def test_build_state_joins_on_the_id(spark, rows):
    demographic = frame(
        spark,
        "id_state long, name_state string, american_native double, asian double, african_american double, "
        "hispanic double, white double, total_population long",
        (10, "District of Columbia", 0.1, 0.2, 0.3, 0.2, 0.2, 7), (46, "Puerto Rico", None, None, None, 1.0, None, 5),
    )
    means = frame(
        spark,
        "id_state long, name_state string, avg_temp double, autumn double, spring double, summer double, winter double",
        (10, "District Of Columbia", 1.0, 2.0, 3.0, 4.0, 5.0),
    )
    state = model.build_state(demographic, means)
    assert state.columns[-4:] == ["avg_autumn_temp", "avg_spring_temp", "avg_summer_temp", "avg_winter_temp"]
    assert rows(state) == [(10, "District of Columbia", 0.1, 0.2, 0.3, 0.2, 0.2, 7, 1.0, 2.0, 3.0, 4.0, 5.0)]
    assert model.build_state(demographic, means, "left").count() == 2


# The full run.


def write_raw(root, college_students=900):
    def put(name, text):
        path = root / RAW[name].path
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)

    def csv(header, data):
        cell = lambda v: "" if v is None else str(v)
        return "\n".join([header, *[",".join(map(cell, row)) for row in data]]) + "\n"

    fields = [
        {"state": "Alabama", "race": RACE["white"], "count": 60}, {"state": "Alabama", "race": RACE["asian"], "count": 40},
        {"state": "Washington", "race": RACE["asian"], "count": 5},
    ]
    put("cities", json.dumps([{"datasetid": "d", "fields": f} for f in fields]))
    put("population", json.dumps([["POP_2021", "NAME", "state"], ["1000", "Alabama", "01"], ["200", "Washington", "53"], ["9", "Guam", "66"]]))
    names = "NAME,CITY,STATE,COUNTY,COUNTRY"
    put("public_schools", csv(f"X,{names},ENROLLMENT,ST_GRADE,FT_TEACHER", [(1, *r[:6], "PK", r[6]) for r in PUBLIC]))
    put("private_schools", csv(f"FID,{names},ENROLLMENT,FT_TEACHER,START_GRAD", [(1, *r, "KG") for r in PRIVATE]))
    colleges = [("U1", "Burg", "WA", "C", "USA", college_students, 5), COLLEGE[1]]
    put("colleges", csv(f"{names},TOT_ENROLL,TOT_EMPLOY,index", [(*r, 0) for r in colleges]))
    temps = readings(("Alabama", "United States"), ("Washington", "United States"))
    put("temperatures", csv("dt,AverageTemperature,AverageTemperatureUncertainty,State,Country", temps))
    put("daily_cases", csv("date,state,positive,negative,hospitalizedCurrently,hospitalizedCumulative,death", [(*r[:3], 7, *r[3:]) for r in CASES]))


def test_full_run(spark, tmp_path, rows):
    write_raw(tmp_path)
    report = model.run_all(spark, str(tmp_path), "run_")
    failures = {(r.table_name, r.rule, r.column_name): r.failures for r in report if r.failures}
    # Guam, Alaska and Wyoming have institutions but no row in `state`.
    assert failures == {("education", "foreign_key", "id_state"): 3}
    state = rows(spark.table("run_state"))
    assert [r[:2] for r in state] == [(1, "Alabama"), (56, "Washington")]
    assert state[0][3] == 0.4 and state[0][6] == 0.6 and state[0][7] == 1000
    assert state[0][8:] == ((2 * 78 - 8) / 23, 11.0, 5.0, 8.0, 2.0)
    education = rows(spark.table("run_education"))
    assert [r[0] for r in education] == list(range(6))
    assert education[2] == (2, "P2", "City", 2, 0.0, 4.0, "private")
    assert education[4] == (4, "U1", "Burg", 56, 900.0, 5.0, "No data")
    assert rows(spark.table("run_covid")) == [
        (0, dt.date(2020, 3, 1), 1, 0.0, 0.0, 0.0, 0.0),
        (1, dt.date(2020, 3, 1), 56, 10.0, 1.0, 2.0, 0.0),
        (2, dt.date(2020, 3, 2), 56, 18.0, 0.0, 0.0, 6.0),
    ]
    model.run_all(spark, str(tmp_path), "run_")
    assert spark.table("run_covid").count() == 3


def test_command_line(spark, tmp_path, capsys):
    write_raw(tmp_path)
    for step in ("stage", "build", "check"):
        command([step, str(tmp_path), "cli_"])
    printed = capsys.readouterr().out
    assert len(printed.splitlines()) == 11
    assert ["education", "foreign_key", "id_state", "3"] in [line.split() for line in printed.splitlines()]
    assert spark.table("cli_covid").count() == 3
    for name in REPORTS:
        command(["report", name, "cli_"])
    assert "mean_new_positive" in capsys.readouterr().out
    county = tmp_path / RAW["county_cases"].path
    county.write_text("date,county,state,fips,cases,deaths\n2020-03-01,King,WA,1,10,1\n2020-03-02,King,WA,1,30,\n")
    command(["county", str(tmp_path)])
    assert "20.0" in capsys.readouterr().out


def test_gate_reports_the_college(spark, tmp_path, rows):
    write_raw(tmp_path, college_students=-999)
    with pytest.raises(QualityError, match="education.n_students: non_negative, 1 rows"):
        model.run_all(spark, str(tmp_path), "gate_")
    # Nothing was published.
    assert spark.table("gate_education").count() == 0
    write_raw(tmp_path)
    model.run_all(spark, str(tmp_path), "gate_")
    good = {name: rows(spark.table(f"gate_{name}")) for name in TABLES}
    assert len(good["education"]) == 6
    write_raw(tmp_path, college_students=-999)
    with pytest.raises(QualityError):
        model.run_all(spark, str(tmp_path), "gate_")
    spark.catalog.clearCache()
    assert {name: rows(spark.table(f"gate_{name}")) for name in TABLES} == good
    warehouse = Path(urlparse(spark.conf.get("spark.sql.warehouse.dir")).path)
    assert len(list(warehouse.glob("gate_education*"))) == 1


def test_scratch_of_a_run_is_deleted(spark, tmp_path):
    write_raw(tmp_path)
    scratch = Path(spark.conf.get("spark.checkpoint.dir"))
    before = {p.name for p in scratch.glob("*")}
    model.run_all(spark, str(tmp_path), "tidy_")
    assert {p.name for p in scratch.glob("*")} == before


# Reports.

FACTS = "id_covid_data long, day_date date, id_state long, positive double, death double"


def case_rows(spark):
    day = lambda d: dt.date(2020, 3, d)
    return frame(
        spark, FACTS,
        (0, day(1), 1, 10.0, 0.0), (1, day(2), 1, 15.0, 1.0), (2, day(3), 1, 12.0, 1.0), (3, day(4), 1, 24.0, 2.0),
        (4, day(1), 2, 0.0, 0.0), (5, day(2), 2, 4.0, 0.0),
    )


def test_daily_growth(spark, rows):
    found = rows(reports.daily_growth(case_rows(spark).repartition(3)), "id_state", "day_date", "new_positive", "growth")
    assert [r[2:] for r in found] == [(None, None), (5.0, 0.5), (0.0, 0.0), (12.0, 1.0), (None, None), (4.0, None)]
    fresh = rows(reports.daily_growth(case_rows(spark), cumulative=False), "id_state", "day_date", "new_positive", "growth")
    assert [r[2] for r in fresh] == [10.0, 15.0, 12.0, 24.0, 0.0, 4.0]
    assert fresh[2][3] == -0.2
    known = reports.daily_growth(case_rows(spark), zero_is_unknown=True)
    assert known.where("id_state = 2").count() == 1


def test_growth_groups(spark, rows):
    growth = reports.state_growth(reports.daily_growth(case_rows(spark)))
    assert rows(growth) == [(1, 0.5), (2, None)]
    education = frame(
        spark, "id_state long, availability string, n_employees double",
        (1, "public", 5.0), (1, "public", 25.0), (1, "private", 5.0), (2, "public", 5.0),
    )
    assert rows(reports.growth_by_availability(education, growth)) == [("private", 1, 0.5), ("public", 3, 0.5)]
    assert rows(reports.growth_by_staff(education, growth, 10)) == [
        ("private", 0.0, 1, 0.5), ("public", 0.0, 2, 0.5), ("public", 20.0, 1, 0.5)
    ]
    # Institutions of a state without cases are counted.
    known = growth.where("id_state = 1")
    assert rows(reports.growth_by_availability(education, known)) == [("private", 1, 0.5), ("public", 3, 0.5)]
    found = reports.availability_mix(education, known, {"public": "public"})
    assert rows(found, "id_state", "n_institutions", "mean_growth") == [(1, 3, 0.5), (2, 1, None)]
    mix = reports.availability_mix(education, growth, {"public": "public", "private": "private"})
    assert rows(mix, "id_state", "n_institutions", "public", "mean_growth") == [
        (1, 3, 2 / 3, 0.5), (2, 1, 1.0, None)
    ]


def test_rates(spark, rows):
    state = frame(
        spark,
        "id_state long, name_state string, total_population long, american_native double, asian double, "
        "african_american double, hispanic double, white double, avg_temp double, avg_autumn_temp double, "
        "avg_spring_temp double, avg_summer_temp double, avg_winter_temp double",
        (1, "A", 100, 0.1, 0.1, 0.1, 0.1, 0.6, 12.0, 1.0, 2.0, 3.0, 4.0), (2, "B", 10, 0.2, 0.2, None, 0.2, 0.4, 17.0, 1.0, 2.0, 3.0, 4.0),
    )
    rates = reports.state_rates(case_rows(spark), state)
    assert rows(rates, "id_state", "positive_rate", "death_rate") == [(1, 0.24, 0.02), (2, 0.4, 0.0)]
    by_race = {r.race: (r.n_states, r.positive_correlation) for r in reports.rate_by_share(rates).collect()}
    assert by_race["asian"][0] == 2 and by_race["asian"][1] == pytest.approx(1.0)
    assert by_race["white"][1] == pytest.approx(-1.0)
    assert by_race["african_american"][0] == 1
    # A state with cases but no population keeps its rows, without rates.
    fewer = reports.state_rates(case_rows(spark), state.where("id_state = 1"))
    assert rows(fewer, "id_state", "positive_rate") == [(1, 0.24), (2, None)]
    counted = {(r.race, r.n_reported, r.n_states) for r in reports.rate_by_share(fewer).collect()}
    assert ("asian", 2, 1) in counted
    assert reports.rate_by_population(case_rows(spark), state.where("id_state = 1")).count() == 6
    daily = rows(reports.rate_by_population(case_rows(spark), state), "id_state", "day_date", "positive_rate")
    assert daily[1] == (1, dt.date(2020, 3, 2), 0.15)
    growth = reports.daily_growth(case_rows(spark))
    season = reports.growth_by_season(growth, state).first()
    assert (season.season, season.n_days, season.n_known, season.mean_temp) == ("winter", 4, 4, 4.0)
    season = reports.growth_by_season(growth, state.where("id_state = 1")).first()
    assert (season.n_days, season.n_known, season.mean_temp) == (4, 3, 4.0)
    buckets = rows(reports.growth_by_temperature(reports.state_growth(growth), state, 5))
    assert buckets == [(10.0, 1, 0.5), (15.0, 0, None)]
    fewer = reports.growth_by_temperature(reports.state_growth(growth), state.where("id_state = 1"), 5)
    assert rows(fewer) == [(10.0, 1, 0.5), (None, 0, None)]


# Incremental ingestion.


def test_incremental_equals_batch(spark, tmp_path, rows):
    landing, log, progress = (str(tmp_path / n) for n in ("landing", "log", "progress"))
    (tmp_path / "landing").mkdir()
    header = ",".join(DAILY_CASES.names)

    def land(name, *lines):
        (tmp_path / "landing" / name).write_text("\n".join([header, *lines]) + "\n")

    def check(expected):
        incremental.ingest_daily_cases(spark, landing, log, progress)
        found = rows(incremental.current_cases(spark, log))
        assert found == rows(incremental.batch_cases(spark, landing))
        assert [(r[0], r[1].day, r[2], r[3]) for r in found] == expected

    land("a.csv", "20200301,WA,10,,,", "20200302,WA,18,,,6", "20200301,AS,0,,,")
    check([(0, 1, "Washington", 10.0), (1, 2, "Washington", 18.0)])
    land("b.csv", "20200303,WA,30,,,6", "20200303,AL,1,,,")
    check([(0, 1, "Washington", 10.0), (1, 2, "Washington", 18.0), (2, 3, "Alabama", 1.0), (3, 3, "Washington", 30.0)])
    land("c.csv", "20200302,WA,20,,,7")
    corrected = [(0, 1, "Washington", 10.0), (1, 2, "Washington", 20.0), (2, 3, "Alabama", 1.0), (3, 3, "Washington", 30.0)]
    check(corrected)
    check(corrected)

    # The same name again is not read: a correction needs a new name.
    land("c.csv", "20200302,WA,99,,,7")
    incremental.ingest_daily_cases(spark, landing, log, progress)
    assert rows(incremental.current_cases(spark, log))[1][3] == 20.0

    # One file per batch, and a batch that runs again because its commit was lost: the same rows.
    log, progress = str(tmp_path / "log2"), tmp_path / "progress2"
    incremental.ingest_daily_cases(spark, landing, log, str(progress), files_per_batch=1)
    expected = rows(incremental.batch_cases(spark, landing))
    assert len(list((tmp_path / "log2").glob("version=*"))) == 3
    assert rows(incremental.current_cases(spark, log)) == expected
    for name in ("2", ".2.crc"):
        (progress / "commits" / name).unlink(missing_ok=True)
    incremental.ingest_daily_cases(spark, landing, log, str(progress), files_per_batch=1)
    assert incremental.months(spark, log) == {"2020-03": 2}
    assert rows(incremental.current_cases(spark, log)) == expected

    # A fresh checkpoint would start the versions anew.
    with pytest.raises(ValueError, match="another checkpoint"):
        incremental.ingest_daily_cases(spark, landing, log, str(tmp_path / "progress3"))


def test_untouched_months_stay_as_they_were(spark, tmp_path, rows):
    landing, log, progress = (str(tmp_path / n) for n in ("landing", "log", "progress"))
    (tmp_path / "landing").mkdir()
    header = ",".join(DAILY_CASES.names)

    def land(name, *lines):
        (tmp_path / "landing" / name).write_text("\n".join([header, *lines]) + "\n")
        incremental.ingest_daily_cases(spark, landing, log, progress)

    def files(month):
        return {f: f.stat().st_mtime_ns for f in (tmp_path / "log").glob(f"*/month={month}/*.parquet")}

    land("a.csv", "20200301,WA,10,,,", "20200401,WA,18,,,6")
    march, april = files("2020-03"), files("2020-04")
    land("b.csv", "20200402,WA,30,,,6", "20200401,WA,20,,,6", "20200501,AL,1,,,")
    assert files("2020-03") == march
    assert incremental.versions(spark, log) == {"2020-03": [0], "2020-04": [0, 1], "2020-05": [1]}
    found = rows(incremental.current_cases(spark, log))
    assert [r[3] for r in found] == [10.0, 20.0, 30.0, 1.0]
    assert found == rows(incremental.batch_cases(spark, landing))
    land("c.csv", "20200403,WA,40,,,6")
    assert incremental.versions(spark, log) == {"2020-03": [0], "2020-04": [1, 2], "2020-05": [1]}
    assert files("2020-03") == march and not files("2020-04").keys() & april.keys()


def test_ids_grow_without_a_shuffle(spark, tmp_path, rows, monkeypatch):
    """Months read alone, offsets from the index; rows put into an early month move the later ids, not their files."""
    landing, log, progress = (str(tmp_path / n) for n in ("landing", "log", "progress"))
    (tmp_path / "landing").mkdir()
    header = ",".join(DAILY_CASES.names)
    states = ["WA", "AL", "OH", "TX", "UT"]

    def land(name, *days):
        lines = [f"{day},{state},{i + day % 7},,," for day in days for i, state in enumerate(states)]
        (tmp_path / "landing" / name).write_text("\n".join([header, *lines]) + "\n")
        incremental.ingest_daily_cases(spark, landing, log, progress)

    land("a.csv", *range(20200301, 20200321), *range(20200401, 20200421))
    land("b.csv", *range(20200501, 20200511))
    later = {m: sorted(p.name for p in (tmp_path / "log").glob(f"*/month={m}/*.parquet")) for m in ("2020-04", "2020-05")}
    land("c.csv", *range(20200321, 20200331))
    assert {m: sorted(p.name for p in (tmp_path / "log").glob(f"*/month={m}/*.parquet")) for m in later} == later
    found = incremental.index(spark, log)
    assert {m: e["rows"] for m, e in found.items()} == {"2020-03": 150, "2020-04": 100, "2020-05": 50}
    assert incremental.offsets(found) == {"2020-03": 0, "2020-04": 150, "2020-05": 250}
    current = incremental.current_cases(spark, log)
    plan = current._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" in plan
    for unwanted in ("hashpartitioning", "rangepartitioning", "SinglePartition", "Window", "Sort "):
        assert unwanted not in plan
    assert [r[0] for r in rows(current)] == list(range(300))
    assert rows(current) == rows(incremental.batch_cases(spark, landing))
    # A file for each month and range at most, not one for each month and shuffle partition.
    assert len(list((tmp_path / "log" / "version=0").glob("month=*/*.parquet"))) <= 2 + 4


def test_profile_of_months(spark, tmp_path, rows, monkeypatch):
    """Only changed months are sketched again, and the profile is that of all rows."""
    landing, log, progress, store = (str(tmp_path / n) for n in ("landing", "log", "progress", "sketches"))
    (tmp_path / "landing").mkdir()
    header = ",".join(DAILY_CASES.names)

    def land(name, *days):
        lines = [f"{d},{s},{(d * 7919 + i) % 997},{i},,{d % 5}" for d in days for i, s in enumerate(("WA", "AL", "OH", "TX"))]
        (tmp_path / "landing" / name).write_text("\n".join([header, *lines]) + "\n")
        incremental.ingest_daily_cases(spark, landing, log, progress)

    def expected():
        current = incremental.current_cases(spark, log)
        found = numeric_profile(current, profiles.MEASURES).collect()
        return sorted([tuple(r) for r in found])

    def close(found):
        got = sorted(tuple(r)[:-1] for r in found.collect())
        assert [r[:2] for r in got] == [r[:2] for r in expected()]
        for mine, theirs in zip(got, expected(), strict=True):
            assert mine[2:] == pytest.approx(theirs[2:], rel=1e-12)

    land("a.csv", *range(20200301, 20200331), *range(20200401, 20200425))
    assert profiles.refresh_sketches(spark, log, store) == ["2020-03", "2020-04"]
    close(profiles.profile_cases(spark, log, store))
    land("b.csv", *range(20200420, 20200430), *range(20200501, 20200505))
    assert profiles.refresh_sketches(spark, log, store) == ["2020-04", "2020-05"]
    assert profiles.refresh_sketches(spark, log, store) == []
    assert profiles.kept_sketches(spark, store).keys() == {"2020-03", "2020-04", "2020-05"}
    close(profiles.profile_cases(spark, log, store))
    # The sketches only enclose: if they are wrong, or too wide to rank at once, the result is the same.
    monkeypatch.setattr(period_profile, "SLACK", 0.0)
    close(profiles.profile_cases(spark, log, store))
    monkeypatch.setattr(period_profile, "KEPT_VALUES", -1)
    close(profiles.profile_cases(spark, log, store))
    with pytest.raises(ValueError, match="nothing was ingested"):
        profiles.profile_cases(spark, str(tmp_path / "nowhere"), store)


def test_batch_that_dies_before_its_index(spark, tmp_path, rows, monkeypatch):
    """Readers see the batch before; the batch runs again and is counted once."""
    landing, log, progress = (str(tmp_path / n) for n in ("landing", "log", "progress"))
    (tmp_path / "landing").mkdir()
    header = ",".join(DAILY_CASES.names)
    (tmp_path / "landing" / "a.csv").write_text(f"{header}\n20200301,WA,10,,,\n")
    incremental.ingest_daily_cases(spark, landing, log, progress)
    before = rows(incremental.current_cases(spark, log))
    (tmp_path / "landing" / "b.csv").write_text(f"{header}\n20200301,WA,11,,,\n20200302,WA,12,,,\n")
    with monkeypatch.context() as broken:
        broken.setattr(incremental, "write_text_once", lambda *_: 1 / 0)
        with pytest.raises(Exception, match="division by zero"):
            incremental.ingest_daily_cases(spark, landing, log, progress)
    assert rows(incremental.current_cases(spark, log)) == before
    incremental.ingest_daily_cases(spark, landing, log, progress)
    assert [(r[0], r[3]) for r in rows(incremental.current_cases(spark, log))] == [(0, 11.0), (1, 12.0)]
    assert rows(incremental.current_cases(spark, log)) == rows(incremental.batch_cases(spark, landing))


def test_landed_long_line_fails(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(",".join(DAILY_CASES.names) + "\n20200301,WA,10,,,1,2\n")
    with pytest.raises(Exception, match="more than 6 cells"):
        incremental.ingest_daily_cases(spark, str(tmp_path / "in"), str(tmp_path / "log"), str(tmp_path / "progress"))
    with pytest.raises(PySparkException, match="more than 6 cells"):
        incremental.batch_cases(spark, str(tmp_path / "in")).collect()


def test_landed_files_with_more_columns(spark, tmp_path, rows):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(
        "state,hash,date,death,positive,hospitalizedCumulative,hospitalizedCurrently\nWA,x,20200301,NA,10,,2\n"
    )
    landing, log = str(tmp_path / "in"), str(tmp_path / "log")
    incremental.ingest_daily_cases(spark, landing, log, str(tmp_path / "progress"))
    expected = [(0, dt.date(2020, 3, 1), "Washington", 10.0, 2.0, 0.0, 0.0, 56)]
    assert rows(incremental.current_cases(spark, log)) == expected
    assert rows(incremental.batch_cases(spark, landing)) == expected
