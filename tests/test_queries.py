"""All registered queries: results against DuckDB, and what their plans must not hold."""

from pathlib import Path

import pytest

import __spark_entry__ as driver
import check
from stateline.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return check.open_tables(FOLDER)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, db, name):
    frame = driver.queries()[name](spark, FOLDER)
    rows, problems = check.compare(frame, driver.oracle_sql()[name], db)
    assert not problems
    assert rows or name == "dq_orphans"
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InArrow"):
        assert unwanted not in plan


def test_entry(spark):
    found = driver.entry(spark)
    assert found.columns[:2] == ["id_state", "name_state"]
    assert found.count() == 25


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()
    assert driver.queries().keys() >= QUERIES.keys()


def test_whole_reports_know_all_nations(spark):
    growth = QUERIES["type_mix_and_growth_whole"](spark, FOLDER)
    assert growth.where("mean_growth is null").isEmpty()
    rates = QUERIES["rate_by_population_whole"](spark, FOLDER)
    assert {r.id_state for r in rates.where("positive_rate is not null").select("id_state").distinct().collect()} == set(range(25))
