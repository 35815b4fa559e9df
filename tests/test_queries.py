"""Every registered query against its check SQL, and the shape of the plans."""

from __future__ import annotations

import re

import pytest
from compare import connect, differences

import __spark_entry__ as driver

SF = "/root/testdata/sf0.001"
# The operators for training data have tests of their own.
OWN = re.compile(r"[STWMQC]\d+")
QUERIES = {k: q for k, q in driver.queries().items() if OWN.fullmatch(k)}
CHECKS = {k: c for k, c in driver.oracle_sql().items() if OWN.fullmatch(k)}
# Too few rows at this scale: their cohorts need ten or twenty cases per group.
MAY_BE_EMPTY = {"Q05", "Q07", "T22"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)
    assert len(QUERIES) == 17 + 27 + 17 + 2 + 20 + 17


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_its_check(spark, duck, name):
    found = differences(QUERIES[name](spark, SF), duck, CHECKS[name])
    if name in MAY_BE_EMPTY:
        found = [f for f in found if f != "empty result"]
    assert found == []


REPORTS = [name for name in QUERIES if name[0] in "MQC"]


def plan(df) -> str:
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", REPORTS)
def test_reports_stay_on_built_in_operators(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert not re.search(r"CartesianProduct|NestedLoopJoin|PythonUDF|EvalPython|MapInPandas", text)


def test_date_limits_reach_the_scan(spark):
    for name in ("Q01", "Q02", "Q04", "Q07", "Q10", "Q13", "Q18"):
        filters = re.findall(r"PushedFilters: \[([^\]]*)", plan(QUERIES[name](spark, SF)))
        assert any("GreaterThanOrEqual(o_orderdate" in f for f in filters), name


def test_scans_read_only_what_a_report_needs(spark):
    (schema,) = re.findall(r"ReadSchema: struct<([^>]*)>", plan(QUERIES["Q14"](spark, SF)))
    assert "o_orderdate" in schema and "o_custkey" not in schema


def test_flagship(spark):
    assert driver.entry(spark).count() == 4
