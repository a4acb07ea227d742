"""Every registered query against its SQL on whole tables."""

import pytest

import __spark_entry__ as entry
from siftworks.plans import catalogue, oracles
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"
QUERIES = catalogue.all_queries()
ORACLES = oracles.all_oracles()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql_and_is_registered():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= entry.queries().items()
    assert ORACLES.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, ORACLES[name]) is None


def test_checks_on_membership_are_not_empty(con):
    assert len(con.execute(ORACLES["domain_violations_join"]).fetchall()) > 0
    assert len(con.execute(ORACLES["malformed_lines"]).fetchall()) > 0


def test_every_expectation_is_met(spark):
    report = QUERIES["expectation_report"](spark, SF).collect()
    assert len(report) == 23
    assert all(r["ok"] for r in report)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["reason", "count", "pct_of_input"]
    assert df.count() == 7


@pytest.mark.parametrize("scale", ["0.001", "0.01", "0.1"])
def test_the_rules_find_exactly_the_planted_faults(spark, scale):
    found = QUERIES["reconcile_summary"](spark, f"/root/testdata/sf{scale}").first()
    assert found["only_found"] == found["only_truth"] == 0
    assert found["matched"] == found["truth_keys"] == found["found_keys"] > 0
