import pytest

import __spark_entry__ as entry
from compare import connect, differences
from conftest import SF
from opinara.checks.queries import registry

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return connect(SF)


OWN = registry()


def test_every_query_has_its_sql():
    assert set(OWN) <= set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", OWN)
def test_query_agrees_with_its_sql(spark, db, name):
    count, examples = differences(QUERIES[name](spark, SF), db, SQL[name])
    assert count == 0, examples


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["review_report_unique", "emails_report", "translate", "detect_language", "parse_emails"])
def test_no_python_worker_in_default_plans(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
