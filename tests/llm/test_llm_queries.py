import pytest
from compare import connect, differences

from opinara.llm.queries import oracles, registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", oracles())
def test_query_agrees_with_its_sql(spark, db, name):
    count, examples = differences(registry()[name](spark, SF), db, oracles()[name])
    assert count == 0, examples


@pytest.mark.parametrize("name", registry())
def test_every_query_gives_rows(spark, name):
    assert registry()[name](spark, SF).count() > 0
