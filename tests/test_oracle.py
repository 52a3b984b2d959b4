"""Every query with check SQL, compared with DuckDB on the smallest tables."""

import pytest

from riskmart.catalog import ORACLE, QUERIES
from tests.oracle import TESTDATA, compare, connect

FOLDER = str(TESTDATA / "sf0.001")
# Minutes each, whatever the table: `python -m tests.oracle` compares them.
LONG = {"search_hyperparameters", "train_challenger"}


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(set(ORACLE) - LONG))
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, FOLDER, QUERIES[name], ORACLE[name]) == []
