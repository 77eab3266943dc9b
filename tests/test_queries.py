"""Every registered query against its SQL on the smallest shared tables that fill them all."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from tools.check import compare, oracle  # noqa: E402

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="shared tables are not here")


@pytest.fixture(scope="module")
def connection():
    return oracle(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, connection, name):
    assert compare(queries()[name](spark, SF), connection, oracle_sql()[name]) == ""


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_query_without_sql_gives_rows(spark, name):
    assert queries()[name](spark, SF).count() > 0


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["order_date", "category", "sub_category", "num_orders", "units_sold", "revenue"]
    assert df.count() > 0
