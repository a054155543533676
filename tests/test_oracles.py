"""Every registered query against its DuckDB oracle, at the smallest scale factor."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import compare, duck  # noqa: E402
from tierforge.plans import catalog  # noqa: E402

NAMES = list(catalog.queries())


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, sf_dir, name):
    res = compare(spark, con, name, sf_dir)
    assert str(res["status"]).startswith("match"), res


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["order_number", "product_key", "customer_key", "order_date", "ship_date", "due_date",
                          "sales_amount", "quantity", "fixed_price"]
