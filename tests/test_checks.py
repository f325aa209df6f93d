"""Every registered query equals its check SQL on the smallest data folder."""

import pytest

from sellerbooks import checks, queries
from tools.compare import compare, views

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return views(FOLDER)


@pytest.mark.parametrize("name", queries.names())
def test_query_equals_check(spark, con, name):
    same, note = compare(spark, con, FOLDER, name)
    assert same, note


def test_entry_contract():
    import __spark_entry__ as entry

    assert set(queries.names()) <= set(entry.queries()) and set(queries.names()) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert all(checks.columns_of(n) for n in queries.names())


def test_inputs_exercise_what_the_checks_claim(spark):
    """Case varies inside groups, a row stands for over 100 units, and published products match."""
    books = queries.Books(spark, FOLDER)
    spelled = books.inputs.order_items.groupBy("account_name", "amazon_order_id", "sku").count().count()
    folded = books.inputs.order_items.selectExpr("lower(account_name)", "lower(amazon_order_id)", "lower(sku)").distinct().count()
    assert spelled > folded
    assert books.return_units.selectExpr("max(order_line_units)").first()[0] > 100
    products, catalog = books._products, books.catalog
    both = products.join(catalog.selectExpr("upper(account_name) account_name", "sku", "upper(asin) asin").distinct(), ["account_name", "sku", "asin"])
    assert both.count() > 0
