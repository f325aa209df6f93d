"""Counts the fixture notes give for the middle data folder."""

from pyspark.sql import functions as F

from sellerbooks.plans import catalog, ledger
from sellerbooks.queries import Books

FOLDER = "/root/testdata/sf0.01"


def test_listing_record_and_shipment_counts(spark):
    books = Books(spark, FOLDER)
    assert books.latest_listing.count() == 7997
    assert catalog.missing_products(books.latest_listing, books.inputs.product_data).count() == 401
    assert books.attach_record_id.filter("record_id <> ''").count() == 1500
    assert books.unfulfillable_pivot.count() == 133
    assert books.sync_diff.count() == 166


def test_cost_assignment_of_sold_units(spark):
    inputs = Books(spark, FOLDER).inputs
    start, end = "1990-01-01", F.lit("2100-01-01").cast("date")
    active = inputs.product_data.select("account_name", "sku", "asin")
    sold = ledger.order_ledger(inputs.all_orders, active, end, start)
    assert sold.count() == 19337
    no_stock = inputs.product_records.filter("starting_inventory < 0")
    receipts = ledger.receipt_rolling(inputs.po_records, active, no_stock, start)
    out = ledger.fifo_assign(
        ledger.ledger_rolling(sold), inputs.product_records, receipts, inputs.order_records.filter("false")
    )
    rows, matched = out.agg(F.count(F.lit(1)), F.count("record_id_num")).first()
    assert (rows, matched, rows - 19337) == (19482, 13711, 145)
