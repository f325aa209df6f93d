"""Product catalog and inventory snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sellerbooks.functions.columns import blank_to_null
from sellerbooks.operators.expand import column_or_null
from sellerbooks.operators.grouping import (
    conditional_sums,
    first_per_group,
    group_by_text,
    latest_per_key,
    latest_value,
    least,
)
from sellerbooks.operators.joins import lookup, same

PRODUCT = ("account_name", "asin", "sku")
# The dispositions that get a column.
DISPOSITIONS = {
    "DEFECTIVE": "defective",
    "WAREHOUSE_DAMAGED": "warehouse_damaged",
    "CUSTOMER_DAMAGED": "customer_damaged",
}


def latest_listing(all_listings: DataFrame) -> DataFrame:
    """Newest listing per asin and sku across accounts; ties by the other columns in order."""
    keys = ["asin1", "seller_sku"]
    ties = [F.col(c) for c in all_listings.columns if c not in (*keys, "open_date")]
    newest = latest_per_key(all_listings, keys, [F.col("open_date").desc(), *ties])
    return newest.withColumnsRenamed({"asin1": "asin", "seller_sku": "sku"})


def missing_products(listings: DataFrame, product_data: DataFrame) -> DataFrame:
    """Products that have no listing under the same account, asin and sku."""
    lacking = lookup(product_data, listings, same(*PRODUCT), how="left_anti")
    return lacking.select(
        "account_name", "asin", "sku", F.col("itemname").alias("item_name"), F.col("list_price").alias("price")
    )


def listings_with_missing(listings: DataFrame, product_data: DataFrame) -> DataFrame:
    """Listings with the missing products added as bare ones."""
    return listings.unionByName(missing_products(listings, product_data), allowMissingColumns=True)


def catalog(listings: DataFrame, product_data: DataFrame, inventory: DataFrame) -> DataFrame:
    """Listing, product attributes and stock code; a product is reduced to one row before each join."""
    named = product_data.filter(blank_to_null(F.col("asin"), ("", "0")).isNotNull())
    attributes = first_per_group(named.select(*PRODUCT, "asins", "style", "color", "size"), PRODUCT)
    codes = group_by_text(inventory, ["account_name", "sku"], *least("fnsku"))
    rows = lookup(
        listings,
        attributes,
        same(*PRODUCT),
        {"parent_asin": "asins", "style": "style", "color": "color", "size": "size"},
    )
    return lookup(rows, codes, same("account_name", "sku"), ["fnsku"])


def unfulfillable_pivot(ledger_summary: DataFrame) -> DataFrame:
    """Closing balances by damage kind on the last day of the ledger."""
    last_day = ledger_summary.filter(F.col("date") == latest_value(ledger_summary, "date"))
    grouped = group_by_text(
        last_day,
        ["account_name", "asin", "msku"],
        *least("date", "fnsku", "title"),
        *conditional_sums("disposition", DISPOSITIONS, "ending_warehouse_balance"),
    )
    return grouped.withColumnRenamed("msku", "sku")


def inventory_snapshot(inventory: DataFrame, reserved: DataFrame, unfulfillable: DataFrame) -> DataFrame:
    """Stock per product with reserved and damaged quantities."""
    reserved_columns = ["reserved_qty", "reserved_customerorders", "reserved_fc_transfers", "reserved_fc_processing"]
    rows = lookup(inventory, reserved, same("account_name", "sku", "asin"), reserved_columns)
    rows = lookup(rows, unfulfillable, same("account_name", "sku", "asin"), list(DISPOSITIONS.values()))
    inbound = ["afn_inbound_working_quantity", "afn_inbound_shipped_quantity", "afn_inbound_receiving_quantity"]
    total = sum((F.coalesce(F.col(c), F.lit(0)) for c in inbound), F.lit(0))
    return rows.select(
        "account_name",
        "sku",
        "asin",
        "condition",
        column_or_null(rows, "your_price", "decimal(12,2)").alias("price"),
        "mfn_listing_exists",
        "afn_listing_exists",
        F.col("mfn_fulfillable_quantity").alias("mfn_fulfillable_qty"),
        F.col("afn_warehouse_quantity").alias("afn_warehouse_qty"),
        F.col("afn_fulfillable_quantity").alias("afn_fulfillable_qty"),
        F.col("afn_unsellable_quantity").alias("afn_unsellable_qty"),
        *DISPOSITIONS.values(),
        total.alias("afn_inbound_qty"),
        F.col("afn_inbound_working_quantity").alias("afn_inbound_working"),
        F.col("afn_inbound_shipped_quantity").alias("afn_inbound_shipped"),
        F.col("afn_inbound_receiving_quantity").alias("afn_inbound_receiving"),
        F.col("afn_researching_quantity").alias("afn_researching_qty"),
        F.col("reserved_qty").alias("afn_reserved_qty"),
        F.col("reserved_customerorders").alias("afn_reserved_customer_orders"),
        F.col("reserved_fc_transfers").alias("afn_reserved_fc_transfers"),
        F.col("reserved_fc_processing").alias("afn_reserved_fc_processing"),
        F.col("afn_total_quantity").alias("afn_total_qty"),
    )
