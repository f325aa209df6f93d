"""Inventory ledger and first-in-first-out cost assignment."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sellerbooks.functions.columns import text_in, text_is
from sellerbooks.operators.grouping import group_by_text, latest_value, least
from sellerbooks.operators.joins import lookup, range_assign, same
from sellerbooks.operators.ordered import (
    global_sequence,
    number_rows,
    previous_value,
    running_and_previous,
    running_sum,
)
from sellerbooks.sources.publish import map_values

SKU = ("account_name", "sku")
START = "2023-12-29"
COSTS = ("duties", "customs_fees", "demurrage", "container_cost", "trucking_cost")
LEDGER = ("account_name", "order_id", "date", "sku", "asin", "order_status", "item_status", "quantity")


def _from(column: str, start: str) -> Column:
    return F.col(column) >= F.lit(start).cast("date")


def po_eta_default(po: DataFrame, eta: str = "2023-10-04") -> DataFrame:
    """Completed orders without an arrival date get a fixed one."""
    blank = text_is("po_status", "Completed") & (F.col("eta") == "")
    return po.withColumn("eta", F.when(blank, eta).otherwise(F.col("eta")))


def active_skus(product_data: DataFrame, po: DataFrame, start: str = START) -> DataFrame:
    """Products with a purchase order that arrives on or after ``start``."""
    recent = po.filter(F.col("eta").try_cast("date") >= F.lit(start).cast("date"))
    return group_by_text(lookup(product_data, recent, same("sku"), how="left_semi"), SKU, *least("asin"))


def listed_skus(product_data: DataFrame, skus: Sequence[str]) -> DataFrame:
    """The products of a given sku list."""
    return group_by_text(product_data.filter(text_in("sku", skus)), SKU, *least("asin"))


def _active(df: DataFrame, active: DataFrame, sku: str = "sku", take=()) -> DataFrame:
    return lookup(df, active, {"account_name": "account_name", sku: "sku"}, take, how="inner")


def ledger_summary(
    summary: DataFrame, active: DataFrame, measures: Sequence[str], start: str = START, aggregate: bool = True
) -> DataFrame:
    """Daily movements of active skus per disposition; without ``aggregate`` the rows pass as they are."""
    keys = ["account_name", "msku", "date", "disposition"]
    rows = _active(summary.filter(_from("date", start)), active, "msku")
    if not aggregate:
        return rows.select(*keys, "asin", *measures)
    return group_by_text(rows, keys, *least("asin"), *[F.sum(m).cast("bigint").alias(m) for m in measures])


def ledger_events(
    detail: DataFrame, daily: DataFrame, active: DataFrame, summary: DataFrame, start: str = START
) -> DataFrame:
    """Ledger events with the closing balance of their day, newest first by ``id``.

    ``ranking`` numbers the events of a day and disposition by event type, then
    the other columns.
    """
    kept = detail.filter(
        _from("date", start)
        & (F.col("date") <= latest_value(summary, "date"))
        & ~text_in("event_type", ["WhseTransfers"])
    )
    rows = lookup(
        _active(kept, active, "msku"),
        daily,
        same("account_name", "msku", "date", "disposition"),
        ["ending_warehouse_balance"],
    )
    keys = ["account_name", "msku", "disposition", "date"]
    ties = [F.col(c) for c in ("event_type", "quantity", "reference_id")]
    ranked = number_rows(rows, keys, ties, "ranking")
    newest = [F.col("date").desc(), *[F.col(c) for c in ("account_name", "msku", "disposition", "ranking")]]
    return global_sequence(ranked, newest, "id").select(
        "id",
        "account_name",
        "date",
        "msku",
        "event_type",
        "quantity",
        "disposition",
        "ending_warehouse_balance",
        "ranking",
    )


def order_ledger(all_orders: DataFrame, active: DataFrame, last_day: Column, start: str = START) -> DataFrame:
    """Units sold per order, as negative quantities; own and cancelled orders are left out."""
    kept = all_orders.filter(
        _from("purchase_date", start)
        & (F.col("purchase_date") <= last_day)
        & ~F.lower("amazon_order_id").startswith("s")
        & ~text_in("order_status", ["Cancelled"])
        & ~text_in("item_status", ["unshipped", "Cancelled"])
    )
    rows = _active(kept, active).withColumnRenamed("amazon_order_id", "order_id")
    grouped = group_by_text(
        rows.withColumn("date", F.to_date("purchase_date")),
        ["account_name", "order_id", "sku"],
        *least("date", "asin", "order_status", "item_status"),
        F.sum(-F.col("quantity")).cast("bigint").alias("quantity"),
    )
    return grouped.select(*LEDGER)


def return_ledger(fba_returns: DataFrame, active: DataFrame, start: str = START) -> DataFrame:
    """Units returned per order and day, reimbursed ones left out."""
    kept = fba_returns.filter((F.lower("status") != "reimbursed") & _from("return_date", start))
    rows = _active(kept, active).withColumn("date", F.to_date("return_date"))
    grouped = group_by_text(
        rows,
        ["account_name", "order_id", "date", "sku"],
        *least("asin"),
        F.min("status").alias("item_status"),
        F.sum("quantity").cast("bigint").alias("quantity"),
    )
    return grouped.withColumn("order_status", F.lit("Return")).select(*LEDGER)


def removal_ledger(removals: DataFrame, active: DataFrame, start: str = START) -> DataFrame:
    """Units removed from the warehouse, as negative quantities."""
    day = F.to_date("request_date")
    kept = removals.filter((day >= F.lit(start).cast("date")) & (F.col("shipped_quantity") != 0))
    rows = _active(kept, active, take=["asin"]).select(
        "account_name",
        "order_id",
        day.alias("date"),
        "sku",
        "asin",
        F.col("removal_order_type").alias("order_status"),
        F.col("disposition").alias("item_status"),
        (-F.col("shipped_quantity")).cast("bigint").alias("quantity"),
    )
    return map_values(rows, "order_status", {"Return": "Vendor Removal"})


def removal_order_ledger(removals: DataFrame, active: DataFrame, start: str = START) -> DataFrame:
    """The variant over removal orders: completed ones only, without an asin."""
    day = F.to_date("request_date")
    kept = removals.filter((day >= F.lit(start).cast("date")) & text_is("order_status", "Completed"))
    return _active(kept, active).select(
        "account_name",
        "order_id",
        day.alias("date"),
        "sku",
        F.lit("").alias("asin"),
        F.lit("Removal").alias("order_status"),
        F.col("order_status").alias("item_status"),
        (-F.col("shipped_quantity")).cast("bigint").alias("quantity"),
    )


def adjustment_ledger(detail: DataFrame, active: DataFrame, start: str = START) -> DataFrame:
    kept = detail.filter(text_is("event_type", "Adjustments") & _from("date", start))
    return _active(kept, active, "msku").select(
        "account_name",
        F.col("reference_id").alias("order_id"),
        "date",
        F.col("msku").alias("sku"),
        "asin",
        F.col("event_type").alias("order_status"),
        F.col("event_type").alias("item_status"),
        F.col("quantity").cast("bigint").alias("quantity"),
    )


def ledger_rows(*parts: DataFrame) -> DataFrame:
    """All ledger parts as one set: identical rows count once."""
    return reduce(DataFrame.unionByName, [p.select(*LEDGER) for p in parts]).distinct()


def ledger_detail(*parts: DataFrame) -> DataFrame:
    """Ledger rows numbered by account, sku, date and order, then the other columns."""
    order = ["account_name", "sku", "date", "order_id", "asin", "order_status", "item_status", "quantity"]
    return global_sequence(ledger_rows(*parts), [F.col(c) for c in order], "id")


def ledger_rolling(rows: DataFrame) -> DataFrame:
    """Units consumed so far per account and sku, and the same for the row before.

    Rows of one day and order share a sum.
    """
    rows = rows.withColumn("_order", F.lower("order_id"))
    order = [F.col("date"), F.col("_order")]
    ties = [F.col(c) for c in ("asin", "order_status", "item_status", "quantity")]
    rolled = running_and_previous(rows, SKU, order, ties, -F.col("quantity"), "rolling_qty", "last_rolling_qty")
    return rolled.drop("_order")


def _received(po: DataFrame, active: DataFrame, arrived: Column) -> DataFrame:
    """Completed receipts with their cost per unit, numbered within account and sku by arrival."""
    kept = po.filter(text_is("po_status", "Completed") & (F.col("fba_shipment_id") != "") & arrived)
    per_unit = [F.round(F.try_divide(F.col(c), F.col("qty")), 6).cast("decimal(18,6)").alias(c) for c in COSTS]
    rows = _active(kept, active).select(
        "account_name",
        "record_id_num",
        "fba_shipment_id",
        "eta",
        "sku",
        "asin",
        F.lit("Received").alias("received"),
        "po_status",
        F.col("qty").cast("bigint").alias("qty"),
        F.col("unit_price").cast("decimal(18,6)").alias("unit_price"),
        *per_unit,
    )
    order = [F.col("eta"), F.col("record_id_num")]
    return number_rows(rows, SKU, order, "id")


def receipt_rolling(po: DataFrame, active: DataFrame, products: DataFrame, start: str = START) -> DataFrame:
    """Receipts with received units so far per account, sku and asin, starting stock first.

    The sum runs per asin but the previous value is that of the row before in the
    account and sku, whatever its asin.
    """
    arrived = F.col("eta").try_cast("date") >= F.lit(start).cast("date")
    receipts = _received(po, active, arrived)
    zero = [F.lit(0).cast("decimal(18,6)").alias(c) for c in ("unit_price", *COSTS)]
    stock = (
        products.filter(F.col("starting_inventory") > 0)
        .select(
            "account_name",
            F.lit(None).cast("bigint").alias("record_id_num"),
            F.lit("Starting Inventory").alias("fba_shipment_id"),
            F.lit(start).alias("eta"),
            "sku",
            "asin",
            F.lit("Received").alias("received"),
            F.lit("Completed").alias("po_status"),
            F.col("starting_inventory").cast("bigint").alias("qty"),
            *zero,
            F.lit(None).cast("bigint").alias("id"),
        )
        .distinct()
    )
    rows = receipts.unionByName(stock)
    # NULL ids sort first: starting stock comes before all receipts.
    rolled = running_sum(rows, [*SKU, "asin"], [F.col("id")], F.col("qty"), "rolling_qty")
    return previous_value(rolled, SKU, [F.col("id"), F.col("asin")], "rolling_qty", "last_rolling_qty")


def receipt_rolling_by_sku(po: DataFrame, active: DataFrame) -> DataFrame:
    """The variant without starting stock and without a start day; sum and previous value per account and sku."""
    rows = _received(po, active, F.lit(True))
    return running_and_previous(rows, SKU, [F.col("id")], [], F.col("qty"), "rolling_qty", "last_rolling_qty")


_RECEIPT = {"fba_shipment_id": "fba_shipment_id", "po_rolling_qty": "rolling_qty", "po_last_rolling_qty": "last_rolling_qty"}


def fifo_assign(ledger: DataFrame, products: DataFrame, receipts: DataFrame, orders: DataFrame) -> DataFrame:
    """Each ledger row with the receipt that supplied it, its cost per unit and its records.

    A row whose running quantity falls on a receipt boundary meets both receipts.
    """
    rows = lookup(
        ledger,
        products,
        same("account_name", "sku", "asin"),
        {"starting_inventory": "starting_inventory", "product_record_id": "record_id_num"},
    )
    rows = lookup(
        rows,
        orders,
        {
            "account_name": "source",
            "order_id": "amazon_order_id",
            "asin": "asin",
            "sku": "sku",
            "order_status": "order_status",
        },
        {"order_record_id": "record_id_num"},
    )
    costs = {c: c for c in ("record_id_num", "unit_price", *COSTS)}
    return range_assign(
        rows,
        receipts,
        same("account_name", "sku", "asin"),
        "rolling_qty",
        "last_rolling_qty",
        "rolling_qty",
        {**_RECEIPT, **costs},
    )


def fifo_assign_strict(ledger: DataFrame, receipts: DataFrame) -> DataFrame:
    """The variant by account and sku, in which a position meets one receipt at most."""
    return range_assign(
        ledger, receipts, same(*SKU), "rolling_qty", "last_rolling_qty", "rolling_qty", _RECEIPT, strict=True
    )
