"""Feeds for the record store: rows to publish and the payload each becomes.

A feed returns its key columns, ``batch_id`` where it is published in batches,
and ``payload``. Missing values are blank text. ``fields`` maps column names to
field ids; without it ids are consecutive.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sellerbooks.functions.columns import day_text, second_text, text_or
from sellerbooks.operators.expand import day_spine
from sellerbooks.operators.grouping import group_by_text, latest_per_key, least, sync_diff
from sellerbooks.operators.joins import attach_ids, lookup, same, unpublished
from sellerbooks.operators.ordered import batches, number_rows
from sellerbooks.session import materialise
from sellerbooks.sources.publish import numbered_fields, payload, still_published

PRODUCT = ("account_name", "sku", "asin")
BATCH = 1000
# Fixed value: the state of fee rows that are replaced by each load.
OPEN = "Open"
# Shipment states that may still change, so their rows are purged before a load.
OPEN_SHIPMENTS = (
    "RECEIVING",
    "DELIVERED",
    "WORKING",
    "READY_TO_SHIP",
    "SHIPPED",
    "ERROR",
    "IN_TRANSIT",
    "CHECKED_IN",
)

PRODUCT_FIELDS = (
    "item_name",
    "sku",
    "parent_asin",
    "asin",
    "size",
    "color",
    "price",
    "listing_id",
    "fnsku",
    "account_name",
    "open_date",
    "style",
)
SALES_FIELDS = (
    "record_id",
    "account_name",
    "quantity",
    "purchase_date",
    "item_price",
    "asin",
    "amazon_order_id",
    "merchant_order_id",
    "order_status",
    "sku",
    "item_status",
    "currency",
    "item_tax",
    "ship_city",
    "ranking",
    "fba_fee",
    "commission",
    "order_type",
)
RETURN_FIELDS = (
    "record_id",
    "account_name",
    "quantity",
    "purchase_date",
    "asin",
    "order_id",
    "merchant_order_id",
    "order_status",
    "product_name",
    "sku",
    "item_status",
    "ranking",
    "group_id",
    "principal",
    "fba_fee",
    "commission",
    "order_type",
)
ORDER_FEE_FIELDS = (
    "account_name",
    "settlement_id",
    "status",
    "order_id",
    "sku",
    "fba_fee",
    "commission",
    "asin",
    "record_id",
    "start_date",
    "end_date",
    "posted_date",
    "transaction_type",
    "group_id",
    "ranking",
)
FEE_FIELDS = (
    "status",
    "account_name",
    "settlement_id",
    "currency",
    "settlement_start_date",
    "settlement_end_date",
    "total_amount",
    "transaction_type",
    "amount_type",
    "amount_description",
    "posted_date",
    "sku",
    "asin",
    "amount",
    "record_id",
)


def upper_keys(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns or PRODUCT:
        df = df.withColumn(c, F.upper(c))
    return df


def _with_record(df: DataFrame, products: DataFrame) -> DataFrame:
    """Upper-case product keys and the record id of the product, as text."""
    found = attach_ids(upper_keys(df), products, same(*PRODUCT), ["record_id"])
    return found.withColumn("record_id", text_or(F.col("record_id")))


def _texts(df: DataFrame, **columns: Column) -> DataFrame:
    return df.withColumns(columns)


def _payload(df: DataFrame, columns: Sequence[str], fields: Mapping[str, str] | None) -> DataFrame:
    return payload(df, fields or numbered_fields(columns))


def product_feed(catalog: DataFrame, published: DataFrame, fields: Mapping[str, str] | None = None) -> DataFrame:
    """Products on one side only, by upper-case account and asin and the sku."""
    rows = upper_keys(catalog, "account_name", "asin")
    changed = sync_diff(rows, published.select(*PRODUCT), list(PRODUCT))
    changed = _texts(changed, open_date=second_text(F.col("open_date")))
    return _payload(changed, PRODUCT_FIELDS, fields).select(*PRODUCT, "payload")


def sales_feed(
    orders: DataFrame, products: DataFrame, since: str, fields: Mapping[str, str] | None = None
) -> DataFrame:
    """Assigned orders from ``since`` on, with the day they are published under."""
    rows = orders.filter(F.col("purchase_date") >= F.lit(since).cast("date"))
    rows = _with_record(rows, products).withColumn("sale_day", F.to_date("purchase_date"))
    rows = _texts(rows, purchase_date=second_text(F.col("purchase_date")), order_type=F.lit("Sale"))
    return _payload(rows, SALES_FIELDS, fields).select("sale_day", "payload")


def returns_feed(
    returns: DataFrame, products: DataFrame, since: str, fields: Mapping[str, str] | None = None
) -> DataFrame:
    rows = returns.filter(F.col("purchase_date") >= F.lit(since).cast("date"))
    rows = _texts(
        _with_record(rows, products),
        purchase_date=second_text(F.col("purchase_date")),
        order_type=F.lit("Return"),
    )
    rows = _payload(rows, RETURN_FIELDS, fields)
    order = [F.col(c) for c in ("account_name", "order_id", "sku", "ranking", "group_id", "payload")]
    return batches(rows, order, BATCH).select("batch_id", "payload")


def settlement_ids(posted: DataFrame, opened: DataFrame) -> DataFrame:
    ids = [f.select(F.col("settlement_id").cast("string").alias("settlement_id")) for f in (posted, opened)]
    return ids[0].union(ids[1]).distinct()


def order_fee_feed(
    fees: DataFrame, published: DataFrame, products: DataFrame, fields: Mapping[str, str] | None = None
) -> DataFrame:
    """Order fees of settlements not published yet, in batches within each settlement.

    Published rows that are still open are replaced, so their ids do not count as published.
    """
    published = still_published(published, "status", [OPEN])
    order = [F.col(c) for c in ("account_name", "order_id", "sku", "transaction_type", "group_id", "ranking")]
    rows = unpublished(fees, published, "settlement_id")
    rows = number_rows(rows, ["settlement_id"], order, "_row")
    rows = rows.withColumn("batch_id", F.floor((F.col("_row") - 1) / BATCH).cast("bigint"))
    rows = _texts(
        _with_record(rows, products),
        fba_fee=text_or(F.col("fba_fee"), "0"),
        commission=text_or(F.col("commission"), "0"),
        start_date=day_text(F.col("start_date")),
        end_date=day_text(F.col("end_date")),
        posted_date=day_text(F.col("posted_date")),
    )
    return _payload(rows, ORDER_FEE_FIELDS, fields).select("settlement_id", "batch_id", "payload")


def _fee_texts(rows: DataFrame, products: DataFrame) -> DataFrame:
    return _texts(
        _with_record(rows, products),
        settlement_start_date=second_text(F.col("settlement_start_date")),
        settlement_end_date=second_text(F.col("settlement_end_date")),
        posted_date=second_text(F.col("posted_date")),
    )


def finance_fee_feed(
    upload: DataFrame, products: DataFrame, fields: Mapping[str, str] | None = None
) -> DataFrame:
    """Open finance rows with a settlement start."""
    rows = _fee_texts(upload.filter(F.col("settlement_start_date").isNotNull()), products)
    rows = _payload(rows, FEE_FIELDS, fields)
    order = [F.col(c) for c in ("account_name", "settlement_id", "sku", "payload")]
    return batches(rows, order, BATCH).select("batch_id", "payload")


def settlement_fee_feed(
    settlements: DataFrame,
    asins: DataFrame,
    published: DataFrame,
    products: DataFrame,
    since: str,
    fields: Mapping[str, str] | None = None,
) -> DataFrame:
    """Fees per settlement that started on or after ``since`` and is not published yet."""
    recent = settlements.filter(F.col("settlement_start_date") >= F.lit(since).cast("date"))
    # A short list of ids, written out so that the planner knows its size: a shuffle of
    # the settlement lines by id would put each settlement into one task.
    wanted = materialise(unpublished(recent.select("settlement_id").distinct(), published, "settlement_id"))
    rows = lookup(settlements, wanted, same("settlement_id"), how="left_semi")
    keys = [c for c in FEE_FIELDS if c not in ("status", "asin", "amount", "record_id", "currency")]
    # Summed per spelling and currency first, where the aggregation hashes; the least ones are picked from those sums.
    summed = rows.groupBy(*keys, "currency").agg(F.sum("amount").cast("decimal(18,4)").alias("amount"))
    summed = group_by_text(summed, keys, *least("currency"), F.sum("amount").cast("decimal(18,4)").alias("amount"))
    # One asin per account and sku, so it is looked up after the sum.
    summed = lookup(summed, asins, same("account_name", "sku"), ["asin"]).withColumn("status", F.lit("Posted"))
    return _payload(_fee_texts(summed, products), FEE_FIELDS, fields).select("settlement_id", "payload")


def shipment_feed(
    shipments: DataFrame, published: DataFrame, fields: Mapping[str, str] | None = None
) -> DataFrame:
    """Shipments the record store does not have, or has in a state that may still change."""
    keys = ["account_name", "shipmentid"]
    final = still_published(published, "shipmentstatus", OPEN_SHIPMENTS)
    new = sync_diff(shipments, final.select(*keys), keys, keep="source")
    return _payload(new, shipments.columns, fields).select(*keys, "payload")


def shipment_details(details: DataFrame, catalog: DataFrame) -> DataFrame:
    """Shipment rows with the asin of the catalog, or a stock code that is itself an asin."""
    rows = lookup(details, catalog, {"account_name": "account_name", "sellersku": "sku"}, ["asin"])
    code = F.col("fulfillmentnetworksku")
    own = F.when(F.lower(code).startswith("b"), code)
    return upper_keys(
        rows.select(
            "account_name",
            "shipmentid",
            F.col("sellersku").alias("sku"),
            code.alias("fnsku"),
            F.coalesce(F.col("asin"), own).alias("asin"),
            "quantityshipped",
            "quantityreceived",
            "quantityincase",
            "releasedate",
        )
    )


def shipment_detail_feed(
    details: DataFrame,
    catalog: DataFrame,
    published: DataFrame,
    products: DataFrame,
    fields: Mapping[str, str] | None = None,
) -> DataFrame:
    """Shipment rows on one side only, once published rows of changing shipments are purged."""
    keys = ["account_name", "shipmentid", "sku", "fnsku"]
    final = still_published(published, "shipmentstatus", OPEN_SHIPMENTS)
    rows = sync_diff(shipment_details(details, catalog), final.select(*keys), keys)
    rows = _texts(_with_record(rows, products), releasedate=day_text(F.col("releasedate")))
    columns = [*keys, "asin", "quantityshipped", "quantityreceived", "quantityincase", "releasedate", "record_id"]
    return _payload(rows, columns, fields).select(*keys, "payload")


def tracking_feed(transport: DataFrame, published: DataFrame, fields: Mapping[str, str] | None = None) -> DataFrame:
    """Tracking rows on one side only, once published rows of changing shipments are purged."""
    keys = ["account_name", "shipmentid"]
    final = still_published(published, "shipmentstatus", OPEN_SHIPMENTS)
    rows = sync_diff(transport, final.select(*keys), keys)
    return _payload(rows, transport.columns, fields).select(*keys, "payload")


def receiving_feed(
    report: DataFrame,
    catalog: DataFrame,
    shipments: DataFrame,
    details: DataFrame,
    products: DataFrame,
    fields: Mapping[str, str] | None = None,
) -> DataFrame:
    """Received quantities with the records of their shipment, product and shipment row."""
    kept = report.filter(
        F.col("shipmentstatus").isNotNull() & (F.col("quantityreceived") != 0) & F.col("date").isNotNull()
    )
    highest = latest_per_key(
        catalog.select("account_name", "sku", "parent_asin", "asin"),
        ["account_name", "sku"],
        [F.col("parent_asin").desc(), F.col("asin")],
    )
    rows = lookup(kept, highest, {"account_name": "account_name", "sellersku": "sku"}, ["asin"])
    rows = upper_keys(rows.withColumnRenamed("sellersku", "sku").withColumnRenamed("date", "received_date"))
    rows = attach_ids(rows, shipments, same("account_name", "shipmentid"), {"shipment_record_id": "record_id"})
    rows = _with_record(rows, products)
    rows = attach_ids(rows, details, same(*PRODUCT, "shipmentid"), {"detail_record_id": "record_id"})
    rows = _texts(rows, received_date=day_text(F.col("received_date")))
    columns = [
        "account_name",
        "shipmentid",
        "sku",
        "asin",
        "quantityshipped",
        "quantityreceived",
        "shipmentstatus",
        "value",
        "received_date",
        "quantity",
        "shipmentname",
        "cost_per_unit",
        "running_quantity",
        "receipt_cost",
        "shipment_record_id",
        "record_id",
        "detail_record_id",
    ]
    return _payload(rows, columns, fields).select("account_name", "shipmentid", "sku", "payload")


def inventory_feed(snapshot: DataFrame, products: DataFrame, fields: Mapping[str, str] | None = None) -> DataFrame:
    rows = _with_record(snapshot, products)
    return _payload(rows, [*snapshot.columns, "record_id"], fields).select(*PRODUCT, "payload")


def unit_ledger_feed(fifo: DataFrame, fields: Mapping[str, str] | None = None) -> DataFrame:
    """Ledger rows with their cost, in batches."""
    rows = upper_keys(fifo, *PRODUCT, "fba_shipment_id")
    rows = _texts(rows, date=day_text(F.col("date")))
    rows = _payload(rows, fifo.columns, fields)
    order = [F.col(c) for c in ("account_name", "sku", "date", "order_id", "rolling_qty", "payload")]
    return batches(rows, order, BATCH).select("batch_id", "payload")


def daily_slices(orders: DataFrame, since: str) -> DataFrame:
    """Rows and quantity of each publish day, empty days included."""
    rows = orders.filter(F.col("purchase_date") >= F.lit(since).cast("date")).withColumn(
        "slice_date", F.to_date("purchase_date")
    )
    sums = rows.groupBy("slice_date").agg(F.count(F.lit(1)).alias("row_count"), F.sum("quantity").alias("quantity"))
    # The daily sums are all the spine needs: their first and last day are those of the rows.
    days = day_spine(sums, "slice_date", "slice_date").join(sums, "slice_date", "left")
    return days.fillna(0, ["row_count", "quantity"])
