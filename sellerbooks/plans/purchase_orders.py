"""Purchase orders kept on sheets: alignment, cleaning and costs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sellerbooks.functions.columns import (
    any_letter,
    blank_to_null,
    day_text,
    dots_to_slashes,
    only_letters,
    parse_date,
    parse_money,
    strip_words,
    text_is,
)
from sellerbooks.operators.joins import lookup, same
from sellerbooks.sources.publish import numbered_fields, payload
from sellerbooks.sources.records import labelled_union, pad_columns

# Further dates and amounts a factory sheet may have.
SHEET_DAYS = ("etd", "order_placed", "date_paid")
SHEET_MONEY = ("invoice_amount", "deposit_sent", "balance_owed")
# Words a completion date may carry besides the date.
READY_WORDS = ("Ready", "; no confirmation")


def pad_and_union(completed: DataFrame, open_orders: DataFrame) -> DataFrame:
    """Both order sheets under the open sheet's columns; the completed one lacks the last of them."""
    columns = open_orders.columns
    cleaned = open_orders.select(
        *[blank_to_null(F.col(c), ("FALSE",)).alias(c) if t == "string" else F.col(c) for c, t in open_orders.dtypes]
    )
    return labelled_union({"Completed": pad_columns(completed, columns), "Open POs": cleaned}, "po_type")


def po_sheet_clean(completed: DataFrame, open_orders: DataFrame, since: str) -> DataFrame:
    """Sheet orders with a quantity, dates and money parsed, from ``since`` on or still open.

    Dates are read by a fixed list of formats; text none of them fits gives NULL.
    """
    rows = pad_and_union(completed, open_orders).filter(F.col("qty").isNotNull() & (F.col("qty") != ""))
    completion = strip_words(dots_to_slashes(F.col("completion_date")), READY_WORDS)
    completion = F.trim(F.replace(completion, F.lit("  "), F.lit(" ")))
    rows = (
        rows.withColumn("eta", parse_date(dots_to_slashes(F.col("eta"))))
        .withColumn("completion_date", completion)
        .filter((F.col("eta") >= F.lit(since).cast("date")) | text_is("po_type", "Open POs"))
    )
    for c in SHEET_DAYS:
        if c in rows.columns:
            rows = rows.withColumn(c, parse_date(dots_to_slashes(F.col(c))))
    for c in SHEET_MONEY:
        if c in rows.columns:
            rows = rows.withColumn(c, parse_money(F.col(c)))
    done = F.when(any_letter(F.col("completion_date")), "").otherwise(F.col("completion_date"))
    return (
        rows.withColumn("ready", F.coalesce(only_letters(F.col("completion_date")), F.lit(False)))
        .withColumn("completion_date", parse_date(done))
        .withColumn("sku", F.upper("sku"))
        .withColumn("unit_price", parse_money(F.col("unit_price")))
        .withColumn("qty", parse_money(F.col("qty")).cast("int"))
        .fillna("", [c for c in rows.columns if c in ("customer_ref", "remarks")])
    )


def cogs_rows(cogs: DataFrame, costs: list[str]) -> DataFrame:
    """Cost sheet rows with trimmed keys; ``row_index`` still points at the sheet row."""
    trimmed = [F.trim(c).alias(c) for c in ("container_num", "sku", "asin", "qty")]
    return cogs.select("row_index", *trimmed, *costs)


def po_cost_attach(po: DataFrame, cogs: DataFrame, costs: list[str]) -> DataFrame:
    """Orders with the costs of their container, sku, asin and quantity; missing costs are zero."""
    keyed = po.withColumn("_qty", F.col("qty").cast("int").cast("string"))
    on = {"container_num": "container_num", "sku": "sku", "asin": "asin", "_qty": "qty"}
    rows = lookup(keyed, cogs_rows(cogs, costs), on, {f"sheet_{c}": c for c in costs}).drop("_qty")
    for c in costs:
        rows = rows.withColumn(f"sheet_{c}", parse_money(F.col(f"sheet_{c}")))
    return rows


def sheet_products(rows: DataFrame, products: DataFrame, account: str) -> DataFrame:
    """Record id and asin of each sheet order, by account and sku."""
    keyed = rows.withColumn("account_name", F.upper(F.lit(account))).withColumn("sku", F.upper("sku"))
    found = lookup(
        keyed, products, same("account_name", "sku"), {"record_id": "record_id", "asin": "asin"}, null_safe=True
    )
    return found.withColumn("record_id", F.coalesce(F.col("record_id").cast("string"), F.lit(""))).fillna("", ["asin"])


def factory_po_rows(
    completed: DataFrame,
    open_orders: DataFrame,
    products: DataFrame,
    cogs: DataFrame,
    costs: list[str],
    since: str,
    account: str,
) -> DataFrame:
    """Factory orders of both sheets, cleaned, with the product record and the costs of their container."""
    rows = sheet_products(po_sheet_clean(completed, open_orders, since), products, account)
    return po_cost_attach(rows, cogs, costs)


def factory_po_feed(
    rows: DataFrame, published: DataFrame, columns: Sequence[str], fields: Mapping[str, str] | None = None
) -> DataFrame:
    """The published factory orders once those of the loaded account are replaced by ``rows``.

    Rows that stay carry no payload; loaded ones carry theirs.
    """
    accounts = rows.select(F.col("account_name").alias("_loaded")).distinct()
    kept = lookup(published, accounts, {"account_name": "_loaded"}, how="left_anti")
    shown = rows.withColumns({c: day_text(F.col(c)) for c, t in rows.dtypes if t == "date"})
    loaded = payload(shown, fields or numbered_fields(columns)).select("account_name", "sku", "row_index", "payload")
    return kept.unionByName(loaded, allowMissingColumns=True)
