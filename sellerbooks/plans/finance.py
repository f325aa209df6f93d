"""Fee types, fee mapping and fees per order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sellerbooks.functions.columns import sign_label, text_in, text_is
from sellerbooks.operators.grouping import (
    conditional_sums,
    first_per_group,
    group_by_text,
    group_in_two_steps,
    latest_per_key,
    least,
)
from sellerbooks.operators.joins import lookup, map_with_fallback, same
from sellerbooks.operators.ordered import global_sequence
from sellerbooks.session import unstaged
from sellerbooks.sources.publish import delete_where, map_values

SKU = ("account_name", "sku")
KINDS = ("adjustmenttype", "chargetype", "feetype", "promotiontype")
MAPPED = ("transaction_type", "amount_type", "amount_description")
MONEY = "decimal(18,4)"
# The amounts that become measures, and the tax line that only opens a group.
FEE_COLUMNS = {"FBAPerUnitFulfillmentFee": "fba_fee", "Commission": "commission", "Principal": "principal"}
TAX_LINE = "MarketplaceFacilitatorTax-Principal"
OTHER = "other-transaction"
SHOWN_TYPES = {"Order": "Shipped", "Refund": "Return", "Chargeback Refund": "Return"}


def fee_type() -> Column:
    """The first kind that is given."""
    return F.coalesce(*[F.col(k) for k in KINDS])


def expected_type(refund: str) -> Column:
    """Transaction type a finance event should map to; a negative charge is a ``refund``."""
    charge = F.when(F.col("currencyamount") >= 0, "Order").when(F.col("currencyamount") < 0, refund)
    return F.coalesce(
        F.col("adjustmenttype"),
        F.when(F.col("chargetype").isNotNull(), charge),
        F.col("feetype"),
        F.when(F.col("promotiontype").isNotNull(), "Promotion"),
    )


def fee_types(finances: DataFrame) -> DataFrame:
    typed = finances.select(
        fee_type().alias("fee_type"), sign_label(F.col("currencyamount")).alias("credit_debit"), *KINDS
    )
    # Distinct first: it hashes, and leaves a handful of rows to group.
    return first_per_group(typed.filter(F.col("fee_type").isNotNull()).distinct(), ["fee_type", "credit_debit"])


def fee_mapping(types: DataFrame, settlements: DataFrame) -> DataFrame:
    """Settlement terms of each fee type and sign; types no settlement names are other transactions."""
    known = settlements.select(*MAPPED, sign_label(F.col("amount")).alias("credit_debit")).distinct()
    rows = lookup(
        types.select("fee_type", "credit_debit"),
        known,
        {"fee_type": "amount_description", "credit_debit": "credit_debit"},
        MAPPED,
    )
    grouped = group_by_text(
        rows, ["fee_type", "transaction_type", "credit_debit"], *least("amount_type", "amount_description")
    )
    return (
        grouped.fillna(OTHER, ["transaction_type", "amount_type"])
        .withColumn("amount_description", F.coalesce("amount_description", "fee_type"))
        .select("fee_type", "credit_debit", *MAPPED)
    )


def settlement_totals(finances: DataFrame) -> DataFrame:
    amount = F.col("currencyamount")
    day = F.col("posteddate")
    totals = group_in_two_steps(
        finances, ["account_name", "group_id"], [("total_amount", "sum", amount), ("start_date", "min", day), ("end_date", "max", day)]
    )
    return totals.withColumn("total_amount", F.col("total_amount").cast(MONEY))


def unique_account_sku(product_data: DataFrame) -> DataFrame:
    """The highest asin of each account and sku."""
    return latest_per_key(product_data.select(*SKU, "asin"), SKU, [F.col("asin").desc()])


def _condensed(finances: DataFrame, refund: str, *more_keys: str) -> DataFrame:
    """Finance events summed to the grain the mapping works on, before any join multiplies them."""
    rows = finances.select(
        "account_name",
        "group_id",
        *more_keys,
        "sellersku",
        F.to_date("posteddate").alias("posted_day"),
        fee_type().alias("og_transaction_type"),
        expected_type(refund).alias("og_fee_type"),
        sign_label(F.col("currencyamount")).alias("credit_debit"),
        F.col("currencycode").alias("currency"),
        "currencyamount",
        "quantity",
    )
    # The currency is a key here only, which keeps text out of the aggregation state.
    keys = [c for c in rows.columns if c not in ("currencyamount", "quantity")]
    return rows.groupBy(*keys).agg(
        F.sum("currencyamount").cast(MONEY).alias("amount"),
        F.sum("quantity").alias("quantity"),
    )


def _mapped(
    rows: DataFrame, asins: DataFrame, totals: DataFrame, mapping: DataFrame, fallback: DataFrame
) -> DataFrame:
    rows = lookup(rows, asins, {"account_name": "account_name", "sellersku": "sku"}, ["asin"])
    rows = lookup(
        rows,
        totals.select(
            "account_name",
            "group_id",
            "total_amount",
            F.to_date("start_date").alias("start_date"),
            F.to_date("end_date").alias("end_date"),
        ),
        same("account_name", "group_id"),
        ["total_amount", "start_date", "end_date"],
    )
    by_type = {"og_transaction_type": "fee_type", "credit_debit": "credit_debit"}
    exact = {**by_type, "og_fee_type": "transaction_type"}
    rows = map_with_fallback(rows, mapping, exact, fallback, by_type, MAPPED)
    return rows.withColumn("posted_date", F.coalesce("posted_day", "end_date"))


def open_finance_upload(finances: DataFrame, asins: DataFrame, totals: DataFrame, mapping: DataFrame) -> DataFrame:
    """Open finance events under settlement terms.

    The fallback joins on fee type and sign alone, so an event whose pair has
    several transaction types counts once for each of them, even where the exact
    mapping matched. That multiplication is part of the result.
    """
    rows = _mapped(_condensed(finances, "Refund"), asins, totals, mapping, mapping)
    rows = rows.withColumnsRenamed(
        {
            "group_id": "settlement_id",
            "start_date": "settlement_start_date",
            "end_date": "settlement_end_date",
            "sellersku": "sku",
        }
    )
    keys = [
        "account_name",
        "settlement_id",
        "settlement_start_date",
        "settlement_end_date",
        "total_amount",
        *MAPPED,
        "posted_date",
        "sku",
        "asin",
    ]
    grouped = group_by_text(
        rows,
        keys,
        *least("currency", "og_transaction_type", "og_fee_type"),
        F.sum("amount").cast(MONEY).alias("amount"),
    ).withColumn("status", F.lit("Open"))
    return delete_where(grouped, F.col("total_amount").isNull() & F.col("amount").isNull())


def posted_order_fees(
    settlements: DataFrame,
    asins: DataFrame,
    since: str = "2022-01-01",
    stage: Callable[[DataFrame], DataFrame] = unstaged,
) -> DataFrame:
    """Posted fees per order, sku, type and shipment.

    The marketplace tax line of an order feeds no measure; it only keeps the group. ``stage``
    writes the groups between the three shuffles, so that one of them lies on disk at a time.
    """
    description = F.lower("amount_description")
    wanted = description.isin([d.lower() for d in FEE_COLUMNS]) | (
        text_is("transaction_type", "Order") & (description == TAX_LINE.lower())
    )
    rows = settlements.filter((F.col("settlement_start_date") >= F.lit(since).cast("date")) & wanted).withColumn(
        "group_id", F.coalesce("shipment_id", "adjustment_id")
    )
    keys = ["order_id", "sku", "group_id", "account_name", "transaction_type"]
    # Only fixed-width state, so the largest aggregation of all hashes first: the least
    # description is kept as its place among the known ones.
    known = sorted([*FEE_COLUMNS, TAX_LINE])
    place = F.array_position(F.array(*[F.lit(k.lower()) for k in known]), F.lower("amount_description")).cast("int")
    fees = group_in_two_steps(
        rows,
        keys,
        [
            ("start_date", "min", F.to_date("settlement_start_date")),
            ("end_date", "min", F.to_date("settlement_end_date")),
            ("posted_date", "min", F.col("posted_date")),
            ("settlement_id", "min", F.col("settlement_id")),
            ("_place", "min", place),
            *[(name, "sum", F.when(text_is("amount_description", d), F.col("amount"))) for d, name in FEE_COLUMNS.items()],
            ("quantity", "sum", F.when(text_is("amount_description", "Principal"), F.col("quantity_purchased"))),
        ],
        stage,
    )
    fees = fees.withColumn("amount_description", F.element_at(F.array(*[F.lit(k) for k in known]), F.col("_place")))
    # The asin depends on account and sku alone, so it is looked up once per group.
    by_sku = {"sku": "sku", "account_name": "account_name"}
    return _fee_shape(lookup(stage(fees), asins, by_sku, ["asin"]).withColumn("status", F.lit("POSTED")))


def open_order_fees(
    finances: DataFrame, asins: DataFrame, totals: DataFrame, mapping: DataFrame
) -> DataFrame:
    """Open fees per order, sku and type; each gets a group id of its own."""
    plain = mapping.filter(~text_in("transaction_type", ("Order", "Refund")))
    fallback = first_per_group(plain, ["fee_type", "credit_debit"])
    rows = _mapped(_condensed(finances, "Chargeback Refund", "amazonorderid"), asins, totals, mapping, fallback)
    rows = rows.filter(text_in("amount_description", FEE_COLUMNS)).withColumnsRenamed(
        {"amazonorderid": "order_id", "sellersku": "sku"}
    )
    keys = ["account_name", "order_id", "sku", "transaction_type"]
    fees = group_by_text(
        rows,
        keys,
        *least("start_date", "end_date", "amount_description", "asin"),
        F.min("posted_day").alias("posted_date"),
        F.min("group_id").alias("settlement_id"),
        *conditional_sums("amount_description", FEE_COLUMNS, "amount", default=0),
        *conditional_sums("amount_description", {"Principal": "quantity"}, "quantity", default=0),
    )
    numbered = global_sequence(fees, [F.col(k) for k in keys], "_open")
    return _fee_shape(
        numbered.withColumn("group_id", F.concat(F.lit("Open_"), "_open")).withColumn("status", F.lit("Open"))
    )


def _fee_shape(fees: DataFrame) -> DataFrame:
    return fees.select(
        "status",
        "account_name",
        "start_date",
        "end_date",
        "posted_date",
        F.col("settlement_id").cast("string").alias("settlement_id"),
        "transaction_type",
        "group_id",
        "order_id",
        "sku",
        "asin",
        "amount_description",
        *[F.col(c).cast(MONEY).alias(c) for c in FEE_COLUMNS.values()],
        F.col("quantity").cast("bigint").alias("quantity"),
    )


def combined_order_fees(posted: DataFrame, opened: DataFrame) -> DataFrame:
    """Posted and open fees, ranked by their own type and then shown as Shipped or Return.

    No duplicate can arise: each side is grouped by its key and the sides differ
    in status, so the distinct union is a plain one. For the same reason the rank
    within the key is 1 for every row: posted rows are grouped by that very key,
    ignoring case, and each open row has a group id of its own.
    """
    ranked = posted.unionByName(opened).withColumn("ranking", F.lit(1))
    shown = map_values(ranked, "transaction_type", SHOWN_TYPES)
    return shown.fillna(0, list(FEE_COLUMNS.values()))
