"""Links from published records to the sheet rows that document them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sellerbooks.functions.columns import cell_link, whole_text
from sellerbooks.operators.expand import explode_refs, per_column
from sellerbooks.operators.joins import lookup
from sellerbooks.plans.purchase_orders import cogs_rows

# The sheet column that documents each cost.
COST_COLUMNS = {
    "DUTIES": "G",
    "CUSTOMS_FEES": "J",
    "DEMURRAGE": "K",
    "CONTAINER_COST": "R",
    "TRUCKING_COST": "S",
}
_SHAPE = ("document_type", "record_id", "fba_shipment_id", "cost_name", "url")


def cogs_links(cogs: DataFrame, po: DataFrame, gid: str, base: str) -> DataFrame:
    """One link per cost column of each cost row that belongs to an order."""
    orders = po.withColumn("_qty", whole_text(F.col("qty")))
    rows = lookup(
        cogs_rows(cogs, []),
        orders,
        {"container_num": "container_num", "sku": "sku", "asin": "asin", "qty": "_qty"},
        {"record_id": "record_id_num", "fba_shipment_id": "fba_shipment_id"},
        how="inner",
    )
    rows = per_column(rows, COST_COLUMNS, "cost_name", "letter")
    link = cell_link(gid, F.col("letter"), F.col("row_index") + 1, base)
    return rows.withColumn("url", link).withColumn("document_type", F.lit("COGS")).select(*_SHAPE)


def freight_out_links(sheet: DataFrame, refs: str, gid: str, base: str, letter: str = "I") -> DataFrame:
    """One link per shipment named in a sheet row."""
    rows = explode_refs(sheet, refs, "fba_shipment_id")
    link = cell_link(gid, F.lit(letter), F.col("row_index") + 1, base)
    return rows.select(
        F.lit("Freight Out").alias("document_type"),
        F.lit(None).cast("bigint").alias("record_id"),
        "fba_shipment_id",
        F.lit(None).cast("string").alias("cost_name"),
        link.alias("url"),
    )


def freight_in_links(sheet: DataFrame, po: DataFrame, gid: str, base: str, letter: str = "H") -> DataFrame:
    """One link per order of the container a sheet row names."""
    rows = lookup(sheet, po, {"customer_ref": "container_num"}, {"record_id": "record_id_num"}, how="inner")
    link = cell_link(gid, F.lit(letter), F.col("row_index") + 1, base)
    return rows.select(
        F.lit("Freight In").alias("document_type"),
        "record_id",
        F.lit(None).cast("string").alias("fba_shipment_id"),
        F.lit(None).cast("string").alias("cost_name"),
        link.alias("url"),
    )


def document_links(cogs: DataFrame, po: DataFrame, freight_out: DataFrame, freight_in: DataFrame, base: str) -> DataFrame:
    return (
        cogs_links(cogs, po, "0", base)
        .unionByName(freight_out_links(freight_out, "customer_ref", "1", base))
        .unionByName(freight_in_links(freight_in, po, "2", base))
    )
