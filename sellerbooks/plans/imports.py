"""Record tables imported from the record store: unwrapped, typed by their values, ready to replace a table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sellerbooks.operators.schema import number_cell, schema_profile, spark_type, widen
from sellerbooks.sources.records import unwrap_records


def typed(rows: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Cast each column to the type its values call for, or to the stored type where that holds them.

    Types depend on all values, so the profile, one row a column, is read before the
    result is planned. Number columns read missing and blank cells as 0, as the profile does.
    """
    measured = schema_profile(rows)
    kinds = {r["column_name"].upper(): r["target_type"] for r in measured.collect()}
    numbers = {r["column_name"].upper() for r in measured.filter("is_number").collect()}
    if stored is not None:
        for r in widen(schema_profile(stored), measured).collect():
            kinds[r["column_name"]] = r["change"] or r["stored_type"]
    cells = []
    for c in rows.columns:
        cell = F.col(c)
        if c.upper() in numbers:
            text = F.trim(cell.cast("string"))
            cell = F.when(text.isNull() | text.isin("nan", "Nan"), "0").otherwise(text)
        cells.append(number_cell(cell, spark_type(kinds[c.upper()])).alias(c))
    return rows.select(*cells)


def import_records(
    records: DataFrame, column: str, fields: Mapping[str, str], stored: DataFrame | None = None
) -> DataFrame:
    """The rows of a record query as a typed table; ``loads.store_import`` stores it."""
    return typed(unwrap_records(records, column, fields), stored)
