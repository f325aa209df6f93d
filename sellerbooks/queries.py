"""Registered queries: each plan over the inputs of one data folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sellerbooks import checks as c
from sellerbooks.operators import grouping, joins, ordered, schema
from sellerbooks.operators.expand import explode_refs
from sellerbooks.operators.predicates import build_predicate
from sellerbooks.plans import catalog, documents, feeds, finance, imports, ledger, loads, orders, purchase_orders, returns
from sellerbooks.session import materialise, passing_stages, table_folder
from sellerbooks.sources import publish, records, stored, tables
from sellerbooks.sources.fixtures import Inputs


class Books:
    """The stages of the whole run over one folder, each planned once and only when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.inputs = spark, Inputs(spark, folder)

    # Sources and schema
    @cached_property
    def scan_table(self):
        return self.inputs.product_data

    @cached_property
    def scan_filtered(self):
        day = F.col("purchase_date")
        return tables.scan_filtered(
            self.inputs.all_orders,
            ["account_name", "amazon_order_id", "sku", "quantity", "item_price", "purchase_date"],
            day >= F.lit(c.ASSIGNED_SINCE).cast("date"),
            day < F.lit("2000-01-01").cast("date"),
            F.col("quantity") != 0,
        )

    @cached_property
    def daily_slices(self):
        return feeds.daily_slices(self.inputs.all_orders, c.ASSIGNED_SINCE)

    @cached_property
    def unwrap_records(self):
        fields = {"3": "Record ID#", "6": "Product Brand", "7": "Product Type"}
        return records.unwrap_records(self.inputs.records_raw, "record", fields)

    @cached_property
    def saved_report(self):
        """Pages of at most 1000 rows, each a response with its own list of fields."""
        fields = '{"id":3,"label":"Record ID#","type":"recordid"},{"id":9,"label":"Is Even","type":"checkbox"},{"id":6,"label":"Product Brand","type":"text"},'
        fields += '{"id":7,"label":"List Price","type":"currency"},{"id":8,"label":"Due Day","type":"date"}'
        page = F.concat(F.lit('{"data":['), F.concat_ws(",", F.collect_list("record")), F.lit(f'],"fields":[{fields}]}}'))
        pages = self.inputs.report_rows.groupBy(F.floor(F.col("record_id") / 1000).alias("page")).agg(page.alias("value"))
        path = table_folder(self.spark)
        pages.select("value").write.text(path)
        return records.read_typed_report(self.spark, path, pages_as_lines=True)

    @cached_property
    def import_records(self):
        fields = {"3": "Record ID#", "6": "Product Brand", "7": "Product Type"}
        stored = self.inputs.products.select(F.lit(0).alias("Record_ID_Num"), F.col("color").alias("Product_Brand"))
        return imports.import_records(self.inputs.records_raw, "record", fields, stored)

    @cached_property
    def predicate_builder(self):
        clauses = [("sku", "CT", "-1"), ("order_status", "EX", "Shipped"), ("account_name", "EX", "West")]
        return self.inputs.all_orders.filter(build_predicate(clauses, ["AND", "OR"]))

    @cached_property
    def normalize_headers(self):
        labelled = self.inputs.all_listings.select(
            F.col("seller_sku").alias("seller sku"),
            F.col("listing_id").alias("record #"),
            F.col("price").alias("Item Price"),
        )
        return records.normalize_headers(labelled, "label").withColumnRenamed("record__Num", "record_Num")

    @cached_property
    def stamp_load_date(self):
        return records.stamp_load_date(self.inputs.ledger_detail, c.LOAD_DATE)

    @cached_property
    def _sheets(self):
        sheet = self.inputs.sheet_po.withColumn("eta", F.col("completion_date"))
        short = ["row_index", "sku", "unit_price", "qty", "completion_date", "eta"]
        return sheet.select(*short), sheet.select(*short, "customer_ref")

    @cached_property
    def pad_and_union(self):
        return purchase_orders.pad_and_union(*self._sheets)

    @cached_property
    def row_count(self):
        return tables.row_count(self.inputs.sheet_po)

    @cached_property
    def date_bounds(self):
        return tables.date_bounds(self.inputs.all_orders, "purchase_date", c.ASSIGNED_SINCE)

    @cached_property
    def schema_profile(self):
        return schema.schema_profile(self.inputs.sheet_po)

    @cached_property
    def schema_widen(self):
        return schema.widen(schema.schema_profile(self.inputs.sheet_cogs), self.schema_profile)

    @cached_property
    def schema_widen_pairs(self):
        """Each measured column of the orders against each of the finance events, numbers in every stored type there is."""
        numbers = [f"{kind}({size},{depth})" for kind in ("NUMERIC", "FLOAT") for size in (12, 20) for depth in (2, 4)]
        measured = F.col("target_type")
        kinds = (
            F.when(measured.startswith("NUMERIC"), F.array(*map(F.lit, numbers)))
            .when(measured == "INTEGER", F.array(F.lit("INTEGER"), F.lit("BIGINT")))
            .otherwise(F.array(measured))
        )

        def in_every_type(table: DataFrame, columns: list[str]) -> DataFrame:
            profile = schema.schema_profile(table.select(*columns))
            rows = profile.withColumn("target_type", F.explode(kinds))
            return materialise(rows.withColumn("column_name", F.concat_ws(" ", "column_name", "target_type")))

        stored = in_every_type(self.inputs.all_orders, c.WIDEN_STORED)
        incoming = in_every_type(self.inputs.finance_events, c.WIDEN_INCOMING)
        # A few names a column, whatever the rows.
        names = [[F.lit(r["column_name"]) for r in side.collect()] for side in (incoming, stored)]
        left = stored.withColumn("other", F.explode(F.array(*names[0])))
        right = incoming.withColumn("other", F.explode(F.array(*names[1])))
        return schema.widen(
            left.withColumn("column_name", F.concat_ws(" < ", "column_name", "other")),
            right.withColumn("column_name", F.concat_ws(" < ", "other", "column_name")),
        )

    @cached_property
    def evolve_append(self):
        target = self.inputs.product_data.select("account_name", "sku", "asin", "list_price")
        return schema.evolve_append(target, records.normalize_headers(self.inputs.remote_products, "upper")).withColumnRenamed(
            "RECORD_ID", "record_id"
        )

    @cached_property
    def numeric_coerce(self):
        amounts = self.inputs.sheet_po.withColumn("amount", F.translate("unit_price", "$", ""))
        return schema.numeric_coerce(amounts, ["qty", "amount"])

    @cached_property
    def key_violations(self):
        return grouping.key_violations(self.inputs.all_listings, ["account_name", "asin1", "seller_sku"])

    @cached_property
    def first_per_group(self):
        return grouping.first_per_group(self.inputs.all_orders, ["account_name", "sku"])

    # Catalog
    @cached_property
    def latest_listing(self):
        return catalog.latest_listing(self.inputs.all_listings)

    @cached_property
    def missing_products(self):
        return catalog.listings_with_missing(self.latest_listing, self.inputs.product_data)

    @cached_property
    def catalog(self):
        return catalog.catalog(self.missing_products, self.inputs.products, self.inputs.stock)

    @cached_property
    def unfulfillable_pivot(self):
        return catalog.unfulfillable_pivot(self.inputs.stock_summary)

    @cached_property
    def inventory_snapshot(self):
        return catalog.inventory_snapshot(self.inputs.stock, self.inputs.stock_reserved, self.unfulfillable_pivot)

    # Finance
    @cached_property
    def fee_types(self):
        return finance.fee_types(self.inputs.finance_events)

    @cached_property
    def fee_mapping(self):
        return finance.fee_mapping(self.fee_types, self.inputs.settlement_lines)

    @cached_property
    def settlement_totals(self):
        return finance.settlement_totals(self.inputs.finance_events)

    @cached_property
    def unique_account_sku(self):
        return finance.unique_account_sku(self.inputs.product_data)

    @cached_property
    def _finance(self):
        # Written out so that the planner knows how small they are: mapping and totals have few
        # keys, and a shuffle of the finance events by them would fill a handful of tasks.
        totals, mapping = materialise(self.settlement_totals), materialise(self.fee_mapping)
        return self.inputs.finance_events, self.unique_account_sku, totals, mapping

    @cached_property
    def open_finance_upload(self):
        return finance.open_finance_upload(*self._finance)

    @cached_property
    def posted_order_fees(self):
        return finance.posted_order_fees(self.inputs.settlement_lines, self.unique_account_sku, c.SETTLED_SINCE)

    @cached_property
    def open_order_fees(self):
        return finance.open_order_fees(*self._finance)

    @cached_property
    def combined_order_fees(self):
        return finance.combined_order_fees(self.posted_order_fees, self.open_order_fees)

    @cached_property
    def _fees(self):
        return self._fees_in(materialise)

    def _fees_in(self, keep):
        # Read by the repair and again by the final join, so it is computed once.
        with passing_stages(self.spark) as stage:
            posted = finance.posted_order_fees(
                self.inputs.settlement_lines, self.unique_account_sku, c.SETTLED_SINCE, stage
            )
            return keep(finance.combined_order_fees(posted, self.open_order_fees))

    # Orders
    @cached_property
    def order_lines(self):
        return orders.order_lines(self.inputs.order_items, c.ORDERS_SINCE)

    @cached_property
    def order_unit_price(self):
        return orders.order_unit_price(self.order_lines)

    @cached_property
    def fulfilled_lines(self):
        return orders.fulfilled_lines(self.inputs.fulfilled_shipments)

    @cached_property
    def assign_orders(self):
        with passing_stages(self.spark) as stage:
            return orders.assign_orders(self._assigned_in(stage))

    def _assigned_in(self, keep):
        # Each step is written before the next one shuffles, and goes once that one is written.
        with passing_stages(self.spark) as joined:
            with passing_stages(self.spark) as stage:
                with passing_stages(self.spark) as summed:
                    lines = orders.order_lines(self.inputs.order_items, c.ORDERS_SINCE, summed)
                    recent = stage(orders.recent_lines(lines, c.ASSIGNED_SINCE))
                fulfilled = stage(orders.fulfilled_lines(self.inputs.fulfilled_shipments, stage))
                shipped = joined(orders.shipped_lines(recent, fulfilled))
            return keep(orders.assigned_lines(shipped))

    def _repaired_in(self, fees, keep):
        with passing_stages(self.spark) as stage:
            return orders.repair_shipments(self._assigned_in(stage), fees, stage, keep)

    @cached_property
    def repair_shipments(self):
        with passing_stages(self.spark) as stage:
            return self._repaired_in(self._fees_in(stage), materialise)

    @cached_property
    def final_assigned_orders(self):
        return orders.final_assigned_orders(self._repaired_in(self._fees, materialise), self._fees)

    # Returns
    @cached_property
    def return_units(self):
        return returns.return_units(self._fees, self.order_unit_price)

    @cached_property
    def _return_units(self):
        # Prices and units are written one after the other, so that their shuffles do not lie on disk together.
        with passing_stages(self.spark) as stage:
            lines = orders.order_lines(self.inputs.order_items, c.ORDERS_SINCE)
            prices = stage(orders.order_unit_price(lines, stage))
            return materialise(returns.return_units(self._fees, prices))

    @cached_property
    def return_expand(self):
        return returns.return_expand(self._return_units)

    @cached_property
    def return_lines(self):
        return returns.return_lines(self.inputs.returned_items, c.ASSIGNED_SINCE)

    @cached_property
    def assign_returns(self):
        lines = self.return_lines
        wanted = materialise(returns.last_rankings(lines))
        return returns.assign_returns(lines, returns.return_expand(self._return_units, wanted))

    @cached_property
    def final_assigned_returns(self):
        return returns.final_assigned_returns(self.assign_returns, self._fees)

    # Ledger
    @cached_property
    def po_eta_default(self):
        return ledger.po_eta_default(self.inputs.po_records, c.ETA_DEFAULT)

    @cached_property
    def active_skus(self):
        return ledger.active_skus(self.inputs.product_data, self.po_eta_default, c.LEDGER_START)

    @cached_property
    def _active(self):
        # Read by every ledger part, so it is computed once.
        return materialise(self.active_skus)

    @cached_property
    def ledger_summary(self):
        return ledger.ledger_summary(self.inputs.stock_summary, self._active, c.MEASURES, c.LEDGER_START)

    @cached_property
    def ledger_events(self):
        return ledger.ledger_events(
            self.inputs.stock_movements, self.ledger_summary, self._active, self.inputs.stock_summary, c.LEDGER_START
        )

    @cached_property
    def order_ledger(self):
        last_day = grouping.latest_value(self.inputs.stock_summary, "date")
        return ledger.order_ledger(self.inputs.order_items, self._active, last_day, c.LEDGER_START)

    @cached_property
    def return_ledger(self):
        return ledger.return_ledger(self.inputs.returned_items, self._active, c.LEDGER_START)

    @cached_property
    def removal_ledger(self):
        return ledger.removal_ledger(self.inputs.removals, self._active, c.LEDGER_START)

    @cached_property
    def adjustment_ledger(self):
        return ledger.adjustment_ledger(self.inputs.stock_movements, self._active, c.LEDGER_START)

    @cached_property
    def receipt_rolling(self):
        return ledger.receipt_rolling(
            self.po_eta_default, self._active, self.inputs.product_records, c.LEDGER_START
        )

    @cached_property
    def _ledger_parts(self):
        return self.order_ledger, self.return_ledger, self.removal_ledger, self.adjustment_ledger

    @cached_property
    def ledger_detail(self):
        return ledger.ledger_detail(*self._ledger_parts)

    @cached_property
    def ledger_rolling(self):
        return ledger.ledger_rolling(ledger.ledger_rows(*self._ledger_parts))

    @cached_property
    def fifo_assign(self):
        return ledger.fifo_assign(
            self.ledger_rolling, self.inputs.product_records, self.receipt_rolling, self.inputs.order_records
        )

    @cached_property
    def fifo_assign_strict(self):
        receipts = ledger.receipt_rolling_by_sku(self.inputs.po_records, self._active)
        return ledger.fifo_assign_strict(self.ledger_rolling, receipts)

    # Publishing
    @cached_property
    def attach_record_id(self):
        rows = feeds.upper_keys(self.inputs.product_data)
        found = joins.attach_ids(rows, self.inputs.remote_products, joins.same(*feeds.PRODUCT), ["record_id"])
        return found.withColumn("record_id", F.coalesce(F.col("record_id").cast("string"), F.lit("")))

    @cached_property
    def sync_diff(self):
        keys = ["account_name", "shipmentid"]
        return grouping.sync_diff(self.inputs.inbound_shipments, self.inputs.remote_shipments, keys)

    @cached_property
    def sync_new_only(self):
        keys = ["account_name", "shipmentid"]
        return grouping.sync_diff(self.inputs.inbound_shipments, self.inputs.remote_shipments, keys, keep="source")

    @cached_property
    def settlement_ids(self):
        return feeds.settlement_ids(self.posted_order_fees, self.open_order_fees)

    @cached_property
    def unpublished_settlements(self):
        return joins.unpublished(self.settlement_ids, self.inputs.published_settlements, "settlement_id")

    @cached_property
    def purge_and_reload(self):
        target = self.inputs.published_fees.withColumn("settlement_id", F.col("settlement_id").cast("string"))
        new = self.open_finance_upload.select(*target.columns)
        return publish.purge_and_reload(target, "status", "Open", new)

    @cached_property
    def upsert_records(self):
        keys = ["account_name", "sku", "asin"]
        target = self.inputs.product_data.select(*keys, "list_price", "itemname")
        new = self.latest_listing.select(*keys, F.col("price").alias("list_price"))
        return joins.replace_rows(target, new, keys)

    @cached_property
    def upsert_changes(self):
        """Products as they come back: a tenth is gone, a price in three has changed, and listings without a product are new."""
        keys = ["account_name", "sku", "asin"]
        products = self.inputs.product_data
        price = F.when(F.col("size") % 3 == 0, F.col("list_price") + 1).otherwise(F.col("list_price"))
        back = products.filter("sku NOT LIKE '%1'").select(*keys, price.cast("decimal(12,2)").alias("list_price"))
        target = products.select(*keys, "list_price", "itemname")
        listed = self.latest_listing.select(*keys, F.col("price").alias("list_price"))
        created = joins.lookup(listed, target, joins.same(*keys), how="left_anti")
        return joins.change_set(target, back.unionByName(created), keys, delete_missing=True)

    @cached_property
    def payload_json(self):
        columns = ["account_name", "sku", "asin", "itemname", "list_price", "size"]
        return publish.payload(self.inputs.product_data, publish.numbered_fields(columns))

    @cached_property
    def global_sequence(self):
        order = ["account_name", "seller_sku", "open_date", "listing_id", "line_no", "asin1", "price"]
        return ordered.global_sequence(self.inputs.all_listings, [F.col(o) for o in order], "sequence")

    @cached_property
    def payload_batches(self):
        order = ["account_name", "sku", "open_date", "listing_id", "line_no", "asin1", "price"]
        rows = self.inputs.all_listings.withColumnRenamed("seller_sku", "sku")
        return ordered.batches(rows, [F.col(o) for o in order])

    @cached_property
    def sheet_export(self):
        remark = F.col("row_index") % 4
        remarks = F.when(remark == 0, "None").when(remark == 1, "nan").when(remark == 3, "kept")
        shown = publish.sheet_export(self.inputs.sheet_po.withColumn("remarks", remarks))
        return shown.toDF(*[c.replace(" ", "_") for c in shown.columns])

    @cached_property
    def sheet_sort(self):
        sheet = self.inputs.sheet_po.select("row_index", "sku", "unit_price", "qty")
        added = publish.append_row(sheet, {"sku": "New", "unit_price": "$1.00", "qty": "1"}, "row_index")
        return publish.sort_sheet(added, "sku", "row_index")

    # Stored tables
    @cached_property
    def stored_import(self):
        fields = {"3": "Record ID#", "6": "Product Brand", "7": "Product Type"}
        return loads.store_import(self.inputs.records_raw, "record", fields, table_folder(self.spark), "imported_products")

    @cached_property
    def stored_listing(self):
        keys = ["asin", "sku"]
        listing = self.latest_listing.select(*keys, "account_name", "listing_id")
        again = self.inputs.all_listings.select(F.col("asin1").alias("asin"), F.col("seller_sku").alias("sku"), "account_name", "listing_id")
        return loads.keyed_listing(listing, again, keys, table_folder(self.spark))

    @cached_property
    def evolved_profile(self):
        target = self.inputs.product_data.select("account_name", "sku", "asin", "list_price")
        load = records.normalize_headers(self.inputs.remote_products, "upper").withColumnRenamed("RECORD_ID", "record_id")
        return loads.evolved_profile(target, load, table_folder(self.spark))

    @cached_property
    def published_days(self):
        rows = self.inputs.all_orders.select("amazon_order_id", "sku", "quantity", F.to_date("purchase_date").alias("slice_date"))
        # As the sales feed does, days are published from the start of the assigned orders on.
        first = F.lit(c.ASSIGNED_SINCE).cast("date")
        rows = rows.filter(F.col("slice_date") >= first)
        days = rows.select("slice_date").distinct().orderBy(F.desc("slice_date")).limit(3)
        changed = rows.join(days, "slice_date", "left_semi").withColumn("quantity", F.col("quantity") * 2)
        return loads.republished_days(rows, changed, "slice_date", table_folder(self.spark), first)

    @cached_property
    def published_batches(self):
        order = ["account_name", "sku", "asin"]
        rows = loads.payload_batches(self.inputs.product_data, publish.numbered_fields([*order, "list_price"]), order)
        path = table_folder(self.spark)
        # A run that got through half of its batches, then two whole ones.
        for part in (rows.filter("batch_id % 2 = 0"), rows, rows):
            loads.publish_batches(part, path)
        return stored.read(self.spark, path)

    @cached_property
    def logged_steps(self):
        """The catalog script run step by step, each step reading the tables the ones before have stored."""
        i, step = self.inputs, "logged_{}".format
        steps = {
            step("latest_listing"): lambda spark: self.latest_listing,
            step("missing_products"): lambda spark: catalog.listings_with_missing(
                spark.table(step("latest_listing")), i.product_data
            ),
            step("catalog"): lambda spark: catalog.catalog(spark.table(step("missing_products")), i.products, i.stock),
        }
        log = loads.run_steps(self.spark, "catalog", steps, table_folder(self.spark))
        return loads.steps_report(log, list(steps))

    # Feeds
    @cached_property
    def _products(self):
        return self.inputs.remote_products

    @cached_property
    def product_feed(self):
        return feeds.product_feed(self.catalog, self._products)

    @cached_property
    def sales_feed(self):
        with passing_stages(self.spark) as stage:
            fees = self._fees_in(stage)
            final = materialise(orders.final_assigned_orders(self._repaired_in(fees, stage), fees))
        return feeds.sales_feed(final, self._products, c.ASSIGNED_SINCE)

    @cached_property
    def returns_feed(self):
        return feeds.returns_feed(self.final_assigned_returns, self._products, c.ASSIGNED_SINCE)

    @cached_property
    def order_fee_feed(self):
        return feeds.order_fee_feed(self._fees, self.inputs.published_settlements, self._products)

    @cached_property
    def finance_fee_feed(self):
        return feeds.finance_fee_feed(self.open_finance_upload, self._products)

    @cached_property
    def settlement_fee_feed(self):
        return feeds.settlement_fee_feed(
            self.inputs.settlement_lines,
            self.unique_account_sku,
            self.inputs.published_settlements,
            self._products,
            c.ASSIGNED_SINCE,
        )

    @cached_property
    def shipment_feed(self):
        return feeds.shipment_feed(self.inputs.inbound_shipments, self.inputs.published_shipments)

    @cached_property
    def shipment_detail_feed(self):
        return feeds.shipment_detail_feed(
            self.inputs.inbound_details, self.inputs.product_data, self.inputs.published_details, self._products
        )

    @cached_property
    def tracking_feed(self):
        return feeds.tracking_feed(self.inputs.inbound_transport, self.inputs.published_shipments)

    @cached_property
    def receiving_feed(self):
        shipments = self.inputs.remote_shipments.withColumn("record_id", F.substring("shipmentid", 3, 20).cast("bigint"))
        shipments = shipments.withColumn("account_name", F.upper("account_name"))
        return feeds.receiving_feed(
            self.inputs.inbound_report, self.catalog, shipments, self.inputs.remote_details, self._products
        )

    @cached_property
    def inventory_feed(self):
        return feeds.inventory_feed(self.inventory_snapshot, self._products)

    @cached_property
    def unit_ledger_feed(self):
        return feeds.unit_ledger_feed(self.fifo_assign)

    # Sheets
    @cached_property
    def po_sheet_clean(self):
        return purchase_orders.po_sheet_clean(*self._sheets, c.SHEET_SINCE)

    @cached_property
    def po_cost_attach(self):
        return purchase_orders.po_cost_attach(self.inputs.po_records, self.inputs.sheet_cogs, ["duties"])

    @cached_property
    def factory_po_feed(self):
        sheet = self.inputs.sheet_factory
        rows = purchase_orders.factory_po_rows(
            sheet.drop("remarks"), sheet, self._products, self.inputs.sheet_cogs, ["duties"], c.SHEET_SINCE, c.FACTORY_ACCOUNT
        )
        return purchase_orders.factory_po_feed(rows, self.inputs.published_factory, c.FACTORY)

    @cached_property
    def split_refs(self):
        return explode_refs(self.inputs.sheet_po, "customer_ref", "reference")

    @cached_property
    def document_links(self):
        return documents.document_links(
            self.inputs.sheet_cogs, self.inputs.po_records, self.inputs.sheet_po, self.inputs.sheet_freight, c.SHEET_BASE
        )

    def _exported(self, sheet: DataFrame) -> DataFrame:
        """A sheet written as CSV in its order and read again, its rows numbered where they are read."""
        order = ["row_index", *[x for x in sheet.columns if x != "row_index"]]
        path = table_folder(self.spark)
        publish.write_csv(sheet.orderBy(*order).drop("row_index"), path)
        return records.read_numbered_sheet(self.spark, path)

    @cached_property
    def sheet_links(self):
        i = self.inputs
        cogs, refs, freight = [self._exported(s) for s in (i.sheet_cogs, i.sheet_po, i.sheet_freight)]
        return documents.document_links(cogs, i.po_records, refs, freight, c.SHEET_BASE)


_CASTS = {
    "t": lambda col: col.cast("string"),
    "i": lambda col: col.cast("bigint"),
    "n": lambda col: col.cast("double"),
    "d": lambda col: col.cast("date").cast("string"),
    "s": lambda col: F.date_format(col, "yyyy-MM-dd HH:mm:ss"),
    "b": lambda col: col.cast("boolean"),
}


def run(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One query with the columns its check declares, in plain types both engines share."""
    result = getattr(Books(spark, folder), name)
    return result.select(*[_CASTS[kind](F.col(col)).alias(col) for col, kind in c.columns_of(name).items()])


def names() -> list[str]:
    return [n for n, (columns, _) in c.CHECKS.items() if columns]


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def query(name: str) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: run(spark, folder, name)

    return {n: query(n) for n in names()}
