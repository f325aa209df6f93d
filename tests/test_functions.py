"""Column functions, expansion, schema operators, sources and sinks."""

import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import functions as F

from sellerbooks.functions import columns as fn
from sellerbooks.operators import expand, schema
from sellerbooks.operators.predicates import build_predicate
from sellerbooks.plans import finance, ledger, purchase_orders, returns
from sellerbooks.sources import publish, records, tables


def one(spark, kind, *values):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def test_prices_round_half_up_and_survive_zero(spark):
    df = spark.createDataFrame(
        [(Decimal("80779.95"), 18), (Decimal("5.00"), 0), (None, 2)], "p decimal(12,2), q int"
    )
    got = [r[0] for r in df.select(fn.unit_price(F.col("p"), F.col("q"))).collect()]
    assert got == [Decimal("4487.78"), Decimal("5.00"), None]


def test_dates_money_and_text(spark):
    dates = one(spark, "string", "4/1/2020", "13/45/2020", "", None, "2020-04-01")
    got = [r[0] for r in dates.select(fn.parse_date(F.col("x"))).collect()]
    assert got == [dt.date(2020, 4, 1), None, None, None, dt.date(2020, 4, 1)]
    money = one(spark, "string", "$1,203.50", "", None, "12", "free")
    assert [float(r[0]) for r in money.select(fn.parse_money(F.col("x"))).collect()] == [1203.5, 0, 0, 12, 0]
    letters = one(spark, "string", "Ready", "4/1", "a1")
    got = [tuple(r) for r in letters.select(fn.only_letters(F.col("x")), fn.any_letter(F.col("x"))).collect()]
    assert got == [(True, True), (False, False), (False, True)]
    numbers = one(spark, "string", "12.0", "x", None)
    assert [r[0] for r in numbers.select(fn.whole_text(F.col("x"))).collect()] == ["12", None, None]
    amounts = one(spark, "decimal(10,2)", Decimal("10.50"), Decimal("100.00"), None)
    assert [r[0] for r in amounts.select(fn.number_text(F.col("x"))).collect()] == ["10.5", "100", ""]


def test_replicate_units(spark):
    df = spark.createDataFrame([(0,), (1,), (3,), (250,), (None,)], "u int")
    out = expand.replicate_units(df, "u", "n").groupBy("u").agg(F.count("*").alias("c"), F.max("n").alias("m"))
    assert {r["u"]: (r["c"], r["m"]) for r in out.collect()} == {
        0: (1, None), 1: (1, 1), 3: (3, 3), 250: (250, 250), None: (1, None),
    }
    assert [r["number"] for r in expand.number_table(spark).collect()] == list(range(1, 101))


def test_explode_refs_and_columns(spark):
    df = one(spark, "string", "a, b", "c|d", " e", None)
    got = [r["r"] for r in expand.explode_refs(df, "x", "r").collect()]
    assert got == ["a", "b", "c", "d", "e", None]
    wide = expand.per_column(df.limit(1), {"DUTIES": "G", "COST": "R"}, "name", "letter")
    assert [(r["name"], r["letter"]) for r in wide.collect()] == [("DUTIES", "G"), ("COST", "R")]


def test_predicates_fold_left(spark):
    df = spark.createDataFrame([("ab", True), ("xb", True), ("ab", False), ("x", False)], "t string, f boolean")
    either = build_predicate([("t", "CT", "A"), ("f", "EX", "True"), ("t", "EX", "X")], ["AND", "OR"])
    assert [tuple(r) for r in df.filter(either).collect()] == [("ab", True), ("x", False)]


def test_profile_types(spark):
    df = spark.createDataFrame(
        [("12", "1.50", "abc", "x" * 300, None, dt.date(2020, 1, 1), True, "12345678901", "1.12345")],
        "whole string, cents string, word string, long string, none string, day date, flag boolean, big string, fine string",
    )
    got = {r["column_name"]: r["target_type"] for r in schema.schema_profile(df).collect()}
    assert got == {
        "whole": "INTEGER", "cents": "NUMERIC(12,2)", "word": "VARCHAR(5)", "long": "TEXT", "none": "INTEGER",
        "day": "DATE", "flag": "BOOLEAN", "big": "BIGINT", "fine": "NUMERIC(12,4)",
    }
    empty = schema.schema_profile(df.filter("false")).collect()
    assert {r["target_type"] for r in empty} == {"BIGINT"}


def test_widen_decisions(spark):
    pairs = [
        ("VARCHAR(10)", "VARCHAR(25)", "VARCHAR(25)"),
        ("VARCHAR(25)", "VARCHAR(10)", None),
        ("INT", "DATETIME", "VARCHAR(25)"),
        ("INT", "INTEGER", None),
        ("BIGINT", "INTEGER", None),
        ("INTEGER", "BIGINT", "BIGINT"),
        ("DECIMAL(12,2)", "INTEGER", None),
        ("DECIMAL(12,2)", "NUMERIC(20,2)", "NUMERIC(20,2)"),
        ("DECIMAL(20,2)", "NUMERIC(12,2)", None),
        ("VARCHAR(10)", "BIGINT", None),
        ("TEXT", "VARCHAR(255)", None),
        ("DATE", "DATETIME", None),
        ("INTEGER", "VARCHAR(10)", "VARCHAR(10)"),
        ("FLOAT(12,2)", "INTEGER", None),
        ("FLOAT", "INTEGER", None),
        ("FLOAT(12,2)", "FLOAT(20,4)", "FLOAT(20,4)"),
        ("FLOAT(20,4)", "FLOAT(12,4)", None),
        ("FLOAT(20,2)", "FLOAT(12,2)", None),
        ("FLOAT(12,2)", "FLOAT(12,4)", "FLOAT(12,4)"),
        ("DECIMAL(20,4)", "NUMERIC(12,4)", None),
        ("DATETIME", "VARCHAR(25)", None),
        ("TINYINT(1)", "BOOLEAN", None),
        ("TEXT", "FLOAT(12,2)", None),
    ]
    df = spark.createDataFrame(pairs, "s string, i string, want string")
    got = df.select("want", schema.widen_decision(F.col("s"), F.col("i"), F.lit(False)).alias("got")).collect()
    assert [r["got"] for r in got] == [r["want"] for r in got]
    kept = df.filter("s = 'INTEGER'").select(schema.widen_decision(F.col("s"), F.col("i"), F.lit(True)))
    assert {r[0] for r in kept.collect()} == {None}


def test_align_coerce_and_listing(spark):
    target = spark.createDataFrame([("a", 1)], "Name string, n int")
    load = spark.createDataFrame([("b", "x")], "NAME string, extra string")
    out = schema.evolve_append(target, load)
    assert sorted(map(tuple, out.collect())) == [("a", 1, None), ("b", None, "x")]
    coerced = schema.numeric_coerce(one(spark, "string", "3", "4.0", None), ["x"])
    assert coerced.dtypes == [("x", "bigint")] and [r[0] for r in coerced.collect()] == [3, 4, 0]
    part = schema.numeric_coerce(one(spark, "string", "3", "4.25"), ["x"])
    assert part.dtypes == [("x", "decimal(6,2)")] and [float(r[0]) for r in part.collect()] == [3, 4.25]
    long = schema.numeric_coerce(one(spark, "string", "12345678901234567890.123456", "1"), ["x"])
    assert [str(r[0]) for r in long.collect()] == ["12345678901234567890.123456", "1.000000"]
    zeros = schema.schema_profile(one(spark, "int", 0, 0)).first()["all_zero"]
    mixed = schema.schema_profile(one(spark, "int", 0, None)).first()["all_zero"]
    assert zeros and not mixed
    wider = schema.evolve_append(one(spark, "int", 7), spark.createDataFrame([("a",), ("5",)], "X string"))
    assert wider.dtypes == [("x", "string")] and sorted(r[0] for r in wider.collect()) == ["5", "7", "a"]
    narrow = schema.evolve_append(one(spark, "string", "abc"), one(spark, "int", 5))
    assert sorted(r[0] for r in narrow.collect()) == ["5", "abc"]
    assert schema.column_listing(target) == [(1, "Name", "string"), (2, "n", "int")]


def test_records_and_headers(spark, tmp_path):
    body = {
        "data": [{"6": {"value": "a"}, "7": {"value": None}}, {"6": {"value": "b"}, "7": {"value": "5"}}],
        "fields": [{"id": 6, "label": "My Name", "type": "text"}, {"id": 7, "label": "Item #", "type": "numeric"}],
    }
    (tmp_path / "part.json").write_text(json.dumps(body))
    rows = records.read_records(spark, str(tmp_path))
    out = records.unwrap_records(rows, "record", {"7": "Item #", "6": "My Name"})
    assert out.columns == ["Item__Num", "My_Name"] and [tuple(r) for r in out.collect()] == [(None, "a"), ("5", "b")]
    assert records.field_columns({"7": "Item #"}) == {"7": "Item__Num"}
    stamped = records.stamp_load_date(spark.createDataFrame([("x",)], "Date string"), "2024-02-01")
    assert stamped.columns == ["record_date", "load_date"]
    assert records.pad_columns(one(spark, "string", "q"), ["a", "b"]).collect()[0].asDict() == {"a": "q", "b": None}
    (tmp_path / "sheet.csv").write_text("Seller SKU,Unit Price\ns,1\n")
    assert records.read_sheet(spark, str(tmp_path / "sheet.csv")).columns == ["seller_sku", "unit_price"]


def test_publish(spark, tmp_path):
    df = spark.createDataFrame([("a", None, "Open"), ("b", 2, None)], "k string, n int, status string")
    got = [json.loads(r["payload"]) for r in publish.payload(df, {"k": "6", "n": "7"}).collect()]
    assert got[0] == {"6": {"value": "a"}, "7": {"value": ""}}
    new = spark.createDataFrame([("c", 3, "Open")], df.schema)
    loaded = publish.purge_and_reload(df, "status", "OPEN", new)
    assert sorted(r["k"] for r in loaded.collect()) == ["b", "c"]
    assert sorted(r["k"] for r in publish.purge_and_reload(loaded, "status", "Open", new).collect()) == ["b", "c"]
    assert [r["k"] for r in publish.delete_where(df, F.col("n") == 2).collect()] == ["a"]
    path = str(tmp_path / "out")
    publish.write_slices(df.withColumn("day", F.lit("2024-01-01")), path, "day")
    publish.write_slices(new.withColumn("day", F.lit("2024-01-02")), path, "day")
    assert spark.read.parquet(path).count() == 3
    now = dt.datetime(2024, 1, 1)
    publish.log_step(spark, str(tmp_path / "log"), "ledger", "q", now, now + dt.timedelta(seconds=2))
    assert spark.read.parquet(str(tmp_path / "log")).first()["duration"] == 2.0
    sheet = spark.createDataFrame([(1, "a"), (2, "None"), (3, None)], "row_index int, v string")
    shown = publish.sheet_export(sheet)
    assert shown.columns == ["Row Index", "V"] and [r["V"] for r in shown.collect()] == ["a", "", ""]
    assert publish.append_row(sheet, {"v": "z"}, "row_index").agg(F.max("row_index")).first()[0] == 4
    assert publish.delete_rows(sheet, "row_index", 1, 2).count() == 1
    assert publish.purge(df, "status", ["open"]).count() == 1


def test_tables(spark, tmp_path):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 5),), (dt.datetime(2024, 1, 3),)], "t timestamp")
    assert tuple(tables.date_bounds(df, "t", "2023-01-01").first()) == (dt.date(2024, 1, 1), dt.date(2024, 1, 3), 3)
    assert not tables.table_exists(spark, "no_such_table")


def test_tax_line_keeps_its_group(spark):
    columns = (
        "account_name string, settlement_id int, order_id string, sku string, transaction_type string, shipment_id string,"
        "adjustment_id string, posted_date date, amount_description string, quantity_purchased int, amount decimal(16,4),"
        "settlement_start_date date, settlement_end_date date"
    )
    day = dt.date(2024, 1, 1)
    tax = ("N", 1, "o1", "s", "Order", "SH", None, day, "MarketplaceFacilitatorTax-Principal", 1, Decimal(3), day, day)
    other = ("N", 1, "o2", "s", "Refund", "SH", None, day, "MarketplaceFacilitatorTax-Principal", 1, Decimal(3), day, day)
    rows = spark.createDataFrame([tax, other], columns)
    asins = spark.createDataFrame([("n", "S", "b1")], "account_name string, sku string, asin string")
    got = finance.posted_order_fees(rows, asins).collect()
    assert [(r["order_id"], r["asin"], r["principal"], r["fba_fee"]) for r in got] == [("o1", "b1", None, None)]


def test_starting_stock_comes_first(spark):
    receipts = spark.createDataFrame(
        [
            ("N", 1, "s", "b1", "F", "2024-02-01", "Completed", 3, 6),
            ("N", 2, "s", "b1", "F", "2024-03-01", "Completed", 2, 0),
            ("N", 3, "s", "b1", "", "2024-03-01", "Completed", 9, 0),
        ],
        "account_name string, record_id_num bigint, sku string, asin string, fba_shipment_id string, eta string,"
        "po_status string, qty int, duties int",
    )
    for c in ledger.COSTS:
        receipts = receipts.withColumn(c, F.lit(6).cast("decimal(12,2)"))
    receipts = receipts.withColumn("unit_price", F.lit(1).cast("decimal(12,2)"))
    active = spark.createDataFrame([("N", "s", "b1")], "account_name string, sku string, asin string")
    stock = spark.createDataFrame(
        [("N", "s", "b1", 7), ("N", "s", "b2", 4)], "account_name string, sku string, asin string, starting_inventory int"
    )
    out = ledger.receipt_rolling(receipts, active, stock, "2023-12-29").collect()
    got = sorted(((r["id"] or 0, r["asin"], r["rolling_qty"], r["last_rolling_qty"]) for r in out))
    assert got == [(0, "b1", 7, 0), (0, "b2", 4, 7), (1, "b1", 10, 4), (2, "b1", 12, 10)]
    assert float(next(r for r in out if r["id"] == 1)["duties"]) == 2.0


def test_ledger_variants(spark):
    products = spark.createDataFrame(
        [("N", "A1", "x"), ("N", "a1", "w"), ("S", "b", "y")], "account_name string, sku string, asin string"
    )
    listed = ledger.listed_skus(products, ["A1"])
    assert [tuple(r) for r in listed.collect()] == [("N", "A1", "w")]
    removals = spark.createDataFrame(
        [("N", "o", "A1", dt.date(2024, 1, 2), "Completed", 5), ("N", "o", "A1", dt.date(2024, 1, 2), "Open", 5)],
        "account_name string, order_id string, sku string, request_date date, order_status string, shipped_quantity int",
    )
    out = ledger.removal_order_ledger(removals, listed).collect()
    assert [(r["order_status"], r["item_status"], r["asin"], r["quantity"]) for r in out] == [
        ("Removal", "Completed", "", -5)
    ]
    summary = spark.createDataFrame(
        [("N", "A1", dt.date(2024, 1, 2), "SELLABLE", "x", 1), ("N", "A1", dt.date(2024, 1, 2), "SELLABLE", "x", 2)],
        "account_name string, msku string, date date, disposition string, asin string, receipts int",
    )
    assert ledger.ledger_summary(summary, listed, ["receipts"], aggregate=False).count() == 2
    assert ledger.ledger_summary(summary, listed, ["receipts"]).first()["receipts"] == 3


def test_equal_removals_count_once(spark):
    part = spark.createDataFrame(
        [("N", "o", dt.date(2024, 1, 1), "s", "a", "Disposal", "Sellable", -1)] * 2,
        "account_name string, order_id string, date date, sku string, asin string, order_status string,"
        "item_status string, quantity bigint",
    )
    assert ledger.ledger_rows(part, part.limit(0), part.limit(0), part.limit(0)).count() == 1


def test_returned_units(spark):
    fees = spark.createDataFrame(
        [("N", "o", "s", "Return", Decimal("-30.0000")), ("N", "p", "s", "Return", Decimal("-1.0000"))],
        "account_name string, order_id string, sku string, transaction_type string, principal decimal(18,4)",
    )
    prices = spark.createDataFrame(
        [("n", "o", "S", Decimal("12.00"), 2), ("N", "p", "s", Decimal("0.00"), 1)],
        "account_name string, order_id string, sku string, unit_price decimal(18,2), quantity bigint",
    )
    out = returns.return_units(fees, prices)
    assert {r["order_id"]: r["order_line_units"] for r in out.collect()} == {"o": 3, "p": 1}


def test_sheet_orders_find_their_product(spark):
    rows = spark.createDataFrame([("a1",), ("zz",)], "sku string")
    products = spark.createDataFrame(
        [(7, "SHOP", "A1", "B0")], "record_id bigint, account_name string, sku string, asin string"
    )
    out = purchase_orders.sheet_products(rows, products, "shop").collect()
    assert [(r["record_id"], r["asin"]) for r in out] == [("7", "B0"), ("", "")]
