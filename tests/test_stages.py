"""Stages that leave no shuffle files, and the plans that are cut by them, on hand-made rows."""

import datetime as dt
from decimal import Decimal
from pathlib import Path

from pyspark.sql import functions as F

from sellerbooks.operators import grouping
from sellerbooks.plans import finance, orders, returns
from sellerbooks.session import materialise, passing_stages

ITEMS = "account_name string, amazon_order_id string, sku string, order_status string, item_status string, quantity int, item_price decimal(12,2), asin string, purchase_date timestamp"
FEES = "account_name string, order_id string, sku string, transaction_type string, group_id string, ranking int, fba_fee decimal(18,4), commission decimal(18,4), principal decimal(18,4)"
UNITS = "account_name string, order_id string, sku string, posted_date date, group_id string, order_line_units bigint"


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_a_stage_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    sums = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).agg(F.sum("id").alias("s"))
    assert materialise(sums.join(sums.withColumnRenamed("s", "t"), "k")).count() == 100
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    left = {f for f in shuffle_files(spark) - before if f.endswith(".data")}
    # The count itself shuffles one row of each task; nothing of the stage is left.
    assert len(left) <= 1 + spark.sparkContext.defaultParallelism and spark.conf.get(name, None) is None


def test_passing_stages_are_deleted_and_may_be_nested(spark):
    with passing_stages(spark) as outer:
        with passing_stages(spark) as inner:
            first = inner(spark.range(10).toDF("a"))
            second = outer(first.filter("a > 3"))
        place = Path(first.inputFiles()[0].removeprefix("file://"))
        assert not place.exists() and second.count() == 6
        kept = materialise(second.filter("a > 5"))
    assert kept.count() == 4 and not Path(second.inputFiles()[0].removeprefix("file://")).exists()


def items(spark):
    day, later = dt.datetime(2022, 1, 1), dt.datetime(2022, 1, 2)
    return spark.createDataFrame(
        [
            ("North", "o1", "s1", "Shipped", "Shipped", 2, Decimal("4.00"), "b", day),
            ("NORTH", "O1", "S1", "shipped", "SHIPPED", 1, Decimal("2.00"), "a", later),
            ("north", "o1", "s1", "Shipped", "Shipped", 1, Decimal("3.00"), None, later),
            ("North", "o1", "s1", "Cancelled", "Shipped", 1, None, "b", day),
            (None, None, "s1", "Shipped", None, 0, Decimal("3.00"), "b", day),
            (None, None, "s1", "Shipped", None, 5, Decimal("15.00"), "b", day),
        ],
        ITEMS,
    )


def test_order_lines_are_summed_over_spellings_and_numbered_behind_one_shuffle(spark):
    lines = orders.order_lines(items(spark), stage=materialise)
    assert shuffles(lines) == 1
    got = {(r.account_name, r.amazon_order_id, r.order_status, r.unit_price): (r.quantity, r.ranking, r.asin) for r in lines.collect()}
    assert got == {
        ("NORTH", "O1", "Shipped", Decimal("2.00")): (3, 1, "a"),
        ("north", "o1", "Shipped", Decimal("3.00")): (1, 2, None),
        ("North", "o1", "Cancelled", None): (1, 1, "b"),
        (None, None, "Shipped", Decimal("3.00")): (5, 1, "b"),
    }
    assert sorted(map(str, lines.collect())) == sorted(map(str, orders.order_lines(items(spark)).collect()))


def test_group_and_number_equals_grouping_and_a_window(spark):
    rows = spark.createDataFrame([(f"{'aA'[i % 2]}{i % 3}", i % 5, i) for i in range(60)], "k string, v int, n int")
    got = grouping.group_and_number(rows, ["k"], ["v"], [F.sum("n").alias("n")], [F.col("v")], "no")
    assert sorted((r.k, r.v, r.n, r.no) for r in got.collect()) == sorted(
        (f"A{k}", v, sum(i for i in range(60) if i % 3 == k and i % 5 == v), v + 1) for k in range(3) for v in range(5)
    )


def test_lines_without_shipment_get_no_fees_and_are_not_shuffled(spark):
    line = "account_name string, amazon_order_id string, sku string, order_status string, shipment_id string, new_ranking int, id bigint"
    repaired = spark.createDataFrame(
        [("North", "o1", "s1", "Shipped", None, 1, 1), ("NORTH", "O1", "s1", "Shipped", "sh1", 1, 2), ("North", "o1", "s1", "Shipped", "sh2", 1, 3)],
        line,
    )
    one = Decimal("1.0000")
    fees = spark.createDataFrame(
        [("north", "o1", "S1", "shipped", "SH1", 1, one, one, one), ("north", "o1", "s1", "Shipped", None, 1, one, one, one)], FEES
    )
    final = orders.final_assigned_orders(repaired, fees)
    assert {r.id: r.fba_fee for r in final.collect()} == {1: 0, 2: 1, 3: 0}
    assert final.columns == [*repaired.columns, *orders.FEES]
    assert "Union" in final._jdf.queryExecution().executedPlan().toString()


def test_only_units_that_a_return_can_meet_are_made(spark):
    day = dt.date(2023, 5, 1)
    units = spark.createDataFrame(
        [
            ("North", "o1", "s1", day, "g1", 2),
            ("NORTH", "O1", "S1", dt.date(2023, 5, 2), "g2", 10_000_000),
            ("North", "o2", "s1", day, None, 10_000_000),
            ("North", "o3", "s1", day, "g1", 3),
            (None, "o4", "s1", day, "g1", 3),
        ],
        UNITS,
    )
    lines = [("north", "o1", "s1", i + 1) for i in range(4)] + [("North", "o2", "s1", 1), ("North", "o9", "s1", 1), (None, "o4", "s1", 1)]
    lines = spark.createDataFrame(lines, "account_name string, order_id string, sku string, ranking int")
    made = returns.return_expand(units, returns.last_rankings(lines))
    assert made.count() == 5
    got = returns.assign_returns(lines, made)
    assert sorted((r.ranking, r.group_id, r.order_line_units) for r in got.collect()) == [
        (1, "g1", 2), (2, "g1", 2), (3, "g2", 10_000_000), (4, "g2", 10_000_000)
    ]


def test_posted_fees_are_the_same_with_and_without_stages(spark):
    day = dt.date(2023, 5, 1)
    kinds = ("Principal", "commission", "FBAPerUnitFulfillmentFee", "MarketplaceFacilitatorTax-Principal")
    rows = [
        (a, 1, o, "Sku", "Order", g, None, day, k, 2, Decimal("1.5"), day, day)
        for a in ("North", "NORTH", None) for o in ("o1", "O1", None) for g in ("g", None) for k in kinds
    ]
    columns = "account_name string, settlement_id int, order_id string, sku string, transaction_type string, shipment_id string, adjustment_id string, posted_date date, amount_description string, quantity_purchased int, amount decimal(16,4), settlement_start_date date, settlement_end_date date"
    table = spark.createDataFrame(rows, columns)
    asins = spark.createDataFrame([("north", "sku", "b1")], "account_name string, sku string, asin string")
    with passing_stages(spark) as stage:
        staged = finance.posted_order_fees(table, asins, stage=stage)
        assert shuffles(staged) <= 2
        found = sorted(map(str, staged.collect()))
    assert len(found) == 8 and found == sorted(map(str, finance.posted_order_fees(table, asins).collect()))
