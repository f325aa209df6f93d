"""Loads into stored tables: days published alone, batches published once, imports through the catalog."""

import json

import pytest
from pyspark.sql import functions as F

from sellerbooks.plans import loads
from sellerbooks.sources import publish, stored


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_only_changed_days_are_written_and_only_wanted_ones_read(spark, tmp_path):
    path = str(tmp_path / "days")
    rows = spark.range(60).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 6).cast("int")).alias("day"))
    publish.write_slices(rows, path, "day")
    written = {f.name: [p.name for p in f.glob("*.parquet")] for f in (tmp_path / "days").glob("day=*")}
    changed = rows.filter("day = DATE '2024-01-03' AND id < 20").withColumn("id", -F.col("id"))
    back = loads.republished_days(rows.limit(0), changed, "day", path, F.lit("2024-01-03").cast("date"))
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "PushedFilters: []" in plan
    again = {f.name: [p.name for p in f.glob("*.parquet")] for f in (tmp_path / "days").glob("day=*")}
    assert {d for d in written if written[d] != again[d]} == {"day=2024-01-03"}
    assert back.filter("day = DATE '2024-01-03'").count() == 3 and back.count() == 3 + 30
    assert loads.read_slices(spark, path, "day", F.lit("2024-01-02").cast("date"), F.lit("2024-01-03").cast("date")).count() == 13


def test_batches_survive_a_broken_run_and_repeats(spark, tmp_path):
    path = str(tmp_path / "batches")
    rows = spark.range(2500).select(F.lit("North").alias("account_name"), F.concat(F.lit("s"), F.format_string("%05d", "id")).alias("sku"))
    batched = loads.payload_batches(rows, {"sku": "6"}, ["sku"])
    # A task that is lost for good: nothing of its run shows.
    broken = batched.withColumn("payload", F.when(F.col("sku") == "s01700", F.raise_error(F.lit("lost task"))).otherwise(F.col("payload")))
    with pytest.raises(Exception, match="lost task"):
        loads.publish_batches(broken.coalesce(3), path)
    assert stored.current(spark, path) is None
    assert loads.publish_batches(batched.filter("batch_id = 1"), path).row_count == 1000
    assert loads.publish_batches(batched, path).row_count == 2500
    assert loads.publish_batches(batched.repartition(5), path) is None
    back = stored.read(spark, path)
    assert back.count() == back.select("sku").distinct().count() == 2500
    # A batch with other rows is another batch.
    loads.publish_batches(batched.filter("batch_id = 2").withColumn("payload", F.lit("{}")), path)
    assert stored.current(spark, path).row_count == 3000


def test_import_is_typed_stored_and_shown_in_the_catalog(spark, tmp_path):
    bodies = [{"3": {"value": str(i)}, "6": {"value": f"{i}.50"}, "7": {"value": None if i else "red"}} for i in range(3)]
    raw = spark.createDataFrame([(json.dumps(b),) for b in bodies], "record string")
    path, fields = str(tmp_path / "t"), {"3": "Record ID#", "6": "List Price", "7": "Color"}
    shown = loads.store_import(raw, "record", fields, path, "imported_test")
    assert shown.dtypes == [("Record_ID_Num", "int"), ("List_Price", "decimal(12,2)"), ("Color", "string")]
    assert rows_of(spark.table("imported_test").selectExpr("Record_ID_Num", "string(List_Price)")) == [(0, "0.50"), (1, "1.50"), (2, "2.50")]
    bad = raw.withColumn("record", F.raise_error(F.lit("no answer")).cast("string"))
    with pytest.raises(Exception, match="no answer"):
        loads.store_import(bad, "record", fields, path, "imported_test")
    assert spark.table("imported_test").count() == 3 and stored.read(spark, path).count() == 3


def test_a_failing_step_ends_the_run_and_keeps_its_table(spark, tmp_path):
    folder = str(tmp_path / "run")
    steps = {
        "steps_first": lambda s: s.range(5),
        "steps_second": lambda s: s.table("steps_first").filter("id > 1"),
        "steps_third": lambda s: s.table("steps_second").withColumn("twice", F.col("id") * 2),
    }
    report = loads.steps_report(loads.run_steps(spark, "demo", steps, folder), list(steps))
    assert rows_of(report.select("query", "row_count", "in_order")) == [
        ("steps_first", 5, True), ("steps_second", 3, True), ("steps_third", 3, True)
    ]
    assert rows_of(spark.table("steps_third")) == [(2, 4), (3, 6), (4, 8)]
    broken = steps | {
        "steps_first": lambda s: s.range(7),
        "steps_second": lambda s: s.table("steps_first").withColumn("id", F.raise_error(F.lit("no source")).cast("long")),
    }
    with pytest.raises(Exception, match="no source"):
        loads.run_steps(spark, "demo", broken, folder)
    assert [stored.read(spark, f"{folder}/{n}").count() for n in steps] == [7, 3, 3]
    assert spark.read.parquet(f"{folder}/log").groupBy("query").count().filter("count = 2").collect()[0]["query"] == "steps_first"
