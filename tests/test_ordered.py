"""Chunked windows against plain windows and hand-worked cases."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from sellerbooks.operators import ordered


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def random_rows(spark, n=600, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # One key holds most rows; keys and values may be missing and days repeat.
        key = "hot" if rng.random() < 0.6 else rng.choice(["Cold", "cold", None, "b"])
        day = rng.choice([None, *range(1, 9)])
        rows.append((key, day, rng.randrange(40), rng.choice([None, -3, 0, 1, 5]), i))
    return spark.createDataFrame(rows, "k string, day int, ref int, v int, id int")


def test_number_rows_equals_plain_window(spark):
    df = random_rows(spark)
    order = [F.col("day"), F.col("ref"), F.col("id")]
    ours = ordered.number_rows(df, ["k"], order, "n")
    plain = df.withColumn("n", F.row_number().over(Window.partitionBy(F.lower("k")).orderBy(*order)))
    assert rows_of(ours, "id", "n") == rows_of(plain, "id", "n")


def test_number_rows_without_days(spark):
    df = random_rows(spark, seed=5)
    order = [F.col("ref"), F.col("id")]
    ours = ordered.number_rows(df, ["k"], order, "n")
    plain = df.withColumn("n", F.row_number().over(Window.partitionBy(F.lower("k")).orderBy(*order)))
    assert rows_of(ours, "id", "n") == rows_of(plain, "id", "n")
    assert ordered.number_rows(df.filter("false"), ["k"], order, "n").count() == 0


def test_running_and_previous_equal_plain_windows(spark):
    df = random_rows(spark)
    order, ties = [F.col("day"), F.col("ref")], [F.col("id")]
    ours = ordered.running_and_previous(df, ["k"], order, ties, F.col("v"), "run", "prev")
    by = Window.partitionBy(F.lower("k"))
    plain = df.withColumn("run", F.sum("v").over(by.orderBy(*order)))
    plain = plain.withColumn("prev", F.coalesce(F.lag("run").over(by.orderBy(*order, *ties)), F.lit(0)))
    assert rows_of(ours, "id", "run", "prev") == rows_of(plain, "id", "run", "prev")


def test_running_sum_previous_value_and_sum_before(spark):
    df = random_rows(spark, seed=8)
    by = Window.partitionBy(F.lower("k"))
    total = [F.col("day"), F.col("ref"), F.col("id")]
    run = ordered.running_sum(df, ["k"], [F.col("day")], F.col("v"), "x")
    assert rows_of(run, "id", "x") == rows_of(df.withColumn("x", F.sum("v").over(by.orderBy("day"))), "id", "x")
    prev = ordered.previous_value(df, ["k"], total, "v", "x")
    plain = df.withColumn("x", F.coalesce(F.lag("v").over(by.orderBy(*total)), F.lit(0)))
    assert rows_of(prev, "id", "x") == rows_of(plain, "id", "x")
    before = ordered.sum_before(df, ["k"], total, F.col("v"), "x")
    frame = by.orderBy(*total).rowsBetween(Window.unboundedPreceding, -1)
    assert rows_of(before, "id", "x") == rows_of(
        df.withColumn("x", F.coalesce(F.sum("v").over(frame), F.lit(0))), "id", "x"
    )


def test_tied_running_sum(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 5), ("a", 2, 5), ("a", 3, 1)], "k string, o int, v int")
    out = ordered.running_sum(df, ["k"], [F.col("o")], F.col("v"), "run")
    assert sorted(r["run"] for r in out.collect()) == [10, 20, 20, 21]


def test_global_sequence_is_dense_and_ordered(spark):
    df = random_rows(spark).repartition(7)
    order = [F.col("day").desc(), F.col("id")]
    ours = ordered.global_sequence(df, order, "n", start=11)
    plain = df.withColumn("n", F.row_number().over(Window.orderBy(*order)) + 10)
    assert rows_of(ours, "id", "n") == rows_of(plain, "id", "n")


def test_global_sequence_of_equal_rows_and_of_none(spark):
    same = spark.range(50).select(F.lit("x").alias("a"))
    assert sorted(r["n"] for r in ordered.global_sequence(same, [F.col("a")], "n").collect()) == list(range(1, 51))
    assert ordered.global_sequence(same.filter("a = 'y'"), [F.col("a")], "n").count() == 0


def test_batches(spark):
    out = ordered.batches(spark.range(2500), [F.col("id")], 1000).groupBy("batch_id").count()
    assert {r["batch_id"]: r["count"] for r in out.collect()} == {0: 1000, 1: 1000, 2: 500}


def test_scans_over_many_ranges_and_batches(spark):
    """Keys and ties that reach over Arrow batches and keys that reach over ranges."""
    rng = random.Random(12)
    rows = [(rng.choice(["hot"] * 8 + ["b", None]), rng.choice([None, 1, 2]), rng.choice([None, None, 2, -1]), i) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, o int, v int, id int")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        by = Window.partitionBy("k")
        order, ties = [F.col("o")], [F.col("id")]
        ours = ordered.running_and_previous(df, ["k"], order, ties, F.col("v"), "run", "prev")
        plain = df.withColumn("run", F.sum("v").over(by.orderBy("o")))
        plain = plain.withColumn("prev", F.coalesce(F.lag("run").over(by.orderBy("o", "id")), F.lit(0)))
        assert rows_of(ours, "id", "run", "prev") == rows_of(plain, "id", "run", "prev")
        # One key on one day: the order goes on in the id, so the key lies over all ranges.
        one = df.withColumn("k", F.lit("x"))
        total = [F.lit(1), F.col("id").desc()]
        ours = ordered.sum_before(one, ["k"], total, F.col("v"), "x")
        frame = Window.partitionBy("k").orderBy(F.col("id").desc()).rowsBetween(Window.unboundedPreceding, -1)
        assert rows_of(ours, "id", "x") == rows_of(one.withColumn("x", F.coalesce(F.sum("v").over(frame), F.lit(0))), "id", "x")
        ours = ordered.previous_value(one, [], [F.col("id")], "o", "x")
        plain = one.withColumn("x", F.coalesce(F.lag("o").over(Window.orderBy("id")), F.lit(0)))
        assert rows_of(ours, "id", "x") == rows_of(plain, "id", "x")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_scans_of_no_rows_and_of_missing_values(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, None), ("b", 1, 4)], "k string, o int, v int")
    out = ordered.running_sum(df, ["k"], [F.col("o")], F.col("v"), "run")
    assert rows_of(out, "k", "o", "run") == [("a", 1, None), ("a", 2, None), ("b", 1, 4)]
    assert ordered.running_sum(df.filter("false"), ["k"], [F.col("o")], F.col("v"), "run").count() == 0


def test_a_hot_key_is_scanned_by_many_tasks(spark, monkeypatch):
    from sellerbooks.session import materialise as written

    df = spark.range(4000).select(F.lit("hot").alias("k"), F.lit(1).alias("day"), F.col("id").alias("ref"), F.lit(2).alias("v"))
    sizes = []
    # Rows as few as these would otherwise be put together again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    monkeypatch.setattr(ordered.scans, "materialise", lambda rows: sizes.append(written(rows)) or sizes[-1])
    ranged = ordered.scans.scan(df.repartition(5), ["k"], [F.col("day"), F.col("ref")], value=F.col("v"))
    assert ranged.select(F.max(ordered.scans.total_with_row())).first()[0] == 8000
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert max(r["count"] for r in sizes[0].groupBy(F.shiftright("_slot", 33)).count().collect()) < 2000
