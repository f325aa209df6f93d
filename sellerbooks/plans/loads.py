"""Loads into stored tables: typed imports, keyed tables, appends that evolve, days and batches published once, logged steps."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sellerbooks.operators.ordered import batches
from sellerbooks.operators.schema import profile_of
from sellerbooks.plans.imports import typed
from sellerbooks.sources import publish, stored, tables
from sellerbooks.sources.records import unwrap_records

BATCH = 1000


def store_import(records: DataFrame, column: str, fields: Mapping[str, str], path: str, view: str) -> DataFrame:
    """Replace a record table by the typed rows of a query and show it in the catalog under ``view``."""
    spark = records.sparkSession
    stored.replace(typed(unwrap_records(records, column, fields)), path)
    stored.read(spark, path).createOrReplaceTempView(view)
    return spark.table(view)


def load_keyed(rows: DataFrame, path: str, keys: Sequence[str]) -> DataFrame | None:
    """Replace a table that has a key; where the key refuses the load, the violations, and the table is as it was."""
    try:
        stored.replace(rows, path, keys)
    except stored.KeyViolation as refused:
        return refused.violations
    return None


def keyed_listing(listing: DataFrame, load: DataFrame, keys: Sequence[str], path: str) -> DataFrame:
    """Rows of a listing stored under its key, and what a second load was refused for."""
    load_keyed(listing, path, keys)
    refused = load_keyed(load, path, keys)
    kept = stored.read(listing.sparkSession, path).withColumn("outcome", F.lit("stored"))
    if refused is None:
        return kept.withColumn("refused", F.lit(None).cast("bigint"))
    return kept.unionByName(refused.withColumn("outcome", F.lit("refused")), allowMissingColumns=True)


def evolved_profile(target: DataFrame, load: DataFrame, path: str) -> DataFrame:
    """The profile of a table after an append, from the states kept beside it."""
    stored.replace(target, path)
    stored.append(load, path)
    return profile_of(stored.state(target.sparkSession, path))


def read_slices(spark: SparkSession, path: str, day: str, first: Column, last: Column | None = None) -> DataFrame:
    """The published days from ``first`` on; other days' folders are not read."""
    days = spark.read.parquet(path).filter(F.col(day) >= first)
    return days if last is None else days.filter(F.col(day) <= last)


def republished_days(rows: DataFrame, changed: DataFrame, day: str, path: str, first: Column) -> DataFrame:
    """Publish all days, then only those that changed, and read them back."""
    publish.write_slices(rows, path, day)
    publish.write_slices(changed, path, day)
    return read_slices(rows.sparkSession, path, day, first)


def publish_batches(rows: DataFrame, path: str) -> stored.Version | None:
    """Publish payload batches that are not published yet; a batch is known by its content.

    Rows have ``batch_id``. A batch's name is made of the hashes of its rows; names already
    committed are left out, so a run that is repeated, or repeats what a broken one had
    committed, adds nothing twice. None where nothing was left to publish.
    """
    spark = rows.sparkSession
    parts = [F.sum(F.xxhash64(F.lit(seed), F.to_json(F.struct(*rows.columns))).cast("decimal(38,0)")) for seed in (0, 1)]
    names = rows.groupBy("batch_id").agg(F.concat_ws("-", F.count(F.lit(1)), *parts).alias("batch_name"))
    fresh = rows.join(names, "batch_id").select(*rows.columns, "batch_name")
    if stored.current(spark, path) is not None:
        known = stored.read(spark, path).select("batch_name").distinct()
        fresh = fresh.join(known, "batch_name", "left_anti")
    if fresh.isEmpty():
        return None
    return stored.append(fresh.select(*rows.columns, "batch_name"), path)


def payload_batches(rows: DataFrame, fields: Mapping[str, str], order: Sequence[str]) -> DataFrame:
    """(batch_id, key columns, payload) of rows to publish, in batches of 1000."""
    numbered = batches(rows, [F.col(c) for c in order], BATCH)
    return publish.payload(numbered, fields).select("batch_id", *order, "payload")


def run_steps(spark: SparkSession, script: str, steps: Mapping[str, Callable[[SparkSession], DataFrame]], folder: str) -> DataFrame:
    """Run the steps of a script in order and return the log: script, query, start, end and duration of each.

    A step's rows replace its stored table, which the steps behind it read from the catalog
    by its name. Its run time is logged once the rows are committed. A step that fails
    leaves its table of an earlier run as it was and nothing in the log, and ends the run.
    """
    log = f"{folder}/log"
    for name, step in steps.items():
        started = dt.datetime.now()
        stored.replace(step(spark), f"{folder}/{name}")
        stored.read(spark, f"{folder}/{name}").createOrReplaceTempView(name)
        publish.log_step(spark, log, script, name, started, dt.datetime.now())
    return spark.read.parquet(log)


def steps_report(log: DataFrame, names: Sequence[str]) -> DataFrame:
    """Each logged step with the rows of its table and whether it began behind the end of the step before."""
    spark = log.sparkSession
    counts = spark.createDataFrame([], "row_count long, query string")
    for name in names:
        if tables.table_exists(spark, name):
            counts = counts.unionByName(tables.row_count(spark.table(name)).withColumn("query", F.lit(name)))
    before = Window.partitionBy("script").orderBy("start_time")
    in_order = F.coalesce(F.lag("end_time").over(before) <= F.col("start_time"), F.lit(True))
    timed = F.col("duration") >= 0
    return log.withColumn("in_order", in_order & timed).join(counts, "query", "left")
