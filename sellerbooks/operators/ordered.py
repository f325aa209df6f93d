"""Ranks, running sums and previous values over groups of any size.

All but ``number_few`` are prefix scans over sampled ranges of the whole order (``scan``):
a group or a day that holds most rows lies over as many tasks as its rows need.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sellerbooks.functions.columns import folded
from sellerbooks.operators import scan as scans
from sellerbooks.session import materialise


def _with(rows: DataFrame, **columns: Column) -> DataFrame:
    return rows.withColumns(columns).drop("_local", "_carried", "_above")


def number_rows(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], name: str) -> DataFrame:
    """``row_number`` within ``keys``."""
    return _with(scans.scan(df, keys, order_by), **{name: scans.number()})


def number_few(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], name: str) -> DataFrame:
    """``row_number`` within ``keys`` whose groups an aggregation has already made small."""
    window = Window.partitionBy(*[folded(df, k) for k in keys]).orderBy(*order_by)
    return df.withColumn(name, F.row_number().over(window))


def sum_before(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], value: Column, name: str) -> DataFrame:
    """Sum of the whole-number ``value`` over the rows before this one; zero for the first."""
    rows = scans.scan(df.withColumn("_own", value), keys, order_by, value=F.col("_own"))
    so_far = F.coalesce(scans.total_with_row(), F.lit(0)) - F.coalesce(F.col("_own").cast("bigint"), F.lit(0))
    return _with(rows, **{name: so_far}).drop("_own")


def running_sum(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], value: Column, name: str) -> DataFrame:
    """Running sum of a whole number in which rows that tie on ``order_by`` share one sum."""
    return _with(scans.scan(df, keys, order_by, (), value=value), **{name: scans.running()})


def running_and_previous(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column],
    ties: Sequence[Column],
    value: Column,
    running: str,
    previous: str,
) -> DataFrame:
    """Running sum by ``order_by`` and the sum of the row before, by ``order_by`` then ``ties``; one scan for both."""
    rows = scans.scan(df, keys, order_by, ties, value=value)
    return _with(rows, **{running: scans.running(), previous: F.coalesce(scans.running_above(), F.lit(0))})


def previous_value(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], value: str, name: str) -> DataFrame:
    """``lag(value, 1)`` within ``keys``, zero where there is none. ``order_by`` must be total."""
    rows = scans.scan(df, keys, order_by, last=value)
    return _with(rows, **{name: F.coalesce(F.col("_above.v"), F.lit(0))})


def global_sequence(
    df: DataFrame,
    order_by: Sequence[Column],
    name: str,
    start: int | Column = 1,
    stage: Callable[[DataFrame], DataFrame] = materialise,
) -> DataFrame:
    """Dense numbers over the whole frame in ``order_by`` order, with no single-task sort.

    Rows are range-partitioned and sorted, then written once: range bounds are
    sampled, so a second evaluation could cut elsewhere. The offsets hold one row
    per written partition, which bounds the broadcast and the window over them.
    """
    slots = stage(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_slot", F.monotonically_increasing_id())
    )
    part = F.shiftright("_slot", 33)
    sizes = slots.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    position = F.col("_offset") + F.col("_slot").bitwiseAND((1 << 33) - 1)
    first = start if isinstance(start, Column) else F.lit(start)
    return (
        slots.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, (position + first).cast("bigint"))
        .drop("_part", "_offset", "_slot")
    )


def batches(df: DataFrame, order_by: Sequence[Column], size: int = 1000, name: str = "batch_id") -> DataFrame:
    """Number the rows into publish batches of ``size``, the last one shorter."""
    numbered = global_sequence(df, order_by, "_position", start=0)
    return numbered.withColumn(name, F.floor(F.col("_position") / size).cast("bigint")).drop("_position")
