"""Table scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scan(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def scan_filtered(df: DataFrame, columns: Sequence[str], *conditions: Column) -> DataFrame:
    """Filter and column list, both of which reach the Parquet scan."""
    for condition in conditions:
        df = df.filter(condition)
    return df.select(*columns)


def read_jdbc(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """A live source; the query runs there, so its filter and columns are pushed down."""
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def date_bounds(df: DataFrame, column: str, since: str) -> DataFrame:
    """First and last day from ``since`` on, and the number of days they span."""
    day = F.to_date(column)
    return (
        df.filter(F.col(column) >= F.lit(since).cast("date"))
        .agg(F.min(day).alias("start_date"), F.max(day).alias("end_date"))
        .withColumn("days", F.date_diff("end_date", "start_date") + 1)
    )
