"""Payloads for the record store, load modes and sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sellerbooks.functions.columns import text_is


def payload(df: DataFrame, fields: Mapping[str, str], name: str = "payload") -> DataFrame:
    """Add the JSON a record becomes: ``{field id: {"value": text}}``, NULL as blank text.

    ``fields`` maps column names to field ids.
    """
    cells = [
        F.struct(F.coalesce(F.col(c).cast("string"), F.lit("")).alias("value")).alias(i) for c, i in fields.items()
    ]
    return df.withColumn(name, F.to_json(F.struct(*cells)))


def numbered_fields(columns: Sequence[str], first: int = 6) -> dict[str, str]:
    """A field map with consecutive ids, for tables whose ids are not given."""
    return {c: str(first + i) for i, c in enumerate(columns)}


def purge(target: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Target rows left after removing those whose column equals one of ``values``."""
    gone = F.lower(F.col(column)).isin([v.lower() for v in values])
    return target.filter(~F.coalesce(gone, F.lit(False)))


def still_published(published: DataFrame, status: str, changing: Sequence[str]) -> DataFrame:
    """Published rows that are final: those in a state that may still change are purged before a load."""
    return purge(published, status, changing)


def purge_and_reload(target: DataFrame, column: str, value: str, new: DataFrame) -> DataFrame:
    """Replace the target rows that hold ``value`` by the new rows."""
    return purge(target, column, [value]).unionByName(new, allowMissingColumns=True)


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is not true (NULL keeps the row)."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def map_values(df: DataFrame, column: str, values: Mapping[str, str]) -> DataFrame:
    """Replace texts of a column, ignoring case; other texts stay."""
    result = F.col(column)
    for old, new in values.items():
        result = F.when(text_is(column, old), F.lit(new)).otherwise(result)
    return df.withColumn(column, result)


def sheet_header(name: str) -> str:
    return name.replace("_", " ").title()


def sheet_export(df: DataFrame) -> DataFrame:
    """Cells as a sheet takes them: numbers stay, the rest is text with blanks for missing; headers in title case."""
    floats = {f.name for f in df.schema.fields if f.dataType.simpleString() in ("double", "float")}
    cells = []
    for c in df.columns:
        if c in floats:
            cells.append(F.col(c))
        else:
            text = F.col(c).cast("string")
            cells.append(F.when(text.isNull() | text.isin("None", "nan"), "").otherwise(text).alias(c))
    return df.select(*cells).toDF(*[sheet_header(c) for c in df.columns])


def append_row(df: DataFrame, row: Mapping[str, str], index: str) -> DataFrame:
    """Add one row at the end of a sheet; its row index follows the largest one."""
    values = [F.lit(row[c]).cast(df.schema[c].dataType).alias(c) if c in row else F.lit(None).cast(df.schema[c].dataType).alias(c) for c in df.columns if c != index]
    last = df.agg(F.max(index).alias("_last"))
    new = last.select((F.col("_last") + 1).cast(df.schema[index].dataType).alias(index), *values)
    return df.unionByName(new)


def delete_rows(df: DataFrame, index: str, first: int, last: int) -> DataFrame:
    """Drop sheet rows by row index, both ends included."""
    return df.filter(~F.col(index).between(first, last))


def sort_sheet(df: DataFrame, *columns: Column | str) -> DataFrame:
    return df.orderBy(*columns)


def write_slices(df: DataFrame, path: str, day: str, rows_per_file: int = 1000) -> None:
    """Publish by day: one folder per day, overwritten alone, at most ``rows_per_file`` rows a file.

    Only days that ``df`` has rows of are touched; a day that has lost all its rows stays as it was.
    Rows of a day are brought together, so that a task writes few days; a day that holds most
    rows is split again, as ``rebalance`` does not promise to keep it whole.
    """
    (
        df.hint("rebalance", day)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(day)
        .parquet(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    """Cells as they are: blanks at the ends of a cell stay."""
    df.write.mode("overwrite").csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def log_step(spark, path: str, script: str, query: str, started, ended) -> None:
    """Append one row with the run time of a step."""
    row = spark.createDataFrame(
        [(script, query, started, ended, (ended - started).total_seconds())],
        "script string, query string, start_time timestamp, end_time timestamp, duration double",
    )
    row.write.mode("append").parquet(path)
