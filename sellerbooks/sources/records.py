"""Records and sheet grids as they arrive: nested values, labels, padded columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sellerbooks.operators.schema import numeric_coerce
from sellerbooks.session import materialise

CELL = "map<string,struct<value:string>>"
# Cells that keep the type they have in the response.
TYPED_CELL = "map<string,struct<value:variant>>"
# The field types of a report whose cells are not text.
NUMBERS = ("numeric", "currency", "percent", "rating", "recordid")
DAYS, TIMES, FLAGS = ("date",), ("datetime", "timestamp"), ("checkbox",)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Staged query responses: one JSON document per file, its rows under ``data``."""
    schema = f"data array<{CELL}>, fields array<struct<id:bigint,label:string,type:string>>"
    return spark.read.schema(schema).json(path, multiLine=True).select(F.explode("data").alias("record"))


def read_report(spark: SparkSession, path: str) -> tuple[DataFrame, dict[str, str]]:
    """A saved report: its rows, and the labels of its fields (a few per report) that the response carries."""
    schema = f"data array<{CELL}>, fields array<struct<id:bigint,label:string,type:string>>"
    response = spark.read.schema(schema).json(path, multiLine=True)
    labels = response.select(F.explode("fields").alias("f")).select("f.id", "f.label").distinct().orderBy("id").collect()
    return response.select(F.explode("data").alias("record")), {str(r["id"]): r["label"] for r in labels}


def read_typed_report(spark: SparkSession, path: str, pages_as_lines: bool = False) -> DataFrame:
    """A saved report as a table whose names, order and types come from the ``fields`` of its own responses.

    A response, one page of the report, is a file, or with ``pages_as_lines`` a line of a
    file. Numbers become BIGINT, decimals or DOUBLE as their values need; days, times and
    flags get their types, and one that is malformed stops the job; other cells are text,
    lists and objects as JSON. Missing and blank cells are NULL in every type. All pages
    must describe a field alike, and labels must differ; a report without any response is
    an error, one without rows an empty table.
    """
    fields = "array<struct<id:bigint,label:string,type:string,fieldType:string>>"
    response = spark.read.schema(f"data array<{TYPED_CELL}>, fields {fields}").json(path, multiLine=not pages_as_lines)
    found = (
        response.select(F.posexplode("fields").alias("place", "f"))
        .groupBy(F.col("f.id").alias("id"))
        # One row per field of the report.
        .agg(F.min("place").alias("place"), F.collect_set(F.struct("f.label", F.coalesce("f.type", "f.fieldType").alias("kind"))).alias("said"))
        .orderBy("place", "id")
        .collect()
    )
    if not found:
        raise ValueError(f"no fields in the report at {path}")
    unlike = [r["id"] for r in found if len(r["said"]) != 1]
    if unlike:
        raise ValueError(f"pages describe fields {unlike} differently")
    names = [label_name(r["said"][0]["label"]).lower() for r in found]
    if len(set(names)) < len(names):
        raise ValueError(f"fields with the same label in {names}")
    rows = response.select(F.explode("data").alias("record"))
    cells, numbers = [], []
    for r in found:
        label, kind = r["said"][0]
        text = F.variant_get(F.col("record")[str(r["id"])]["value"], "$", "string")
        given = F.when(F.trim(text) != "", text)
        if kind in DAYS:
            text = given.cast("date")
        elif kind in TIMES:
            text = given.cast("timestamp")
        elif kind in FLAGS:
            text = given.cast("boolean")
        elif kind in NUMBERS:
            numbers.append(label_name(label))
        cells.append(text.alias(label_name(label)))
    # A text cell that is blank is missing as well.
    shaped = rows.select(*cells)
    plain = [f.name for f in shaped.schema.fields if f.dataType.simpleString() == "string"]
    shaped = shaped.withColumns({c: F.when(F.trim(F.col(c)) != "", F.col(c)) for c in plain})
    return numeric_coerce(shaped, numbers, keep_missing=True) if numbers else shaped


def label_name(label: str) -> str:
    return label.replace(" ", "_").replace("#", "_Num")


def unwrap_records(df: DataFrame, record: str, fields: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Cells of a record as columns, in the order of ``fields`` (field id to label).

    A record may still be JSON text; it is parsed with a fixed schema.
    """
    cells = F.col(record)
    if df.schema[record].dataType.simpleString() == "string":
        df = df.withColumn(record, F.from_json(cells, CELL))
    return df.select(*keep, *[cells[i]["value"].alias(label_name(label)) for i, label in fields.items()])


def field_columns(fields: Mapping[str, str]) -> dict[str, str]:
    """Field id to the column name its label gives."""
    return {i: label_name(label) for i, label in fields.items()}


def normalize_headers(df: DataFrame, style: str) -> DataFrame:
    """Rename all columns: ``lower`` for sheets, ``upper`` for frames, ``label`` for records, ``title`` to show."""
    rules = {
        "lower": lambda c: c.lower().replace(" ", "_"),
        "upper": str.upper,
        "label": label_name,
        "title": lambda c: c.replace("_", " ").title(),
    }
    return df.toDF(*[rules[style](c) for c in df.columns])


def stamp_load_date(df: DataFrame, load_date: str | None = None, renamed: str = "record_date") -> DataFrame:
    """Move a column named date (any case) aside and add the day of the load as ``load_date``."""
    for c in df.columns:
        if c.lower() == "date":
            df = df.withColumnRenamed(c, renamed)
    stamp = F.current_date() if load_date is None else F.lit(load_date).cast("date")
    return df.withColumn("load_date", stamp)


def pad_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Name columns by position; positions the frame lacks are NULL text."""
    missing = len(names) - len(df.columns)
    if missing < 0:
        raise ValueError("more columns than names")
    have = df.toDF(*names[: len(df.columns)])
    return have.select("*", *[F.lit(None).cast("string").alias(n) for n in names[len(df.columns) :]])


def labelled_union(frames: Mapping[str, DataFrame], label: str) -> DataFrame:
    """All rows of all frames, each marked with its name."""
    parts = [f.select(F.lit(name).alias(label), "*") for name, f in frames.items()]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p, allowMissingColumns=True)
    return rows


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """A sheet exported as CSV: the first row is the header, cells stay text."""
    return normalize_headers(spark.read.csv(path, header=True, inferSchema=False), "lower")


def read_numbered_sheet(spark: SparkSession, path: str, index: str = "row_index") -> DataFrame:
    """A sheet exported as CSV with each row's number, from 0, as it stands in the files.

    Files follow by name, lines by place; every file starts with the header. A file may be
    read in many splits: each counts its lines, the counts are summed in order, one row a
    split, and a line's number is its place in the split plus the lines before the split.
    Numbered lines are written once, as another scan may split the files elsewhere. A line
    is a row, a blank one too (its cells are NULL); a line break inside a cell must be
    replaced on export. Blank and missing trailing cells are NULL. A sheet of headers alone
    is empty.
    """
    names = read_sheet(spark, path).columns
    if index in names:
        raise ValueError(f"the sheet has a column {index}")
    source = F.col("_metadata")
    lines = materialise(
        spark.read.text(path).select(
            source["file_path"].alias("file"),
            source["file_block_start"].alias("split"),
            F.monotonically_increasing_id().alias("id"),
            F.col("value").alias("line"),
        )
    )
    # The first split of a file holds its header, which is no row.
    header = (F.col("split") == 0).cast("bigint")
    splits = lines.groupBy("file", "split").agg(F.min("id").alias("first"), (F.count(F.lit(1)) - F.max(header)).alias("n"))
    earlier = Window.orderBy("file", "split").rowsBetween(Window.unboundedPreceding, -1)
    before = splits.select("file", "split", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    place = F.col("before") + F.col("id") - F.col("first") - header
    cells = F.from_csv("line", ", ".join(f"`{c}` string" for c in names), {"mode": "PERMISSIVE"})
    return (
        lines.join(F.broadcast(before), ["file", "split"])
        .filter((F.col("split") != 0) | (F.col("id") != F.col("first")))
        .select(place.cast("bigint").alias(index), cells.alias("cells"))
        .select(index, *[F.col("cells")[c].alias(c) for c in names])
    )
