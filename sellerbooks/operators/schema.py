"""Type profiles of columns, widening decisions and schema alignment."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)$"
# A text column whose longest value has at least this length gets this width.
TEXT_WIDTHS = ((100, 255), (50, 100), (25, 50), (15, 25), (10, 15), (5, 10), (0, 5))


def _clean(name: str) -> Column:
    """Cell text; a missing cell and the text ``nan`` count as 0 in the number test."""
    text = F.trim(F.col(name).cast("string"))
    return F.when(text.isNull() | text.isin("nan", "Nan"), F.lit("0")).otherwise(text)


def _decimals(text: Column) -> Column:
    """Digits after the point without trailing zeros."""
    after = F.substring_index(F.substring_index(text, ".", 2), ".", -1)
    return F.when(text.contains("."), F.rtrim(after, F.lit("0"))).otherwise("")


def _state_struct(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    cell = F.col(f"`{name}`").cast("string")
    text = _clean(name)
    decimals = _decimals(text)
    whole = F.substring_index(text, ".", 1)
    # Length of the number as a frame shows it: at least one digit after a point.
    number = F.length(whole) + 1 + F.greatest(F.length(decimals), F.lit(1))
    missing = F.trim(cell).isNull() | F.trim(cell).isin("nan", "Nan")
    is_number = text.rlike(NUMBER)
    zero = ~missing & is_number & (text.try_cast("double") == 0)
    fits = ~is_number | whole.isin("", "+", "-") | whole.try_cast("bigint").isNotNull()

    def every(condition: Column) -> Column:
        return F.coalesce(F.bool_and(condition), F.lit(True))

    def most(size: Column) -> Column:
        return F.coalesce(F.max(size), F.lit(0)).cast("int")

    return F.struct(
        F.lit(name).alias("column_name"),
        F.lit(_family(kind)).alias("family"),
        every(is_number).alias("is_number"),
        most(F.length(decimals)).alias("decimal_depth"),
        most(F.length(cell)).alias("longest"),
        most(number).alias("number_length"),
        most(F.length(whole)).alias("integer_length"),
        every(fits).alias("fits_long"),
        every(missing).alias("all_missing"),
        every(zero).alias("all_zeros"),
        F.count(F.lit(1)).alias("row_count"),
    )


# How the states of two sets of rows make the state of both.
_EVERY = ("is_number", "fits_long", "all_missing", "all_zeros")
_MOST = ("decimal_depth", "longest", "number_length", "integer_length")
# The state of rows that lack a column: their cells count as missing.
_LACKING = {"is_number": True, "fits_long": True, "all_missing": True, "all_zeros": False, "decimal_depth": 0, "longest": 0, "number_length": 3, "integer_length": 1}


def profile_state(df: DataFrame) -> DataFrame:
    """One row per column with all that its type depends on; one aggregation over all columns.

    States of two sets of rows merge into the state of both (``merge_states``), so a table
    that keeps its state need not be read again to profile it together with a load.
    """
    one_row = df.agg(F.array(*[_state_struct(df, c) for c in df.columns]).alias("states"))
    return one_row.select(F.explode("states").alias("s")).select("s.*")


def merge_states(stored: DataFrame, loaded: DataFrame) -> DataFrame:
    """The state of the rows of both sides, columns matched without case; a few rows a side."""
    names = stored.columns

    def side(df: DataFrame, letter: str) -> tuple[DataFrame, DataFrame]:
        rows = df.agg(F.max("row_count").alias(f"{letter}_rows"))
        states = df.select(F.upper("column_name").alias("_key"), F.struct(*names).alias(letter))
        return states, rows

    (left, left_rows), (right, right_rows) = side(stored, "a"), side(loaded, "b")
    # The sides' numbers of rows are one row each.
    both = left.join(right, "_key", "full").join(left_rows, F.lit(True)).join(right_rows, F.lit(True))

    def lacking(letter: str) -> dict[str, Column]:
        # No rows at all lack nothing.
        none = F.coalesce(F.col(f"{letter}_rows"), F.lit(0)) == 0
        return {n: F.when(none, F.lit(True if n in _EVERY else 0)).otherwise(F.lit(v)) for n, v in _LACKING.items()}

    def of(letter: str, name: str) -> Column:
        return F.when(F.col(letter).isNull(), lacking(letter)[name]).otherwise(F.col(f"{letter}.{name}"))

    columns = {
        "column_name": F.coalesce("a.column_name", "b.column_name"),
        "family": F.coalesce("a.family", "b.family"),
        "row_count": F.coalesce("a_rows", F.lit(0)) + F.coalesce("b_rows", F.lit(0)),
    }
    columns |= {n: of("a", n) & of("b", n) for n in _EVERY}
    columns |= {n: F.greatest(of("a", n), of("b", n)).cast("int") for n in _MOST}
    return both.select(*[columns[n].alias(n) for n in names])


def _family(kind: T.DataType) -> str:
    if isinstance(kind, T.BooleanType):
        return "boolean"
    if isinstance(kind, T.DateType):
        return "date"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    return "cell"


def _target_type() -> Column:
    text = F.when(F.col("longest") > 255, "TEXT")
    for least, width in TEXT_WIDTHS:
        text = text.when(F.col("longest") >= least, f"VARCHAR({width})")
    # A whole number no 64-bit integer holds stays text, digit by digit.
    whole = F.when(~F.col("fits_long"), text).when(F.col("integer_length") >= 10, "BIGINT").otherwise("INTEGER")
    scale = F.when(F.col("decimal_depth") <= 2, "2").otherwise("4")
    precision = F.when(F.col("number_length") <= 10, "12").when(F.col("number_length") <= 20, "20")
    fraction = F.coalesce(F.concat(F.lit("NUMERIC("), precision, F.lit(","), scale, F.lit(")")), F.lit("DOUBLE"))
    return (
        F.when(F.col("row_count") == 0, "BIGINT")
        .when(F.col("family") == "boolean", "BOOLEAN")
        .when(F.col("family") == "date", "DATE")
        .when(F.col("family") == "datetime", "DATETIME")
        .when(F.col("is_number") & (F.col("decimal_depth") == 0), whole)
        .when(F.col("is_number"), fraction)
        .otherwise(text)
    )


def profile_of(state: DataFrame) -> DataFrame:
    """The profile that a state stands for. One single value, zero or missing, makes a column empty: 0 beside NULL are two."""
    rows = state.withColumn("all_zero", F.col("all_missing") | F.col("all_zeros")).withColumn("target_type", _target_type())
    return rows.select("column_name", "is_number", "decimal_depth", "longest", "row_count", "all_zero", "target_type")


def schema_profile(df: DataFrame) -> DataFrame:
    """One row per column with its measured target type; one aggregation over all columns."""
    return profile_of(profile_state(df))


def _width(column: Column) -> Column:
    return F.regexp_extract(column, r"[(](\d+)", 1).try_cast("int")


def widen_decision(stored: Column, incoming: Column, all_zero: Column) -> Column:
    """The type a stored column should have after a load, NULL when it stays as it is."""

    def pair(left: str, right: str) -> Column:
        return stored.rlike(left) & incoming.rlike(right)

    number = r"^(NUMERIC|DECIMAL)"
    kept = (
        (stored == incoming)
        | pair(r"^INT(EGER)?([(]11[)])?$", "^INTEGER$")
        | pair(r"^BIGINT([(]20[)])?$", "^(BIGINT|INTEGER)$")
        | pair("^DATETIME$", "VARCHAR")
        | pair("VARCHAR", "DATETIME")
        | pair("^TIMESTAMP$", "DATETIME")
        | pair("^DATE$", "VARCHAR|DATETIME")
        | pair(r"^FLOAT([(](12|20),[24][)])?$", "^INTEGER$")
        | pair(r"FLOAT[(]20,4[)]", r"FLOAT[(]12,4[)]")
        | pair(r"FLOAT[(]20,2[)]", r"FLOAT[(]12,2[)]")
        | pair(r"^TINYINT[(]1[)]$", "^BOOLEAN$")
        | pair(number + r"[(]20,4[)]", number + r"[(]12,4[)]")
        | pair(number + r"[(]20,2[)]", number + r"[(](12|20),2[)]|INT")
        | pair(number + r"[(]12,2[)]", number + r"[(]12,2[)]|INT")
        | pair("VARCHAR", "NUMERIC|DECIMAL|FLOAT|INTEGER|BIGINT|BOOLEAN")
        | pair("TEXT", "VARCHAR|FLOAT")
    )
    both_text = pair("VARCHAR", "VARCHAR")
    return (
        F.when(kept, F.lit(None).cast("string"))
        .when(both_text & (_width(incoming) > _width(stored)), incoming)
        .when(both_text, F.lit(None).cast("string"))
        .when(pair("INT", "DATETIME"), "VARCHAR(25)")
        .when(all_zero, F.lit(None).cast("string"))
        .otherwise(incoming)
    )


def widen(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Compare two profiles column by column, names without case; NULL ``change`` keeps the type."""
    left = stored.select(F.upper("column_name").alias("column_name"), F.col("target_type").alias("stored_type"))
    right = incoming.select(
        F.upper("column_name").alias("column_name"), F.col("target_type").alias("incoming_type"), "all_zero"
    )
    decision = widen_decision(F.col("stored_type"), F.col("incoming_type"), F.col("all_zero"))
    return left.join(right, "column_name").withColumn("change", decision).drop("all_zero")


def align(df: DataFrame, target: T.StructType) -> DataFrame:
    """Name ``df``'s columns as the target does (ignoring case) and add those it lacks as typed NULL."""
    have = {c.upper(): c for c in df.columns}
    known = [
        F.col(have[f.name.upper()]).alias(f.name) if f.name.upper() in have else F.lit(None).cast(f.dataType).alias(f.name)
        for f in target.fields
    ]
    wanted = {f.name.upper() for f in target.fields}
    return df.select(*known, *[F.col(c) for c in df.columns if c.upper() not in wanted])


# Spark's type for each measured one; texts have no width there.
_SPARK_TYPES = (
    ("^(VARCHAR|TEXT)", "string"),
    ("^BIGINT", "bigint"),
    ("^INT", "int"),
    ("^(DOUBLE|FLOAT)", "double"),
    ("^DATETIME$|^TIMESTAMP$", "timestamp_ntz"),
    ("^DATE$", "date"),
    ("^BOOLEAN$|^TINYINT", "boolean"),
)
# Stored types whose missing cells are loaded as 0.
ZERO_FILLED = ("FLOAT(12,2)", "FLOAT(12,4)", "FLOAT(20,2)", "FLOAT(20,4)", "VARCHAR(5)")


def spark_type(measured: str) -> str:
    """The column type a measured type is stored as."""
    number = re.match(r"(?:NUMERIC|DECIMAL)[(](\d+),(\d+)[)]", measured)
    if number:
        return f"decimal({number[1]},{number[2]})"
    return next(kind for pattern, kind in _SPARK_TYPES if re.search(pattern, measured))


def widened_types(stored: DataFrame, incoming: DataFrame, target: T.StructType) -> dict[str, str]:
    """Columns of ``target`` whose type a load changes, with the type they get; the sides are profiles."""
    changes = {r["column_name"]: r["change"] for r in widen(stored, incoming).collect() if r["change"]}
    return {f.name: spark_type(changes[f.name.upper()]) for f in target.fields if f.name.upper() in changes}


def shape_load(incoming: DataFrame, stored: DataFrame, target: T.StructType) -> DataFrame:
    """Rows of a load in the columns of ``target``, then those it lacks; ``stored`` is the profile of what is stored.

    Number cells pass through a decimal on their way to a whole number, so ``4.0`` is 4.
    """
    kinds = {r["column_name"].upper(): r["target_type"] for r in stored.collect()}
    have = {c.upper(): c for c in incoming.columns}
    filled = incoming.select(
        *[
            F.coalesce(F.col(c).cast("string"), F.lit("0")).alias(c)
            if kinds.get(c.upper()) in ZERO_FILLED and isinstance(incoming.schema[c].dataType, T.StringType)
            else F.col(c)
            for c in incoming.columns
        ]
    )
    cells = {}
    for f in target.fields:
        if f.name.upper() in have:
            name = have[f.name.upper()]
            kind = f.dataType.simpleString()
            text = isinstance(incoming.schema[name].dataType, T.StringType)
            cells[name] = number_cell(F.col(name), kind) if text else F.col(name).try_cast(kind)
    return align(filled.withColumns(cells), target)


def number_cell(cell: Column, kind: str) -> Column:
    """A text cell as ``kind``; NULL where it is no such value."""
    return (_whole_text(cell) if kind in ("int", "bigint") else cell).try_cast(kind)


def _whole_text(cell: Column) -> Column:
    """Number text without zeros behind the point, as a cast to a whole number wants it."""
    text = F.trim(cell)
    return F.when(text.rlike(r"^[+-]?[0-9]+[.]0*$"), F.substring_index(text, ".", 1)).otherwise(text)


def evolve_append(target: DataFrame, incoming: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Append rows after profiling them, widening the target where they need it and adding its missing columns.

    Column types depend on all values, so profiles, one row a column, are read before the
    result is planned. With ``stored``, the state kept beside the target (``profile_state``),
    the target itself is not read for that. A kept column takes the loaded cells cast to its
    own type; a widened one changes type on both sides.
    """
    known = profile_of(stored) if stored is not None else schema_profile(target)
    kinds = widened_types(known, schema_profile(incoming), target.schema)
    shaped = target.withColumns({n: F.col(n).cast(k) for n, k in kinds.items()})
    return shaped.unionByName(shape_load(incoming, known, shaped.schema), allowMissingColumns=True)


def _no_number(cell: Column) -> Column:
    """Whether a cell holds nothing where a number is expected."""
    text = F.trim(cell.cast("string"))
    return text.isNull() | text.isin("", "nan", "Nan")


def numeric_coerce(df: DataFrame, columns: Sequence[str], keep_missing: bool = False) -> DataFrame:
    """Text columns to numbers: NULL and blanks read as 0 (NULL with ``keep_missing``), whole-number columns become BIGINT.

    The type depends on all values, so one row of state per column is read before the result
    is planned, as schema inference does. Whole numbers too long for BIGINT become decimals of
    38 digits or, longer still, stay text; fractions that no decimal holds become DOUBLE.
    """
    filled = df
    for c in columns:
        text = F.trim(F.col(c).cast("string"))
        filled = filled.withColumn(c, F.when(_no_number(F.col(c)), "0").otherwise(text))
    found = {r["column_name"]: r for r in profile_state(filled.select(*columns)).collect()}
    cells = {}
    for c in columns:
        state = found[c]
        if not state["is_number"]:
            continue
        digits, depth = max(state["integer_length"], 1), state["decimal_depth"]
        if depth == 0:
            whole = _whole_text(F.col(c))
            if state["fits_long"]:
                cells[c] = whole.cast("bigint")
            elif digits <= 38:
                cells[c] = whole.cast("decimal(38,0)")
        elif digits + depth <= 38:
            cells[c] = F.col(c).cast(f"decimal({min(38, max(digits, state['longest']) + depth)},{depth})")
        else:
            cells[c] = F.col(c).cast("double")
    if keep_missing:
        filled = df
        cells = {c: F.when(~_no_number(F.col(c)), cell) for c, cell in cells.items()}
    return filled.withColumns(cells)


def column_listing(df: DataFrame) -> list[tuple[int, str, str]]:
    """Position, name and type of each column, as a catalog lists them."""
    return [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
