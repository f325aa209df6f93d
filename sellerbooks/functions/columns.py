"""Column expressions shared by the plans. All stay inside generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The formats a sheet date may have, tried in this order.
DATE_FORMATS = ("M/d/yyyy", "M/d/yy", "yyyy-MM-dd", "MMM d, yyyy", "d MMM yyyy")


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def folded(df: DataFrame, name: str) -> Column:
    """The value two texts are compared on: text ignores case, the rest is as it is."""
    return F.lower(F.col(name)) if is_text(df, name) else F.col(name)


def all_of(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def text_in(column: str, values) -> Column:
    return F.lower(F.col(column)).isin([v.lower() for v in values])


def text_is(column: str, value: str) -> Column:
    return F.lower(F.col(column)) == value.lower()


def sign_label(amount: Column) -> Column:
    """Zero and NULL count as credit."""
    return F.when(amount < 0, "debit").otherwise("credit")


def quotient(numerator: Column, denominator: Column, scale: int) -> Column:
    """Half-up quotient of decimals; NULL when the divisor is zero."""
    return F.round(F.try_divide(numerator, denominator), scale)


def unit_price(price: Column, quantity: Column) -> Column:
    """Price of one unit, or the line price when there is no quantity to divide by."""
    return F.coalesce(quotient(price, quantity, 2), price).cast("decimal(12,2)")


def text_or(column: Column, default: str = "") -> Column:
    return F.coalesce(column.cast("string"), F.lit(default))


def number_text(column: Column, default: str = "") -> Column:
    """A decimal as text without trailing zeros after the point."""
    text = column.cast("string")
    short = F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))
    return F.coalesce(F.when(text.contains("."), short).otherwise(text), F.lit(default))


def strip_words(column: Column, words) -> Column:
    return reduce(lambda c, w: F.replace(c, F.lit(w), F.lit("")), words, column)


def dots_to_slashes(column: Column) -> Column:
    return F.translate(column, ".", "/")


def parse_date(column: Column, formats=DATE_FORMATS) -> Column:
    """First format that fits; NULL when none does."""
    return F.coalesce(*[F.try_to_timestamp(column, F.lit(f)).cast("date") for f in formats])


def parse_money(column: Column) -> Column:
    """Currency text to a number; NULL and unreadable text become zero."""
    number = F.translate(column, "$,", "").try_cast("decimal(12,2)")
    return F.coalesce(number, F.lit(0).cast("decimal(12,2)"))


def whole_text(column: Column) -> Column:
    """A number as whole-number text, so that it can meet a text key."""
    return column.try_cast("decimal(20,4)").cast("bigint").cast("string")


def only_letters(column: Column) -> Column:
    return column.rlike("^[A-Za-z]+$")


def any_letter(column: Column) -> Column:
    return column.rlike("[A-Za-z]")


def blank_to_null(column: Column, marks=("",)) -> Column:
    return F.when(~column.isin(list(marks)), column)


def day_text(column: Column) -> Column:
    return F.coalesce(F.date_format(column, "yyyy-MM-dd"), F.lit(""))


def second_text(column: Column) -> Column:
    return F.coalesce(F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(""))


def cell_link(gid: Column | str, letter: Column, row: Column, base: str) -> Column:
    """Address of one sheet cell."""
    gid = F.lit(gid) if isinstance(gid, str) else gid
    return F.concat(F.lit(base), F.lit("#gid="), gid, F.lit("&range="), letter, row.cast("string"))
