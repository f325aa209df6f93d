"""Grouping operators. Each pre-aggregates on the map side, so hot keys stay cheap."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sellerbooks.functions.columns import all_of, folded, text_is
from sellerbooks.session import unstaged


def group_by_text(df: DataFrame, keys: Sequence[str], *measures: Column) -> DataFrame:
    """Group on keys that ignore case; a key shows its least spelling.

    Keys are joined ignoring case, so they must be unique that way. A least spelling
    needs a sorting aggregation; ``group_in_two_steps`` hashes first.
    """
    marks = [f"_key{i}" for i in range(len(keys))]
    grouped = df.groupBy(*[folded(df, k).alias(m) for k, m in zip(keys, marks)])
    return grouped.agg(*[F.min(k).alias(k) for k in keys], *measures).drop(*marks)


def group_and_number(
    df: DataFrame, within: Sequence[str], others: Sequence[str], measures: Sequence[Column], order_by: Sequence[Column], name: str
) -> DataFrame:
    """``group_by_text`` on ``within`` and ``others``, and the number of each group among those of ``within``, behind one shuffle.

    The rows are dealt by ``within`` for both, not combined before: they should come grouped by spelling.
    """
    keys = [*within, *others]
    marks = [f"_key{i}" for i in range(len(keys))]
    dealt = df.repartition(*[folded(df, k) for k in within])
    grouped = dealt.groupBy(*[folded(df, k).alias(m) for k, m in zip(keys, marks)])
    grouped = grouped.agg(*[F.min(k).alias(k) for k in keys], *measures)
    window = Window.partitionBy(*marks[: len(within)]).orderBy(*order_by)
    return grouped.withColumn(name, F.row_number().over(window)).drop(*marks)


# How a measure is taken over rows, and how its parts are joined.
_TAKE = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.count}
_JOIN = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.sum}


def group_in_two_steps(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[tuple[str, str, Column]],
    stage: Callable[[DataFrame], DataFrame] = unstaged,
) -> DataFrame:
    """``group_by_text`` for large tables: by spelling first, which hashes, then by the folded keys.

    ``measures`` are (name, sum | min | max | count, column) of fixed width. ``stage`` writes what
    the first step has made, so that its shuffle is gone before that of the second. Sorting is by
    the keys in their order: one that tells many rows apart is best first.
    """
    spelled = stage(df.groupBy(*keys).agg(*[_TAKE[kind](column).alias(name) for name, kind, column in measures]))
    return group_by_text(spelled, keys, *[_JOIN[kind](name).alias(name) for name, kind, _ in measures])


def least(*names: str) -> list[Column]:
    """Any-value columns: the least value of each, so that the pick is repeatable."""
    return [F.min(n).alias(n) for n in names]


def first_per_group(df: DataFrame, keys: Sequence[str], *measures: Column) -> DataFrame:
    """One row per key; columns neither grouped nor measured take their least value."""
    measured = {m for m in df.columns if m not in keys}
    return group_by_text(df, keys, *least(*[c for c in df.columns if c in measured]), *measures)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """The first row of each key.

    Spark turns the filter on the rank into a limit before the shuffle, so each
    map task sends at most one row per key.
    """
    window = Window.partitionBy(*[folded(df, k) for k in keys]).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def conditional_sums(label: str, names: Mapping[str, str], value: str, default: int | None = None) -> list[Column]:
    """One sum per label: the fixed-column pivot. NULL where a label is absent, unless ``default``."""
    sums = {name: F.sum(F.when(text_is(label, text), F.col(value))) for text, name in names.items()}
    if default is None:
        return [s.alias(n) for n, s in sums.items()]
    return [F.coalesce(s, F.lit(default)).alias(n) for n, s in sums.items()]


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys, in lower case, that would break a primary key: NULL in any part, or more than one row."""
    marks = [f"_k{i}" for i in range(len(keys))]
    folded_keys = [folded(df, k).alias(m) for k, m in zip(keys, marks)]
    counted = df.groupBy(*folded_keys).agg(F.count(F.lit(1)).alias("row_count"))
    counted = counted.withColumnsRenamed(dict(zip(marks, keys)))
    complete = all_of([F.col(k).isNotNull() for k in keys])
    return counted.filter(~complete | (F.col("row_count") > 1))


def sync_diff(source: DataFrame, published: DataFrame, keys: Sequence[str], keep: str = "both") -> DataFrame:
    """Rows whose key occurs exactly once in both frames together.

    A key that repeats on one side is dropped too, and NULL keys are equal. With
    ``keep="source"`` only source rows remain. Columns the published frame lacks
    are NULL there.
    """
    both = source.withColumn("_side", F.lit("source")).unionByName(
        published.withColumn("_side", F.lit("published")), allowMissingColumns=True
    )
    # Keys alone are counted, which hashes and combines on the map side; then their rows are picked.
    times = both.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("_times")).filter("_times = 1")
    once = both.join(times, all_of([F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]), "left_semi")
    if keep == "source":
        return once.filter("_side = 'source'").drop("_side")
    return once.withColumnRenamed("_side", "side")


def latest_value(df: DataFrame, column: str) -> Column:
    """Scalar ``max(column)``, evaluated once."""
    return df.select(F.max(column)).scalar()
