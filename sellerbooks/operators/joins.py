"""Join operators. Join sides are left to the optimizer, which checks their size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sellerbooks.functions.columns import all_of, folded
from sellerbooks.operators import scan as scans

# Numbers generated at a time where a row becomes many.
RUN = 1000
# Places of a bound before a position, the position, and a bound behind it, where they are equal.
BEFORE, POINT, AFTER = 0, 1, 2


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str] | Sequence[str] = (),
    how: str = "left",
    null_safe: bool = False,
    only_if: Column | None = None,
) -> DataFrame:
    """Join ``right`` to ``left`` on keys that ignore case and add the ``take`` columns.

    ``on`` maps left to right key columns, ``take`` new names to right columns.
    """
    names = dict(take) if isinstance(take, Mapping) else {c: c for c in take}
    marks = [f"_r{i}" for i in range(len(on))]
    side = right.select(
        *[folded(right, r).alias(m) for r, m in zip(on.values(), marks)],
        *[F.col(source).alias(name) for name, source in names.items()],
    )
    tests = [
        folded(left, k).eqNullSafe(F.col(m)) if null_safe else folded(left, k) == F.col(m) for k, m in zip(on, marks)
    ]
    if only_if is not None:
        tests.append(only_if)
    joined = left.join(side, all_of(tests), how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*marks)


def same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


def map_with_fallback(
    df: DataFrame,
    exact: DataFrame,
    exact_on: Mapping[str, str],
    fallback: DataFrame,
    fallback_on: Mapping[str, str],
    columns: Sequence[str],
) -> DataFrame:
    """Look ``columns`` up in ``exact``, then in ``fallback`` where that gave NULL.

    Both sides join every row, so a fallback with several rows per key multiplies
    rows even where the exact side matched.
    """
    rows = lookup(df, exact, exact_on, {f"_e_{c}": c for c in columns})
    rows = lookup(rows, fallback, fallback_on, {f"_f_{c}": c for c in columns})
    for c in columns:
        rows = rows.withColumn(c, F.coalesce(F.col(f"_e_{c}"), F.col(f"_f_{c}")))
    return rows.drop(*[f"_{s}_{c}" for s in "ef" for c in columns])


def attach_ids(
    df: DataFrame, reference: DataFrame, keys: Mapping[str, str], ids: Mapping[str, str] | Sequence[str]
) -> DataFrame:
    """Add published record ids; as in a frame merge, NULL keys match each other."""
    return lookup(df, reference, keys, ids, null_safe=True)


def unpublished(df: DataFrame, published: DataFrame, id_column: str) -> DataFrame:
    """Rows whose id, as text, is not among the published ones."""
    ids = published.select(F.col(id_column).cast("string").alias("_published"))
    return df.join(ids, F.col(id_column).cast("string") == F.col("_published"), "left_anti")


def replace_rows(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop target rows whose key, ignoring case, is in ``new``, then add ``new``: an upsert by key."""
    kept = lookup(target, new, same(*keys), how="left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def change_set(target: DataFrame, new: DataFrame, keys: Sequence[str], delete_missing: bool = False) -> DataFrame:
    """Each key, ignoring case, with the ``outcome`` of an upsert: created, changed, unchanged or deleted.

    One full join by key compares the columns of ``new`` that the target has, NULLs being
    equal. Rows show the new values, those that go the old ones; columns the load lacks keep
    theirs. A key must be unique on both sides, as ``sources.stored`` enforces. Without
    ``delete_missing`` target rows that the load does not name are unchanged. NULL keys are equal.
    """
    marks = [f"_k{i}" for i in range(len(keys))]
    taken = [c for c in new.columns if c in target.columns]

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*[folded(df, k).alias(f"{name}{m}") for k, m in zip(keys, marks)], F.struct(*df.columns).alias(name))

    same_key = all_of([F.col(f"old{m}").eqNullSafe(F.col(f"new{m}")) for m in marks])
    both = side(target, "old").join(side(new, "new"), same_key, "full")
    equal = all_of([F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in taken])
    outcome = (
        F.when(F.col("old").isNull(), "created")
        .when(F.col("new").isNull(), "deleted" if delete_missing else "unchanged")
        .when(equal, "unchanged")
        .otherwise("changed")
    )
    cells = []
    for c in [*target.columns, *[c for c in new.columns if c not in target.columns]]:
        if c not in new.columns:
            cells.append(F.col(f"old.{c}").alias(c))
        elif c not in target.columns:
            cells.append(F.col(f"new.{c}").alias(c))
        else:
            cells.append(F.when(F.col("new").isNull(), F.col(f"old.{c}")).otherwise(F.col(f"new.{c}")).alias(c))
    return both.select(outcome.alias("outcome"), *cells)


def to_write(changes: DataFrame) -> DataFrame:
    """The rows of a change set that a sink must take: created and changed ones."""
    return changes.filter(F.col("outcome").isin("created", "changed")).drop("outcome")


def apply_changes(changes: DataFrame) -> DataFrame:
    """The target after an upsert."""
    return changes.filter("outcome <> 'deleted'").drop("outcome")


def range_assign(
    usage: DataFrame,
    receipts: DataFrame,
    on: Mapping[str, str],
    position: str,
    lower: str,
    upper: str,
    take: Mapping[str, str],
    strict: bool = False,
) -> DataFrame:
    """Left join each usage position to the receipts whose quantity range holds it.

    Run form: ``position <= upper and greatest(position, 0) >= lower``, so a
    position on a boundary meets two receipts. Strict form:
    ``position <= upper and position > lower``.

    Usage positions and the bounds of receipts are merged into one order, by product, then
    quantity, which is cut into sampled ranges and scanned once: every position gets its rank
    among all positions, every bound the number of positions before it. The positions that a
    receipt supplies are then consecutive ranks, whatever ranges they lie in, so a receipt
    becomes exactly as many rows as it has matches and joins on the rank, which is spread evenly.
    Work follows rows and matches: neither a product that sells a third of all units nor a
    receipt larger than all others changes it. In the run form a position below zero meets what a
    zero meets as long as the receipt reaches it, so a receipt from zero or below is open downwards.
    """
    marks = [f"_r{i}" for i in range(len(on))]
    low, high = F.col(lower), F.col(upper)
    held = receipts.filter(high > low if strict else high >= F.when(low > 0, low).otherwise(high))
    # A missing key meets none, and must not stand beside the positions that lack one.
    held = held.filter(all_of([low.isNotNull(), *[F.col(r).isNotNull() for r in on.values()]]))
    # A bound counts the positions before it: a closed lower one stands before equal positions, the others behind them.
    if strict:
        begin = F.struct(low.alias("at"), F.lit(AFTER).alias("kind"))
    else:
        closed = F.struct(low.alias("at"), F.lit(BEFORE).alias("kind"))
        everything = F.struct(F.lit(None).cast(receipts.schema[lower].dataType).alias("at"), F.lit(AFTER).alias("kind"))
        begin = F.when(low > 0, closed).otherwise(everything)
    end = F.struct(high.cast(receipts.schema[lower].dataType).alias("at"), F.lit(AFTER + 1).alias("kind"))
    numbered = held.select(
        *[folded(receipts, r).alias(m) for r, m in zip(on.values(), marks)],
        F.monotonically_increasing_id().alias("_receipt"),
        F.struct(*[F.col(source).alias(name) for name, source in take.items()]).alias("_taken"),
        F.array(begin, end).alias("_bounds"),
    )
    # Both bounds come out of one reading of a receipt, after it has its id; its columns travel with the first only.
    bounds = numbered.select(*marks, "_receipt", "_taken", F.explode("_bounds").alias("_bound")).select(
        *marks, "_receipt", "_bound.at", "_bound.kind", F.when(F.col("_bound.kind") <= AFTER, F.col("_taken")).alias("_taken")
    )
    points = usage.select(
        *[folded(usage, k).alias(m) for k, m in zip(on, marks)],
        F.col(position).alias("at"),
        F.lit(POINT).alias("kind"),
        F.struct(*[F.col(f"`{c}`") for c in usage.columns]).alias("_usage"),
    )
    merged = points.unionByName(bounds, allowMissingColumns=True)
    order = [*[F.col(m) for m in marks], F.col("at"), F.col("kind")]
    swept = scans.scan(merged, [], order, value=F.when(F.col("kind") == POINT, 1))
    swept = swept.withColumn("_rank", F.coalesce(scans.total_with_row(), F.lit(0)))
    ranges = (
        swept.filter(F.col("kind") != POINT)
        .groupBy("_receipt")
        .agg(F.min("_rank").alias("_low"), F.max("_rank").alias("_high"), F.first("_taken", ignorenulls=True).alias("_taken"))
        .filter("_high > _low")
    )
    supplied = _each_number(ranges, F.col("_low") + 1, F.col("_high"), "_at").select("_at", "_taken")
    rows = swept.filter(F.col("kind") == POINT).select("_usage", "_rank")
    joined = rows.join(supplied, F.col("_rank") == F.col("_at"), "left")
    return joined.select("_usage.*", *[F.col(f"_taken.`{name}`").alias(name) for name in take])


def _each_number(df: DataFrame, first: Column, last: Column, name: str) -> DataFrame:
    """One row for each whole number from ``first`` to ``last``, generated in runs so that no array is long."""
    runs = df.withColumn("_first", first).withColumn("_last", last)
    runs = runs.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_last") - F.col("_first")) / RUN))))
    begin = F.col("_first") + F.col("_run") * RUN
    rows = runs.withColumn(name, F.explode(F.sequence(begin, F.least(begin + RUN - 1, F.col("_last")))))
    return rows.drop("_first", "_last", "_run")
