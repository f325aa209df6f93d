"""Range assignment, key differences and lookups on hand-worked and random cases."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sellerbooks.operators import grouping, joins

RECEIPTS = "account string, sku string, po string, last bigint, roll bigint"
USAGE = "account string, sku string, id int, pos bigint"


def assigned(usage, receipts, strict):
    out = joins.range_assign(
        usage, receipts, joins.same("account", "sku"), "pos", "last", "roll", {"po": "po"}, strict=strict
    )
    return sorted(((r["id"], r["po"] or "") for r in out.collect()))


def brute(usage, receipts, strict):
    out = []
    for account, sku, i, p in usage:
        hits = [
            po
            for a, s, po, low, high in receipts
            if a.lower() == account.lower()
            and s.lower() == sku.lower()
            and None not in (p, low, high)
            and p <= high
            and (p > low if strict else max(p, 0) >= low)
        ]
        out += [(i, po) for po in hits] or [(i, "")]
    return sorted(out)


def test_fifo_boundaries(spark):
    receipts = spark.createDataFrame([("A", "x", "PO1", 0, 100), ("A", "x", "PO2", 100, 150)], RECEIPTS)
    points = [-5, 0, 60, 100, 120, 150, 151]
    usage = spark.createDataFrame([("a", "X", i, p) for i, p in enumerate(points)], USAGE)
    assert assigned(usage, receipts, False) == [
        (0, "PO1"), (1, "PO1"), (2, "PO1"), (3, "PO1"), (3, "PO2"), (4, "PO2"), (5, "PO2"), (6, ""),
    ]
    assert assigned(usage, receipts, True) == [
        (0, ""), (1, ""), (2, "PO1"), (3, "PO1"), (4, "PO2"), (5, "PO2"), (6, ""),
    ]


def test_range_assign_equals_brute_force(spark):
    rng = random.Random(5)
    receipts, usage = [], []
    for sku in "pqr":
        at = 0
        for n in range(25):
            size = rng.choice([0, 1, 3, 40, 500])
            # Ranges may overlap, be empty or run backwards, as they do when a sku has several asins.
            low = at + rng.choice([0, 0, 0, -7, 9])
            receipts.append(("A", sku, f"{sku}{n}", low, at + size))
            at += size
        usage += [("a", sku, len(usage) + i, rng.randrange(-50, at + 30)) for i in range(120)]
    usage.append(("a", "none", 9999, 3))
    receipts.append(("A", "p", "null", None, None))
    left, right = spark.createDataFrame(usage, USAGE), spark.createDataFrame(receipts, RECEIPTS)
    for strict in (False, True):
        assert assigned(left, right, strict) == brute(usage, receipts, strict)


def test_receipts_of_very_different_sizes(spark):
    receipts = [("A", "big", "b0", 0, 5_000_000), ("A", "big", "b1", 5_000_000, 5_000_010)]
    receipts += [("A", "small", f"s{i}", 3 * i, 3 * i + 3) for i in range(40)]
    usage = [("A", "big", i, i * 500_000) for i in range(12)] + [("A", "small", 100 + i, i) for i in range(-5, 125)]
    left, right = spark.createDataFrame(usage, USAGE), spark.createDataFrame(receipts, RECEIPTS)
    for strict in (False, True):
        assert assigned(left, right, strict) == brute(usage, receipts, strict)


def test_one_receipt_over_many_small_ones(spark):
    """A receipt that spans all others, one of nothing, ranges below zero, and rows without keys or quantities."""
    receipts = [("A", "x", f"s{i}", i, i + 1) for i in range(300)]
    receipts += [("A", "x", "all", 0, 10**9), ("A", "x", "none", 7, 7), ("A", "x", "below", -9, -2), ("A", "x", "back", 9, 4)]
    receipts += [(None, "x", "lost", 0, 99), ("A", "x", "open", None, 50), ("A", "x", "open", 50, None)]
    usage = [("A", "x", i, p) for i, p in enumerate([*range(-12, 310, 3), 7, 7, 10**9, 10**9 + 1, None])]
    left = spark.createDataFrame([*usage, (None, "x", 999, 5), ("A", None, 998, 5)], USAGE)
    right = spark.createDataFrame(receipts, RECEIPTS)
    known = [r for r in receipts if r[0]]
    for strict in (False, True):
        assert assigned(left, right, strict) == sorted(brute(usage, known, strict) + [(999, ""), (998, "")])


def test_range_assign_without_receipts_or_usage(spark):
    left, right = spark.createDataFrame([("A", "x", 1, 5)], USAGE), spark.createDataFrame([], RECEIPTS)
    assert assigned(left, right, False) == [(1, "")]
    assert assigned(left.filter("false"), right, True) == []


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(1, 60), min_size=1, max_size=12), st.lists(st.integers(-20, 500), min_size=1, max_size=20))
def test_strict_assigns_each_positive_position_once(spark, sizes, points):
    ends = [sum(sizes[: i + 1]) for i in range(len(sizes))]
    receipts = [("A", "x", f"{i}", e - s, e) for i, (s, e) in enumerate(zip(sizes, ends))]
    usage = [("A", "x", i, p) for i, p in enumerate(points)]
    left, right = spark.createDataFrame(usage, USAGE), spark.createDataFrame(receipts, RECEIPTS)
    strict, run = assigned(left, right, True), assigned(left, right, False)
    assert len(strict) == len(points)
    assert all(po for i, po in strict if 0 < points[i] <= ends[-1])
    differ = set(run) ^ set(strict)
    assert all(points[i] <= 0 or points[i] in ends for i, _ in differ)


def test_sync_diff_drops_same_side_duplicates(spark):
    left = spark.createDataFrame([("A",), ("B",), ("B",), (None,)], "k string")
    right = spark.createDataFrame([("A",), ("C",), (None,)], "k string")
    assert [tuple(r) for r in grouping.sync_diff(left, right, ["k"]).collect()] == [("C", "published")]
    assert grouping.sync_diff(left, right, ["k"], keep="source").count() == 0
    assert grouping.sync_diff(left, left, ["k"]).count() == 0


def test_lookup_ignores_case_and_keeps_rows(spark):
    left = spark.createDataFrame([("North", 1), ("SOUTH", 2), (None, 3)], "a string, v int")
    right = spark.createDataFrame([("north", "n"), ("South", "s"), (None, "z")], "a string, w string")
    plain = {r["v"]: r["w"] for r in joins.lookup(left, right, {"a": "a"}, ["w"]).collect()}
    assert plain == {1: "n", 2: "s", 3: None}
    safe = {r["v"]: r["w"] for r in joins.attach_ids(left, right, {"a": "a"}, ["w"]).collect()}
    assert safe == {1: "n", 2: "s", 3: "z"}


def test_fallback_multiplies_rows(spark):
    df = spark.createDataFrame([("Principal", "Order", 10)], "fee string, kind string, amount int")
    mapping = spark.createDataFrame(
        [("principal", "order", "X"), ("principal", "refund", "Y")], "fee string, kind string, term string"
    )
    out = joins.map_with_fallback(df, mapping, joins.same("fee", "kind"), mapping, joins.same("fee"), ["term"])
    assert sorted((r["term"], r["amount"]) for r in out.collect()) == [("X", 10), ("X", 10)]


def test_replace_unpublished_and_key_violations(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "c")], "id int, v string")
    out = joins.replace_rows(target, new, ["id"])
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a"), (2, "B"), (3, "c")]
    again = joins.replace_rows(out, new, ["id"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))
    published = spark.createDataFrame([("2",)], "id string")
    assert [r["id"] for r in joins.unpublished(target, published, "id").collect()] == [1]
    keys = spark.createDataFrame([("a", 1), ("A", 1), (None, 2), ("c", 3)], "k string, n int")
    bad = grouping.key_violations(keys, ["k", "n"])
    assert sorted((r["k"] or "", r["row_count"]) for r in bad.collect()) == [("", 1), ("a", 2)]


def test_replace_rows_ignores_case(spark):
    target = spark.createDataFrame([("North", "Sku-1", 1), ("North", "Sku-2", 2)], "a string, s string, v int")
    new = spark.createDataFrame([("NORTH", "SKU-1", 9)], "a string, s string, v int")
    out = joins.replace_rows(target, new, ["a", "s"])
    assert sorted(r["v"] for r in out.collect()) == [2, 9]


def test_group_in_two_steps_ignores_case(spark):
    rows = [("A", "x", 1), ("a", "X", 2), ("B", "x", 4), (None, "x", 8), (None, "X", 16)]
    df = spark.createDataFrame(rows, "k string, s string, v int")
    measures = [("total", "sum", F.col("v")), ("low", "min", F.col("v")), ("high", "max", F.col("v")), ("n", "count", F.lit(1))]
    out = grouping.group_in_two_steps(df, ["k", "s"], measures)
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(
        [("A", "X", 3, 1, 2, 2), ("B", "x", 4, 4, 4, 1), (None, "X", 24, 8, 16, 2)], key=repr
    )


def test_change_set_tells_what_an_upsert_does(spark):
    target = spark.createDataFrame([("A", 1, "x"), ("b", 2, None), ("c", None, "z"), (None, 4, "w")], "k string, v int, note string")
    new = spark.createDataFrame([("a", 1), ("B", 3), ("c", None), ("d", 9), (None, 5)], "k string, v int")
    out = joins.change_set(target, new, ["k"])
    rows = {(r["k"] or "").lower(): (r["outcome"], r["v"], r["note"]) for r in out.collect()}
    # The spelling of the key is a value, too.
    assert rows == {"a": ("changed", 1, "x"), "b": ("changed", 3, None), "c": ("unchanged", None, "z"), "d": ("created", 9, None), "": ("changed", 5, "w")}
    assert sorted(r["v"] for r in joins.to_write(out).collect()) == [1, 3, 5, 9]
    part = new.filter("k = 'd'")
    kept = joins.change_set(target, part, ["k"])
    assert {r["outcome"] for r in kept.filter("k <> 'd' OR k IS NULL").collect()} == {"unchanged"}
    gone = joins.change_set(target, part, ["k"], delete_missing=True)
    assert joins.apply_changes(gone).collect()[0]["k"] == "d" and gone.filter("outcome = 'deleted'").count() == 4
    assert joins.change_set(target, new.filter("false"), ["k"]).filter("outcome <> 'unchanged'").count() == 0
