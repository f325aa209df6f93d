"""Stored tables: replace, append, key check, kept state, and loads that fail or come twice."""

import pytest
from pyspark.sql import functions as F

from sellerbooks.operators import schema
from sellerbooks.sources import stored

COLUMNS = "account string, sku string, qty int"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def sales(spark, *rows):
    return spark.createDataFrame(list(rows), COLUMNS)


def state_of(df):
    return {r["column_name"].upper(): r.asDict() | {"column_name": ""} for r in df.collect()}


def test_replace_and_a_load_that_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    stored.replace(sales(spark, ("A", "x", 1), ("A", "y", None)), path)
    assert rows_of(stored.read(spark, path)) == [("A", "x", 1), ("A", "y", None)]
    broken = sales(spark, ("B", "x", 1), ("B", "y", 2)).withColumn("qty", F.when(F.col("qty") == 2, F.raise_error(F.lit("lost"))).otherwise(1).cast("int"))
    with pytest.raises(Exception, match="lost"):
        stored.replace(broken, path)
    assert rows_of(stored.read(spark, path)) == [("A", "x", 1), ("A", "y", None)]
    made = stored.replace(spark.createDataFrame([(5,)], "other long"), path)
    assert rows_of(stored.read(spark, path)) == [(5,)] and made.number == 2 and made.row_count == 1
    with pytest.raises(FileNotFoundError):
        stored.read(spark, str(tmp_path / "none"))


def test_a_key_refuses_rows_that_lack_or_repeat_it(spark, tmp_path):
    path = str(tmp_path / "t")
    keys = ["account", "sku"]
    stored.replace(sales(spark, ("A", "x", 1), ("A", "y", 2)), path, keys)
    bad = sales(spark, ("B", "x", 1), ("b", "X", 2), ("B", "X", 3), (None, "x", 4), (None, "x", 4), ("C", "x", 5))
    with pytest.raises(stored.KeyViolation) as caught:
        stored.replace(bad, path, keys)
    assert (caught.value.missing, caught.value.repeated) == (2, 2)
    assert sum(r["refused"] for r in caught.value.violations.collect()) == 4
    # An append must not repeat stored keys either, in any spelling.
    with pytest.raises(stored.KeyViolation) as caught:
        stored.append(sales(spark, ("a", "X", 9), ("D", "x", 1)), path)
    assert (caught.value.missing, caught.value.repeated) == (0, 1)
    assert rows_of(stored.read(spark, path)) == [("A", "x", 1), ("A", "y", 2)]
    stored.append(sales(spark, ("D", "x", 1)), path)
    assert stored.current(spark, path).row_count == 3 and stored.read(spark, path).count() == 3


def test_state_of_appends_equals_the_full_profile(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    stored.replace(spark.createDataFrame([("a", "1", 7)], "name string, n string, q int"), path)
    with monkeypatch.context() as m:
        # No type changes: the stored rows are not read.
        m.setattr(stored, "read", lambda *_: pytest.fail("the stored rows were read"))
        stored.append(spark.createDataFrame([("b", 4)], "NAME string, Q int"), path)
        stored.append(spark.createDataFrame([(2.5, 3)], "extra double, q int"), path)
    stored.append(spark.createDataFrame([("12.75",)], "q string"), path)
    whole = stored.read(spark, path)
    assert whole.dtypes == [("name", "string"), ("n", "string"), ("q", "decimal(12,2)"), ("extra", "double")]
    assert sorted(str(r["q"]) for r in whole.collect()) == ["12.75", "3.00", "4.00", "7.00"]
    assert state_of(stored.state(spark, path)) == state_of(schema.profile_state(whole))
    assert rows_of(schema.profile_of(stored.state(spark, path))) == rows_of(schema.schema_profile(whole))


def test_a_load_with_a_name_counts_once(spark, tmp_path):
    path = str(tmp_path / "t")
    first, second = sales(spark, ("A", "x", 1), ("A", "y", 2)), sales(spark, ("A", "x", 1))
    again = sales(spark, ("A", "y", 2), ("A", "x", 1))
    assert stored.content_name(first) == stored.content_name(again) != stored.content_name(second)
    for load in (first, again, second, second):
        stored.append(load, path, stored.content_name(load))
    assert rows_of(stored.read(spark, path)) == [("A", "x", 1), ("A", "x", 1), ("A", "y", 2)]
    assert stored.current(spark, path).number == 2


def test_two_writers_cannot_make_the_same_commit(spark, tmp_path):
    path = str(tmp_path / "t")
    made = stored.replace(sales(spark, ("A", "x", 1)), path)
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        stored._commit(spark, path, made)


def test_merged_states_of_nothing_and_of_lacking_columns(spark):
    one, none = spark.createDataFrame([(1, "a")], "x int, y string"), spark.createDataFrame([], "x int, y string")
    other = spark.createDataFrame([(0,)], "X int")
    for left, right in ((one, none), (none, one), (one, other), (other, one), (none, none)):
        both = left.unionByName(schema.align(right, left.schema), allowMissingColumns=True)
        merged = schema.merge_states(schema.profile_state(left), schema.profile_state(right))
        assert state_of(merged) == state_of(schema.profile_state(both))


def test_wide_numbers_are_kept(spark):
    long, longest = "12345678901234567890", "9" * 45
    whole = schema.numeric_coerce(spark.createDataFrame([(long,), ("7.0",)], "x string"), ["x"])
    assert [str(r[0]) for r in whole.collect()] == [long, "7"]
    text = schema.numeric_coerce(spark.createDataFrame([(longest,), ("7",)], "x string"), ["x"])
    assert [r[0] for r in text.collect()] == [longest, "7"]
    fraction = schema.numeric_coerce(spark.createDataFrame([("1" * 26 + "." + "3" * 22,)], "x string"), ["x"])
    assert fraction.dtypes == [("x", "double")] and fraction.first()[0] == pytest.approx(1.1111e25, rel=1e-3)
    grown = schema.evolve_append(spark.createDataFrame([(5,)], "x bigint"), spark.createDataFrame([(long,)], "x string"))
    assert sorted(str(r[0]) for r in grown.collect()) == [long, "5"]
    from sellerbooks.plans.imports import typed

    assert [str(r[0]) for r in typed(spark.createDataFrame([(long,), ("4.0",)], "x string")).collect()] == [long, "4.0"]
    assert [r[0] for r in typed(spark.createDataFrame([("4.0",), (None,)], "x string")).collect()] == [4, 0]
