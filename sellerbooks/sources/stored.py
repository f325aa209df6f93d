"""Tables that loads replace or add to, with a key check inside the write and the profile kept beside the rows.

A table is a folder: ``rows/<load>`` holds the rows of a load as Parquet, ``commits/<n>`` one row
that says which loads make up the table, its schema, and the state of its columns. Rows are
written first, checked by what the write itself observed, and count only once their commit is
there; a commit is one file with the next number, and an existing number is never written
again. So a load that fails or is refused leaves the table as it was, and two writers cannot
both add the same commit. A load may have a name, made of its content for example: a name that is
committed is not loaded a second time, whatever a retried run sends.

The state (``operators.schema.profile_state``) of a load is merged into the table's, so an append
reads the stored rows only when a column changes its type and has to be written anew.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sellerbooks.functions.columns import all_of, folded
from sellerbooks.operators import schema as schemas
from sellerbooks.session import exists

COMMIT = "number int, loads array<string>, names array<string>, kinds string, keys array<string>, state string, row_count bigint"


class KeyViolation(ValueError):
    """A load that would break the table's key; ``violations`` lists the keys, read from the refused rows."""

    def __init__(self, missing: int, repeated: int, violations: DataFrame):
        super().__init__(f"load refused: {missing} rows without a key, {repeated} rows repeat one")
        self.missing, self.repeated, self.violations = missing, repeated, violations


@dataclass(frozen=True)
class Version:
    number: int
    loads: list[str]
    names: list[str]
    schema: T.StructType
    keys: list[str]
    state: list[dict]
    row_count: int


def current(spark: SparkSession, path: str) -> Version | None:
    """The last commit of a table, None where there is none."""
    if not exists(spark, f"{path}/commits"):
        return None
    row = spark.read.schema(COMMIT).json(f"{path}/commits/*").orderBy(F.desc("number")).limit(1).collect()
    if not row:
        return None
    r = row[0]
    kinds = T.StructType.fromJson(json.loads(r["kinds"]))
    return Version(r["number"], r["loads"], r["names"], kinds, r["keys"], json.loads(r["state"]), r["row_count"])


def read(spark: SparkSession, path: str) -> DataFrame:
    """The committed rows; columns that a load lacks are NULL there."""
    now = current(spark, path)
    if now is None:
        raise FileNotFoundError(f"no table at {path}")
    return spark.read.schema(now.schema).parquet(*[f"{path}/rows/{load}" for load in now.loads])


def state(spark: SparkSession, path: str) -> DataFrame:
    """The state of the table's columns, kept beside it."""
    now = current(spark, path)
    if now is None:
        raise FileNotFoundError(f"no table at {path}")
    return _state_rows(spark, now.state)


def _state_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    kinds = schemas.profile_state(spark.createDataFrame([], "a string")).schema
    return spark.createDataFrame([tuple(r[f.name] for f in kinds) for r in rows], kinds)


def _keep(rows: DataFrame) -> list[dict]:
    return [r.asDict() for r in rows.collect()]


def _commit(spark: SparkSession, path: str, version: Version) -> None:
    row = (
        version.number, version.loads, version.names, version.schema.json(), version.keys, json.dumps(version.state), version.row_count,
    )
    # The write fails where another writer has made this number.
    spark.createDataFrame([row], COMMIT).coalesce(1).write.mode("error").json(f"{path}/commits/{version.number:08d}")


def _write(df: DataFrame, path: str, load: str, keys: Sequence[str], stored: DataFrame | None = None) -> int:
    """Write a load's rows and return their number; the one pass that writes also looks for keys that are missing or repeat.

    With a key, rows are shuffled by it and sorted, so equal keys stand together and a row
    number tells them; rows without a key are spread by their other columns. ``stored`` are
    rows whose keys the load must not repeat.
    """
    target = f"{path}/rows/{load}"
    if not keys:
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(target)
        return seen.get["rows"]
    marks = [f"_k{i}" for i in range(len(keys))]
    complete = all_of([F.col(m).isNotNull() for m in marks])

    def marked(rows: DataFrame, old: bool) -> DataFrame:
        found = rows.select("*", *[folded(rows, k).alias(m) for k, m in zip(keys, marks)], F.lit(old).alias("_old"))
        apart = F.when(~complete, F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])).otherwise(F.lit(0))
        return found.withColumn("_apart", apart)

    rows = marked(df, False)
    if stored is not None:
        lacking = [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields if f.name not in keys]
        old = marked(stored.select(*keys), True).select(*keys, *lacking, *marks, "_old", "_apart")
        rows = rows.unionByName(old)
    by = Window.partitionBy(*marks, "_apart").orderBy(F.col("_old").desc())
    rows = rows.withColumn("_n", F.row_number().over(by)).filter(~F.col("_old"))
    seen = Observation()
    watched = rows.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~complete).alias("missing"),
        F.count_if(complete & (F.col("_n") > 1)).alias("repeated"),
    )
    watched.withColumn("_bad", ~complete | (F.col("_n") > 1)).drop(*marks, "_old", "_apart", "_n").write.parquet(target)
    found = seen.get
    if found["missing"] or found["repeated"]:
        refused = df.sparkSession.read.parquet(target).filter("_bad")
        raise KeyViolation(found["missing"], found["repeated"], refused.groupBy(*keys).agg(F.count(F.lit(1)).alias("refused")))
    return found["rows"]


def replace(df: DataFrame, path: str, keys: Sequence[str] = (), name: str | None = None) -> Version:
    """Make ``df`` the whole table; until its commit the old rows stay what readers see."""
    spark = df.sparkSession
    now = current(spark, path)
    if now is not None and name is not None and name in now.names:
        return now
    load = uuid.uuid4().hex
    count = _write(df, path, load, keys)
    written = spark.read.schema(df.schema).parquet(f"{path}/rows/{load}")
    made = Version(
        now.number + 1 if now else 1, [load], [name] if name else [], df.schema, list(keys), _keep(schemas.profile_state(written)), count
    )
    _commit(spark, path, made)
    return made


def append(df: DataFrame, path: str, name: str | None = None) -> Version:
    """Add rows: the load is profiled, columns widen where it needs them to, and missing ones are added.

    Stored rows are read only for a key check (their key columns) and where a column's type changes.
    """
    spark = df.sparkSession
    now = current(spark, path)
    if now is None:
        return replace(df, path, name=name)
    if name is not None and name in now.names:
        return now
    known = schemas.profile_of(_state_rows(spark, now.state))
    kinds = schemas.widened_types(known, schemas.schema_profile(df), now.schema)
    loads, kept = now.loads, now.state
    target = now.schema
    if kinds:
        shaped = read(spark, path).withColumns({c: F.col(c).cast(k) for c, k in kinds.items()})
        load, target = uuid.uuid4().hex, shaped.schema
        _write(shaped, path, load, ())
        loads = [load]
        rewritten = schemas.profile_state(spark.read.parquet(f"{path}/rows/{load}").select(*kinds))
        kept = [r for r in kept if r["column_name"] not in kinds] + _keep(rewritten)
    load = uuid.uuid4().hex
    rows = schemas.shape_load(df, known, target)
    stored = read(spark, path).select(*now.keys) if now.keys else None
    count = _write(rows, path, load, now.keys, stored)
    loaded = schemas.profile_state(spark.read.schema(rows.schema).parquet(f"{path}/rows/{load}"))
    merged = _keep(schemas.merge_states(_state_rows(spark, kept), loaded))
    made = Version(
        now.number + 1, [*loads, load], [*now.names, *([name] if name else [])], rows.schema, now.keys, merged, now.row_count + count
    )
    _commit(spark, path, made)
    return made


def content_name(df: DataFrame) -> str:
    """A name of a frame's rows, whatever their order: equal loads have equal names."""
    hashes = [F.xxhash64(F.lit(seed), F.to_json(F.struct("*"), {"ignoreNullFields": "false"})) for seed in (0, 1)]
    sums = [F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)).cast("string") for h in hashes]
    row = df.agg(F.count(F.lit(1)).alias("n"), *[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()
    return "-".join(str(v) for v in row)
