"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Each source's documents form one stream of words, cut into blocks of ``BLOCK`` words.
A source's target is an exact number of words: so many whole passes over its blocks,
then the first blocks of a permutation of them, the last one in part. All these block
draws are dealt to output shards by a binary tree: at each node the left half gets its
share of the draws, split among the sources by a multivariate-hypergeometric draw, and
so on down to single shards. A shard then owns a run of each source's draws, disjoint
from every other shard's, and puts its pieces into a random order of its own.

The tree works on one row per source. Streams are laid out by chunk totals, so a
source that holds a third of the corpus is spread over many tasks.

Defined cases: a NULL or blank text has size 0 and is never taken; NULL sources form
one source, last in the order; equal rows are separate documents; an empty table gives
an empty mix. Seeds are fixed, so runs agree.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sellerbooks.llm.common import ROW, before_in_group, numbered, numbered_in_files, spread, with_row
from sellerbooks.session import materialise

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
BLOCK = 4096
SHARDS = 64
SEED = 20_240_601
#: Documents of a source that one task lays out.
CHUNK_ROWS = 50_000
#: Draws that one hypergeometric call can count; blocks grow beyond it.
MOST_DRAWS = 500_000_000
WORD = r"[^\x20\x09-\x0D]+"


def sizes(docs: DataFrame) -> DataFrame:
    """(_row, doc_id, source, size): size is the number of words."""
    return with_row(docs, *_measured())


def _measured(own: str = "") -> list[Column]:
    words = F.coalesce(F.regexp_count(F.col(f"{own}text"), F.lit(WORD)), F.lit(0)).cast("long")
    return [F.col(f"{own}doc_id").alias("doc_id"), F.col(f"{own}source").alias("source"), words.alias("size")]


def targets(rows: DataFrame) -> DataFrame:
    """(source, source_size, rank, target): the weighted shares, none above MOST times its source.

    Capping and sharing the excess again ends with one rate: a source gets the smaller
    of its cap and rate times weight. In the order of cap over weight the capped sources
    come first, so running sums give the rate.
    """
    per = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy(F.lit(0))
    rank = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    per = per.withColumn("rank", rank).withColumn("weight", weight).withColumn("cap", F.col("source_size") * MOST)
    per = per.withColumn("full", F.col("cap") / F.col("weight"))
    order = everything.orderBy("full", "rank")
    above, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything) * F.lit(SHARE)
    rate = (total - F.coalesce(F.sum("cap").over(above), F.lit(0))) / F.sum("weight").over(onward)
    # Capping a source below its share raises the rate, capping one above it would lower it: the peak is the rate.
    per = per.withColumn("rate", rate).withColumn("rate", F.max("rate").over(everything))
    target = F.least(F.col("cap").cast("double"), F.col("rate") * F.col("weight"))
    return per.select("source", "source_size", "rank", target.alias("target"))


def split_draws(draws: np.ndarray, shards: int, seed: int = SEED) -> np.ndarray:
    """Counts (shard, source) that sum to ``draws`` over the shards."""
    counts = np.zeros((shards, len(draws)), dtype=np.int64)

    def split(node: int, low: int, high: int, left: np.ndarray) -> None:
        if high - low == 1:
            counts[low] = left
            return
        middle = (low + high) // 2
        total = int(left.sum())
        share = total * (middle - low) // (high - low)
        taken = np.random.default_rng([seed, node]).multivariate_hypergeometric(left, share, method="marginals")
        split(2 * node, low, middle, taken)
        split(2 * node + 1, middle, high, left - taken)

    if len(draws):
        split(1, 0, shards, draws.astype(np.int64))
    return counts


def _plan(shards: int, seed: int):
    def plan(per: pd.DataFrame) -> pd.DataFrame:
        per = per.sort_values("rank").reset_index(drop=True)
        size = per["source_size"].to_numpy(np.int64)
        words = np.minimum(np.rint(per["target"].to_numpy()).astype(np.int64), MOST * size)
        block = max(BLOCK, math.ceil(int(words.sum()) / MOST_DRAWS))
        passes = np.where(size > 0, words // np.maximum(size, 1), 0)
        rest = words - passes * size
        blocks = -(-size // block)
        draws = passes * blocks + -(-rest // block)
        ends = np.cumsum(split_draws(draws, shards, seed), axis=0).T
        factors, shifts = [], []
        for rank, whole in zip(per["rank"], size // block):
            # Place of a block in the permutation: factor * block + shift, modulo the whole blocks.
            rng = np.random.default_rng([seed, int(rank), 7])
            factor = int(rng.integers(1, 1 << 28)) | 1
            while math.gcd(factor, max(int(whole), 1)) > 1:
                factor += 2
            factors.append(factor)
            shifts.append(int(rng.integers(0, max(int(whole), 1))))
        return pd.DataFrame(
            {
                "source": per["source"], "source_size": size, "target": per["target"], "block": block, "passes": passes,
                "rest": rest, "whole": size // block, "blocks": blocks, "factor": factors, "shift": shifts,
                "ends": list(ends),
            }
        )

    return plan


PLAN = (
    "source string, source_size long, target double, block long, passes long, rest long, whole long, "
    "blocks long, factor long, shift long, ends array<long>"
)


def plan_mix(rows: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """One row a source: its target, its blocks and the ends of each shard's run of its draws."""
    per = targets(rows).withColumn("source", F.col("source").cast("string"))
    return per.groupBy(F.lit(0).alias("all")).applyInPandas(_plan(shards, seed), PLAN)


def _pieces() -> Column:
    """The pieces of one document: (pass, draw, first word, words) for each block it overlaps in each pass."""
    start, end, block = F.col("start"), F.col("start") + F.col("size"), F.col("block")
    blocks = F.sequence(F.floor(start / block).cast("long"), F.floor((end - 1) / block).cast("long"))
    turns = F.sequence(F.lit(0).cast("long"), F.col("passes"))

    def piece(turn: Column, j: Column) -> Column:
        moved = F.pmod(F.col("factor") * F.pmod(j, F.greatest("whole", F.lit(1))) + F.col("shift"), F.greatest("whole", F.lit(1)))
        place = F.when(j < F.col("whole"), moved).otherwise(F.col("whole"))  # the short last block stays last
        # The last pass takes the first `rest` words of the permuted blocks.
        most = F.when(turn < F.col("passes"), block).otherwise(F.col("rest") - place * block)
        low = F.greatest(start, j * block)
        high = F.least(end, j * block + F.least(most, block))
        return F.struct(
            turn.alias("turn"),
            (turn * F.col("blocks") + place).alias("draw"),
            (low - start).alias("first"),
            F.greatest(high - low, F.lit(0)).alias("n"),
        )

    return F.flatten(F.transform(turns, lambda t: F.transform(blocks, lambda j: piece(t, j))))


def mix(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(rows, pieces).

    rows: _row, doc_id, source, size, source_size, target for every document.
    pieces: _row, turn, first, n, shard, place for every part of a document that the mix
    takes: ``n`` words from word ``first``, written to ``shard`` in the order of ``place``.
    """
    return _mix(materialise(sizes(docs)), shards, seed)


def _mix(sized: DataFrame, shards: int = SHARDS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    chunks = max(1, math.ceil(sized.count() / CHUNK_ROWS))
    # By a hash of doc_id, so that runs agree on any file layout; equal ids follow the files.
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.col("size"), F.col(ROW)]
    laid = before_in_group(sized, ["source"], F.col("size"), order, chunks, ["doc_id", "size"], "start")
    plan = materialise(plan_mix(sized, shards, seed)).withColumnRenamed("source", "_source")
    rows = materialise(laid.join(plan, F.col("source").eqNullSafe(F.col("_source"))).drop("_source"))
    pieces = rows.filter("size > 0").select(ROW, "source", "ends", F.explode(_pieces()).alias("p")).filter("p.n > 0")
    shard = F.size(F.filter("ends", lambda e: e <= F.col("p.draw")))
    place = F.xxhash64(F.lit(seed), ROW, "p.draw", "p.first")
    pieces = pieces.select(ROW, "p.turn", "p.first", "p.n", shard.alias("shard"), place.alias("place"))
    return rows.select(ROW, "doc_id", "source", "size", "source_size", "target"), pieces


def taken(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) for every document."""
    rows, pieces = mix(docs)
    words = pieces.groupBy(F.col(ROW).alias("_r")).agg(F.sum("n").alias("taken"))
    joined = rows.join(words, F.col(ROW) == F.col("_r"), "left")
    return joined.select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def mixed_documents(docs: DataFrame, in_files: bool = False) -> DataFrame:
    """The mix as documents: a row for each pass that takes a document.

    A document taken whole keeps its text; one taken in part keeps the words taken,
    one blank apart. Other columns are repeated as they are. ``in_files``: the documents
    are read from Parquet files as they lie there.
    """
    numbers = numbered_in_files(docs) if in_files else materialise(numbered(docs))
    _, pieces = _mix(materialise(numbers.select(ROW, *_measured("doc."))))
    part = F.sort_array(F.collect_list(F.struct("first", "n")))
    turns = pieces.groupBy(F.col(ROW).alias("_r"), "turn").agg(F.sum("n").alias("_n"), part.alias("_parts"))
    # A row or more a document: not to be broadcast, small as the packed table it is derived from may look.
    joined = numbers.join(turns.hint("merge"), F.col(ROW) == F.col("_r"))
    full = F.col("doc.text")
    words = F.regexp_extract_all(full, F.lit(WORD), F.lit(0))
    some = F.flatten(F.transform("_parts", lambda p: F.slice(words, (p["first"] + 1).cast("int"), p["n"].cast("int"))))
    whole = F.col("_n") == F.regexp_count(full, F.lit(WORD))
    text = F.when(whole, full).otherwise(F.array_join(some, " "))
    return joined.select(*spread(joined, docs.columns, text))
