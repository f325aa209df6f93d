"""Approximate nearest neighbours by inner product: p-stable hashing with query-directed multiprobe.

Inner product becomes Euclidean distance by one more coordinate: vectors are divided by
the largest norm M and get sqrt(1 - |x|^2), queries are made unit vectors and get 0.
Vectors of a shard are cut into ranges of norms within ``RATIO`` of each other, each with
an M of its own, so one long vector does not crowd the others together.
Each of ``TABLES`` tables hashes a point to ``HASHES`` slots of width ``WIDTH`` along
Gaussian directions. A query visits its own bucket and then perturbed ones in the order
of estimated success: the distances from its slots' edges are sorted, and sets of steps
are taken in increasing order of their expected squared distance. Candidates of all
tables are merged and ranked by the exact inner product of the original vectors in
double precision, summed in one fixed order, so equal vectors score equally.

Probing goes on by ``STOPS`` and ends where its bound is met. A vector that would still
change a query's list lies within the distance its last score stands for; the slots' edges
give the probability that the probes so far, of all tables, meet a point at that distance.
Where it stays below ``FOUND_AT_LEAST`` after the last probe, or the list is not full, the
rest of the range is scored too. Ranges go from long vectors to short ones, and one whose M
cannot reach the list's last score is passed over.

Equal vectors are indexed once with the smallest ids they can need, and equal queries
search once, so copies never make a hot bucket. The index is dealt into shards of about
``SHARD_ROWS`` distinct vectors by a hash of the vector, which spreads a hot bucket too;
a task holds one shard's tables and streams the distinct queries past it in batches.

Defined cases: vectors that are NULL, zero, or hold NULL or non-finite components take
no part; a vector is searched among those of its own dimension, each dimension having
shards of its own; NULL ids take no part; rows that
repeat an id and vector count once; an id never finds itself; ties go to the smaller id;
fewer candidates give fewer rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sellerbooks.session import materialise

TOP = 20
EVERY = 20
TABLES = 10
HASHES = 10
WIDTH = 2.3
PROBES = 900
#: Probes of a table after which the bound is looked at.
STOPS = (150, 300, 500, 700, 900)
#: Norms of a range; within it the longest is its M.
RATIO = 1.2
#: Ranges of fewer vectors are scored whole, which is less work than their probes.
LEAST_RANGE = 256
#: Least estimated probability that the probes meet a vector at the end of the list, the hardest to meet.
FOUND_AT_LEAST = 0.92
#: Bounds the error of a product of unit vectors.
ROUNDING = 1e-11
SEED = 5
SHARD_ROWS = 20_000


@lru_cache(maxsize=2)
def directions(dimension: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.normal(size=(TABLES, HASHES, dimension + 1)), rng.uniform(0, WIDTH, size=(TABLES, HASHES))


@lru_cache(maxsize=2)
def probing_sequence(hashes: int = HASHES, probes: int = PROBES) -> list[tuple[int, ...]]:
    """Sets of ranks among the 2 * hashes sorted edge distances, by expected sum of squares.

    The j-th smallest distance has expected square j(j+1) / 4(m+1)(m+2) in the first half
    and its mirror image in the second; ranks j and 2m+1-j are the two edges of one slot.
    """
    m = hashes
    square = [0.0] * (2 * m + 1)
    for j in range(1, m + 1):
        square[j] = j * (j + 1) / (4 * (m + 1) * (m + 2))
    for j in range(m + 1, 2 * m + 1):
        i = 2 * m + 1 - j
        square[j] = 1 - i / (m + 1) + i * (i + 1) / (4 * (m + 1) * (m + 2))
    sets = [
        c
        for size in range(0, min(m, 6) + 1)
        for c in combinations(range(1, 2 * m + 1), size)
        if all((2 * m + 1 - j) not in c for j in c)
    ]
    sets.sort(key=lambda c: (sum(square[j] for j in c), c))
    return sets[:probes]


@lru_cache(maxsize=2)
def _steps(hashes: int = HASHES, probes: int = PROBES) -> np.ndarray:
    """Probe by rank: 1 where the probe takes the step of that rank."""
    taken = np.zeros((probes, 2 * hashes), dtype=np.int64)
    for i, steps in enumerate(probing_sequence(hashes, probes)):
        taken[i, [j - 1 for j in steps]] = 1
    return taken


@lru_cache(maxsize=2)
def _taken() -> np.ndarray:
    return _steps().astype(np.float64)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _project(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots and places within them, by point, table and hash."""
    a, b = directions(points.shape[1] - 1)
    places = np.einsum("nd,thd->nth", points, a, optimize=True) + b
    slots = np.floor(places / WIDTH)
    return slots.astype(np.int64), places / WIDTH - slots


def norms(x: np.ndarray) -> np.ndarray:
    """Lengths of the rows, also where their squares are out of range."""
    most = np.abs(x).max(axis=1)
    return most * np.sqrt(((x / most[:, None]) ** 2).sum(axis=1))


def _below(x: np.ndarray) -> np.ndarray:
    """The standard normal distribution function, to 1e-7 (Abramowitz and Stegun 26.2.17)."""
    t = 1 / (1 + 0.2316419 * np.abs(x))
    tail = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail *= np.exp(-x * x / 2) / math.sqrt(2 * math.pi)
    return np.where(x < 0, tail, 1 - tail)


class Probe:
    """One query's buckets in all tables, and how likely they hold a point at some distance."""

    def __init__(self, inside: np.ndarray, own: np.ndarray, weights: np.ndarray):
        edges = np.concatenate([inside, 1 - inside], axis=1)  # a step down, a step up
        ranked = np.argsort(edges, axis=1, kind="stable")
        self.moves = np.where(ranked < HASHES, -1, 1) * weights[ranked % HASHES]
        self.inside, self.ranked, self.own = inside, ranked, own

    def visited(self, table: int, first: int, last: int) -> np.ndarray:
        """Buckets of the probes from ``first`` to ``last``."""
        return self.own[table] + _steps()[first:last] @ self.moves[table]

    def success(self, distance: float, probes: int = PROBES) -> float:
        """Probability that one of the first ``probes`` buckets of any table holds a given point at ``distance``."""
        width = WIDTH / max(distance, 1e-9)
        low, high = -self.inside * width, (1 - self.inside) * width
        under, over = _below(low), _below(high)
        # Per hash: the slots below, at and above the query's own.
        down, stay, up = under - _below(low - width), over - under, _below(high + width) - over
        stay = np.maximum(stay, 1e-300)
        gain = np.log(np.maximum(np.concatenate([down, up], axis=1), 1e-300)) - np.log(np.concatenate([stay, stay], axis=1))
        gain = np.take_along_axis(gain, self.ranked, axis=1)
        chance = np.exp(_taken()[:probes] @ gain.T + np.log(stay).sum(axis=1)).sum(axis=0)
        return 1 - float(np.prod(1 - np.minimum(chance, 1)))


class NormRange:
    """Vectors of like norms, ``rows`` of the shard: for each table its buckets, and each vector's bucket."""

    def __init__(self, x: np.ndarray, rows: np.ndarray, longest: float, weights: np.ndarray):
        self.rows, self.longest = rows, longest
        self.tables = None
        if len(rows) < LEAST_RANGE:
            return
        scaled = x[rows] / longest
        lift = np.sqrt(np.maximum(1 - (scaled * scaled).sum(axis=1), 0))
        slots, _ = _project(np.concatenate([scaled, lift[:, None]], axis=1))
        self.tables = [np.unique((slots[:, t] * weights).sum(axis=1), return_inverse=True) for t in range(TABLES)]

    def met(self, probe: Probe, first: int, last: int) -> np.ndarray:
        """Which of ``rows`` lie in the buckets that the probes from ``first`` to ``last`` visit."""
        found = np.zeros(len(self.rows), dtype=bool)
        for table, (buckets, bucket_of) in enumerate(self.tables):
            visited = probe.visited(table, first, last)
            at = np.searchsorted(buckets, visited)
            at[at == len(buckets)] = 0
            hit = np.zeros(len(buckets), dtype=bool)
            hit[at[buckets[at] == visited]] = True
            found |= hit[bucket_of]
        return found


class Shard:
    """One share of the vectors, in ranges of norms from the longest to the shortest."""

    def __init__(self, x: np.ndarray):
        self.x = x
        # A bucket's key is a weighted sum of its slots, so that a step adds or takes one weight.
        self.weights = np.random.default_rng(SEED).integers(1, 1 << 62, size=HASHES, dtype=np.int64)
        self.length = length = norms(x)
        order = np.argsort(-length, kind="stable")
        self.ranges, at = [], 0
        while at < len(order):
            longest = float(length[order[at]])
            end = max(at + 1, int(np.searchsorted(-length[order], -longest / RATIO, side="right")))
            # The next range begins below; a rest that is scored whole may be as wide as it likes.
            end = len(order) if len(order) - end < LEAST_RANGE and end - at < LEAST_RANGE else end
            self.ranges.append(NormRange(x, np.sort(order[at:end]), longest * (1 + 1e-12), self.weights))
            at = end

    def candidates(self, queries: np.ndarray, top: int) -> Iterator[np.ndarray]:
        """Rows that hold each query's ``top`` best ones, as far as the bound goes; never fewer than there are."""
        unit = queries / norms(queries)[:, None]
        slots, inside = _project(np.concatenate([unit, np.zeros((len(unit), 1))], axis=1))
        own = (slots * self.weights).sum(axis=2)
        for i in range(len(queries)):
            found, scores, probe = np.zeros(0, np.int64), np.zeros(0), None
            last = -np.inf
            for part in self.ranges:
                if last > part.longest:
                    break
                left = np.ones(len(part.rows), dtype=bool)
                if part.tables is not None:
                    probe = probe or Probe(inside[i], own[i], self.weights)
                    for a, b in zip((0, *STOPS), STOPS):
                        new = part.met(probe, a, b) & left
                        left &= ~new
                        found, scores = self._add(found, scores, part.rows[new], unit[i])
                        last = self._last(found, scores, top)
                        # Whatever belongs to the list and was not met is no farther than this.
                        distance = math.sqrt(max(2 - 2 * last / part.longest, 0)) if last > -np.inf else np.inf
                        if distance < np.inf and probe.success(distance, b) >= FOUND_AT_LEAST:
                            left[:] = False
                            break
                if left.any():
                    found, scores = self._add(found, scores, part.rows[left], unit[i])
                    last = self._last(found, scores, top)
            yield np.sort(found[scores + ROUNDING * self.length[found] >= last])

    def _add(self, found: np.ndarray, scores: np.ndarray, rows: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([found, rows]), np.concatenate([scores, self.x[rows] @ unit])

    def _last(self, found: np.ndarray, scores: np.ndarray, top: int) -> float:
        """What the ``top``-th best score is at least, as scores are rounded in proportion to the norms."""
        if len(found) < top:
            return -np.inf
        return float(np.partition(scores - ROUNDING * self.length[found], len(found) - top)[len(found) - top])


FOUND = "q1 long, q2 long, k1 long, k2 long, score double, ids array<long>"


def _search(top: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by dimension and part, vectors before queries; a shard is dropped when the next part begins."""
        now, held, shard = None, [], None
        for batch in batches:
            marks = np.stack([batch.column(n).to_numpy() for n in ("d", "part", "kind")], axis=1)
            parts, kinds = [tuple(m) for m in marks[:, :2].tolist()], marks[:, 2]
            cuts = np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(parts)]):
                if a == b:
                    continue
                if parts[a] != now:
                    now, held, shard = parts[a], [], None
                if kinds[a] == 0:
                    held.append(batch.slice(a, b - a))
                    continue
                if shard is None and held:
                    index = pa.Table.from_batches(held).combine_chunks()
                    columns = [index.column(n).combine_chunks() for n in ("k1", "k2", "ids")]
                    shard = Shard(_matrix(index.column("vector").combine_chunks()))
                if shard is not None:
                    for at in range(a, b, 256):
                        yield from _look_up(batch.slice(at, min(256, b - at)), shard, columns, top)

    return search


def _look_up(run: pa.RecordBatch, shard: Shard, columns: list[pa.Array], top: int) -> Iterator[pa.RecordBatch]:
    queries = _matrix(run.column("vector"))
    asked, rows, values = [], [], []
    for i, own in enumerate(shard.candidates(queries, top)):
        asked.append(np.full(len(own), i))
        rows.append(own)
        values.append((shard.x[own] * queries[i]).sum(axis=1))
    asked, rows, values = map(np.concatenate, (asked, rows, values))
    take = pa.array(asked)
    yield pa.RecordBatch.from_arrays(
        [
            run.column("k1").take(take), run.column("k2").take(take),
            *[c.take(pa.array(rows)) for c in columns[:2]], pa.array(values), columns[2].take(pa.array(rows)),
        ],
        names=["q1", "q2", "k1", "k2", "score", "ids"],
    )


def usable(embeddings: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, vector, k1, k2): rows that take part, once each."""
    rows = embeddings.select(
        F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vector")
    )
    fine = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & F.col("vector").isNotNull() & fine & F.exists("vector", lambda v: v != 0))
    # One zero for both signs, so that equal vectors have equal hashes.
    rows = rows.withColumn("vector", F.transform("vector", lambda v: v + F.lit(0.0)))
    return rows.withColumn("k1", F.xxhash64("vector")).withColumn("k2", F.xxhash64(F.lit(1), "vector"))


def nearest(
    embeddings: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", every: int = EVERY, top: int = TOP
) -> DataFrame:
    """(query_id, rank, id, score): the ``top`` nearest found of each row whose id is divisible by ``every``."""
    rows = usable(embeddings, id_column, vector_column)
    rows = materialise(rows)
    # The smallest ids of each vector: one more than the list, as a query leaves itself out.
    by_id = Window.partitionBy("k1", "k2").orderBy("id")
    few = rows.select("id", "k1", "k2").distinct().withColumn("r", F.row_number().over(by_id)).filter(F.col("r") <= top + 1)
    few = few.groupBy("k1", "k2").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    one = rows.groupBy("k1", "k2").agg(F.first("vector").alias("vector"))
    distinct = materialise(one.join(few, ["k1", "k2"]).select("k1", "k2", "vector", "ids"))
    asked = rows.filter(F.pmod(F.col("id"), F.lit(every)) == 0).select("id", "k1", "k2").distinct()
    queries = distinct.join(asked.select("k1", "k2").distinct(), ["k1", "k2"], "left_semi")

    # One row for each dimension: so many shards.
    shards = F.ceil(F.count(F.lit(1)) / SHARD_ROWS).cast("int").alias("parts")
    dimensions = materialise(distinct.groupBy(F.size("vector").alias("d")).agg(shards))
    parts = dimensions.agg(F.sum("parts")).collect()[0][0]
    if not parts:
        return embeddings.sparkSession.createDataFrame([], "query_id long, rank int, id long, score double")
    part = F.pmod("k1", F.col("parts")).cast("int")
    own = distinct.withColumn("d", F.size("vector")).join(dimensions, "d")
    index = own.select("d", part.alias("part"), F.lit(0).alias("kind"), "k1", "k2", "vector", "ids")
    every_part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    asking = queries.withColumn("d", F.size("vector")).join(dimensions, "d").select(
        "d", every_part.alias("part"), F.lit(1).alias("kind"), "k1", "k2", "vector", F.array().cast("array<long>").alias("ids")
    )
    dealt = index.unionByName(asking).repartition(parts, "d", "part").sortWithinPartitions("d", "part", "kind")
    found = dealt.mapInArrow(_search(top + 1), FOUND)

    # The best top + 1 vectors hold the best top + 1 rows.
    best = Window.partitionBy("q1", "q2").orderBy(F.desc("score"), F.element_at("ids", 1))
    found = found.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= top + 1)
    found = found.select("q1", "q2", "score", F.explode("ids").alias("id"))
    place = Window.partitionBy("q1", "q2").orderBy(F.desc("score"), "id")
    found = found.withColumn("r", F.row_number().over(place)).filter(F.col("r") <= top + 1)
    lists = found.groupBy("q1", "q2").agg(F.array_sort(F.collect_list(F.struct("r", "id", "score"))).alias("near"))
    pairs = asked.join(lists, (F.col("k1") == F.col("q1")) & (F.col("k2") == F.col("q2")))
    others = F.slice(F.filter("near", lambda n: n["id"] != F.col("_q")), 1, top)
    pairs = pairs.select(F.col("id").alias("_q"), "near").select("_q", F.posexplode(others).alias("p", "n"))
    return pairs.select(
        F.col("_q").alias("query_id"), (F.col("p") + 1).cast("int").alias("rank"), F.col("n.id").alias("id"), "n.score"
    )
