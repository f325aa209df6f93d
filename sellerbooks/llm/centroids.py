"""Centroid clustering of integer vectors with JVM expressions only.

Every kept vector becomes an array of whole numbers and is written once. ``zip_with`` and
``aggregate`` give its squared distances to the centroids, which stand in the plan as literal
arrays; ``array_min`` over (distance, number) structs chooses the cluster, the smaller number
on a tie. An update is one aggregation: a count and one sum per component, combined on the
map side, so a cluster that holds most rows moves ``clusters`` rows a task. The driver sees
one row a cluster and round. All arithmetic is on whole numbers, so reruns agree bit for bit.

Defined cases: a vector that is NULL, has another number of components, or holds a NULL,
NaN or infinite one takes no part and has no row in the result; equal rows are vectors of
their own, and may become equal centroids; equal hashes of ids are ordered by id and then by
components, a NULL id last; fewer vectors than centroids make each vector a centroid; an
empty table gives an empty result; only the id and the vector are read, so other columns of
any name cannot clash. There are no texts here. A component whose scaled value is not within
2 ** 27 either side of zero stops the job with a message: squared distances would pass 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sellerbooks.session import materialise

DIMENSION, SCALE, CLUSTERS, ROUNDS, SEED = 64, 1024, 8, 10, 3
LARGEST = 1 << 27


def whole_vectors(vectors: DataFrame, name: str, vector: str, dimension: int, scale: int) -> DataFrame:
    """(id, q): the vectors that take part, their components scaled and rounded down."""
    parts = F.col(f"`{vector}`").cast("array<double>")
    # abs(x) < infinity is false for NaN as well, since NaN is the largest double.
    finite = F.forall(parts, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    fits = F.forall(parts, lambda x: F.abs(x * scale) < F.lit(float(LARGEST)))
    kept = vectors.filter((F.size(parts) == dimension) & finite)
    wide = F.raise_error(F.lit(f"a vector component times {scale} is not within {LARGEST} either side of zero"))
    whole = F.when(fits, F.transform(parts, lambda x: F.floor(x * scale).cast("bigint"))).otherwise(
        wide.cast("array<bigint>")
    )
    return kept.select(F.col(f"`{name}`").alias("id"), whole.alias("q"))


def first_centroids(whole: DataFrame, clusters: int, seed: int) -> list[list[int]]:
    """The vectors whose ids hash smallest; a top-k, so at most ``clusters`` rows a task travel."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = whole.orderBy(order.asc_nulls_last(), F.col("id").asc_nulls_last(), "q").limit(clusters).select("q").collect()
    return [list(r["q"]) for r in rows]


def literal_array(values: Sequence[int]) -> Column:
    """A literal array; one text that folds to it plans far faster than an expression per number."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def squared_distance(q: Column, centroid: Sequence[int]) -> Column:
    squares = F.zip_with(q, literal_array(centroid), lambda x, c: (x - c) * (x - c))
    return F.aggregate(squares, F.lit(0).cast("bigint"), lambda total, square: total + square)


def nearest(q: Column, centroids: Sequence[Sequence[int]]) -> Column:
    """struct(distance, cluster) of the nearest centroid, the smaller number on a tie."""
    found = [
        F.struct(squared_distance(q, c).alias("distance"), F.lit(number).alias("cluster"))
        for number, c in enumerate(centroids)
    ]
    return F.array_min(F.array(*found))


def updated(whole: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round: componentwise floor of the mean, empty clusters as they were."""
    dimension = len(centroids[0])
    sums = [F.sum(F.get("q", F.lit(i))).alias(f"s{i}") for i in range(dimension)]
    near = whole.select("q", nearest(F.col("q"), centroids)["cluster"].alias("cluster"))
    moved = list(centroids)
    for row in near.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect():
        moved[row["cluster"]] = [row[f"s{i}"] // row["n"] for i in range(dimension)]
    return moved


def cluster(
    vectors: DataFrame,
    name: str = "vec_id",
    vector: str = "embedding",
    dimension: int = DIMENSION,
    scale: int = SCALE,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: int = SEED,
) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid): one row per vector that takes part."""
    whole = materialise(whole_vectors(vectors, name, vector, dimension, scale))
    centroids = first_centroids(whole, clusters, seed)
    if not centroids:
        kinds = {"cluster": "int", "distance": "bigint", "cluster_inertia": "bigint", "inertia": "bigint"}
        nothing = [F.lit(None).cast(kind).alias(c) for c, kind in kinds.items()]
        return whole.select("id", *nothing, F.col("q").alias("centroid"))
    for _ in range(rounds):
        moved = updated(whole, centroids)
        if moved == centroids:  # the same assignment would follow in every later round
            break
        centroids = moved
    placed = whole.select("id", nearest(F.col("q"), centroids).alias("near"))
    rows = placed.groupBy("near.cluster").agg(F.sum("near.distance").alias("total")).collect()
    totals = {r["cluster"]: r["total"] for r in rows}
    each = literal_array([totals.get(i, 0) for i in range(len(centroids))])
    final = F.array(*[literal_array(c) for c in centroids])
    return placed.select(
        "id",
        F.col("near.cluster").cast("int").alias("cluster"),
        F.col("near.distance").alias("distance"),
        F.get(each, F.col("near.cluster")).alias("cluster_inertia"),
        F.lit(sum(totals.values())).cast("bigint").alias("inertia"),
        F.get(final, F.col("near.cluster")).alias("centroid"),
    )


def centroid_digest(centroid: Column) -> Column:
    return F.sha2(F.concat_ws(",", centroid.cast("array<string>")), 256)


def brute_force(rows: Sequence[tuple], clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> list[tuple]:
    """(id, cluster, distance, cluster_inertia, inertia, centroid) in plain Python, for the tests."""
    rows = [(i, [int(x * SCALE // 1) for x in v]) for i, v in rows]
    rank = sorted(rows, key=lambda r: (hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[0], r[1]))
    centroids = [v for _, v in rank[:clusters]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        groups: dict[int, list] = {}
        for _, v in rows:
            groups.setdefault(near(v)[1], []).append(v)
        centroids = [[sum(c) // len(groups[k]) for c in zip(*groups[k])] if k in groups else old for k, old in enumerate(centroids)]
    placed = [(i, *near(v)) for i, v in rows]
    total = sum(d for _, d, _ in placed)
    return [(i, k, d, sum(e for _, e, j in placed if j == k), total, centroids[k]) for i, d, k in placed]


def _round_sql(number: int) -> str:
    """One round of the check: assignment to the centroids of round ``number``, then the next ones."""
    return f"""
a{number} AS MATERIALIZED (
  SELECT row_id, min({{'d': d, 'k': k}}) AS near FROM (
    SELECT w.row_id, c.k, list_sum(list_transform(range(1, {DIMENSION + 1}),
      lambda i: (w.q[i] - c.q[i]) * (w.q[i] - c.q[i]))) AS d FROM w CROSS JOIN c{number} c) GROUP BY row_id),
s{number} AS (
  SELECT near.k AS k, i, sum(q[i])::BIGINT AS s, count(*) AS n
  FROM a{number} JOIN w USING (row_id), range(1, {DIMENSION + 1}) r(i) GROUP BY 1, 2),
c{number + 1} AS MATERIALIZED (
  SELECT c.k, coalesce(m.q, c.q) AS q FROM c{number} c LEFT JOIN (
    SELECT k, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS q FROM s{number} GROUP BY k) m USING (k))"""


CHECK_SQL = f"""
WITH w AS MATERIALIZED (
  SELECT row_number() OVER () AS row_id, vec_id,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS q
  FROM embeddings WHERE len(embedding) = {DIMENSION}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = {DIMENSION}),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h NULLS LAST, vec_id NULLS LAST, q) - 1 AS k, q
  FROM (SELECT *, sha256('{SEED}:' || vec_id::VARCHAR) AS h FROM w ORDER BY h NULLS LAST, vec_id NULLS LAST, q LIMIT {CLUSTERS})),
{",".join(_round_sql(r) for r in range(ROUNDS))},
f AS (
  SELECT row_id, min({{'d': d, 'k': k}}) AS near FROM (
    SELECT w.row_id, c.k, list_sum(list_transform(range(1, {DIMENSION + 1}),
      lambda i: (w.q[i] - c.q[i]) * (w.q[i] - c.q[i]))) AS d FROM w CROSS JOIN c{ROUNDS} c) GROUP BY row_id)
SELECT w.vec_id, f.near.k::INTEGER AS cluster, f.near.d::BIGINT AS distance,
  (sum(f.near.d) OVER (PARTITION BY f.near.k))::BIGINT AS cluster_inertia,
  (sum(f.near.d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM f JOIN w USING (row_id) JOIN c{ROUNDS} c ON c.k = f.near.k
"""
