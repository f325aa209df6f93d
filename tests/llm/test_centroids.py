"""Centroid clustering against plain Python, and the defined edge cases."""

import random

import pytest
from pyspark.sql import functions as F

from sellerbooks.llm import centroids

COLUMNS = ("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
VECTORS = "vec_id long, embedding array<double>, id int, q string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], VECTORS)


def found(df, **options):
    return sorted((tuple(r[c] for c in COLUMNS) for r in centroids.cluster(df, **options).collect()), key=repr)


def test_equals_plain_python_with_repeats_and_bad_rows(spark):
    rng = random.Random(8)
    middles = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(5)]
    good = [(i, [m + rng.gauss(0, 0.3) for m in rng.choice(middles)]) for i in range(300)]
    # A third of all rows is one vector, under ids of its own and repeated ones.
    good += [(1000 + i // 2, middles[0]) for i in range(150)]
    bad = [(2000, None), (2001, [0.5] * 63), (2002, [0.5] * 63 + [None]), (2003, [float("nan")] * 64), (2004, [float("-inf")] + [0.0] * 63)]
    expected = sorted(centroids.brute_force(good), key=repr)
    assert found(vectors(spark, good + bad)) == expected


def test_few_and_equal_vectors(spark):
    few = [(3, [0.25] * 64), (3, [0.25] * 64), (4, [-0.7] * 64)]
    assert found(vectors(spark, few)) == sorted(centroids.brute_force(few), key=repr)
    unnamed = found(vectors(spark, [(None, [0.5] * 64), (1, [0.5] * 64)]))
    assert [r[:3] for r in unnamed] == [(1, 0, 0), (None, 0, 0)]


def test_empty_clusters_stay_and_means_round_down(spark):
    rows = [(i, [-0.001 * i, 0.002 * i]) for i in range(40)] + [(99, [9.0, 9.0])] * 8
    expected = sorted(centroids.brute_force(rows), key=repr)
    assert found(vectors(spark, rows), dimension=2) == expected


def test_empty_table_and_numbers_too_large(spark):
    assert found(vectors(spark, [])) == []
    assert centroids.cluster(vectors(spark, [])).columns == list(COLUMNS)
    with pytest.raises(Exception, match="either side of zero"):
        found(vectors(spark, [(1, [1e300] * 64)]))


def test_digest(spark):
    row = spark.range(1).select(centroids.centroid_digest(F.array(F.lit(-3), F.lit(12))).alias("d")).first()
    import hashlib

    assert row["d"] == hashlib.sha256(b"-3,12").hexdigest()
