"""Heap-ordered clustering against the plain rounds, with awkward vectors."""

import hashlib
import math

import numpy as np
import pytest

from kestrel.llm import kmeans as K


def plain(vectors, k, rounds, scale=256):
    """{id: (cluster, distance)} and centroids by the contract's text, in Python integers."""
    kept = {i: [math.floor(scale * x) for x in v] for i, v in vectors}
    start = sorted(kept, key=lambda i: hashlib.sha256(f"2:{i}".encode()).hexdigest())[:k]
    cent = [kept[i] for i in start]

    def assign():
        return {i: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(cent)) for i, v in kept.items()}

    for _ in range(rounds):
        got = assign()
        for n in range(len(cent)):
            own = [kept[i] for i, (_, c) in got.items() if c == n]
            if own:
                cent[n] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    return {i: (c, d) for i, (d, c) in assign().items()}, cent


@pytest.mark.parametrize("shape", ["blobs", "ties", "large"])
def test_equal_to_plain_rounds(spark, shape):
    rng = np.random.default_rng(3)
    if shape == "blobs":
        v = rng.normal(size=(6, 8))[rng.integers(0, 6, 300)] + rng.normal(size=(300, 8)) * 0.2
    elif shape == "ties":
        v = rng.integers(0, 2, (300, 8)) / 256
    else:
        v = rng.normal(size=(300, 8)) * 2.0**17
    vectors = [(i, [float(x) for x in row]) for i, row in enumerate(v)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(5)
    got, cent = K.cluster_vectors(df, "vec_id", "embedding", k=7, rounds=5, dim=8)
    want, centroids = plain(vectors, 7, 5)
    assert {r.id: (r.cluster, r.distance) for r in got.collect()} == want
    assert cent.tolist() == centroids


def test_stable_vectors_are_not_read_again(spark):
    """Well separated clusters: after the first round next to no gap expires."""
    rng = np.random.default_rng(4)
    v = np.eye(8)[rng.integers(0, 4, 2000)] * 50 + rng.normal(size=(2000, 8)) * 0.01
    vectors = [(i, [float(x) for x in row]) for i, row in enumerate(v)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    runs, kept = [], K.scanned

    def counted(rows, centroids, offset):
        runs.append(rows.count())
        return kept(rows, centroids, offset)

    K.scanned = counted
    try:
        got, _ = K.cluster_vectors(df, "vec_id", "embedding", k=4, rounds=5, dim=8)
        assert got.count() == 2000
    finally:
        K.scanned = kept
    assert runs[0] == 2000 and runs[-1] < 200, runs


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 0.25]), (1, [0.5, 0.25]), (2, None), (3, [1.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 0.0]), (7, []), (8, [1e300, 0.0]), (None, [0.5, 0.5])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, cluster int, id int")
    got, cent = K.cluster_vectors(df, "vec_id", "embedding", k=40, rounds=5, dim=2)
    assert sorted((r.id or 0, r.cluster) for r in got.collect()) == [(0, 0), (1, 1), (1, 1)] and len(cent) == 2
    none, cent = K.cluster_vectors(df.where("false"), "vec_id", "embedding", k=40, rounds=5, dim=2)
    assert none.count() == 0 and len(cent) == 0


def test_query_on_empty_table(spark, tmp_path):
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert K.op13_centroid_clusters(spark, str(tmp_path)).count() == 0
