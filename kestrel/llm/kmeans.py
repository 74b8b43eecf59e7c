"""Exact centroid clustering with heap-ordered bounds.

A scanned vector has an upper bound (distance to its own centroid) and a lower bound (to the next one).  Centroids
that move eat into the gap between both, by at most their own drift and the largest drift of another centroid.
Each cluster accumulates that drift as an offset, and each vector's key is its gap plus the offset at the time of its scan:
as long as the key is above the cluster's offset, no centroid can have overtaken its own.

A cluster's heap is kept on disk as sorted runs, one a round: tables sorted by (cluster, key), smallest key first.  A round

 1. pops the keys that the offset has reached, which is a range of (cluster, key) in every run (a pushed filter, so that
    row groups above it aren't read),
 2. rescans the popped vectors exactly against all centroids and writes them as a new run with their new keys,
 3. sends the change of sums and counts of the vectors that moved, combined per task, and takes exact floor means.

Rows that stay in a heap are neither read nor written again, and a run is never changed: what was popped in an earlier
round lies below that round's offset.  Nothing is shuffled but partial sums; centroids, offsets and sums (at most k x dim
numbers) are all that the driver holds.  Distances are integers and exact; bounds are doubles with a safety margin, which costs
rescans of near-ties and never a wrong cluster.

Defined results: a vector that is null, of another length, or holds null or non-finite components is left out, and so is one
with a component beyond +-2**27 after scaling (its squared distance would not fit 64 bits).  Ties go to the smaller centroid.
Rows that repeat an id are vectors of their own.  A null id is clustered but starts no centroid.  With fewer than k vectors each
starts a centroid.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from kestrel.llm.common import store, table

LIMIT = 1 << 27
#: Below this size of components all terms of a squared distance are exact in doubles (64 dimensions).
EXACT = 1 << 22
ROWS = 4096
MARGIN = 1e-9


def whole_vectors(rows: DataFrame, id_col: str, vec_col: str, dim: int, scale: int) -> DataFrame:
    """(id, q) of the vectors kept: q holds floor(scale * x) as 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column(1)
            full = np.flatnonzero(np.fromiter((x.is_valid and len(x.values) == dim and not x.values.null_count for x in col), bool, len(col)))
            for i in range(0, len(full), ROWS):
                at = full[i : i + ROWS]
                part = col.take(pa.array(at))
                v = np.floor(scale * part.flatten().to_numpy(zero_copy_only=False).reshape(len(at), dim))
                fit = (np.abs(np.where(np.isfinite(v), v, np.inf)) <= LIMIT).all(1)
                q = v[fit].astype("<i4")
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at[fit])), pa.array([r.tobytes() for r in q], pa.binary())], names=["id", "q"])

    return rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).mapInArrow(run, "id long, q binary")


def squared(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to integer centroids, as int64."""
    if max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0)) <= EXACT // max(1, x.shape[1] // 64):
        a, c = x.astype(np.float64), centroids.astype(np.float64)
        return (np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", c, c) - 2 * (a @ c.T)).astype(np.int64)
    return np.stack([((x - c) ** 2).sum(1) for c in centroids.astype(np.int64)], 1)


def _ints(col: pa.Array) -> np.ndarray:
    raw = col.to_pylist()
    return np.frombuffer(b"".join(raw), "<i4").reshape(len(raw), -1).astype(np.int64)


def scanned(rows: DataFrame, centroids: np.ndarray, offset: np.ndarray) -> DataFrame:
    """(id, q, previous, cluster, key) of ``rows`` (id, q, previous): exact nearest centroid and heap key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                d = squared(_ints(part.column(1)), centroids)
                best = d.argmin(1)
                upper = np.sqrt(d[np.arange(len(d)), best].astype(np.float64))
                if d.shape[1] > 1:
                    d[np.arange(len(d)), best] = np.iinfo(np.int64).max
                    lower = np.sqrt(d.min(1).astype(np.float64))
                else:
                    lower = np.full(len(d), np.inf)
                key = lower - upper - MARGIN * np.where(np.isfinite(lower), lower + upper, 0) + offset[best]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(best.astype(np.int32)), pa.array(key)], names=["id", "q", "previous", "cluster", "key"])

    return rows.select("id", "q", "previous").mapInArrow(run, "id long, q binary, previous int, cluster int, key double")


def moved_sums(run_table: DataFrame, k: int, dim: int) -> np.ndarray:
    """Change of (count, sums) of every cluster by the vectors of a run that changed theirs: k x (1 + dim) integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dim + 1), np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                q = _ints(part.column(0))
                q = np.concatenate([np.ones((len(q), 1), np.int64), q], 1)
                was, now = part.column(1).to_numpy(), part.column(2).to_numpy()
                np.add.at(total, now, q)
                np.subtract.at(total, was[was >= 0], q[was >= 0])
        c, i = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int32)), pa.array(i.astype(np.int32)), pa.array(total[c, i])], names=["c", "i", "s"])

    changed = run_table.where("cluster <> previous").select("q", "previous", "cluster")
    out = np.zeros((k, dim + 1), dtype=object)
    for r in changed.mapInArrow(run, "c int, i int, s long").groupBy("c", "i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():  # at most k x (1 + dim) rows
        out[r["c"], r["i"]] = int(r["s"])
    return out


def between(low: np.ndarray | None, high: np.ndarray | None) -> Column:
    """Rows of a run whose key lies above ``low`` and up to ``high`` of their cluster, as ranges that a scan can use."""
    lows = [""] * len(high) if low is None else [f" AND key > {float(x)!r}D" for x in low]
    highs = [""] * len(lows) if high is None else [f" AND key <= {float(x)!r}D" for x in high]
    return F.expr(" OR ".join(f"(cluster = {c}{a}{b})" for c, (a, b) in enumerate(zip(lows, highs, strict=True))))


def start_centroids(kept: DataFrame, k: int, prefix: str) -> np.ndarray:
    """The k vectors of smallest SHA-256 of prefix and id (a bounded top-k), in that order."""
    named = kept.where("id IS NOT NULL").withColumn("h", F.sha2(F.concat(F.lit(prefix), F.col("id").cast("string")), 256))
    rows = named.orderBy("h", "q").limit(k).collect()
    return np.array([np.frombuffer(r["q"], "<i4") for r in rows], np.int64) if rows else np.empty((0, 0), np.int64)


def cluster_vectors(rows: DataFrame, id_col: str, vec_col: str, k: int, rounds: int, dim: int, scale: int = 256, prefix: str = "2:") -> tuple[DataFrame, np.ndarray]:
    """((id, cluster, distance) of every vector kept, centroids): ``rounds`` of assignment and floor means, and a last assignment."""
    kept = store(whole_vectors(rows, id_col, vec_col, dim, scale), "vectors")
    centroids = start_centroids(kept, k, prefix)
    k = len(centroids)
    if not k:
        return kept.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).where("false"), centroids
    offset = np.zeros(k)
    runs = [store(scanned(kept.withColumn("previous", F.lit(-1)), centroids, offset).sortWithinPartitions("cluster", "key"), "run")]
    sums, low = np.zeros((k, dim + 1), dtype=object), None
    for _ in range(rounds):
        sums = sums + moved_sums(runs[-1], k, dim)
        new = np.array([[int(s) // int(row[0]) for s in row[1:]] if row[0] else list(c) for row, c in zip(sums, centroids, strict=True)], np.int64)
        drift = np.sqrt(((new - centroids) ** 2).sum(1).astype(np.float64))
        others = np.array([np.delete(drift, c).max(initial=0.0) for c in range(k)])
        offset, centroids = offset + drift + others, new
        high = offset * (1 + MARGIN) + MARGIN
        # the newest run has not been popped from yet; older ones hold no keys up to the last offset any more
        popped = [r.where(between(None if r is runs[-1] else low, high)) for r in runs]
        popped = reduce(DataFrame.union, [p.select("id", "q", F.col("cluster").alias("previous")) for p in popped])
        runs.append(store(scanned(popped, centroids, offset).sortWithinPartitions("cluster", "key"), "run"))
        low = high
    live = reduce(DataFrame.union, [(r if r is runs[-1] else r.where(between(low, None))).select("id", "q", "cluster") for r in runs])

    def distance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                d = ((_ints(part.column(1)) - centroids[part.column(2).to_numpy()]) ** 2).sum(1)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(d)], names=["id", "cluster", "distance"])

    return live.mapInArrow(distance, "id long, cluster int, distance long"), centroids


# ---------------------------------------------------------------- registered query

K, ROUNDS, DIM = 40, 5, 64


def op13_centroid_clusters(spark, sf_dir):
    rows, centroids = cluster_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", k=K, rounds=ROUNDS, dim=DIM)
    rows = store(rows, "clusters")
    # one row a centroid: bounded by k
    per = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).cast("long").alias("cluster_inertia")).collect()
    inertia = sum(r["cluster_inertia"] for r in per)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = spark.createDataFrame([(r["cluster"], r["cluster_inertia"], inertia, digest[r["cluster"]]) for r in per],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(facts), "cluster").select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _assigned(n: int) -> str:
    return f"""a{n} AS MATERIALIZED (
  SELECT vec_id, (m).c AS c, (m).d AS d FROM (
    SELECT vec_id, min({{'d': d, 'c': c}}) AS m FROM (
      SELECT p.vec_id, k.c, sum((p.x - k.x) * (p.x - k.x))::BIGINT AS d FROM p JOIN c{n} k USING (i) GROUP BY ALL) GROUP BY vec_id))"""


def _moved(n: int) -> str:
    return f"""c{n + 1} AS MATERIALIZED (
  SELECT k.c, k.i, coalesce(m.x, k.x) AS x FROM c{n} k LEFT JOIN (
    SELECT c, i, ((s - ((s % n) + n) % n) // n)::BIGINT AS x FROM (
      SELECT a.c, p.i, sum(p.x) AS s, count(*) AS n FROM p JOIN a{n} a USING (vec_id) GROUP BY ALL)) m ON k.c = m.c AND k.i = m.i)"""


OP13_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIM}),
p AS MATERIALIZED (SELECT vec_id, unnest(q) AS x, generate_subscripts(q, 1) AS i FROM v),
s AS (SELECT q, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c FROM v QUALIFY c < {K}),
c0 AS MATERIALIZED (SELECT c, unnest(q) AS x, generate_subscripts(q, 1) AS i FROM s),
{", ".join(f"{_assigned(n)},{chr(10)}{_moved(n)}" for n in range(ROUNDS))},
{_assigned(ROUNDS)},
h AS (SELECT c, sha256(string_agg(x, ',' ORDER BY i)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY c),
t AS (SELECT c, sum(d)::BIGINT AS cluster_inertia FROM a{ROUNDS} GROUP BY c)
SELECT vec_id, a.c::INTEGER AS cluster, d AS distance, cluster_inertia, (SELECT sum(d)::BIGINT FROM a{ROUNDS}) AS inertia, centroid_sha256
FROM a{ROUNDS} a JOIN h ON a.c = h.c JOIN t ON a.c = t.c
"""
