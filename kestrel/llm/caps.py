"""Near-duplicate embeddings by spherical-cap filters from structured random product codes.

A random rotation is followed by a product code: the coordinates are cut into ``parts`` blocks with ``code``
random unit codewords each, and every combination of codewords is one filter direction, code**parts
in all.  A vector belongs to every filter whose direction it exceeds a threshold on; these are list-decoded
block by block, pruning with the best that the later blocks can add, so the filters are never
enumerated.  The number of filters grows with the number of vectors and the threshold follows from
the wanted number of filters a vector, so buckets keep their expected size at any scale.

 1. Identical vectors form a class with a weight; the smallest vec_id stands for it.
 2. (filter, class) rows are shuffled without vectors; filters above ``block`` members are dealt into blocks, and
    every pair of blocks is a bounded group of its own.  Smaller filters share groups of about ``pool`` rows.
 3. Vectors join their rows, and a group computes all cosines of a filter in double precision.
    A pair that shares several filters counts in the smallest one only (by the filter lists that rows carry).
    A group returns, per linked class, the weight it is linked with and a member of its component: never pairs.
 4. Sums give the links, and grouped minima the components.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components, and rows
with a null vec_id, are linked with nothing and kept; their component is their vec_id.  Vectors of different
lengths are never linked.  Rows that repeat a vec_id are vectors of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from kestrel.llm.common import components, store, table


@lru_cache(maxsize=8)
def product_code(dim: int, parts: int, code: int, seed: int = 11) -> list[np.ndarray]:
    """Per block a (code, dim) matrix: rotation and codewords in one, scaled so that scores are about N(0, 1) in sum."""
    rng = np.random.default_rng([seed, dim])
    rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    out = []
    for cols in np.array_split(np.arange(dim), parts):
        words = rng.standard_normal((code, len(cols)))
        words /= np.linalg.norm(words, axis=1, keepdims=True)
        # a unit word of a block of m coordinates has variance 1/dim on a random unit vector's block
        out.append(words @ rotation[:, cols].T * np.sqrt(dim / parts))
    return out


def _exceeding(scores: list[np.ndarray], best: list[np.ndarray], rows: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, filter, score) of the filters that the given rows exceed their thresholds on."""
    row, low, filt, total = rows, least, np.zeros(len(rows), np.int64), np.zeros(len(rows))
    for k, s in enumerate(scores):
        rest = sum((b[row] for b in best[k + 1 :]), np.zeros(len(row)))
        at, word = np.nonzero(s[row] >= (low - total - rest)[:, None])
        row, low, filt, total = row[at], low[at], filt[at] * s.shape[1] + word, total[at] + s[row[at], word]
    return row, filt, total


def list_decode(unit: np.ndarray, books: list[np.ndarray], least: float, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, filter), by row, then filter, of all filters that the unit vectors exceed ``least`` on.

    How many there are depends on where a vector lies among the codewords, so for a vector with fewer than
    ``wanted`` the threshold falls to the score of its ``wanted``-th filter.
    """
    scores = [unit @ b.T for b in books]
    best = [s.max(1) for s in scores]
    wanted = min(wanted, int(np.prod([s.shape[1] for s in scores])))
    rows, filters = [], []
    todo, low = np.arange(len(unit)), least
    while len(todo):
        row, filt, total = _exceeding(scores, best, todo, np.full(len(todo), low))
        n = np.bincount(row, minlength=len(unit))
        done = n[row] >= wanted
        if low < least:  # cut what the lowered threshold let in beyond the wanted number
            order = np.lexsort([filt, -total, row])
            row, filt, total = row[order], filt[order], total[order]
            done = (n[row] >= wanted) & (np.arange(len(row)) - np.searchsorted(row, row) < wanted)
        rows.append(row[done])
        filters.append(filt[done])
        todo = todo[n[todo] < wanted]
        low -= 0.25
    row, filt = np.concatenate(rows), np.concatenate(filters)
    order = np.lexsort([filt, row])
    return row[order], filt[order]


def vectors(rows: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, type]:
    """(id, vec, dim), and the number type in vec: raw bytes of the components, null where the vector cannot be linked."""
    kind = rows.schema[vec_col].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    dtype = np.float32 if single else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, dims = [], []
            for x in batch.column(1):
                v = None
                if x.is_valid and x.values is not None and len(x.values) and not x.values.null_count:
                    v = x.values.to_numpy(zero_copy_only=False).astype(dtype)
                    d = v.astype(np.float64)
                    if not (np.isfinite(d).all() and d.any()):
                        v = None
                out.append(None if v is None else v.tobytes())
                dims.append(None if v is None else len(v))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary()), pa.array(dims, pa.int32())], names=["id", "vec", "dim"])

    cast = "array<float>" if single else "array<double>"
    return rows.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast(cast).alias("v")).mapInArrow(run, "id long, vec binary, dim int"), dtype


def _unit(raw: list[bytes], dtype) -> np.ndarray:
    v = np.frombuffer(b"".join(raw), dtype).reshape(len(raw), -1).astype(np.float64)
    v /= np.abs(v).max(1, keepdims=True)  # squares of very large or small components stay finite
    return v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]


def decode(classes: DataFrame, dtype, parts: int, code: int, least: float, wanted: int) -> DataFrame:
    """(id, filters) of every class: its filters, ascending (a filter belongs to one dimension)."""

    def run(batches):
        for batch in batches:
            ids, raw, dims = batch.column(0).to_numpy(), batch.column(1).to_pylist(), batch.column(2).to_numpy()
            for dim in np.unique(dims):
                mine = np.flatnonzero(dims == dim)
                for at in np.array_split(mine, max(1, len(mine) // 256)):
                    row, filt = list_decode(_unit([raw[i] for i in at], dtype), product_code(int(dim), min(parts, int(dim)), code), least, wanted)
                    cuts = np.searchsorted(row, np.arange(len(at) + 1)).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.ListArray.from_arrays(pa.array(cuts), pa.array(filt))], names=["id", "filters"])

    return classes.select("id", "vec", "dim").mapInArrow(run, "id long, filters array<long>")


def deal(rows: DataFrame, block: int, pool: int) -> DataFrame:
    """(g, hot, i, j, mine, dim, filter, id): the bounded groups of ``rows`` (dim, filter, id); lone members go."""
    skinny = store(rows, "filters")
    sizes = skinny.groupBy("dim", "filter").agg(F.count("*").alias("n")).where("n > 1")
    total = skinny.count()
    sized = skinny.join(sizes, ["dim", "filter"])
    few = sized.where(F.col("n") <= block).select(
        F.pmod(F.xxhash64("dim", "filter"), F.lit(max(1, total // pool))).alias("g"), F.lit(-1).cast("long").alias("hot"), F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("mine"), "dim", "filter", "id")
    many = sized.where(F.col("n") > block).withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    many = many.withColumn("mine", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    many = many.select("dim", "filter", "id", "mine", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    many = many.select(F.col("dim").cast("long").alias("g"), F.col("filter").alias("hot"), F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "dim", "filter", "id")
    return few.union(many)


def group_links(dealt: DataFrame, full: DataFrame, dtype, cosine: float) -> DataFrame:
    """(id, links, other): per group and linked class the weight it is linked with, and a class of its component.

    ``full`` has (id, weight, vec, filters) of every class.
    """
    wide = dealt.join(full, "id")

    def compare(batch):
        order = np.lexsort([batch.column(c).to_numpy() for c in ("id", "filter", "dim")])
        batch = batch.take(pa.array(order))
        ids, weight, mine, filt, dim = (batch.column(c).to_numpy() for c in ("id", "weight", "mine", "filter", "dim"))
        i, j = batch.column("i")[0].as_py(), batch.column("j")[0].as_py()
        raw, lists = batch.column("vec").to_pylist(), batch.column("filters").to_pylist()
        cuts = np.concatenate([[0], np.flatnonzero((filt[1:] != filt[:-1]) | (dim[1:] != dim[:-1])) + 1, [len(filt)]])
        out_id, out_links, out_other = [], [], []
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b - a < 2:
                continue
            v = _unit(raw[a:b], dtype)
            near = v @ v.T >= cosine
            np.fill_diagonal(near, False)
            if i != j:  # pairs inside a block belong to that block's own group
                near &= mine[a:b, None] != mine[None, a:b]
            at = np.flatnonzero(near.any(1))
            if not len(at):
                continue
            near = near[np.ix_(at, at)]
            # the pair counts here only if it shares no smaller filter
            earlier = [[f for f in lists[a + k] if f < filt[a]] for k in at]
            known = {f: n for n, f in enumerate(sorted({f for e in earlier for f in e}))}
            if known:
                has = np.zeros((len(at), len(known)), np.float32)
                for n, e in enumerate(earlier):
                    has[n, [known[f] for f in e]] = 1
                near &= has @ has.T == 0
            near_ids = ids[a:b][at]
            links = near @ weight[a:b][at]
            label = near_ids.copy()
            while True:
                low = np.minimum(label, np.where(near, label[None, :], np.iinfo(np.int64).max).min(1))
                if (low == label).all():
                    break
                label = low
            some = links > 0
            out_id.append(near_ids[some])
            out_links.append(links[some])
            out_other.append(label[some])
        cat = lambda x: pa.array(np.concatenate(x) if x else np.empty(0, np.int64), pa.int64())
        return pa.table({"id": cat(out_id), "links": cat(out_links), "other": cat(out_other)})

    return wide.groupBy("g", "hot", "i", "j").applyInArrow(compare, "id long, links long, other long")


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", cosine: float = 0.9, filters: int = 40,
                 parts: int = 3, block: int = 512, pool: int = 4096) -> DataFrame:
    """(id, n_links, component_id, kept) of every row.

    ``filters`` is the expected and the smallest number of filters a vector belongs to.  Of 40, a pair at a cosine of
    0.9 is expected to share 20 among 10**4 vectors, 14 among 10**6 and 8 among 10**9 (independent Gaussian directions).
    """
    every, dtype = vectors(rows, id_col, vec_col)
    every = store(every, "vectors")
    classes = (every.where("vec IS NOT NULL AND id IS NOT NULL").groupBy("vec", "dim")
               .agg(F.min("id").alias("id"), F.count("*").alias("weight")))
    # a vec_id with several vectors: classes are told apart by a number of their own
    classes = classes.withColumn("nth", F.row_number().over(Window.partitionBy("id").orderBy("vec")))
    classes = store(classes.select(F.col("id").alias("vec_id"), F.when(F.col("nth") == 1, F.col("id")).otherwise(F.xxhash64("vec", "dim")).alias("id"), "vec", "dim", "weight"), "classes")
    n = classes.count()
    code = max(2, int(np.ceil(max(n, 1) ** (1 / parts) - 1e-9)))
    least = NormalDist().inv_cdf(1 - min(0.5, filters / code**parts))
    lists = store(decode(classes, dtype, parts, code, least, filters), "decoded")
    full = classes.select("id", "weight", "vec").join(lists, "id")
    skinny = classes.select("id", "dim").join(lists, "id").select("dim", F.explode("filters").alias("filter"), "id")
    found = store(group_links(deal(skinny, block, pool), full, dtype, cosine), "cap-links")
    comp = components(found.select(F.col("id").alias("a"), F.col("other").alias("b")), "components")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    label = classes.select("id", "vec_id", "vec", "dim", "weight").join(links, "id", "left").join(comp.withColumnsRenamed({"node": "id"}), "id", "left")
    label = store(label.select("vec", "dim", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "vec_id", F.coalesce("component", "id").alias("component")), "labels")
    # stored, so that a component with a third of all vectors can be split in the join
    least_id = store(label.groupBy("component").agg(F.min("vec_id").alias("component_id")), "least-ids")
    label = label.join(least_id, "component").select("vec", "dim", "n_links", "component_id")
    label = label.withColumnsRenamed({"vec": "vec2", "dim": "dim2"})
    linkable = every.where("id IS NOT NULL").join(label, (F.col("vec") == F.col("vec2")) & (F.col("dim") == F.col("dim2")), "left")
    alone = every.where("id IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return (linkable.select("id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "id").alias("component_id")).union(alone)
            .withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))))


# ---------------------------------------------------------------- registered query

def op4_embedding_near_dedup(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings")).withColumnsRenamed({"id": "vec_id"})


OP4_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda z: z IS NULL OR NOT isfinite(z))) = 0 AND len(list_filter(embedding, lambda z: z <> 0)) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_dot_product(a.x, b.x) / (sqrt(list_dot_product(a.x, a.x)) * sqrt(list_dot_product(b.x, b.x))) >= 0.9),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c USING (vec_id) LEFT JOIN n USING (vec_id)
"""
