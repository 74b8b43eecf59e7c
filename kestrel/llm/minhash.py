"""Near-duplicate documents by MinHash with tensored banding.

Two small collections of ``side`` bands each are drawn, every band made of
``rows`` minhash values.  A table key is a *pair* (band i of the first collection,
band j of the second), so ``side * side`` keys come from ``2 * side * rows``
minhash values, about the square root of what separate keys would need.  A pair of
documents of similarity s meets in some key unless it misses a whole collection:
probability at most 2 * (1 - s**rows)**side, which is 2e-5 at s = 0.8 with the
defaults and falls quickly above.

Steps
 1. Every whole text becomes a set of word-shingle hashes, its size, a 128-bit
    digest of the set, and the minhash values (numpy over Arrow batches).
 2. Documents with equal sets form one class; the smallest doc_id stands for it.
 3. A band value that a single class holds cannot be part of a shared key, so only
    repeated band values are combined into keys (lossless).
 4. Keys are shuffled and streamed in sorted order: the first ``small`` classes of a bucket give all
    their pairs, the others one link each (to a like neighbour or the first), so links grow with the rows.  Links whose
    minhash values rule the similarity out (``SLACK`` standard deviations) are no candidates.
 5. Candidates, and all links of hot buckets (more than ``small`` classes) whether likely or not, connect classes into
    families, so two classes that share a key are a candidate or in one family.  The likeliest candidate of every
    class is confirmed on the full sets, which gives first components.  Pairs of different components inside a
    family are then compared in bounded blocks: first by minhash values alone, then, for the classes that have
    a likely partner in their block, on the full sets.  Only links that join components leave a block.
 6. Components of the confirmed links, by grouped minima.

Defined results: a null or blank text has an empty set, is linked with nothing and
kept.  Rows sharing a doc_id count as one document for links and each give a row.
A null doc_id is linked with nothing; its component is null and it is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from kestrel.llm.common import U64, components, mix, store, text_chunks, word_hashes, word_spans

#: Standard deviations below the wanted similarity at which an estimate rules a pair out.
SLACK = 4.5


def shingle_rows(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes (with repeats) of the rows of a chunk, and each row's bounds in them."""
    starts, ends, first = word_spans(data, offsets)
    h = word_hashes(data, starts, ends, lower=True)
    count = np.diff(first)
    n = np.where(count >= words, count - words + 1, np.minimum(count, 1))
    bounds = np.concatenate([[0], np.cumsum(n)])
    at = np.repeat(first[:-1] - bounds[:-1], n) + np.arange(bounds[-1])
    length = np.repeat(np.minimum(count, words), n)
    total = np.zeros(bounds[-1], np.uint64)
    for j in range(words):
        inside = length > j
        total[inside] = total[inside] * U64(0x9FB21C651E98DF25) + h[at[inside] + j]
    return mix(total + length.astype(np.uint64)), bounds


def minhashes(x: np.ndarray, bounds: np.ndarray, k: int) -> np.ndarray:
    """The k minhash values (uint32) of each non-empty row."""
    rng = np.random.default_rng(977)
    a = rng.integers(1, 1 << 63, k, dtype=np.uint64) * U64(2) + U64(1)
    b = rng.integers(0, 1 << 63, k, dtype=np.uint64)
    rows = np.flatnonzero(np.diff(bounds))
    out = np.empty((len(rows), k), np.uint32)
    if len(rows):
        at = bounds[rows]
        for i in range(k):
            out[:, i] = np.minimum.reduceat((x * a[i] + b[i]) >> U64(32), at)
    return out


def distinct_rows(x: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    return [np.unique(x[i:j]) for i, j in zip(bounds[:-1], bounds[1:], strict=True)]


def signatures(docs: DataFrame, words: int, k: int) -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, sketch) of every row; set_a, set_b and sketch are null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch.column(1)):
                x, bounds = shingle_rows(data, offsets, words)
                sets = distinct_rows(x, bounds)
                full = np.diff(bounds) > 0
                sketch = minhashes(x, bounds, k)
                it = iter(sketch)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0)[i:j],
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([int(mix(s).sum().astype(np.int64)) if len(s) else None for s in sets], pa.int64()),
                    pa.array([int(mix(s + U64(0x632BE59BD9B4E019)).sum().astype(np.int64)) if len(s) else None for s in sets], pa.int64()),
                    pa.array([next(it).tobytes() if ok else None for ok in full], pa.binary()),
                ], names=["doc_id", "n_shingles", "set_a", "set_b", "sketch"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, set_a long, set_b long, sketch binary")


def band_values(classes: DataFrame, rows: int, side: int) -> DataFrame:
    """(id, band, value) of the 2 * side bands of every class."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            s = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(batch.num_rows, 2 * side, rows)
            value = np.zeros(s.shape[:2], np.uint64)
            for r in range(rows):
                value = mix(value + s[:, :, r] + U64(1))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(batch.column(0).to_numpy(), 2 * side)),
                pa.array(np.tile(np.arange(2 * side, dtype=np.int32), batch.num_rows)),
                pa.array(value.astype(np.int64).ravel()),
            ], names=["id", "band", "value"])

    return classes.select("id", "sketch").mapInArrow(run, "id long, band int, value long")


def tensor_keys(classes: DataFrame, rows: int, side: int) -> DataFrame:
    """(key, near, id): all pairs of a repeated first-collection band and a repeated second-collection band.

    ``near`` is a further band value: sorting a bucket by it puts like classes side by side.
    """
    bands = band_values(classes, rows, side)
    repeated = (bands.groupBy("band", "value").agg(F.max("id").alias("hi"), F.min("id").alias("lo"))
                .where("hi <> lo").select("band", "value"))
    kept = bands.join(repeated, ["band", "value"], "left_semi")
    packed = kept.groupBy("id").agg(  # at most 2 * side values a class
        F.sort_array(F.collect_list(F.when(F.col("band") < side, F.struct("band", "value")))).alias("xs"),
        F.sort_array(F.collect_list(F.when(F.col("band") >= side, F.struct("band", "value")))).alias("ys"))
    one = packed.select("id", F.explode("xs").alias("x"), "xs", "ys")
    # the next band of the first collection that the class has (band numbers differ between buckets, not inside one)
    after = F.filter("xs", lambda z: z["band"] > F.col("x.band"))
    one = one.select("id", "x", F.coalesce(F.get(after, F.lit(0)), F.col("xs")[0]).alias("next"), "ys")
    return one.select("id", "x", F.xxhash64("next").alias("near"), F.explode("ys").alias("y")).select(F.xxhash64("x", "y").alias("key"), "near", "id")


def bucket_links(keys: DataFrame, small: int) -> DataFrame:
    """Links (a, b, hot), a < b, of every bucket; the rows of a key are streamed in (near, id) order.

    The first ``small`` classes of a bucket give all their pairs.  Of the others, each is linked with the one
    before it if both have the same near value, else with the bucket's first: one link a row.  These links, and
    those of the first ``small`` with the first, are hot: they connect all classes of a bucket too large for all its pairs.
    No more than ``small`` ids are held, whatever the bucket's size.
    """

    def run(batches):
        key, head, last, like = None, [], None, None
        for batch in batches:
            ks, nears, ids = (batch.column(c).to_numpy() for c in range(3))
            if not len(ks):
                continue
            cuts = np.concatenate([[0], np.flatnonzero(ks[1:] != ks[:-1]) + 1, [len(ks)]])
            a, b, hot = [], [], []
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                if ks[i] != key:
                    if j - i == 1 and j < len(ks):  # alone in its bucket
                        continue
                    key, head, last, like = ks[i], [], None, None
                for x in ids[i : min(j, i + small - len(head))].tolist():
                    a += head
                    b += [x] * len(head)
                    hot += [False] * len(head)
                    head.append(x)
                    last, like = x, nears[i]
                    i += 1
                if j > i:  # beyond the head
                    before, same = np.concatenate([[last], ids[i : j - 1]]), nears[i:j] == np.concatenate([[like], nears[i : j - 1]])
                    a += np.where(same, before, head[0]).tolist()
                    b += ids[i:j].tolist()
                    a += head[:1] * (len(head) - 1)
                    b += head[1:]
                    hot += [True] * (j - i + len(head) - 1)
                    last, like = ids[j - 1], nears[j - 1]
            a, b = np.array(a, np.int64), np.array(b, np.int64)
            rows = np.stack([np.minimum(a, b), np.maximum(a, b), np.array(hot, np.int64)], 1)
            rows = np.unique(rows[a != b], axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(rows[:, 0].copy()), pa.array(rows[:, 1].copy()), pa.array(rows[:, 2] == 1)], names=["a", "b", "hot"])

    ordered = keys.repartition("key").sortWithinPartitions("key", "near", "id")
    return ordered.mapInArrow(run, "a long, b long, hot boolean").groupBy("a", "b").agg(F.max("hot").alias("hot"))


def estimated(links: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """(a, b, likeness) of the links that are hot or whose minhash values allow the wanted similarity."""
    left = classes.select(F.col("id").alias("a"), F.col("sketch").alias("sa"))
    right = classes.select(F.col("id").alias("b"), F.col("sketch").alias("sb"))
    both = links.join(left, "a").join(right, "b")

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            sa = np.frombuffer(b"".join(batch.column("sa").to_pylist()), np.uint32).reshape(n, -1)
            sb = np.frombuffer(b"".join(batch.column("sb").to_pylist()), np.uint32).reshape(n, -1)
            like = (sa == sb).mean(1)
            out = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(like)], names=["a", "b", "likeness"])
            yield out.filter(pa.array((like >= least) | np.asarray(batch.column("hot").to_pylist(), bool)))

    return both.select("a", "b", "hot", "sa", "sb").mapInArrow(run, "a long, b long, likeness double")


def nearest(candidates: DataFrame) -> DataFrame:
    """The likeliest link of every class: at most one a class, so as many rows as classes."""
    both = candidates.select("a", "b", "likeness").union(candidates.select(F.col("b").alias("a"), F.col("a").alias("b"), "likeness"))
    best = both.groupBy("a").agg(F.max(F.struct("likeness", (-F.col("b")).alias("b"))).alias("best"))
    return best.select(F.least("a", -F.col("best.b")).alias("a"), F.greatest("a", -F.col("best.b")).alias("b")).distinct()


def shingle_sets(docs: DataFrame, classes: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """(id, shingles) of the classes in ``ids``: the sorted distinct shingle hashes as bytes."""
    wanted = classes.select("id", "set_a").join(ids, "id", "left_semi")
    texts = docs.join(wanted, F.col("doc_id") == F.col("id"))

    def sets(batches):
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch.column(1)):
                got = distinct_rows(*shingle_rows(data, offsets, words))
                # rows may repeat a doc_id with other texts
                match = [bool(len(s)) and int(mix(s).sum().astype(np.int64)) == c for s, c in zip(got, batch.column(2)[i:j].to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i:j], pa.array([s.tobytes() for s in got], pa.binary())], names=["id", "shingles"]
                ).filter(pa.array(match, pa.bool_()))

    return texts.select("id", "text", "set_a").mapInArrow(sets, "id long, shingles binary").dropDuplicates(["id"])


def linked(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    """den * intersection >= num * union of two sorted sets."""
    if den * min(len(x), len(y)) < num * max(len(x), len(y)):
        return False
    at = np.searchsorted(y, x)
    both = int((y[np.minimum(at, len(y) - 1)] == x).sum())
    return den * both >= num * (len(x) + len(y) - both) and both > 0


def confirmed(links: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The links that hold on the full shingle sets."""
    pairs = (links.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("tb")), "b")
             .join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("ta")), "a").select("a", "b", "ta", "tb"))

    def check(batches):
        for batch in batches:
            ok = [linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), num, den)
                  for x, y in zip(batch.column("ta"), batch.column("tb"), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return pairs.mapInArrow(check, "a long, b long")


def family_links(members: DataFrame, sketches: DataFrame, sets: DataFrame, block: int, least: float, num: int, den: int) -> DataFrame:
    """Confirmed links that join different components inside a family.

    ``members`` (family, id, component): families are connected by candidate links, components by confirmed ones.
    Families of up to ``block`` classes share bounded groups; a larger one is dealt into blocks, with
    blocks of their own for its large components, and every pair of blocks that is not of one component is a
    group of at most about 2 * block classes.  A group is read twice.  First with minhash values alone: classes without a
    likely partner of another component leave it, so unlike texts over one template never carry their sets into the
    blocks.  Then it tests its likely pairs of different components on the sets, likeliest first, skips
    those joined meanwhile, and returns only links that join: fewer than its classes.
    """
    sizes = members.groupBy("family").agg(F.count("*").alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    rows = members.join(sizes.select("family", "n"), "family")
    few = rows.where(F.col("n") <= block)
    pools = max(1, few.count() // block)
    few = few.select(F.pmod(F.xxhash64("family"), F.lit(pools)).alias("g"), F.lit(False).alias("big"), F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("mine"),
                     "family", "id", "component")
    many = rows.where(F.col("n") > block)
    parts = many.groupBy("family", "component").agg(F.count("*").alias("m"))
    own = F.when(F.col("m") > block, F.col("component"))
    many = many.join(parts, ["family", "component"]).withColumn("own", own)
    many = many.withColumn("slot", F.when(F.col("own").isNotNull(), F.pmod(F.xxhash64("id"), F.ceil(F.col("m") / block)))
                           .otherwise(F.pmod(F.xxhash64("component"), F.ceil(F.col("n") / block))))
    blocks = many.select("family", "own", "slot").distinct()
    blocks = blocks.withColumn("mine", F.row_number().over(Window.partitionBy("family").orderBy("own", "slot")))  # one row a block
    other = blocks.select(F.col("family").alias("family2"), F.col("own").alias("own2"), F.col("mine").alias("other"))
    dealt = blocks.join(other, (F.col("family") == F.col("family2")) & ~F.coalesce(F.col("own") == F.col("own2"), F.lit(False)))
    dealt = dealt.select("family", F.col("own").alias("own3"), F.col("slot").alias("slot3"), "mine", "other").withColumnsRenamed({"family": "family3"})
    many = many.join(dealt, (F.col("family") == F.col("family3")) & F.col("own").eqNullSafe(F.col("own3")) & (F.col("slot") == F.col("slot3")))
    many = many.select(F.col("family").alias("g"), F.lit(True).alias("big"), F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine",
                       "family", "id", "component")
    dealt = few.union(many).join(sketches.select("id", "sketch"), "id")

    def likely(batch):
        """Row numbers and likeness of the pairs of different components that the minhash values allow."""
        sk = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint32).reshape(batch.num_rows, -1)
        ids, comp, fam, mine = (batch.column(c).to_numpy() for c in ("id", "component", "family", "mine"))
        i, j = batch.column("i")[0].as_py(), batch.column("j")[0].as_py()
        xs, ys, like = [], [], []
        for x in np.flatnonzero(mine == i):
            y = np.flatnonzero((fam == fam[x]) & (comp != comp[x]) & (mine == j) & ((i != j) | (ids > ids[x])))
            p = (sk[y] == sk[x]).mean(1)
            ok = p >= least
            xs.append(np.full(int(ok.sum()), x))
            ys.append(y[ok])
            like.append(p[ok])
        return (np.concatenate(z) if z else np.empty(0, np.int64) for z in (xs, ys, like))

    def partnered(batch):
        xs, ys, _ = likely(batch)
        return batch.take(pa.array(np.union1d(xs, ys).astype(np.int64)))

    group = ("g", "big", "i", "j")
    dealt = dealt.select(*group, "mine", "family", "id", "component", "sketch")
    dealt = store(dealt.groupBy(*group).applyInArrow(partnered, dealt.schema), "partners").join(sets, "id")

    def compare(batch):
        ids, comp = (batch.column(c).to_numpy() for c in ("id", "component"))
        full = [np.frombuffer(x, np.uint64) for x in batch.column("shingles").to_pylist()]
        xs, ys, like = likely(batch)
        root = {c: c for c in comp.tolist()}

        def find(c):
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        a, b = [], []
        for k in np.argsort(-like, kind="stable"):
            x, y = int(xs[k]), int(ys[k])
            cx, cy = find(int(comp[x])), find(int(comp[y]))
            if cx != cy and linked(full[x], full[y], num, den):
                root[max(cx, cy)] = min(cx, cy)
                a.append(min(int(ids[x]), int(ids[y])))
                b.append(max(int(ids[x]), int(ids[y])))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.groupBy(*group).applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 5, num: int = 80, den: int = 100, rows: int = 3, side: int = 16,
                    small: int = 8, block: int = 256) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, links): classes of documents with similarity >= num / den.

    ``docs`` needs doc_id and text; other columns are ignored.  ``words`` is the shingle length.
    """
    docs = docs.select("doc_id", "text")
    k, s = 2 * side * rows, num / den
    least = s - SLACK * (s * (1 - s) / k) ** 0.5
    sign = store(signatures(docs, words, k), "signatures")
    rep = (sign.where("set_a IS NOT NULL AND doc_id IS NOT NULL")
           .groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("id")))
    rep = store(rep, "classes")
    classes = store(
        sign.select(F.col("doc_id").alias("id"), "set_a", "set_b", "n_shingles", "sketch").join(rep, ["id", "set_a", "set_b", "n_shingles"], "left_semi")
        .dropDuplicates(["id"]), "sketches")
    found = bucket_links(tensor_keys(classes, rows, side), small)
    candidates = store(estimated(found, classes, least), "candidates")
    family = store(components(candidates, "families"), "families").select(F.col("node").alias("id"), F.col("component").alias("family"))
    sets = store(shingle_sets(docs, classes, family.select("id"), words), "shingles")
    links = store(confirmed(nearest(candidates.where(F.col("likeness") >= least)), sets, num, den), "links")
    comp = components(links, "components").select(F.col("node").alias("id"), "component")
    members = store(family.join(comp, "id", "left").select("family", "id", F.coalesce("component", "id").alias("component")), "members")
    links = links.union(store(family_links(members, classes, sets, block, least, num, den), "links"))
    comp = components(links, "components")
    label = rep.join(comp.withColumnsRenamed({"node": "id"}), "id", "left").select(
        "set_a", "set_b", "n_shingles", F.coalesce("component", "id").alias("component_id"))
    return (sign.join(label, ["set_a", "set_b", "n_shingles"], "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True))))


def deduplicate(docs: DataFrame, **options) -> DataFrame:
    """The documents of ``docs`` that stand for their class, with all columns of ``docs``.

    Of rows that repeat a kept doc_id and its text exactly one stays, and each other text under that doc_id
    stays once; rows with a null doc_id all stay.
    """
    marks = near_duplicates(docs, **options).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    known = docs.where("doc_id IS NOT NULL")
    return known.join(marks, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]).unionByName(docs.where("doc_id IS NULL"))


# ---------------------------------------------------------------- registered query

def op2_minhash_near_dedup(spark, sf_dir):
    from kestrel.llm.common import table

    return near_duplicates(table(spark, sf_dir, "documents"), words=4, num=80, den=100)


OP2_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) >= 4 THEN list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))
                                      WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
"""
