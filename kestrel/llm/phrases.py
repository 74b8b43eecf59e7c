"""Collocations by dynamic itemset counting over shards of the corpus.

The documents are dealt into shards, which are scanned one a step, in a cycle.  Words are counted from the first step.
A longer phrase is activated as soon as both its subphrases (without its last, without its first word) are known
to reach the threshold, so lengths interleave: while words are still being counted, pairs of words that
are frequent already are counted in the same scan.  Each phrase is counted in every shard exactly once, from the
step after its activation until the cycle closes; then its total is final.

 * Which phrases have reached the threshold, and at which step, is held in a table of fixed size, ``slots`` bytes indexed by
   phrase hash, which every scan gets (its size does not depend on the corpus).  Two phrases may share a slot: that activates a
   phrase early or needlessly, never late, and both start and end of its cycle follow from the same table,
   so every total covers each shard once whatever the collisions.
 * A scan hashes all phrases of whole Arrow batches, counts the active ones per task, and stores (length, start, key, count,
   a document that holds it).  After a step, keys whose partial counts above one alone make the threshold are known
   to reach it.  When the phrases of a start step have seen all shards, their partial counts are summed: these totals
   are final, and the tables that only they needed are dropped.
 * Each frequent phrase is then spelled once, by the first document that holds it.

Keys have 64 bits and carry the language, so with N different phrases in the corpus two share a key with a probability of
about N * N / 2**65.

Scores, cuts and containment are joins and grouped extremes over the frequent phrases; numbers that
may pass 64 bits are decimals.  The first ``top`` of a language are taken per block of its phrases, and then
of the blocks' firsts, so no task sees all phrases of a language.

Defined results: a null text has no words, a null lang is ``und``, repeated rows count each, doc_ids and further columns don't matter.
A corpus without frequent phrases gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from kestrel.llm.common import drop, mix, rolling, store, table, text_chunks, word_hashes

MAX_WORDS = 4
NEVER = 255
BUFFER = 4_000_000
GAP = re.compile(rb"[ \t]+")
WORD = r"[^\x20\x09.,;:!?\x0A-\x0D]+"

#: What a byte is: part of a word, a gap between words (1), the end of a piece (2).
_KIND = np.zeros(256, np.uint8)
_KIND[[9, 32]] = 1
_KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 2


def _salt(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def pieces(data: np.ndarray, offsets: np.ndarray, salts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row, piece, hash) of every word; words of one piece share a number, and hashes carry the row's salt."""
    kind = _KIND[data]
    letter = kind == 0
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = letter[:-1], letter[1:]
    starts = np.flatnonzero(letter & (~before | edge[:-1]))
    ends = np.flatnonzero(letter & (~after | edge[1:])) + 1
    row = np.searchsorted(offsets, starts, "right") - 1
    piece = np.cumsum(kind == 2, dtype=np.int64)[starts] + row
    return starts, ends, row, piece, mix(word_hashes(data, starts, ends, lower=True) ^ salts[row])


def phrase_keys(piece: np.ndarray, words: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per length: its number of words, start words of its phrases, their keys, and the keys of the next shorter phrases at every word."""
    shorter = np.empty(0, np.uint64)
    for n in range(1, MAX_WORDS + 1):
        keys = rolling(words, n)
        at = np.flatnonzero(piece[: len(keys)] == piece[n - 1 :]) if len(keys) else np.empty(0, np.int64)
        yield n, at, keys[at], shorter
        shorter = keys


def slot(keys: np.ndarray, slots: int) -> np.ndarray:
    return (keys & np.uint64(slots - 1)).astype(np.int64)


def starts_at(n: int, at: np.ndarray, shorter: np.ndarray, reached: np.ndarray) -> np.ndarray:
    """The step at which each phrase is activated (NEVER where a subphrase is not known to be frequent)."""
    if n == 1:
        return np.zeros(len(at), np.uint8)
    known = reached[slot(shorter, len(reached))]
    return np.maximum(known[at], known[at + 1])


def packed(sc, reached: np.ndarray):
    """The table for the workers (compressed: most of a sparse table is one value)."""
    return sc.broadcast(zlib.compress(reached.tobytes(), 1))


def unpacked(known) -> np.ndarray:
    return np.frombuffer(zlib.decompress(known.value), np.uint8)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(batch, first row, end row, bytes, pieces()) of the batches' texts (columns lang, text, and any others)."""
    salts: dict[str, int] = {}
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for x in set(langs):
            salts.setdefault(x, _salt(x))
        salt = np.array([salts[x] for x in langs], np.uint64)
        for i, j, data, offsets in text_chunks(batch.column(1)):
            if len(data):
                yield batch, i, j, data, pieces(data, offsets, salt[i:j])


def counted(shard: DataFrame, step: int, shards: int, reached) -> DataFrame:
    """(len, start, key, n, doc): partial counts of the phrases that are active in this step, and a document with each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_ = unpacked(reached)
        held: dict[int, list] = {}
        size = 0

        def flush():
            for n, parts in held.items():
                keys, first, counts = np.unique(np.concatenate([k for k, _, _ in parts]), return_index=True, return_counts=True)
                begun, doc = (np.concatenate([p[c] for p in parts])[first] for c in (1, 2))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), n, np.int8)), pa.array(begun.astype(np.int16)), pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64)), pa.array(doc)],
                                                 names=["len", "start", "key", "n", "doc"])
            held.clear()

        for batch, i, j, _, (_, _, row, piece, words) in _chunks(batches):
            docs = batch.column(2).to_numpy()[i:j]
            for n, at, keys, shorter in phrase_keys(piece, words):
                begun = starts_at(n, at, shorter, table_)
                on = (begun <= step) & (step < begun.astype(np.int64) + shards)
                if on.any():
                    held.setdefault(n, []).append((keys[on], begun[on], docs[row[at[on]]]))
                    size += int(on.sum())
            if size > BUFFER:
                yield from flush()
                size = 0
        yield from flush()

    return shard.select("lang", "text", "doc").mapInArrow(run, "len byte, start short, key long, n long, doc long")


def spelled(layout: DataFrame, frequent: DataFrame) -> DataFrame:
    """(lang, phrase, words, a) of the rows (key, a, doc) of ``frequent``: each document spells the phrases assigned to it."""
    own = frequent.groupBy("doc").agg(F.collect_list(F.struct("key", "a")).alias("own"))  # at most four a word of the document

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, i, j, data, (starts, ends, row, piece, words) in _chunks(batches):
            raw, langs = data.tobytes().lower(), batch.column(0).slice(i, j - i).to_pylist()
            lists = batch.column(2).slice(i, j - i)
            flat = lists.flatten()
            wanted, total = flat.field("key").to_numpy().view(np.uint64), flat.field("a").to_numpy()
            order = np.argsort(wanted, kind="stable")  # a phrase is assigned to one document only
            owner = np.repeat(np.arange(j - i), lists.value_lengths().to_numpy())[order]
            wanted, total = wanted[order], total[order]
            for n, at, keys, _ in phrase_keys(piece, words):
                keys, first = np.unique(keys, return_index=True)
                _, here, there = np.intersect1d(keys, wanted, assume_unique=True, return_indices=True)
                where = at[first[here]]
                names = [GAP.sub(b" ", raw[starts[w] : ends[w + n - 1]]).decode("utf-8", "replace") for w in where.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array([langs[r] for r in owner[there].tolist()], pa.string()), pa.array(names, pa.string()),
                                                  pa.array(np.full(len(here), n, np.int32)), pa.array(total[there])], names=["lang", "phrase", "words", "a"])

    return layout.join(own, "doc").select("lang", "text", "own").mapInArrow(run, "lang string, phrase string, words int, a long")


def bitmap(rows: DataFrame, slots: int, *by: str) -> list:
    """Rows (by, bucket, bits) of a bitmap over ``rows.slot``, built in Spark: at most slots / 8 bytes a group come back.

    Spark numbers the values of a bitmap from 1, so bucket b holds the slots (b - 1) * 32768 to b * 32768 - 1."""
    at = F.col("slot") + 1
    return rows.groupBy(*by, F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect()


def mark(frequent: DataFrame, reached: np.ndarray, step: int) -> int:
    """Enter the slots of ``frequent`` (len, key) at ``step``; returns how many new slots may activate longer phrases."""
    new = 0
    for r in bitmap(frequent.select((F.col("len") == MAX_WORDS).alias("last"), F.pmod("key", F.lit(len(reached))).alias("slot")), len(reached), "last"):
        on = np.flatnonzero(np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little")) + (r["bucket"] - 1) * 32768
        fresh = on[reached[on] == NEVER]
        reached[fresh] = step
        new += 0 if r["last"] else len(fresh)
    return new


def frequent_keys(layout: DataFrame, shards: int, least: int, slots: int) -> list[DataFrame]:
    """The counting itself: stored tables (key, a, doc) of the phrases that reach the threshold, each in one of them."""
    sc = layout.sparkSession.sparkContext
    reached = np.full(slots, NEVER, np.uint8)
    parts: list[DataFrame | None] = []
    tables: list[DataFrame] = []
    step, last = 0, 0
    while step < last + shards:
        known = packed(sc, reached)
        parts.append(store(counted(layout.where(F.col("shard") == step % shards), step, shards, known), f"step{step}"))
        known.destroy()  # the step's table is written
        found = parts[step].where("n > 1").groupBy("len", "key").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("len", "key")
        if (begun := step - shards + 1) >= 0:  # these phrases have now seen every shard
            closed = reduce(DataFrame.union, [p.where(F.col("start") == begun).select("len", "key", "n", "doc") for p in parts[begun:]])
            closed = closed.groupBy("len", "key").agg(F.sum("n").alias("a"), F.min("doc").alias("doc")).where(F.col("a") >= least)
            tables.append(store(closed, f"frequent{step}"))
            found = found.union(tables[-1].select("len", "key"))
        if mark(found, reached, step + 1):
            last = step + 1
        if begun >= 0:
            drop(parts[begun])
            parts[begun] = None
        step += 1
    for p in parts:
        if p is not None:
            drop(p)
    return tables


def frequent_phrases(docs: DataFrame, least: int, shards: int = 4, slots: int = 1 << 24) -> DataFrame:
    """(lang, phrase, words, a) of all phrases of 1 to MAX_WORDS words that occur ``least`` times in their language.

    Rows with phrase '' and 0 words hold the number of all words of the language.
    """
    text = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    text = text.withColumn("doc", F.monotonically_increasing_id())
    layout = store(text.withColumn("shard", F.pmod("doc", F.lit(shards)).cast("int")), "shards", by="shard")
    tables = frequent_keys(layout, shards, least, slots)
    phrases = spelled(layout, reduce(DataFrame.union, tables).select("key", "a", "doc"))
    every = layout.groupBy("lang").agg(F.sum(F.regexp_count("text", F.lit(WORD)).cast("long")).alias("a"))
    out = store(phrases.union(every.select("lang", F.lit(""), F.lit(0), "a")), "phrases")
    for t in [layout, *tables]:
        drop(t)
    return out


BIG = "decimal(20,0)"


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, contained: int = 80, **options) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases by the score of their weakest cut."""
    every = frequent_phrases(docs, least, **options)
    candidates = every.where("words > 1").withColumn("w", F.split("phrase", " "))
    part = every.where("words > 0")

    # the weakest cut: both parts are frequent themselves, as they occur wherever the phrase does
    cuts = candidates.select("lang", "phrase", "a", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
                       F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("rest"))
    cuts = (cuts.join(part.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l")), ["lang", "first"])
            .join(part.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r")), ["lang", "rest"]))
    score = F.expr(f"cast(2000000 as decimal(7,0)) * cast(a as {BIG}) div (cast(l as {BIG}) + cast(r as {BIG}))").cast("long")
    scored = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))

    # the most frequent longer candidate around each candidate
    longer = candidates.where("words > 2").select("lang", "a", "w", "words", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("m"))
    longer = longer.select("lang", "a", "w", "m", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("m") + 1)).alias("i"))
    inside = longer.groupBy("lang", F.array_join(F.slice("w", F.col("i"), F.col("m")), " ").alias("phrase")).agg(F.max("a").alias("around"))
    kept = scored.join(inside, ["lang", "phrase"], "left").where(
        F.expr(f"around is null or {100} * cast(around as {BIG}) < {contained} * cast(a as {BIG})"))

    kept = kept.select("lang", "phrase", "a", "m.l", "m.r", "m.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    block = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    firsts = kept.withColumn("nth", F.row_number().over(block)).where(F.col("nth") <= top)
    ranked = firsts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    n = every.where("words = 0").select("lang", F.col("a").alias("n"))
    return ranked.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


# ---------------------------------------------------------------- registered query

def op12_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"), least=30, top=2000, contained=80)


OP12_SQL = r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
p AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM t),
u AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p WHERE len(w) > 0),
g AS (SELECT lang, unnest(list_transform(range(i, least(i + 3, len(w)) + 1), lambda j: array_to_string(w[i:j], ' '))) AS phrase FROM u),
f AS MATERIALIZED (SELECT lang, phrase, len(string_split(phrase, ' ')) AS words, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 30),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
c AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE words BETWEEN 2 AND 4),
k AS (SELECT *, unnest(range(1, words)) AS k FROM c),
x AS (
  SELECT k.lang, k.phrase, k.a, k.k, f1.a AS l, f2.a AS r, ((2000000::HUGEINT * k.a) // (f1.a + f2.a))::BIGINT AS score
  FROM k JOIN f f1 ON f1.lang = k.lang AND f1.phrase = array_to_string(k.w[1:k.k], ' ')
         JOIN f f2 ON f2.lang = k.lang AND f2.phrase = array_to_string(k.w[k.k + 1:], ' ')),
b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
s AS (
  SELECT lang, a, unnest(flatten(list_transform(range(2, words), lambda m: list_transform(range(1, words - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))))) AS phrase
  FROM c WHERE words > 2),
o AS (SELECT lang, phrase, max(a) AS around FROM s GROUP BY ALL),
r AS (
  SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, score
  FROM b LEFT JOIN o ON b.lang = o.lang AND b.phrase = o.phrase WHERE around IS NULL OR 100 * around::HUGEINT < 80 * a::HUGEINT)
SELECT r.lang, rank, phrase, a, l, r, n, score FROM r JOIN n ON r.lang = n.lang WHERE rank <= 2000
"""
