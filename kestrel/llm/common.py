"""Helpers shared by the corpus operators: scratch tables, word hashing, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kestrel.session import checkpoint_dir

#: The six ASCII white space characters that separate words.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

U64 = np.uint64
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back (cuts lineage, survives lost executors).

    With ``by`` the table has a folder for each value of that column, so a filter on it reads only those files.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def drop(df: DataFrame) -> None:
    """Delete a stored table that nothing reads any more (only what ``store`` has written)."""
    path = getattr(df, "stored_at", None)
    if path:
        jvm = df.sparkSession.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def word_array(text: Column) -> Column:
    """Words of a text, split at ASCII white space; a null or blank text has none."""
    trimmed = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, GAP))


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


# ---------------------------------------------------------------- hashing of whole Arrow batches

def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (xor-shift-multiply); spreads every input bit over the result."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = U64(0x9E3779B97F4A7C15)
_BASE_INV = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[ord(c) for c in SPACES]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def run(base):
        p = np.full(n, base, dtype=np.uint64)
        p[0] = 1
        return np.multiply.accumulate(p)

    return run(_BASE), run(_BASE_INV)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, at least ``n`` of each."""
    return _powers(1 << max(20, int(n).bit_length()))


def rolling(values: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hash of every run of ``width`` values (one hash per start position)."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    p, inv = powers(len(values) + 1)
    total = np.concatenate([[U64(0)], np.cumsum(values * p[: len(values)], dtype=np.uint64)])
    return mix((total[width:] - total[:-width]) * inv[:n])


def text_chunks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Pieces of a string array as (first row, end row, bytes, offsets of the rows in them).

    A piece holds whole texts and about CHUNK_BYTES bytes (more only for one longer text); null is ''.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK_BYTES, "right")) - 1)
        j = min(j, n)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the first word of each row (one more entry at the end)."""
    if not len(data):
        empty = np.empty(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    letter = ~_IS_SPACE[data]
    cut = np.ones(len(data) + 1, bool)  # a word cannot go on across this byte position
    cut[1:-1] = ~letter[:-1]
    cut[offsets] = True
    starts = np.flatnonzero(letter & cut[:-1])
    after = np.ones(len(data), bool)
    after[:-1] = ~letter[1:]
    after[offsets[offsets > 0] - 1] = True
    ends = np.flatnonzero(letter & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """64-bit hash of each word's bytes (A-Z lower-cased on request), equal words alike everywhere."""
    if not len(starts):
        return np.empty(0, np.uint64)
    p, inv = powers(len(data) + 1)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[_LOWER[data] if lower else data] * p[: len(data)], out=total[1:])
    h = (total[ends] - total[starts]) * inv[starts]
    return mix(h + (ends - starts).astype(np.uint64))


# ---------------------------------------------------------------- graph

def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of the undirected ``edges`` (a, b): one row (node, component) per node.

    ``component`` is the smallest node reachable.  Alternating large-star and
    small-star steps turn every component into a star around its smallest node in
    a logarithmic number of rounds; every round is a grouped minimum (combined
    before the shuffle) joined back to the edges.  The minima are written to the
    shared folder before they are joined: with two plain scans under the join,
    adaptive execution can split a hub that holds a third of all edges.  A
    round's tables are deleted once the next round is written.
    """
    e = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    e = store(e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    seen = None
    while True:
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state or not state[0]:
            break
        seen = state
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = store(both.groupBy("u").agg(F.min("v").alias("m")), name)
        large = store(both.where("v > u").join(low, "u")
                      .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct(), name)
        least = store(large.groupBy("u").agg(F.min("v").alias("m")), name)
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = store(small.union(least.select("u", F.col("m").alias("v"))).distinct(), name)
        for old in (e, low, large, least):
            drop(old)
        e = after
    star = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return star.union(star.select(F.col("component").alias("node"), "component").distinct())
