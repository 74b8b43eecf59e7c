"""Substring dedup: Rabin-Karp hashes of every window of ``width`` words.

A word goes if some window covering it also starts in a document with a smaller
doc_id.  All windows are hashed; to count them, only those that can repeat are
shuffled:

 1. Every text gives its word count, the digest of its word sequence, and its
    *anchors*: for each window the smallest hash of the half-width windows inside it.
    Equal windows have equal anchors, so a window can only repeat where its anchor does.
 2. Documents with equal word sequences form a class.  All but the smallest doc_id
    lose every word (if they have a window at all); the rest work on classes.
 3. Anchors of a single class are dropped (counted with map-side combining); windows of
    the others are emitted as (hash, doc_id, position).
 4. Smallest doc_id of each window hash by grouped minimum, joined back to the windows; hot
    windows are split by adaptive execution.
 5. Per document, repeated windows merge into maximal intervals of words, which are cut out.

Defined results: a null or blank text has no words, and the digest of ''.  A null
doc_id neither removes nor loses words.  Rows repeating a doc_id lose nothing to each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kestrel.llm.common import rolling, store, table, text_chunks, word_hashes, word_spans

EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _window_anchors(h: np.ndarray, first: np.ndarray, width: int):
    """For each row of a chunk: start of its windows' anchors in the returned array, and how many there are."""
    half = width // 2
    low = rolling(h, half)
    span = width - half + 1  # half-width windows in a window
    reach = 1
    while 2 * reach <= span:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if span > reach:
        low = np.minimum(low[: len(low) - (span - reach)], low[span - reach :])
    count = np.maximum(np.diff(first) - width + 1, 0)
    return low, count


def _chunks(column: pa.Array, width: int):
    for i, j, data, offsets in text_chunks(column):
        starts, ends, first = word_spans(data, offsets)
        h = word_hashes(data, starts, ends, lower=False)
        anchors, count = _window_anchors(h, first, width)
        yield i, j, data, offsets, h, first, anchors, count


def _normal(raw: bytes) -> bytes:
    return b" ".join(raw.split())


def summarise(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_words, sha, anchors) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets, _, first, anchors, count in _chunks(batch.column(1), width):
                raw = data.tobytes()
                shas = [hashlib.sha256(_normal(raw[a:b])).hexdigest() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                kept = [np.unique(anchors[f : f + c]).astype(np.int64) for f, c in zip(first[:-1], count, strict=True)]
                bounds = np.concatenate([[0], np.cumsum([len(x) for x in kept])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(kept) if kept else np.empty(0, np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], pa.array(np.diff(first), pa.int64()), pa.array(shas), lists],
                                                 names=["doc_id", "n_words", "sha", "anchors"])

    return docs.mapInArrow(run, "doc_id long, n_words long, sha string, anchors array<long>")


def _same_text(batch: pa.RecordBatch, i: int, j: int, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether the rows have the word sequence that the joined list was made from (rows may repeat a doc_id)."""
    raw = data.tobytes()
    shas = batch.column("sha")[i:j].to_pylist()
    return np.array([hashlib.sha256(_normal(raw[a:b])).hexdigest() == s for a, b, s in zip(offsets[:-1], offsets[1:], shas, strict=True)], bool)


def repeated_windows(docs: DataFrame, width: int = 50) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(summary of every row, texts that share an anchor, starts of the windows each of them loses)."""
    summary = store(summarise(docs, width), "windows")
    classes = (summary.where(F.col("doc_id").isNotNull() & (F.col("n_words") >= width))
               .groupBy("sha").agg(F.min("doc_id").alias("doc_id")))
    anchors = (summary.join(classes, ["sha", "doc_id"], "left_semi").dropDuplicates(["sha", "doc_id"])
               .select("doc_id", "sha", F.explode("anchors").alias("anchor")))
    anchors = store(anchors, "anchors")
    # classes with one doc_id but different texts must not hide a third document, so compare by doc_id
    shared = (anchors.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
              .where("lo <> hi").select("anchor"))
    wanted = anchors.join(shared, "anchor", "left_semi").groupBy("doc_id", "sha").agg(F.collect_list("anchor").alias("anchors"))
    texts = store(docs.join(wanted, "doc_id").select("doc_id", "text", "sha", "anchors"), "shared-texts")

    def emit(batches):
        for batch in batches:
            for i, j, data, offsets, h, first, low, count in _chunks(batch.column(1), width):
                hashes, same = rolling(h, width), _same_text(batch, i, j, data, offsets)
                ids, shas = batch.column(0)[i:j].to_numpy(), batch.column("sha")[i:j].to_pylist()
                lists = batch.column("anchors")[i:j]
                got = []
                for k in np.flatnonzero(same & (count > 0)):
                    f, c = first[k], count[k]
                    pos = np.flatnonzero(np.isin(low[f : f + c], np.asarray(lists[int(k)].values, np.int64).astype(np.uint64)))
                    got.append((k, pos, hashes[f + pos]))
                if got:
                    n = [len(p) for _, p, _ in got]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.concatenate([x for *_, x in got]).astype(np.int64)),
                        pa.array(np.repeat(ids[[k for k, *_ in got]], n)),
                        pa.array(np.repeat(np.array([int(shas[k][:15], 16) for k, *_ in got], np.int64), n)),
                        pa.array(np.concatenate([p for _, p, _ in got]).astype(np.int32)),
                    ], names=["hash", "doc_id", "cls", "pos"])

    windows = store(texts.mapInArrow(emit, "hash long, doc_id long, cls long, pos int"), "repeats")
    # stored, so that the join below is dealt by Spark alone and a hot window can be split
    firsts = store(windows.groupBy("hash").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
                   .where("lo <> hi").select("hash", "lo"), "first-windows")
    lost = (windows.join(firsts, "hash").where("lo < doc_id")
            .groupBy("doc_id", "cls").agg(F.collect_list("pos").alias("starts")))
    return summary, texts, lost


def covered(starts: np.ndarray, n: int, width: int) -> np.ndarray:
    """Mask of the words inside the windows that begin at ``starts``: the union of maximal intervals."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    return np.cumsum(edge[:-1]) > 0


def deduplicate_windows(docs: DataFrame, width: int = 50) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text_sha, intervals): removal intervals [start, end) in words of every row.

    ``intervals`` is null where nothing goes; a later copy of a whole text has the one interval [0, n_words).
    """
    docs = docs.select("doc_id", "text")
    summary, texts, lost = repeated_windows(docs, width)
    cls = F.conv(F.substring("sha", 1, 15), 16, 10).cast("long")

    def cut(batches):
        for batch in batches:
            ids, shas, ns, gone, kept, spans = [], [], [], [], [], []
            for doc_id, raw, sha, starts in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(),
                                                batch.column(2).to_pylist(), batch.column(3), strict=True):
                words = raw.split()
                if hashlib.sha256(b" ".join(words)).hexdigest() != sha:
                    continue
                mask = covered(np.asarray(starts.values, np.int64), len(words), width)
                flips = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
                ids.append(doc_id)
                shas.append(sha)
                ns.append(len(words))
                gone.append(int(mask.sum()))
                kept.append(hashlib.sha256(b" ".join([words[k] for k in np.flatnonzero(~mask)])).hexdigest())
                spans.append([{"start": int(a), "end": int(b)} for a, b in zip(flips[::2], flips[1::2], strict=True)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(shas, pa.string()), pa.array(gone, pa.int64()), pa.array(kept, pa.string()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
                names=["doc_id", "sha", "n_removed", "kept", "intervals"])

    cuts = (texts.withColumn("cls", cls).join(lost, ["doc_id", "cls"]).select("doc_id", "text", "sha", "starts")
            .mapInArrow(cut, "doc_id long, sha string, n_removed long, kept string, intervals array<struct<start:int,end:int>>")
            .dropDuplicates(["doc_id", "sha"]))
    # stored, so that a text that a third of all documents repeat can be split in the join
    classes = store(summary.where(F.col("doc_id").isNotNull() & (F.col("n_words") >= width))
                    .groupBy("sha").agg(F.min("doc_id").alias("first")), "first-copies")
    whole = F.coalesce(F.col("first") < F.col("doc_id"), F.lit(False))
    span = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end")))
    return (summary.drop("anchors").join(classes, "sha", "left").join(cuts, ["doc_id", "sha"], "left")
            .select("doc_id", "n_words",
                    F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
                    F.when(whole, F.lit(EMPTY_SHA)).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"),
                    F.when(whole, span).otherwise(F.col("intervals")).alias("intervals")))


# ---------------------------------------------------------------- registered query

def op8_substring_dedup(spark, sf_dir):
    return deduplicate_windows(table(spark, sf_dir, "documents"), 50).drop("intervals")


OP8_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
t AS (SELECT doc_id, unnest(range(1, len(words) + 1)) AS pos, words FROM w),
h AS (SELECT doc_id, pos, words[pos] AS word, CASE WHEN pos + 49 <= len(words) THEN md5(array_to_string(words[pos:pos + 49], ' ')) END AS win FROM t),
f AS (SELECT win, min(doc_id) AS first FROM h WHERE win IS NOT NULL GROUP BY win),
g AS (
  SELECT h.doc_id, pos, word,
         sum(CASE WHEN f.first < h.doc_id THEN 1 ELSE 0 END) OVER (PARTITION BY h.doc_id ORDER BY pos ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) > 0 AS gone
  FROM h LEFT JOIN f ON h.win = f.win)
SELECT w.doc_id, len(w.words)::BIGINT AS n_words, count(*) FILTER (WHERE gone)::BIGINT AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM w LEFT JOIN g ON g.doc_id = w.doc_id GROUP BY w.doc_id, len(w.words)
"""
