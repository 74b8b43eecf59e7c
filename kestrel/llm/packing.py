"""Packing documents into fixed-length sequences, bounded-space and online.

Every partition keeps at most ``open_windows`` sequences open.  A document's ids
first fill whole sequences; what is left goes to the open sequence that it fits
best.  When none fits and no more may be opened, the fullest is emitted: a gap of at
least ``min_cut`` ids is filled with the head of the waiting piece, a smaller gap is
padded.  At the end of a partition its open sequences are merged into full ones; the
one partial sequence left of each partition (fewer than ``size`` ids) is merged with
those of ``fan_in`` partitions, and what remains of such a group is cut into
sequences whose lengths are powers of two, which need no padding.

Token ids come from a public tokenizer file named by path (a parameter, present on
every machine).  That tokenizer lower-cases, drops white space and splits words at changes between
letters, digits and marks, so ids are looked up per such unit in a bounded table, a megabyte of
text at a time; unseen units are encoded by the tokenizer and its model.

Defined results: a null or empty text has the end id alone.  Rows that repeat a
doc_id are packed one by one.  A null doc_id stays null.  An empty table gives none.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from kestrel.llm.common import store, table, text_chunks, word_hashes, word_spans

END_ID = (1).to_bytes(4, "little")
#: Units a worker remembers before it starts anew.
CACHE_UNITS = 2_000_000

# Byte classes: 0 white space, 1 letter, 2 digit, 3 mark, 4 anything that makes its word opaque
# (other characters, apostrophes, which start contractions, and the bracket of special tokens).
_CLASS = np.full(256, 4, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[[*range(65, 91), *range(97, 123)]] = 1
_CLASS[48:58] = 2
_CLASS[[c for c in range(33, 127) if chr(c) not in "'<|" and not chr(c).isalnum()]] = 3

_ENCODERS: dict[str, UnitEncoder] = {}


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each unit, and the first unit of each row.

    The tokenizer drops white space and splits words into runs of letters, single digits and runs of marks, none of which
    affects another's ids.  A unit is such a run, or a whole word if it holds a byte of class 4.
    """
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    starts, ends, _ = word_spans(data, offsets)
    kind = _CLASS[data]
    cut = kind == 2
    cut[1:] |= kind[1:] != kind[:-1]
    strange = np.flatnonzero(kind == 4)
    if len(strange):
        word = np.unique(np.searchsorted(starts, strange, "right") - 1)
        edge = np.zeros(len(data) + 1, np.int8)
        edge[starts[word]] += 1
        edge[ends[word]] -= 1
        cut &= np.cumsum(edge[:-1], dtype=np.int8) == 0
    spaces = kind == 0
    cut &= ~spaces
    cut[starts] = True
    # a unit ends where the next byte begins another or is white space
    last = np.append(cut[1:] | spaces[1:], True) & ~spaces
    begin = np.flatnonzero(cut)
    return begin, np.flatnonzero(last) + 1, np.searchsorted(begin, offsets)


class UnitEncoder:
    """Token ids of texts, looked up by unit under 128 hash bits."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.forget()

    def forget(self) -> None:
        self.key, self.check = np.empty(0, np.uint64), np.empty(0, np.uint64)  # sorted by key
        self.start, self.count = np.empty(0, np.int64), np.empty(0, np.int64)
        self.pool, self.filled = np.empty(1 << 16, "<u4"), 0

    def learn(self, texts: list[bytes], key: np.ndarray, check: np.ndarray) -> None:
        """Ids of new units: runs of plain lower-case letters from the model itself, all others by one call of the tokenizer."""
        plain = [t.isalpha() and t.islower() for t in texts]  # bytes: ASCII letters only
        lists: list = [[x.id for x in self.model.tokenize(t.decode())] if ok else None for t, ok in zip(texts, plain, strict=True)]
        rest = [i for i, ok in enumerate(plain) if not ok]
        shown = [texts[i].decode("utf-8", "replace") for i in rest]
        begin = np.concatenate([[0], np.cumsum(np.fromiter(map(len, shown), np.int64, len(shown)) + 1)])
        got = self.tokenizer.encode(" ".join(shown), add_special_tokens=False)
        cuts = np.searchsorted(np.fromiter((o[0] for o in got.offsets), np.int64, len(got)), begin).tolist()
        ids = got.ids
        for i, a, b in zip(rest, cuts[:-1], cuts[1:], strict=True):
            lists[i] = ids[a:b]
        count = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter(chain.from_iterable(lists), "<u4", count.sum())
        while self.filled + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        self.pool[self.filled : self.filled + len(flat)] = flat
        at = np.searchsorted(self.key, key)
        self.key, self.check = np.insert(self.key, at, key), np.insert(self.check, at, check)
        self.start, self.count = np.insert(self.start, at, self.filled + np.cumsum(count) - count), np.insert(self.count, at, count)
        self.filled += len(flat)

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        for _, _, data, offsets in text_chunks(texts):
            raw = data.tobytes()
            # special tokens are matched before lower-casing, all else is lower-cased anyway
            if b"<|" not in raw:
                raw = raw.lower()
                data = np.frombuffer(raw, np.uint8)
            begin, stop, first = units(data, offsets)
            check = word_hashes(data[::-1], len(data) - stop, len(data) - begin, lower=False)
            key, at, unit = np.unique(word_hashes(data, begin, stop, lower=False), return_index=True, return_inverse=True)
            if len(self.key) > CACHE_UNITS:
                self.forget()
            pos = np.searchsorted(self.key, key)
            fresh = pos == len(self.key)
            fresh[~fresh] = self.key[pos[~fresh]] != key[~fresh]
            if fresh.any():
                self.learn([raw[begin[i] : stop[i]] for i in at[fresh]], key[fresh], check[at[fresh]])
                pos = np.searchsorted(self.key, key)
            if (self.check[pos][unit] != check).any():
                raise ValueError("two units share a 64-bit hash")
            count = self.count[pos][unit]
            bounds = np.concatenate([[0], np.cumsum(count)])
            ids = self.pool[np.repeat(self.start[pos][unit] - bounds[:-1], count) + np.arange(bounds[-1])].tobytes()
            rows = 4 * bounds[first]
            yield from (ids[a:b] for a, b in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True))


def encoder(path: str) -> UnitEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = UnitEncoder(path)
    return _ENCODERS[path]


class Packer:
    """Open sequences of one partition; pieces are (doc_id, start, doc_tokens, ids)."""

    def __init__(self, first_id: int, size: int, open_windows: int, min_cut: int):
        self.size, self.most, self.min_cut = size, open_windows, min_cut
        self.next_id = first_id
        self.fills: list[tuple[int, int]] = []  # (ids in it, sequence), sorted
        self.pieces: dict[int, list[tuple]] = {}

    def new(self) -> int:
        self.next_id += 1
        return self.next_id - 1

    def place(self, sequence: int, fill: int, piece: tuple) -> list[tuple]:
        """Append a piece that fits; the rows of the sequence if that fills it."""
        self.pieces.setdefault(sequence, []).append(piece)
        fill += len(piece[3]) // 4
        if fill == self.size:
            return self.emit(sequence)
        insort(self.fills, (fill, sequence))
        return []

    def emit(self, sequence: int) -> list[tuple]:
        out, offset = [], 0
        for doc_id, start, doc_tokens, ids in self.pieces.pop(sequence):
            out.append((doc_id, start, len(ids) // 4, zlib.crc32(ids), doc_tokens, sequence, offset))
            offset += len(ids) // 4
        return out

    def add(self, doc_id, ids: bytes) -> list[tuple]:
        n, out, at = len(ids) // 4, [], 0
        while n - at >= self.size:
            out.append((doc_id, at, self.size, zlib.crc32(ids[4 * at : 4 * (at + self.size)]), n, self.new(), 0))
            at += self.size
        while at < n:
            rest = n - at
            i = bisect_left(self.fills, (self.size - rest + 1, -1)) - 1  # the fullest that has room
            if i >= 0:
                fill, sequence = self.fills.pop(i)
                return out + self.place(sequence, fill, (doc_id, at, n, ids[4 * at :]))
            if len(self.fills) < self.most:
                return out + self.place(self.new(), 0, (doc_id, at, n, ids[4 * at :]))
            fill, sequence = self.fills.pop()
            gap = self.size - fill
            if gap >= self.min_cut:
                out += self.place(sequence, fill, (doc_id, at, n, ids[4 * at : 4 * (at + gap)]))
                at += gap
            else:
                out += self.emit(sequence)
        return out

    def close(self) -> tuple[list[tuple], list[tuple]]:
        """Merge the open sequences: the rows of the full ones, the pieces of the last one."""
        waiting = [p for _, s in reversed(self.fills) for p in self.pieces.pop(s)]
        self.fills = []
        return self.pour(waiting, [self.size])

    def pour(self, waiting: list[tuple], lengths: list[int]) -> tuple[list[tuple], list[tuple]]:
        """Fill sequences with the pieces in order, cutting where one is full; the pieces left."""
        out, fill, held = [], 0, []
        left = sum(len(p[3]) // 4 for p in waiting)
        size = next((x for x in lengths if x <= left), 0)
        for doc_id, start, n, ids in waiting:
            while size and ids:
                take = ids[: 4 * (size - fill)]
                held.append((doc_id, start, n, take))
                fill, start, ids = fill + len(take) // 4, start + len(take) // 4, ids[len(take) :]
                if fill == size:
                    sequence = self.new()
                    self.pieces[sequence] = held
                    out += self.emit(sequence)
                    left, fill, held = left - size, 0, []
                    size = next((x for x in lengths if x <= left), 0)
            if ids:
                held.append((doc_id, start, n, ids))
        return out, held


PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def _columns(rows: list[tuple], n: int) -> list[pa.Array]:
    return [pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [[]] * n)]


def pack(docs: DataFrame, tokenizer_path: str, size: int = 2048, open_windows: int = 32, min_cut: int = 16, fan_in: int = 64) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``docs`` needs doc_id and text; the partitions are packed as they are, so no row is shuffled.
    """
    if size & (size - 1):
        raise ValueError("size must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        packer, tok = Packer(part << 32, size, open_windows, min_cut), encoder(tokenizer_path)

        def batch_of(rows, left):
            cols = _columns(rows, 7)
            cols += [pa.array([None] * len(rows) + [p[3] for p in left], pa.binary()), pa.array([part] * (len(rows) + len(left)), pa.int64())]
            if left:
                cols[:7] = _columns([(p[0], p[1], len(p[3]) // 4, 0, p[2], 0, 0) for p in left], 7)
            return pa.RecordBatch.from_arrays(cols, names=[*COLUMNS, "ids", "part"])

        for batch in batches:
            rows: list[tuple] = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), tok.encode(batch.column(1)), strict=True):
                rows += packer.add(doc_id, ids + END_ID)
            yield batch_of(rows, [])
        rows, left = packer.close()
        yield batch_of(rows, [])
        yield batch_of([], left)

    placed = store(docs.select("doc_id", "text").mapInArrow(run, PIECE + ", ids binary, part long"), "packed")

    def merge(key, group):
        group = group.sort_by([("part", "ascending"), ("doc_id", "ascending"), ("start", "ascending")])
        packer = Packer((1 << 62) + (key[0].as_py() << 32), size, open_windows, min_cut)
        waiting = list(zip(*(group.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids")), strict=True))
        rows, _ = packer.pour(waiting, [size >> i for i in range(size.bit_length())])
        return pa.Table.from_arrays(_columns(rows, 7), names=COLUMNS)

    left = placed.where("ids IS NOT NULL").groupBy(F.floor(F.col("part") / fan_in).alias("g")).applyInArrow(merge, PIECE)
    return placed.where("ids IS NULL").select(*COLUMNS).unionByName(left)


# ---------------------------------------------------------------- registered query

def op10_sequence_packing(spark, sf_dir):
    from public_tokenizers import path

    return pack(table(spark, sf_dir, "documents"), path("word_bpe_49k.json"))
