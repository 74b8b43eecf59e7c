"""Greedy word-piece token counts by a linear longest-match automaton.

The vocabulary becomes a trie with failure links.  Every node knows how many tokens
are popped when the match cannot go on from it, and the node where matching resumes,
so a word is read once, character by character, and no piece is ever built.

 * A node that is a piece pops itself (1) and resumes at the root.
 * Any other node pops what its parent pops, and follows the failure links until one
   has the node's character; it resumes at that child.

Texts are split at ASCII white space, and each word is preceded by the vocabulary's
word mark.  A character that begins no piece costs its UTF-8 bytes (byte pieces).  Workers count
each distinct word once and remember a bounded number of them.

Defined results: a null or blank text has 0 words and 0 tokens; every row gives a row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from kestrel.llm.common import table

WORD_MARK = "▁"
CACHE_WORDS = 1_000_000


class LongestMatch:
    """Counts the tokens of greedy longest-match-first segmentation in linear time."""

    def __init__(self, pieces: Iterable[str]):
        pieces = {p for p in pieces if p}
        # a character that is not a piece itself still ends a match, at the price of its bytes
        price = {c: len(c.encode()) for p in pieces for c in p if c not in pieces}
        self.children: list[dict[str, int]] = [{}]
        parent, char, ends = [-1], [""], [0]
        for piece in sorted(pieces | set(price)):
            v = 0
            for c in piece:
                if c not in self.children[v]:
                    self.children[v][c] = len(parent)
                    self.children.append({})
                    parent.append(v)
                    char.append(c)
                    ends.append(0)
                v = self.children[v][c]
            ends[v] = price.get(piece, 1)
        self.popped, self.resume = [0] * len(parent), [0] * len(parent)
        level = list(self.children[0].values())
        while level:  # shorter strings first: their links are needed
            for v in level:
                if ends[v]:
                    self.popped[v] = ends[v]
                    continue
                u, c = parent[v], char[v]
                count, z = self.popped[u], self.resume[u]
                while c not in self.children[z]:
                    count += self.popped[z]
                    z = self.resume[z]
                self.popped[v], self.resume[v] = count, self.children[z][c]
            level = [w for v in level for w in self.children[v].values()]

    def count(self, word: str) -> int:
        children, popped, resume = self.children, self.popped, self.resume
        v, total = 0, 0
        for c in word:
            while c not in children[v]:
                if not v:
                    total += len(c.encode("utf-8", "surrogatepass"))
                    break
                total += popped[v]
                v = resume[v]
            else:
                v = children[v][c]
        while v:
            total += popped[v]
            v = resume[v]
        return total


_MATCHERS: dict[str, tuple[LongestMatch, dict[bytes, int]]] = {}


def vocabulary(path: str) -> list[str]:
    """The pieces of a public sentencepiece model file, without control, unknown and byte pieces."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]


def matcher(path: str) -> tuple[LongestMatch, dict[bytes, int]]:
    if path not in _MATCHERS:
        _MATCHERS[path] = LongestMatch(vocabulary(path)), {}
    return _MATCHERS[path]


def token_counts(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """(doc_id, n_words, n_tokens) of every row; the vocabulary file must be on every machine."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto, known = matcher(vocabulary_path)
        for batch in batches:
            words, tokens = [], []
            for i in range(0, batch.num_rows, 512):
                for raw in batch.column(1).slice(i, 512).cast(pa.binary()).fill_null(b"").to_pylist():
                    split = raw.split()
                    new = set(split).difference(known)
                    if len(known) + len(new) > CACHE_WORDS:
                        known.clear()
                        new = set(split)
                    for w in new:
                        known[w] = auto.count(WORD_MARK + w.decode("utf-8", "replace"))
                    words.append(len(split))
                    tokens.append(sum(map(known.__getitem__, split)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())],
                                             names=["doc_id", "n_words", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, n_tokens long")


# ---------------------------------------------------------------- registered query

def op7_token_counts(spark, sf_dir):
    from public_tokenizers import path

    return token_counts(table(spark, sf_dir, "documents"), path("piece_bpe_32k.model"))
