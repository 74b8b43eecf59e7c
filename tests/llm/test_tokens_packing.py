import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from public_tokenizers import path
from tokenizers import Tokenizer

from kestrel.llm.common import table
from kestrel.llm.packing import UnitEncoder, op10_sequence_packing, pack
from kestrel.llm.tokens import WORD_MARK, LongestMatch, op7_token_counts, token_counts, vocabulary
from tests.llm import brute


def greedy(word, pieces, most):
    n, i = 0, 0
    while i < len(word):
        j = next((j for j in range(min(len(word), i + most), i, -1) if word[i:j] in pieces), None)
        n += 1 if j else len(word[i].encode())
        i = j or i + 1
    return n


@given(st.sets(st.text("abc", min_size=1, max_size=5), max_size=12), st.text("abcdé", max_size=30))
@settings(max_examples=300, deadline=None)
def test_automaton_is_greedy(pieces, word):
    assert LongestMatch(pieces).count(word) == greedy(word, pieces, 5)


def test_token_query_equals_greedy(spark, small_dir):
    pieces = set(vocabulary(path("piece_bpe_32k.model")))
    most = max(map(len, pieces))
    texts = {r["doc_id"]: r["text"] for r in table(spark, small_dir, "documents").collect()}
    known = {}
    for r in op7_token_counts(spark, small_dir).collect():
        w = brute.words(texts[r["doc_id"]])
        for x in set(w) - set(known):
            known[x] = greedy(WORD_MARK + x, pieces, most)
        assert (r["n_words"], r["n_tokens"]) == (len(w), sum(known[x] for x in w))


def test_token_edges(spark, edge, empty):
    rows = token_counts(edge, path("piece_bpe_32k.model")).collect()
    assert len(rows) == edge.count()
    assert {(r["n_words"], r["n_tokens"]) for r in rows if r["doc_id"] in (3, 4, 6)} == {(0, 0)}
    assert token_counts(empty, path("piece_bpe_32k.model")).count() == 0


def check(rows, docs, size=2048):
    """Every id in exactly one piece, sequences gapless; the padding."""
    tok = Tokenizer.from_file(path("word_bpe_49k.json"))
    by, seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
        seq[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, text in docs:
        ids = np.array(tok.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for p in sorted(by[i], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids) and p["length"] > 0
            assert p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    padding = 0
    for pieces in seq.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= size
        padding += size - at if at & (at - 1) else 0
    return padding


def test_packing_round_trip(spark, mid_dir):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, mid_dir, "documents").collect()]
    rows = op10_sequence_packing(spark, mid_dir).collect()
    assert check(rows, docs) < 0.01 * sum(r["length"] for r in rows)


def test_packing_many_partitions(spark, small_dir):
    df = table(spark, small_dir, "documents").repartition(90)
    docs = [(r["doc_id"], r["text"]) for r in df.collect()]
    rows = pack(df, path("word_bpe_49k.json"), size=256, open_windows=3, min_cut=8, fan_in=16).collect()
    assert check(rows, docs, 256) < 0.03 * sum(r["length"] for r in rows)


def test_packing_edges(spark, edge, empty):
    one = edge.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    check(pack(one, path("word_bpe_49k.json")).collect(), [(r["doc_id"], r["text"]) for r in one.collect()])
    rows = pack(edge, path("word_bpe_49k.json")).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 11) == 2 * sum(r["length"] for r in rows if r["doc_id"] == 5)
    assert sorted(r["length"] for r in rows if r["doc_id"] is None and r["doc_tokens"] == 1) == [1]
    assert pack(empty, path("word_bpe_49k.json")).count() == 0


@pytest.mark.parametrize("text", ["<|endoftext|> a<|startoftext|>b", "é ́x Å", "  a b 　", "İstanbul ΣΑΣ ﬁ", "it's 'S 12.5 I'LL", "a.,b!! 3rd no.4 x--y (z) <|ENDOFTEXT|> THE\x00the \x1fa", "", "퟿ \U0001f600‍\U0001f680"])
def test_word_ids_equal_text_ids(text):
    tok = Tokenizer.from_file(path("word_bpe_49k.json"))
    got = b"".join(UnitEncoder(path("word_bpe_49k.json")).encode(pa.array([text])))
    assert np.frombuffer(got, "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids
