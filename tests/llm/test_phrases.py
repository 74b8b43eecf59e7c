"""Collocations against the contract's text in plain Python, with few slots, several shards and awkward rows."""

import random
import re
from collections import Counter

import pytest

from kestrel.llm import phrases as P
from tests.llm.brute import AZ


def brute(docs, least, top, contained=80):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(AZ)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    cand = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    out = []
    for (lang, w), a in cand.items():
        cuts = [(2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        if any(x[0] == lang and len(x[1]) > len(w) and 100 * b >= contained * a and any(x[1][i : i + len(w)] == w for i in range(len(x[1]) - len(w) + 1))
               for x, b in cand.items()):
            continue
        out.append((lang, -score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    rows, rank = [], Counter()
    for lang, score, a, phrase, left, right in sorted(out):
        rank[lang] += 1
        if rank[lang] <= top:
            rows.append((lang, rank[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return rows


def text(rng, words):
    vocabulary = ["the", "The", "cat", "sat", "on", "mat", "é", "漢字", "ÀB", "x-y", "new", "york", "city"]
    out = []
    while len(out) < words:
        out += rng.choice([["new", "York", "city", "hall"], ["on", "the", "mat"], [rng.choice(vocabulary)], [rng.choice(vocabulary), rng.choice(".,;:!?\n\x0b\r")]])
    return rng.choice([" ", "  ", "\t"]).join(out)


@pytest.mark.parametrize("slots,shards", [(1 << 20, 4), (64, 3), (1 << 16, 1)])
def test_equal_to_brute_force(spark, slots, shards):
    rng = random.Random(slots + shards)
    docs = [(rng.choice(["en", "de", None, "und"]), text(rng, rng.randint(0, 60))) for _ in range(150)]
    docs += [("en", None), (None, ""), ("fr", " \t ..;\n"), ("en", "new york city hall " * 3000), ("de", "one two"), ("de", "one two")]
    df = spark.createDataFrame([(i, *d, 0) for i, d in enumerate(docs)], "doc_id long, lang string, text string, phrase int").repartition(6)
    got = P.collocations(df, least=8, top=15, slots=slots, shards=shards)
    assert sorted(map(tuple, got.collect())) == sorted(brute(docs, 8, 15))


def test_every_phrase_is_counted_once_a_shard(spark):
    """Phrases that reach the threshold at the very end of the cycle are found too."""
    docs = [("en", "a b c d e")] * 8
    df = spark.createDataFrame(docs, "lang string, text string").repartition(8)
    got = {r.phrase: r.a for r in P.frequent_phrases(df, least=8, shards=4, slots=1 << 10).collect()}
    assert got == {"": 40, **{" ".join("abcde"[i : i + n]): 8 for n in range(1, 5) for i in range(6 - n)}}


def test_no_frequent_phrases(spark, empty):
    assert P.collocations(empty, shards=2, slots=64).count() == 0
    df = spark.createDataFrame([("en", "just a few words")], "lang string, text string")
    assert P.collocations(df, shards=2, slots=64).count() == 0
