"""Components of texts with few k-mers: every one is drawn from the whole text, so that it carries order."""

import random

import pytest

from kestrel.llm.fingerprint import fingerprints
from tests.llm.brute import fingerprint


def test_every_length_against_brute_force(spark):
    rng = random.Random(5)
    texts = ["a a a a a a b a a a b", "x", "", None, "x y", " ".join("ab"[i % 2] for i in range(300))]
    texts += [" ".join(f"w{rng.randrange(50)}" for _ in range(n)) for n in [*range(1, 90), 150, 400, 2000]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["fingerprint"] for r in fingerprints(df).collect()}
    assert got == {i: fingerprint(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("words", [20, 40, 60])
def test_swapped_halves_of_a_short_text_are_less_alike(spark, words):
    rng = random.Random(words)
    rows = []
    for i in range(0, 80, 2):
        w = [f"w{rng.randrange(10_000)}" for _ in range(words)]
        rows += [(i, " ".join(w)), (i + 1, " ".join(w[words // 2 :] + w[: words // 2]))]
    parts = {r["doc_id"]: r["parts"] for r in fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(x is not None for p in parts.values() for x in p)
    like = [sum(x == y for x, y in zip(parts[i], parts[i + 1], strict=True)) / 32 for i in range(0, 80, 2)]
    assert sum(like) / len(like) < 0.5  # half of the pairs of elements change their order, and some k-mers change
