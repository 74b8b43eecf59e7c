import random

import pytest

from kestrel.llm.common import components, table
from kestrel.llm.minhash import bucket_links, deduplicate, near_duplicates, op2_minhash_near_dedup
from tests.llm import brute


def as_dict(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_query_equals_brute_force(spark, mid_dir):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, mid_dir, "documents").collect()]
    rows = op2_minhash_near_dedup(spark, mid_dir).collect()
    expected = brute.near(docs)
    assert len(rows) == len(docs)
    for r in rows:
        assert expected[r["doc_id"]] == (r["n_shingles"], r["component_id"])
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_large_family_needs_blocks(spark):
    """A template with many edits: links on both sides of the threshold, more classes than a block."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    docs = []
    for i in range(160):
        w = list(base)
        for _ in range(rng.randint(0, 7)):
            w[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        docs.append((i, " ".join(w)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert as_dict(near_duplicates(df, words=4, small=3, block=16)) == brute.near(docs)


def template_texts(n, pairs, seed):
    """``n`` mutually unlike texts over one template, and for the first ``pairs`` of them a near copy."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for i in range(n):
        start = rng.randrange(150)  # the edited third is one run, so that most shingles stay the template's
        texts.append([f"x{i}y{k}" if (k - start) % 150 < 40 else w for k, w in enumerate(base)])
    docs = [(i, " ".join(w)) for i, w in enumerate(texts)]
    for i in range(pairs):
        w = list(texts[i])
        at = rng.randrange(5, 145)
        w[at] = f"z{i}"
        docs.append((n + i, " ".join(w)))
    return docs


def test_hot_buckets_lose_no_pair(spark):
    """Buckets far beyond ``small`` classes, most links proposed there unlike: each near copy is still found."""
    n, pairs = 1500, 300
    docs = template_texts(n, pairs, 11)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {i: c for i, (_, c) in as_dict(near_duplicates(df, words=4, small=2, block=128, side=4)).items()}
    rows = {n + i: i for i in range(pairs)}
    lost = [i for i, c in rows.items() if got[i] != c]
    assert not lost and all(got[i] == i for i in range(n))


def test_hot_bucket_connects_all_its_classes(spark):
    """Every class of a bucket beyond ``small`` is reachable over hot links, those of its head too."""
    keys = spark.createDataFrame([(1, i % 3, i) for i in range(40)] + [(2, 0, 100), (2, 0, 101), (3, 0, 200)], "key long, near long, id long")
    rows = bucket_links(keys, 4).collect()
    u = brute.Union()
    for r in rows:
        assert r["a"] < r["b"]
        if r["hot"]:
            u.join(r["a"], r["b"])
    assert {u.find(i) for i in range(40)} == {0}
    assert [(r["a"], r["b"], r["hot"]) for r in rows if r["a"] >= 100] == [(100, 101, False)]


def test_edges(spark, edge, empty):
    got = near_duplicates(edge, words=4).collect()
    assert len(got) == edge.count()
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by[1]["component_id"] == by[2]["component_id"] == 1 and not by[2]["kept"]
    assert by[7]["component_id"] == by[8]["component_id"] == 7
    assert by[5]["component_id"] == by[11]["component_id"] == 5
    for i in (3, 4, 6):
        assert (by[i]["n_shingles"], by[i]["component_id"], by[i]["kept"]) == (0, i, True)
    assert all(r["kept"] and r["component_id"] is None for r in got if r["doc_id"] is None)
    assert near_duplicates(empty).count() == 0
    kept = deduplicate(edge, words=4)
    assert kept.columns == edge.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [1, 3, 4, 5, 6, 7, 9, 12, 13]  # 9 and 10 share 57 of 61 shingles
    assert deduplicate(empty).count() == 0


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 60)], [(5, 9), (9, 2), (7, 8), (None, 3)]])
def test_components(spark, edges):
    u = brute.Union()
    nodes = {x for a, b in edges if None not in (a, b) and a != b for x in (a, b)}
    for a, b in edges:
        if None not in (a, b):
            u.join(a, b)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert got == {x: u.find(x) for x in nodes}
