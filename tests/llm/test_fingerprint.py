import hashlib
import random

from kestrel.llm.common import table
from kestrel.llm.fingerprint import fingerprints, op3_order_minhash, with_next
from tests.llm import brute

def test_fingerprints_equal_brute_force(spark, small_dir):
    docs = {r["doc_id"]: r["text"] for r in table(spark, small_dir, "documents").collect()}
    docs |= {-1: "a a a a a a b a a a b", -2: "x", -3: "", -4: None, -5: "x y", -6: " ".join("ab"[i % 2] for i in range(300))}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["fingerprint"] for r in fingerprints(df).collect()}
    assert got == {i: brute.fingerprint(t) for i, t in docs.items()}


def test_query_against_brute_force(spark, small_dir):
    docs = sorted(((r["doc_id"], r["text"]) for r in table(spark, small_dir, "documents").collect()), reverse=True)
    rows = {r["doc_id"]: r for r in op3_order_minhash(spark, small_dir).collect()}
    assert len(rows) == len(docs)
    pieces = lambda s: [s[i : i + 8] for i in range(0, len(s), 8)]

    def likeness(a, b):
        both = [(x, y) for x, y in zip(pieces(a), pieces(b), strict=True) if (x, y) != ("--------",) * 2]
        return sum(x == y for x, y in both) / len(both) if both else 1.0

    for k, (i, text) in enumerate(docs):
        nxt, r = docs[(k + 1) % len(docs)], rows[i]
        edited = text[: len(text) - len(text) // 2] + nxt[1][: len(text) // 2]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r["fingerprint"] == brute.fingerprint(text) and r["edited_fingerprint"] == brute.fingerprint(edited)
        assert abs(r["near_edited"] - likeness(r["fingerprint"], r["edited_fingerprint"])) < 1e-12
        assert abs(r["near_next"] - likeness(r["fingerprint"], rows[nxt[0]]["fingerprint"])) < 1e-12


def test_likeness_follows_order_and_edits(spark):
    rng = random.Random(2)
    base = [f"w{rng.randrange(400)}" for _ in range(600)]
    swapped = base[300:] + base[:300]
    rows = {"base": base, "few": base[:200] + ["new"] + base[203:], "many": [x if rng.random() > 0.2 else "e" + x for x in base], "swapped": swapped}
    df = spark.createDataFrame([(k, " ".join(v)) for k, v in enumerate(rows.values())], "doc_id long, text string")
    fp = [r["parts"] for r in fingerprints(df, bins=128).orderBy("doc_id").collect()]
    like = [sum(a == b for a, b in zip(fp[0], x, strict=True)) / 128 for x in fp]
    assert like[0] == 1.0 and like[1] > 0.9 > like[2]
    assert like[3] < like[1] - 0.2  # the same words and nearly all k-mers, in another order


def test_next_across_ranges(spark):
    docs = [(i * 7 % 101, f"text {i}") for i in range(101)] + [(None, "nothing"), (5, "second five")]
    got = {(r["doc_id"], r["text"]): r["next_text"] for r in with_next(spark.createDataFrame(docs, "doc_id long, text string"), rows_a_range=9).collect()}
    assert len(got) == len(docs)
    by = dict(docs[:101])
    for i in range(7, 101):
        assert got[i, by[i]] == by[i - 1]
    assert got[0, by[0]] == "nothing" and got[None, "nothing"] == by[100]
    assert sorted([got[6, by[6]], got[5, by[5]], got[5, "second five"]]) == sorted([by[4], by[5], "second five"])


def test_edges(spark, edge, empty):
    rows = with_next(edge).collect()
    assert len(rows) == edge.count() and all(r["next_text"] is not None for r in rows)
    assert fingerprints(edge).count() == edge.count()
    assert fingerprints(empty).count() == 0 and with_next(empty).count() == 0
    one = spark.createDataFrame([(1, "alone here")], "doc_id long, text string")
    assert [r["next_text"] for r in with_next(one).collect()] == ["alone here"]
