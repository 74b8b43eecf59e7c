"""Invariants of the whole-text functions over generated text (one Spark job each)."""

import random

from pyspark.sql import functions as F

from kestrel.functions import text as tf

WS = ["\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x1f", " ", "\x85", "\xa0", " ", " ", "　"]
WORDS = ["alpha", "Beta", "- x", "- Code path", "- Statistics:", "{", "é", "-", "--", "- ok", "rules", "Schema"]


def corpus(n=400, seed=7):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        parts = [rnd.choice(WORDS + WS) for _ in range(rnd.randint(0, 40))]
        out.append("".join(parts))
    return out + [None, "", " ", "x" * 5000]


def test_sanitize_invariants(spark):
    df = spark.createDataFrame([(t,) for t in corpus()], "t string")
    rows = df.select("t", tf.sanitize_text(F.col("t"), 60).alias("s"),
                     tf.sanitize_text(tf.sanitize_text(F.col("t"), 10_000), 10_000).alias("twice"),
                     tf.sanitize_text(F.col("t"), 10_000).alias("once")).collect()
    for r in rows:
        s = r["s"]
        assert len(s) <= 60
        assert s == s.strip() and "  " not in s
        assert not any(w in s for w in WS if w != " ")
        assert r["twice"] == r["once"]                         # idempotent
        if r["t"] is not None:
            assert r["once"].split() == r["t"].split()         # same words, whole text kept


def test_clean_root_causes_invariants(spark):
    df = spark.createDataFrame([(t,) for t in corpus()], "t string")
    for r in df.select("t", tf.clean_root_causes(F.col("t")).alias("b")).collect():
        if not r["b"]:
            continue
        lines = r["b"].split("\n")
        src = [x.strip() for x in (r["t"] or "").split("\n")]
        assert len(lines) <= 4
        for ln in lines:
            assert ln.startswith("- ") and ln == ln.strip() and ln in src
            assert not any(p in ln.lower() for p in tf.ROOT_CAUSE_SKIP)


def test_other_types_get_null_checks_only(spark):
    from kestrel.operators import profile as P

    df = spark.createDataFrame([(True, None), (None, None)], "b boolean, ts timestamp")
    assert [r["column_name"] for r in P.column_profile(df).collect()] == []
    got = {r["column_name"]: r["null_count"] for r in P.null_anomalies(df).collect()}
    assert got == {"b": 1, "ts": 2}
