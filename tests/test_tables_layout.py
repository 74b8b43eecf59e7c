"""Catalog tables, Z-order layout, mergeable sketches and exact distincts by pairs."""

import random

from pyspark.sql import functions as F

from kestrel.operators import gold, profile, sketches
from kestrel.plans import catalog
from kestrel.sources import io as IO
from kestrel.sources import layout
from tests.conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_join_has_no_shuffle(spark):
    names = catalog.catalog_tables(spark, SF_SMALL)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = gold.enrich_sales(IO.read_table(spark, names["sales"]), IO.read_table(spark, names["customers"]), dedupe=False)
        assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert IO.table_or_empty(spark, "no_such_table", "a int, b string").schema.simpleString() == "struct<a:int,b:string>"


def test_z_value_interleaves_bits(spark):
    rows = spark.createDataFrame([(0b101, 0b011)], "a int, b int").select(layout.z_value([F.col("a"), F.col("b")], 3)).first()
    assert rows[0] == 0b011011


def test_z_order_keeps_rows_and_skips_files(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, rng.gauss(0, 1), rng.choice([None, 0, 1, 2, 5000])) for i in range(5000)]
    df = spark.createDataFrame(rows, "id int, x double, y int")
    layout.z_ordered(df, ["id", "x", "y"], files=32, bits=6).write.parquet(f"{tmp_path}/z")
    back = spark.read.parquet(f"{tmp_path}/z")
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    for cond in (F.col("id") < 500, F.col("x") > 1.5):
        hit = layout.files_with(back, cond).first()
        assert hit["rows"] == df.where(cond).count() and hit["files_hit"] < 0.6 * hit["files"]
    assert layout.z_ordered(df.limit(0), ["x"], files=4).count() == 0


def test_merged_sketches_equal_one_profile(spark):
    rng = random.Random(2)
    rows = [(1e9 + rng.gauss(0, 1), None if i % 7 == 0 else rng.randrange(40)) for i in range(3000)]
    df = spark.createDataFrame(rows, "x double, k int")
    parts = [sketches.run_sketch(df.where(F.pmod(F.xxhash64("x"), F.lit(5)) == i), ["x", "k"], i) for i in range(4)]
    parts += [sketches.run_sketch(df.where(F.pmod(F.xxhash64("x"), F.lit(5)) == 4), ["x", "k"], 4), sketches.run_sketch(df.where("false"), ["x", "k"], 5)]
    stored = parts[0]
    for p in parts[1:]:
        stored = stored.unionByName(p)
    got = {r["column_name"]: r for r in sketches.merged(stored).collect()}
    want = df.agg(*(f(c).alias(f"{n}_{c}") for c in ("x", "k") for n, f in (("mean", F.avg), ("sd", F.stddev_samp), ("low", F.min), ("high", F.max)))).first()
    for c in ("x", "k"):
        r = got[c]
        assert r["runs"] == 6 and r["rows"] == 3000 and abs(r["mean"] - want[f"mean_{c}"]) < 1e-5
        assert abs(r["stddev"] - want[f"sd_{c}"]) < 1e-5 and (r["low"], r["high"]) == (want[f"low_{c}"], want[f"high_{c}"])
    assert got["k"]["distinct_estimate"] == 40 and got["k"]["nulls"] == sum(k is None for _, k in rows)
    empty = sketches.merged(sketches.run_sketch(df.where("false"), ["x"], 0)).first()
    assert empty["rows"] == 0 and empty["mean"] is None and empty["stddev"] is None


def test_distinct_pairs_count_exactly_without_expand(spark):
    nan = float("nan")
    rows = [(0.0, "a", 1), (-0.0, "a", None), (nan, "", 1), (nan, None, 2), (None, "A", 2)]
    df = spark.createDataFrame(rows, "x double, s string, n int")
    got = profile.distinct_pairs(df).first()
    assert list(got) == [2, 3, 2]
    assert "Expand" not in plan(profile.column_profile(df))
    assert list(profile.distinct_pairs(df.limit(0)).first()) == [0, 0, 0]
