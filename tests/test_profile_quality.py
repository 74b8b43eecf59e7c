"""Profiling and quality-score properties and edge cases."""

from pyspark.sql import functions as F

from kestrel.operators import profile as P
from kestrel.operators import quality as Q


def test_count_plus_nulls_is_rows(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id")).alias("x"),
                                  F.when(F.col("id") % 3 == 0, None).otherwise(F.lit("s")).alias("s"))
    for r in P.column_profile(df).collect():
        assert r["count"] + r["null_count"] == 1000


def test_constant_and_all_null_columns_have_no_variance(spark):
    df = spark.range(50).select(F.lit(5).alias("c"), F.lit(None).cast("int").alias("n"))
    got = {r["column_name"]: r for r in P.zscore_outliers(df).collect()}
    for c in ("c", "n"):
        assert got[c]["outlier_count"] == 0 and got[c]["reason"] == "No variance" and got[c]["mean"] is None


def test_empty_table_is_zero_not_error(spark):
    df = spark.createDataFrame([], "a int, b string")
    rows = P.null_anomalies(df).collect()
    assert [(r["null_count"], r["total_rows"], r["null_percentage"], r["issue"]) for r in rows] == [(0, 0, 0.0, "OK")] * 2
    log = Q.table_quality(df, "empty", "r", "t").first()
    assert log["quality_score"] == 100


def test_zscore_counts_upper_side_only(spark):
    vals = [0] * 100 + [1000, -1000]
    df = spark.createDataFrame([(v,) for v in vals], "x int")
    r = P.zscore_outliers(df).first()
    assert r["outlier_count"] == 1  # only (x - mean) / sd > 3


def test_null_threshold_boundary(spark):
    # 20.003 % nulls: flagged by the unrounded test, not penalised after rounding to 20.0
    df = spark.range(100000).select(F.when(F.col("id") < 20003, None).otherwise(F.lit("v")).alias("c"))
    r = P.null_anomalies(df).first()
    assert r["null_percentage"] == 20.0 and r["issue"] == "High null percentage"
    log = Q.table_quality(df, "t", "r", "ts").first()
    assert log["quality_score"] == 100
    assert "No significant null anomalies" in log["ai_summary"]


def test_score_bounds_and_penalties(spark):
    cols = {f"c{i}": F.lit(None).cast("string") for i in range(12)}
    df = spark.range(10).select(*[v.alias(k) for k, v in cols.items()])
    log = Q.table_quality(df, "t", "r", "ts").first()
    assert log["quality_score"] == 0  # 12 high-null columns: floored at 0
    from pyspark.sql import types as T
    base = T.StructType([T.StructField("c0", T.IntegerType()), T.StructField("gone", T.StringType())])
    df2 = spark.range(10).select(F.col("id").cast("string").alias("c0"), F.lit(1).alias("extra"))
    log2 = Q.table_quality(df2, "t", "r", "ts", baseline=base).first()
    assert log2["quality_score"] == 100 - 30 - 10 - 20
    assert log2["ai_summary"].startswith("⚠ Schema drift detected in t.")


def test_quality_score_in_range_on_real_tables(spark):
    from tests.conftest import SF_SMALL
    from kestrel.plans import catalog

    for r in catalog.quality_log(spark, SF_SMALL).select("quality_score").collect():
        assert 0 <= r["quality_score"] <= 100


def test_outlier_examples_bounded(spark):
    vals = list(range(100)) + [10000 + i for i in range(3)]
    df = spark.createDataFrame([(v,) for v in vals], "x int")
    got = P.outlier_examples(df, k=3.0, n=2).first()
    assert got["examples"] == [10002.0, 10001.0]


def test_summary_templates(spark):
    df = spark.range(10).select(F.lit(None).cast("string").alias("c"), F.lit(1).alias("n"))
    master = Q.table_quality(df, "t", "r", "ts").first()["ai_summary"].split("\n")
    assert master == ["✔ No schema drift detected in t. Schema matches baseline.",
                      "⚠ High null percentages found in: c.",
                      "✔ No numeric outliers detected in t.",
                      "✔ Overall, t looks healthy and ready for downstream use."]
    sales = Q.table_quality(df, "t", "r", "ts", summary_template="sales").first()["ai_summary"].split("\n")
    assert sales[1] == "⚠ High null percentages in: c." and sales[3] == "✔ Dataset looks healthy and ready for GOLD aggregations."
    cust = Q.table_quality(df, "t", "r", "ts", summary_template="customers").first()["ai_summary"].split("\n")
    assert cust[0] == "✔ No schema drift detected. The structure matches the baseline schema."


def test_chunked_distincts_equal_single_pass(spark):
    from tests.conftest import SF_SMALL
    from kestrel.plans import catalog

    df = catalog.silver(spark, SF_SMALL, "customers")
    one = P.column_profile(df).collect()
    chunked = P.column_profile(df, distinct_chunk=2).collect()
    assert sorted(one) == sorted(chunked)
    a = Q.table_quality(df, "customers_silver", "r", "t").first()
    b = Q.table_quality(df, "customers_silver", "r", "t", distinct_chunk=3).first()
    assert a["statistics"] == b["statistics"] and a["quality_score"] == b["quality_score"]
