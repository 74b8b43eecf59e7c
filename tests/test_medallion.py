"""The end-to-end job writes every layer and profiles the stored silver."""

from pyspark.sql import functions as F

from kestrel.operators import drift as D
from kestrel.operators import gold, ingest
from kestrel.operators import ml as ML
from kestrel.plans import catalog, medallion
from kestrel.streaming.sources import scratch
from tests.conftest import SF_SMALL


def test_medallion_job(spark):
    out = scratch(spark, "medallion")
    t = medallion.run(spark, SF_SMALL, out, "run_t", "2024-02-01T00:00:00", as_of=catalog.AS_OF)
    for feed in catalog.FEEDS:  # silver and quarantine share out the cleaned rows
        name = catalog.schemas.SILVER_TABLE_NAMES[feed]
        cleaned = ingest.CLEANERS[feed](catalog.raw(spark, SF_SMALL, feed))
        held = t[f"quarantine_{name}"].drop("quarantine_reason")
        assert held.count() > 0 or feed == "transactions"
        assert t[name].unionAll(held).exceptAll(cleaned).count() == 0
        assert t[name].count() + held.count() == cleaned.count()
    assert t["quality_log"].filter(F.col("run_id") == "run_t").count() == 3
    assert t["llm_summaries"].count() == 3
    again = gold.customer_sales(t["sales_silver"], t["customers_silver"])
    assert t["gold_customer_sales"].exceptAll(again).count() == 0


def test_medallion_from_csv(spark):
    """The job run from CSV files gives the same silver as from the tables."""
    folder, out, ref = scratch(spark, "csv"), scratch(spark, "csv-out"), scratch(spark, "csv-ref")
    for feed in catalog.FEEDS:
        catalog.raw(spark, SF_SMALL, feed).write.option("header", True).option("ignoreLeadingWhiteSpace", False) \
            .option("ignoreTrailingWhiteSpace", False).csv(f"{folder}/{feed}")
    a = medallion.run(spark, folder, out, "r", "2024-02-01T00:00:00", as_of=catalog.AS_OF, raw_feeds=medallion.csv_feeds())
    b = medallion.run(spark, SF_SMALL, ref, "r", "2024-02-01T00:00:00", as_of=catalog.AS_OF)
    for feed in catalog.FEEDS:
        name = catalog.schemas.SILVER_TABLE_NAMES[feed]
        assert a[name].exceptAll(b[name]).count() == 0 and a[name].count() == b[name].count() > 0


def test_model_save_load_roundtrip(spark):
    model, test, lab = catalog._fit(spark, SF_SMALL)
    path = scratch(spark, "model")
    ML.save_model(model, path)
    again = ML.load_model(path)
    a = ML.predict(model, lab).select("customer_id", "prediction")
    b = ML.predict(again, lab).select("customer_id", "prediction")
    assert a.exceptAll(b).count() == 0
    names = [n for n, _ in ML.feature_importances(model, ML.FEATURES)]
    assert names == ML.FEATURES


def test_small_operators(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert ingest.filter_not_null(df, "a", "b").count() == 1
    assert ingest.filter_null(df, "b").count() == 1
    assert ingest.select_columns(df, ["b"]).columns == ["b"]
    s1 = spark.createDataFrame([("t", "a", "x", 0), ("t", "b", "x", 1)], D.SNAPSHOT_SCHEMA)
    s2 = spark.createDataFrame([("t", "b", "x", 0), ("t", "c", "x", 1)], D.SNAPSHOT_SCHEMA)
    r = D.column_sets(s1, s2).first()
    assert (r["added"], r["removed"], r["common"]) == (["c"], ["a"], ["b"])


def test_medallion_rerun_does_not_duplicate(spark):
    out = scratch(spark, "medallion-rerun")
    medallion.run(spark, SF_SMALL, out, "run_a", "2024-02-01T00:00:00", as_of=catalog.AS_OF)
    t = medallion.run(spark, SF_SMALL, out, "run_a", "2024-02-01T00:00:00", as_of=catalog.AS_OF)
    assert t["quality_log"].count() == 3 and t["llm_summaries"].count() == 3
    t = medallion.run(spark, SF_SMALL, out, "run_b", "2024-02-02T00:00:00", as_of=catalog.AS_OF)
    assert t["quality_log"].count() == 6 and t["llm_summaries"].count() == 6


def test_drift_against_stored_snapshot(spark):
    from pyspark.sql import functions as F
    from kestrel.operators import quality as Q

    out = scratch(spark, "snapshots")
    snap = D.schema_snapshot(spark, "t", spark.range(1).select(F.col("id").cast("int").alias("a"), F.lit("x").alias("b")))
    D.store_snapshots(snap, out, "run_1")
    D.store_snapshots(snap, out, "run_1")          # retried run: no duplicate
    assert spark.read.parquet(out).count() == 2
    base = D.stored_baselines(spark, out)
    assert base == {"t": {"a": "IntegerType()", "b": "StringType()"}}
    now = spark.range(1).select(F.col("id").alias("a"), F.lit(1).alias("c"))   # a: int -> long, b gone, c new
    row = Q.table_quality(now, "t", "run_2", "ts", baseline=base["t"]).first()
    d = row["schema_drift_summary"]
    assert d["missing_columns"] == ["b"] and d["new_columns"] == ["c"]
    assert [(m["column"], m["baseline_type"], m["current_type"]) for m in d["type_mismatches"]] == [
        ("a", "IntegerType()", "LongType()")]
    assert row["quality_score"] == 100 - 30 - 10 - 20


def test_job_entry_point(spark):
    import json
    import os
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    out = scratch(spark, "job-cli")
    res = subprocess.run([sys.executable, "-m", "kestrel.plans.medallion", SF_SMALL, out, "cli_run",
                          "2024-02-01T00:00:00"], capture_output=True, text=True, cwd=root, timeout=900,
                         env={**os.environ, "PYTHONPATH": str(root)})
    assert res.returncode == 0, res.stderr[-2000:]
    rec = json.loads([l for l in res.stdout.splitlines() if l.startswith("{")][-1])
    assert rec["run_id"] == "cli_run" and set(rec["quality_scores"]) == {
        "customers_silver", "sales_silver", "transactions_silver"}
