"""Sources/sinks round trips and ML metrics."""

from pyspark.sql import functions as F

from kestrel import schemas
from kestrel.operators import ingest
from kestrel.operators import ml as ML
from kestrel.sources import io as IO
from kestrel.streaming.sources import scratch
from tests.conftest import SF_SMALL


def test_csv_raw_read_keeps_leading_zeros_and_corrupt_rows(spark):
    path = scratch(spark, "csv")
    header = ",".join(f.name for f in schemas.CUSTOMERS_SILVER.fields)
    lines = [header,
             "C1,Ann,Lee,a@x,0012345678,Pune,India,2024-01-01,33",
             "C2,Bo,Li,b@x,0099,Delhi,India,not-a-date,x",
             "C3,too,many,fields,1,2,3,4,5,6,7"]
    spark.createDataFrame([(l,) for l in lines], "value string").coalesce(1).write.text(path)
    contract = schemas.CUSTOMERS_SILVER
    raw = IO.read_raw_csv(spark, path, contract).cache()
    rows = {r["customer_id"]: r for r in raw.collect()}
    assert rows["C1"]["phone"] == "0012345678"
    assert rows["C3"]["_corrupt_record"] is not None and rows["C1"]["_corrupt_record"] is None
    typed = ingest.enforce(raw, contract)
    t = {r["customer_id"]: r for r in typed.collect()}
    assert t["C2"]["signup_date"] is None and t["C2"]["age"] is None and t["C1"]["age"] == 33


def test_schema_evolution_and_partitioned_log(spark):
    from kestrel.plans import catalog

    log = catalog.quality_log(spark, SF_SMALL)
    path = scratch(spark, "qlog")
    IO.write_partitioned_log(log.select("table_name", "run_id", "timestamp", "quality_score"), path)
    IO.write_partitioned_log(log.select("table_name", "run_id", "timestamp", "quality_score", "ai_summary")
                             .withColumn("run_id", F.lit("run_002")), path)
    back = IO.read_log(spark, path)
    assert "ai_summary" in back.columns and back.count() == 6
    sel = back.filter(F.col("table_name") == "sales_silver")
    plan = sel._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "sales_silver" in plan
    old = log.select("table_name", "run_id", "quality_score")
    both = IO.union_evolving(old, log.select("table_name", "run_id", "ai_summary"))
    assert both.filter(F.col("quality_score").isNull()).count() == 3


def test_ingest_metadata_and_validate(spark):
    from kestrel.plans import catalog

    df = catalog.silver(spark, SF_SMALL, "customers")
    path = scratch(spark, "ingest")
    IO.write_path(df, path)
    m = IO.ingest_metadata(IO.read_path(spark, path), "customers_silver", path).first()
    assert m["row_count"] == 150 and m["file_size_mb"] > 0 and m["files"] >= 1
    v = IO.validate_output(df, schemas.CUSTOMERS_SILVER).first()
    assert v["schema_matches"] and v["row_count"] == 150


def test_classification_metrics_by_hand(spark):
    pred = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0), (1, 1)], "is_high_value int, prediction int")
    m = ML.classification_metrics(pred).first()
    assert (m["tp"], m["fp"], m["fn"], m["tn"]) == (2, 1, 1, 1)
    assert abs(m["accuracy"] - 0.6) < 1e-9 and abs(m["f1"] - 2 * 2 / (2 * 2 + 1 + 1)) < 1e-9


def test_regression_metrics_by_hand(spark):
    pred = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 4.0)], "total_spend double, prediction double")
    m = ML.regression_metrics(pred).first()
    assert abs(m["mae"] - 2 / 3) < 1e-9 and abs(m["rmse"] - (2 / 3) ** 0.5) < 1e-9
    assert abs(m["r2"] - (1 - 2 / 8)) < 1e-9


def test_forest_fits_and_labels_are_deterministic_function(spark):
    from kestrel.plans import catalog

    m = catalog.q_rf_metrics(spark, SF_SMALL).first()
    assert m["n"] > 0 and m["accuracy"] >= 0.8
    lab = catalog.q_high_value_label(spark, SF_SMALL)
    assert {r[0] for r in lab.select("is_high_value").distinct().collect()} <= {0, 1}
    bad = lab.filter(((F.col("total_spend") >= 2_500_000) | (F.col("avg_order_value") >= 41_000)) != (F.col("is_high_value") == 1))
    assert bad.count() == 0


def test_customer_without_amounts_is_scored(spark, monkeypatch):
    from kestrel.plans import catalog

    silver = catalog.silver

    def with_nobody(spark, sf_dir, feed):
        df = silver(spark, sf_dir, feed)
        if feed != "sales":
            return df
        odd = df.limit(1).withColumn("customer_id", F.lit("nobody").cast(df.schema["customer_id"].dataType))
        return df.unionByName(odd.withColumn("amount", F.lit(None).cast(df.schema["amount"].dataType)))

    monkeypatch.setattr(catalog, "silver", with_nobody)
    for query in (catalog.q_rf_predictions, catalog.q_stream_predict):
        rows = {r["customer_id"]: r["prediction"] for r in query(spark, SF_SMALL).collect()}
        assert len(rows) == catalog.gold_sales(spark, SF_SMALL).count()
        assert rows.pop("nobody") is None and set(rows.values()) <= {0, 1}
