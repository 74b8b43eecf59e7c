"""Schema drift, drift report, metadata summary and documentation texts."""

from pyspark.sql import types as T

from kestrel.operators import docs as DOC
from kestrel.operators import drift as D

OLD = [("customer_id", "string"), ("amount", "double"), ("txn_date", "date")]
NEW = [("customer_id", "string"), ("amount", "float"), ("txn_date", "date"), ("merchant_id", "string")]


def snap(spark, cols, table="t"):
    return spark.createDataFrame([(table, c, t, i) for i, (c, t) in enumerate(cols)], D.SNAPSHOT_SCHEMA)


def test_drift_reference_example(spark):
    d = D.schema_drift(snap(spark, OLD), snap(spark, NEW))
    got = sorted((r["column_name"], r["change_type"], r["baseline_type"], r["current_type"]) for r in d.collect())
    assert got == [("amount", "type_mismatch", "double", "float"), ("merchant_id", "new", None, "string")]
    report = D.drift_report(d).first()["report"]
    assert report == ("# Schema Drift Summary\n\n## Added Columns:\n- merchant_id: string\n\n"
                      "## Columns With Changed Datatypes:\n- amount: double → float\n")


def test_drift_properties(spark):
    assert D.schema_drift(snap(spark, OLD), snap(spark, OLD)).count() == 0
    ab = {(r["column_name"], r["change_type"]) for r in D.schema_drift(snap(spark, OLD), snap(spark, NEW)).collect()}
    ba = {(r["column_name"], r["change_type"]) for r in D.schema_drift(snap(spark, NEW), snap(spark, OLD)).collect()}
    mirror = {"new": "missing", "missing": "new", "type_mismatch": "type_mismatch"}
    assert ba == {(c, mirror[k]) for c, k in ab}
    tables = spark.createDataFrame([("t",)], "table_name string")
    empty = D.drift_report(D.schema_drift(snap(spark, OLD), snap(spark, OLD)), tables).first()["report"]
    assert empty == "# Schema Drift Summary\n\nNo schema drift detected."
    removed = D.drift_report(D.schema_drift(snap(spark, NEW), snap(spark, OLD))).first()["report"]
    assert "## Removed Columns:\n- merchant_id: previously string\n" in removed


def test_snapshot_type_text(spark):
    st = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    rows = D.schema_snapshot(spark, "t", st).collect()
    assert [(r["column_name"], r["data_type"]) for r in rows] == [("a", "IntegerType()"), ("b", "StringType()")]


def test_infer_types(spark):
    df = spark.createDataFrame([("1", "9912345678", "2024-01-05", "1.5", "x"), ("2", None, "2024-02-01", "2", "7")],
                               "a string, b string, c string, d string, e string")
    got = {r["column_name"]: r["data_type"] for r in D.infer_types(df, "t").collect()}
    assert got == {"a": "IntegerType()", "b": "LongType()", "c": "DateType()", "d": "DoubleType()", "e": "StringType()"}


def test_metadata_summary_reference_example(spark):
    meta = spark.createDataFrame([("transactions", 120000, 85.3)], "table_name string, row_count long, file_size_mb double")
    schema = snap(spark, [("customer_id", "string"), ("amount", "double"), ("txn_date", "date")], "transactions")
    nulls = spark.createDataFrame([("transactions", 1, "amount", 2.1), ("transactions", 2, "txn_date", 0.0)],
                                  "table_name string, ordinal int, column_name string, null_percentage double")
    got = DOC.metadata_summary(meta, schema, nulls).first()["summary"]
    assert got == ("# Table Overview: transactions\n\n## Basic Stats\n- Row count: 120000\n- File size: 85.3 MB\n\n"
                   "## Schema Overview\n- customer_id: string\n- amount: double\n- txn_date: date\n\n"
                   "## Null Value Summary\n- amount: 2.1% nulls\n- txn_date: 0.0% nulls\n\n"
                   "## Data Health Observations\n- Schema and metadata look valid.")
    meta0 = spark.createDataFrame([("e", 0, 1.0), ("z", 5, 0.0)], "table_name string, row_count long, file_size_mb double")
    nul = spark.createDataFrame([("z", 0, "c", 60.0)], "table_name string, ordinal int, column_name string, null_percentage double")
    out = {r["table_name"]: r["summary"] for r in DOC.metadata_summary(meta0, snap(spark, [], "e"), nul).collect()}
    assert out["e"].endswith("No null statistics available.\n\n## Data Health Observations\n- Table is empty. Needs immediate inspection.")
    assert out["z"].endswith("- File size is zero but row_count > 0 (possible corruption).\n- High null percentages in: c")


def test_documentation_reference_example(spark):
    schema = snap(spark, [("amount", "double"), ("merchant_id", "string"), ("txn_date", "date")], "transactions")
    rules = spark.createDataFrame([("transactions", 0, "Flag transactions where amount > 500000 and merchant_id is missing", "high")],
                                  "table_name string, ordinal int, description string, severity string")
    anomalies = spark.createDataFrame([("transactions", "missing_values", "merchant_id contains nulls", "high")],
                                      "table_name string, anomaly_type string, explanation string, severity string")
    doc = DOC.table_documentation(schema, rules, anomalies, "2024-02-01T00:00:00").first()["documentation"]
    assert doc == ("# Documentation for Table: transactions\n\nGenerated at: 2024-02-01T00:00:00\n\n## Purpose\n"
                   "This table stores transactional or analytical data for `transactions`, used across ingestion, "
                   "profiling, and ML workflows.\n\n## Schema Overview\n- amount: double\n- merchant_id: string\n"
                   "- txn_date: date\n\n## Data Quality Rules\n- Flag transactions where amount > 500000 and "
                   "merchant_id is missing (severity: high)\n\n## Anomaly Summary\n- missing_values: merchant_id "
                   "contains nulls (severity: high)\n")
    empty = DOC.table_documentation(schema, rules.limit(0), anomalies.limit(0), "x").first()["documentation"]
    assert "## Data Quality Rules\n- No rules defined.\n\n## Anomaly Summary\n- No anomalies detected.\n" in empty
