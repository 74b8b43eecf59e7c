"""Column text functions against the reference's documented examples."""

import hashlib

from pyspark.sql import functions as F

from kestrel.functions import prompts
from kestrel.functions import text as tf


def one(spark, col, value, schema="t string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_sanitize_collapses_all_python_whitespace(spark):
    assert one(spark, tf.sanitize_text(F.col("t")), "  a\t\tb  c\n\n d \x1c ") == "a b c d"


def test_sanitize_null_and_cap(spark):
    assert one(spark, tf.sanitize_text(F.col("t")), None) == ""
    assert one(spark, tf.sanitize_text(F.col("t")), "x" * 4000) == "x" * 4000
    assert one(spark, tf.sanitize_text(F.col("t")), "x" * 5000) == "x" * 3997 + "..."
    # the whole text is cleaned before the cap is applied
    assert one(spark, tf.sanitize_text(F.col("t"), 10), "a   b   c   d   e   f") == "a b c d..."


ECHOED = "\n".join([
    "You are a Senior Data Engineer.",
    "- Statistics: {\"row_count\": 5}",
    "- Nulls: {}",
    "   - Missing emails from the CRM export.   ",
    "- Bullet points are allowed.",
    "- Code paths changed",
    "* not a bullet",
    "- Upstream job dropped phone numbers.",
    "- Outliers: {x}",
    "- Third cause.",
    "- Fourth cause.",
    "- Fifth cause.",
])


def test_clean_root_causes_drops_echo_and_keeps_four(spark):
    got = one(spark, tf.clean_root_causes(F.col("t")), ECHOED)
    assert got == ("- Missing emails from the CRM export.\n- Upstream job dropped phone numbers.\n"
                   "- Third cause.\n- Fourth cause.")
    assert one(spark, tf.clean_root_causes(F.col("t")), None) == ""
    assert one(spark, tf.clean_root_causes(F.col("t")), "") == ""


def test_render_template_is_sequential(spark):
    df = spark.createDataFrame([("{{b}}", "X")], "a string, b string")
    r = df.select(tf.render_template("A {{a}} B {{b}}", [("a", F.col("a")), ("b", F.col("b"))])).first()[0]
    assert r == "A X B X"
    df = spark.createDataFrame([(None,)], "a string")
    assert df.select(tf.render_template("[{{a}}]", [("a", F.col("a"))])).first()[0] == "[]"


def test_prompt_hash_matches_python_sha1(spark):
    text = prompts.ANOMALY_SUMMARY_TEMPLATE + prompts.DATA_HEALTH_TEMPLATE + prompts.ROOT_CAUSE_TEMPLATE
    assert one(spark, tf.short_sha1(F.col("t")), text) == hashlib.sha1(text.encode()).hexdigest()[:10]


def classify(spark, text):
    r = spark.createDataFrame([(text,)], "t string").select(tf.classify_anomaly(F.col("t")).alias("c")).first()["c"]
    return r["type"], r["severity"], r["explanation"]


def test_classify_reference_example(spark):
    assert classify(spark, "Found missing merchant_id values in 42% of rows") == (
        "missing_values", "high", "Records contain missing or null values.")


def test_classify_precedence_and_regex_edges(spark):
    assert classify(spark, "New column added; values are null")[0] == "schema_drift"
    assert classify(spark, "value above limit")[0] == "outlier"
    assert classify(spark, "amount> 5")[0] == "outlier"
    assert classify(spark, "many outliers")[0] == "unknown"
    assert classify(spark, "amount > 5")[0] == "unknown"
    assert classify(spark, "Distribution skew vs last week") == (
        "distribution_shift", "medium", "Data distribution has changed compared to historical patterns.")
    assert classify(spark, "constraint broken")[0] == "business_rule_violation"
    assert classify(spark, None) == ("unknown", "medium", "Unable to determine anomaly type from description.")


def test_rule_parsing_examples(spark):
    df = spark.createDataFrame([("Flag transactions where amount > 500000 and merchant_id is missing",),
                                ("price above 1,200 on txn_date",), ("no threshold here, null ok",),
                                ("amount greater than 0",)], "t string")
    rows = df.select(tf.rule_threshold(F.col("t")).alias("m"), tf.rule_columns(F.col("t")).alias("c"),
                     tf.rule_type(F.col("t")).alias("k"),
                     tf.rule_severity(tf.rule_threshold(F.col("t"))).alias("s")).collect()
    assert (rows[0]["m"], rows[0]["c"], rows[0]["k"], rows[0]["s"]) == (500000.0, "amount,merchant_id", "null_check", "high")
    assert (rows[1]["m"], rows[1]["c"]) == (1200.0, "price")
    assert (rows[2]["m"], rows[2]["c"], rows[2]["k"], rows[2]["s"]) == (None, "", "null_check", "medium")
    assert (rows[3]["m"], rows[3]["s"]) == (0.0, "medium")   # threshold 0 is not "truthy"
