"""Plan-level guarantees behind the scale claims."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as E
from kestrel.operators import quality as Q
from kestrel.streaming.sources import scratch
from tests.conftest import SF_SMALL

PY_NODES = r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fused_profile_scans_a_stored_table_exactly_twice(spark):
    path = scratch(spark, "stored")
    (spark.range(5000).select((F.col("id") % 97).cast("int").alias("n"), F.col("id").cast("string").alias("s"),
                              F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") * 1.5).alias("d"))
     .write.parquet(path))
    df = spark.read.parquet(path)
    log = Q.table_quality(df, "t", "r", "ts", rules=[("t", "neg", "n < 0")])
    assert len(re.findall(r"FileScan parquet|Scan parquet", plan_of(log))) == 2


def test_text_and_rule_queries_stay_in_the_jvm(spark):
    for name in ["sanitize_text", "clean_root_causes", "classify_anomaly", "parse_rules", "quality_summary",
                 "gold_customer_transactions", "sessions"]:
        assert not re.search(PY_NODES, plan_of(E.queries()[name](spark, SF_SMALL))), name
    assert re.search(PY_NODES, plan_of(E.queries()["generate_summaries"](spark, SF_SMALL)))  # the generator only


def test_scans_read_only_needed_columns(spark):
    plan = plan_of(E.queries()["gold_customer_sales"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    lineitem = [s for s in schemas if "l_orderkey" in s][0]
    assert "l_comment" not in lineitem and "l_shipdate" not in lineitem and "l_discount" not in lineitem
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in plan
