"""Model inputs, prompts, generation and cleaning on the reference's own log fixture."""

import json

from pyspark.sql import functions as F

from kestrel.functions import prompts
from kestrel.operators import summaries as SUM

FIXTURE_SCHEMA = (
    "table_name string, run_id string, timestamp string, "
    "statistics struct<row_count:int,min_age:int,max_age:int>, "
    "null_summary struct<email:int,phone:int>, "
    "outlier_summary struct<age:struct<count:int,examples:array<int>>>, "
    "schema_drift_summary struct<missing_columns:array<string>,extra_columns:array<string>>, "
    "business_rule_violations struct<age_negative:int,invalid_email_format:int>")
ROW = ("customers", "run_001", "2025-01-10 12:00:00", (1000, 18, 75), (50, 120), ((5, [120, 3]),),
       (["middle_name"], ["tmp_debug_col"]), (2, 34))


def fixture(spark, rows=(ROW,)):
    return spark.createDataFrame(list(rows), FIXTURE_SCHEMA)


def test_inputs_from_fixture(spark):
    later = ROW[:2] + ("2025-01-11 00:00:00",) + ((2000, 1, 2),) + ROW[4:]
    null_stats = ROW[:3] + (None,) + ROW[4:]
    inp = SUM.build_inputs(fixture(spark, [ROW, later])).first()
    assert inp["timestamp"] == "2025-01-11 00:00:00"
    assert json.loads(inp["statistics"]) == {"row_count": 2000, "min_age": 1, "max_age": 2}  # latest row wins
    assert json.loads(inp["outlier_summary"]) == {"age": {"count": 5, "examples": [120, 3]}}
    assert json.loads(inp["payload_json"])["run_id"] == "run_001"
    assert SUM.build_inputs(fixture(spark, [null_stats])).first()["statistics"] == "None"


def test_dry_run_prompts_and_hash(spark):
    out = SUM.generate(SUM.build_inputs(fixture(spark)), dry_run=True, model_name="m").first()
    assert out["anomaly_summary"].startswith("[DRY_RUN]\nYou are an expert Data Quality Analyst.")
    assert '- Statistics: {"row_count":1000,"min_age":18,"max_age":75}' in out["anomaly_summary"]
    assert "{{" not in out["data_health"] and "{{" not in out["root_causes"]
    assert out["prompt_hash"] == "5c0bfc6ca4" and out["llm_model"] == "m"
    assert out["generated_at"] == "2025-01-10 12:00:00"


def test_live_generation_with_echo_is_cleaned(spark):
    inputs = SUM.build_inputs(fixture(spark))
    raw = SUM.generate(inputs, echo_prompt=True).first()
    assert raw["root_causes"].startswith(prompts.VALIDATOR.strip().replace("[ANSWER]", "").strip()[:20])
    assert "[ANSWER]" not in raw["anomaly_summary"]
    clean = SUM.clean_outputs(SUM.generate(inputs, echo_prompt=True)).first()
    # echoed prompt bullets are all dropped by the skip list; generated bullets survive
    for line in clean["root_causes"].split("\n"):
        assert line.startswith("- ") and "statistics" not in line.lower()
    assert "\n" not in clean["anomaly_summary"]


def test_custom_generator_is_pluggable(spark):
    import pandas as pd

    def shout(batch: pd.DataFrame) -> pd.DataFrame:
        n = len(batch)
        return pd.DataFrame({"anomaly_summary": ["A."] * n, "data_health": ["Poor."] * n,
                             "root_causes": ["- x\n- y"] * n}, index=batch.index)

    out = SUM.generate(SUM.build_inputs(fixture(spark)), generator=shout, model_name="shout").first()
    assert (out["anomaly_summary"], out["data_health"], out["root_causes"], out["llm_model"]) == (
        "A.", "Poor.", "- x\n- y", "shout")
    v = SUM.validate_summaries(SUM.generate(SUM.build_inputs(fixture(spark)), generator=shout)).first()
    assert v["root_cause_bullets"] == 2 and v["health_word_ok"] and not v["anomaly_length_ok"] and not v["compliant"]


def test_default_generator_output_is_compliant(spark):
    from kestrel.plans import catalog
    from tests.conftest import SF_SMALL

    v = SUM.validate_summaries(catalog.llm_summaries(spark, SF_SMALL))
    assert v.filter(~F.col("compliant")).count() == 0


def test_inputs_from_flat_json_log(spark):
    flat = spark.createDataFrame(
        [("t", "r", "2024", '{"a":1}', None, "{}", "{}", '{"rule":2}')],
        "table_name string, run_id string, timestamp string, statistics string, null_summary string, "
        "outlier_summary string, schema_drift_summary string, business_rule_violations string")
    r = SUM.build_inputs(flat).first()
    assert (r["statistics"], r["null_summary"], r["business_rule_violations"]) == ('{"a":1}', "None", '{"rule":2}')


def test_per_worker_generator_factory(spark):
    import pandas as pd

    def factory():
        def gen(batch: pd.DataFrame) -> pd.DataFrame:
            n = len(batch)
            return pd.DataFrame({"anomaly_summary": ["a"] * n, "data_health": ["good."] * n,
                                 "root_causes": ["- r"] * n}, index=batch.index)
        return gen

    out = SUM.generate(SUM.build_inputs(fixture(spark)), generator=SUM.per_worker(factory)).first()
    assert (out["anomaly_summary"], out["data_health"], out["root_causes"]) == ("a", "good.", "- r")
