"""Quality log -> model inputs -> generated summaries -> cleaned summaries.

Prompt assembly, hashing, cleaning and validation are column expressions.
Only the generator itself runs in Python, through ``mapInPandas`` so rows
travel to it in Arrow batches and a model is loaded once per Python worker.
The generator is pluggable; the default is a small deterministic rule-based
writer (no model is available offline).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.functions import prompts
from kestrel.functions import text as tf

CONTEXT = prompts.CONTEXT_KEYS
SUMMARY_SCHEMA = ("table_name string, run_id string, anomaly_summary string, data_health string, "
                  "root_causes string, prompt_hash string, llm_model string, generated_at string")


# ---------------------------------------------------------------- Q12
def build_inputs(log: DataFrame) -> DataFrame:
    """Q12: one row per (table_name, run_id) with the context as JSON text.

    Complex columns become JSON, text columns (the flat log's JSON strings)
    pass through, NULL becomes "None".  When a (table, run) has
    several rows, the latest timestamp wins; ties are broken by the texts
    themselves, so the choice is deterministic (``max`` of a struct).
    """
    from pyspark.sql.types import ArrayType, MapType, StructType

    kinds = {f.name: isinstance(f.dataType, (ArrayType, MapType, StructType)) for f in log.schema.fields}
    texts = [tf.value_text(F.col(c), kinds[c]).alias(c) for c in CONTEXT]
    latest = F.max(F.struct(F.col("timestamp"), *[F.col(c) for c in CONTEXT])).alias("_latest")
    return (
        log.select("table_name", "run_id", "timestamp", *texts)
        .groupBy("table_name", "run_id").agg(latest)
        .select("table_name", "run_id", F.col("_latest.timestamp").alias("timestamp"),
                *[F.col(f"_latest.{c}").alias(c) for c in CONTEXT])
        .withColumn("payload_json", F.to_json(F.struct(
            "table_name", "run_id", *CONTEXT, "timestamp")))
    )


# ---------------------------------------------------------------- F8 / Q19
def _context() -> list[tuple[str, Column]]:
    return [(k, F.col(k)) for k in CONTEXT]


def prompt_hash() -> Column:
    """Q19: version stamp = first 10 hex of SHA-1 over the three templates."""
    return tf.short_sha1(F.lit(prompts.ANOMALY_SUMMARY_TEMPLATE + prompts.DATA_HEALTH_TEMPLATE
                               + prompts.ROOT_CAUSE_TEMPLATE))


def render_prompts(inputs: DataFrame) -> DataFrame:
    """F8: the three prompts of every input row (placeholders filled in order)."""
    return inputs.select(
        "table_name", "run_id", "timestamp", *CONTEXT,
        *[tf.render_template(t, _context()).alias(f"{k}_prompt") for k, t in prompts.TEMPLATES.items()],
        prompt_hash().alias("prompt_hash"),
    )


# ---------------------------------------------------------------- generator
Generator = Callable[[pd.DataFrame], pd.DataFrame]


def _loads(s):
    try:
        return json.loads(s) if s and s != "None" else {}
    except (TypeError, ValueError):
        return {}


def rule_based_generator(batch: pd.DataFrame) -> pd.DataFrame:
    """Deterministic stand-in for a language model.

    Reads the context JSON of each row and writes an anomaly paragraph, a
    health paragraph naming good / moderate / poor, and 2-4 root-cause
    bullets.  Per-row work is a few dictionary lookups.
    """
    out = {"anomaly_summary": [], "data_health": [], "root_causes": []}
    for t, nulls, outl, drift, rules in zip(batch["table_name"], batch["null_summary"], batch["outlier_summary"],
                                            batch["schema_drift_summary"], batch["business_rule_violations"]):
        nulls, outl, drift, rules = _loads(nulls), _loads(outl), _loads(drift), _loads(rules)
        high = [c for c, v in nulls.items() if isinstance(v, dict) and v.get("issue", "OK") != "OK"]
        odd = [c for c, v in outl.items() if isinstance(v, dict) and (v.get("outlier_count") or 0) > 0]
        broken = {r: n for r, n in rules.items() if n}
        drifted = sum(len(drift.get(k) or []) for k in ("missing_columns", "new_columns", "type_mismatches"))
        issues = bool(high) + bool(odd) + bool(broken) + bool(drifted)
        health = "good" if issues == 0 else ("moderate" if issues <= 2 else "poor")
        out["anomaly_summary"].append(" ".join([
            f"The table {t} was profiled across {len(nulls)} columns.",
            (f"High null rates appear in {', '.join(high)}." if high else "No column exceeds the null threshold."),
            (f"Z-score outliers were found in {', '.join(odd)}." if odd else "No numeric outliers were found."),
            (f"Business rules report {sum(broken.values())} violations across {len(broken)} rules."
             if broken else "All business rules passed."),
            (f"Schema drift affects {drifted} columns." if drifted else "The schema matches its baseline."),
        ]))
        out["data_health"].append(" ".join([
            f"Overall data quality of {t} is {health}.",
            f"The profile found {issues} kinds of issues.",
            (f"The most important issue is missing data in {high[0]}." if high else
             f"The most important issue is outlying values in {odd[0]}." if odd else
             "No single issue dominates."),
            f"Severity is {'high' if health == 'poor' else 'medium' if health == 'moderate' else 'low'}.",
            "Next, fix the flagged columns at the source and re-run the profile.",
        ]))
        bullets = []
        if high:
            bullets.append(f"- Upstream feeds leave {high[0]} empty for many records.")
        if odd:
            bullets.append(f"- Extreme values in {odd[0]} suggest unit or entry errors.")
        for r in sorted(broken)[: max(0, 4 - len(bullets))]:
            bullets.append(f"- Records break the {r} check at ingestion time.")
        while len(bullets) < 2:
            bullets.append(f"- Source system changes may affect {t}.")
        out["root_causes"].append("\n".join(bullets[:4]))
    return pd.DataFrame(out, index=batch.index)



def per_worker(factory: Callable[[], Generator]) -> Generator:
    """Wrap a generator factory so each Python worker builds it once.

    ``factory`` loads the model (weights, tokenizer) and returns a
    ``batch -> texts`` function.  The cache lives in the closure that Spark
    ships to each Python worker, so the load happens on the first batch a
    worker sees and is reused for its later batches -- never per row.
    """
    state: dict[str, Generator] = {}

    def gen(batch: pd.DataFrame) -> pd.DataFrame:
        if "g" not in state:
            state["g"] = factory()
        return state["g"](batch)

    return gen


def generate(inputs: DataFrame, generator: Generator | None = None, dry_run: bool = False,
             model_name: str = "rule-based-v1", echo_prompt: bool = False) -> DataFrame:
    """Q13: three generated texts per input row (llm_raw_outputs).

    ``dry_run`` skips the generator and returns ``"[DRY_RUN]\\n" + prompt``.
    Live mode puts the validator in front of each stripped prompt and runs
    the generator over Arrow batches; ``echo_prompt`` reproduces causal-LM
    decoding that returns prompt + completion (then "[ANSWER]" is removed).
    """
    rendered = render_prompts(inputs)
    keys = list(prompts.TEMPLATES)
    if dry_run:
        return rendered.select(
            "table_name", "run_id",
            *[F.concat(F.lit("[DRY_RUN]\n"), F.col(f"{k}_prompt")).alias(k) for k in keys],
            "prompt_hash", F.lit(model_name).alias("llm_model"), F.col("timestamp").alias("generated_at"))
    gen = generator or rule_based_generator
    live = rendered.select(
        "table_name", "run_id", *CONTEXT, "prompt_hash", F.col("timestamp").alias("generated_at"),
        *[F.concat(F.lit(prompts.VALIDATOR), tf.py_strip(F.col(f"{k}_prompt"))).alias(f"{k}_final")
          for k in keys])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            done = gen(b)
            res = pd.DataFrame({"table_name": b["table_name"], "run_id": b["run_id"]})
            for k in keys:
                text = (b[f"{k}_final"] + done[k]) if echo_prompt else done[k]
                res[k] = text.str.replace("[ANSWER]", "", regex=False).str.strip()
            res["prompt_hash"] = b["prompt_hash"]
            res["llm_model"] = model_name
            res["generated_at"] = b["generated_at"]
            yield res

    return live.mapInPandas(run, SUMMARY_SCHEMA)


# ---------------------------------------------------------------- Q14
def clean_outputs(raw: DataFrame, max_len: int = 4000) -> DataFrame:
    """Q14: paragraphs sanitised (F10), root causes reduced to clean bullets."""
    return raw.withColumns({
        "anomaly_summary": tf.sanitize_text(F.col("anomaly_summary"), max_len),
        "data_health": tf.sanitize_text(F.col("data_health"), max_len),
        "root_causes": tf.clean_root_causes(F.col("root_causes")),
    })


# ---------------------------------------------------------------- Q21
SENTENCE_END = r"[.!?](\s|$)"


def validate_summaries(summaries: DataFrame) -> DataFrame:
    """Q21: format compliance of generated text, one flag per prompt rule."""
    a, h, r = F.coalesce(F.col("anomaly_summary"), F.lit("")), F.coalesce(F.col("data_health"), F.lit("")), \
        F.coalesce(F.col("root_causes"), F.lit(""))
    bullets = F.size(F.filter(F.split(r, "\n"), lambda x: F.startswith(tf.py_strip(x), F.lit("- "))))
    a_n = F.regexp_count(a, F.lit(SENTENCE_END))
    h_n = F.regexp_count(h, F.lit(SENTENCE_END))
    echo = lambda c: F.contains(F.lower(c), F.lit("use only the information"))
    fence = lambda c: F.contains(c, F.lit("```"))
    out = summaries.select(
        "table_name", "run_id",
        a_n.alias("anomaly_sentences"), h_n.alias("health_sentences"), bullets.alias("root_cause_bullets"),
        a_n.between(4, 7).alias("anomaly_length_ok"),
        h_n.between(5, 7).alias("health_length_ok"),
        F.lower(h).rlike(r"\b(good|moderate|poor)\b").alias("health_word_ok"),
        bullets.between(2, 4).alias("root_cause_count_ok"),
        (~(fence(a) | fence(h) | fence(r))).alias("no_code_ok"),
        (~(echo(a) | echo(h) | echo(r))).alias("no_echo_ok"),
    )
    flags = ["anomaly_length_ok", "health_length_ok", "health_word_ok", "root_cause_count_ok",
             "no_code_ok", "no_echo_ok"]
    return out.withColumn("compliant", F.expr(" AND ".join(flags)))


# ---------------------------------------------------------------- F22 / P24
def summary_export(summaries: DataFrame) -> DataFrame:
    """downloadable text per summary and its file name."""
    return summaries.select(
        "table_name", "run_id",
        F.concat(F.lit("anomaly_summary:\n"), F.coalesce("anomaly_summary", F.lit("")),
                 F.lit("\n\nhealth:\n"), F.coalesce("data_health", F.lit("")),
                 F.lit("\n\nroot_causes:\n"), F.coalesce("root_causes", F.lit(""))).alias("export_text"),
        F.concat_ws("_", "table_name", "run_id", F.lit("summary.txt")).alias("file_name"))


def run_metadata(summaries: DataFrame) -> DataFrame:
    """The metadata object shown next to a summary, as JSON."""
    return summaries.select("table_name", "run_id", F.to_json(F.struct(
        "run_id", F.col("table_name").alias("table"), F.col("llm_model").alias("model_used"),
        "generated_at", "prompt_hash")).alias("metadata_json"))
