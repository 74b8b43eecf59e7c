"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the driver tables of ``sf_dir`` through the feed builders,
so its work grows with the tables.  Doubles are rounded to 4 dp at the edge
(``edge``) so the DuckDB comparison is not sensitive to summation order.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel import schemas
from kestrel.operators import gold, ingest
from kestrel.sources import feeds

AS_OF = _dt.date(2024, 2, 1)          # fixed "today" for compared queries
RUN_ID, RUN_TS = "run_001", "2024-02-01T00:00:00"

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def edge(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round double/float columns (top level) for a stable comparison."""
    return df.select([
        F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


# ---------------------------------------------------------------- building blocks
def raw(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    return feeds.RAW_FEEDS[feed](spark, sf_dir)


def silver(spark: SparkSession, sf_dir: str, feed: str) -> DataFrame:
    return ingest.silver(raw(spark, sf_dir, feed), feed)


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, for a query that reads it more than once."""
    from kestrel.sources import io as IO

    path = _scratch(spark, name)
    IO.write_path(df, path)
    return IO.read_path(spark, path)


def silver_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {schemas.SILVER_TABLE_NAMES[f]: silver(spark, sf_dir, f) for f in ("customers", "sales", "transactions")}


# ---------------------------------------------------------------- ingestion
@register("clean_customers")
def q_clean_customers(spark, sf_dir):
    return silver(spark, sf_dir, "customers")


@register("clean_sales")
def q_clean_sales(spark, sf_dir):
    return silver(spark, sf_dir, "sales")


@register("clean_transactions")
def q_clean_transactions(spark, sf_dir):
    return silver(spark, sf_dir, "transactions")


# ---------------------------------------------------------------- gold
@register("customer_sales_enriched")
def q_customer_sales_enriched(spark, sf_dir):
    return gold.enrich_sales(silver(spark, sf_dir, "sales"), silver(spark, sf_dir, "customers"))


@register("customer_transactions_enriched")
def q_customer_transactions_enriched(spark, sf_dir):
    return gold.enrich_transactions(silver(spark, sf_dir, "transactions"), silver(spark, sf_dir, "customers"))


@register("gold_customer_sales")
def q_gold_customer_sales(spark, sf_dir):
    return edge(gold.customer_sales(silver(spark, sf_dir, "sales"), silver(spark, sf_dir, "customers")))


@register("gold_product_sales")
def q_gold_product_sales(spark, sf_dir):
    return edge(gold.product_sales(silver(spark, sf_dir, "sales")))


@register("gold_customer_transactions")
def q_gold_customer_transactions(spark, sf_dir):
    return gold.customer_transactions(silver(spark, sf_dir, "transactions"))


@register("payment_method_counts")
def q_payment_method_counts(spark, sf_dir):
    return gold.payment_method_counts(silver(spark, sf_dir, "transactions"))


@register("top_payment_method")
def q_top_payment_method(spark, sf_dir):
    return gold.top_payment_method(gold.payment_method_counts(silver(spark, sf_dir, "transactions")))


# ---------------------------------------------------------------- profiling
from kestrel.operators import drift as D  # noqa: E402
from kestrel.operators import profile as P  # noqa: E402
from kestrel.operators import quality as Q  # noqa: E402
from kestrel.operators import rules as R  # noqa: E402

FEEDS = ("customers", "sales", "transactions")


def _per_feed(prefix: str, build):
    for feed in FEEDS:
        def q(spark, sf_dir, _feed=feed):
            return build(spark, sf_dir, _feed)
        q.__name__ = f"q_{prefix}_{feed}"
        register(f"{prefix}_{feed}")(q)


_per_feed("column_profile", lambda s, d, f: edge(P.column_profile(silver(s, d, f))))
_per_feed("null_anomalies", lambda s, d, f: edge(P.null_anomalies(silver(s, d, f))))
_per_feed("zscore_outliers", lambda s, d, f: edge(P.zscore_outliers(silver(s, d, f))))
_per_feed("business_rules", lambda s, d, f: R.business_rules(
    silver(s, d, f), schemas.SILVER_TABLE_NAMES[f], as_of=AS_OF))


@register("outlier_examples")
def q_outlier_examples(spark, sf_dir):
    """A17 over the sales feed (quantity outliers exist there)."""
    return P.outlier_examples(silver(spark, sf_dir, "sales"), k=3.0, n=5)


@register("range_outliers")
def q_range_outliers(spark, sf_dir):
    """Q20: documented simple thresholds on the customer and sales numerics."""
    c = P.range_outliers(silver(spark, sf_dir, "customers"), {"age": (18, 90)})
    s = P.range_outliers(silver(spark, sf_dir, "sales"), {"quantity": (1, 50), "amount": (1, 100000)})
    return (c.withColumn("table_name", F.lit("customers_silver"))
            .unionByName(s.withColumn("table_name", F.lit("sales_silver"))))


@register("null_anomalies_selected")
def q_null_anomalies_selected(spark, sf_dir):
    """Q23: null summary restricted to chosen columns."""
    return P.null_anomalies(silver(spark, sf_dir, "customers"), columns=["email", "phone"])


# ---------------------------------------------------------------- schema drift
def raw_as_text(spark, sf_dir, feed):
    """A raw feed as its CSV carries it: every column as text."""
    r = raw(spark, sf_dir, feed)
    return r.select([F.col(c).cast("string").alias(c) for c in r.columns])


def _drift_all(spark, sf_dir):
    out = None
    for feed in FEEDS:
        name = schemas.SILVER_TABLE_NAMES[feed]
        base = D.schema_snapshot(spark, name, schemas.SILVER[feed])
        cur = D.infer_types(raw_as_text(spark, sf_dir, feed), name)
        d = D.schema_drift(base, cur)
        out = d if out is None else out.unionByName(d)
    return out


@register("schema_drift")
def q_schema_drift(spark, sf_dir):
    """Declared silver contract vs types inferred from the raw values."""
    return _drift_all(spark, sf_dir)


@register("schema_drift_report")
def q_schema_drift_report(spark, sf_dir):
    names = spark.createDataFrame([(schemas.SILVER_TABLE_NAMES[f],) for f in FEEDS], "table_name string")
    return D.drift_report(_drift_all(spark, sf_dir), names)


@register("inferred_schema")
def q_inferred_schema(spark, sf_dir):
    """S1 type inference as one distributed aggregate per feed."""
    out = None
    for feed in FEEDS:
        r = D.infer_types(raw_as_text(spark, sf_dir, feed), schemas.SILVER_TABLE_NAMES[feed])
        out = r if out is None else out.unionByName(r)
    return out


# ---------------------------------------------------------------- quality log
def quality_log(spark, sf_dir, run_id=RUN_ID, ts=RUN_TS):
    return Q.profile_tables(silver_tables(spark, sf_dir), run_id, ts,
                            baselines={schemas.SILVER_TABLE_NAMES[f]: schemas.SILVER[f] for f in FEEDS},
                            as_of=AS_OF)


@register("quality_log")
def q_quality_log(spark, sf_dir):
    return quality_log(spark, sf_dir)


@register("quality_score")
def q_quality_score(spark, sf_dir):
    return quality_log(spark, sf_dir).select("table_name", "quality_score")


@register("quality_summary")
def q_quality_summary(spark, sf_dir):
    return quality_log(spark, sf_dir).select("table_name", "quality_score", "ai_summary")


# ---------------------------------------------------------------- quarantine / silver checks
@register("quarantine_null_keys")
def q_quarantine_null_keys(spark, sf_dir):
    """Rows held back from silver because the declared non-null key is NULL.

    The key-less transactions of the feed are the customer-less ones; the
    check runs on every feed's declared key.
    """
    out = None
    for feed in FEEDS:
        q = ingest.quarantine(raw(spark, sf_dir, feed), feed)
        q = q.select(F.lit(schemas.SILVER_TABLE_NAMES[feed]).alias("table_name"),
                     F.col(schemas.KEYS[feed]).alias("record_key"), "quarantine_reason")
        out = q if out is None else out.unionByName(q)
    return out


@register("quarantine_keyless_transactions")
def q_quarantine_keyless_transactions(spark, sf_dir):
    """P3 where keys are NULL: the customer-less transactions lose their key too."""
    t = raw(spark, sf_dir, "transactions")
    t = t.withColumn("transaction_id", F.when(F.col("customer_id").isNotNull(), F.col("transaction_id")))
    return ingest.quarantine(t, "transactions")


# ---------------------------------------------------------------- ingest and sinks, round trip
def _scratch(spark, name):
    return SS.scratch(spark, name)


@register("csv_ingest")
def q_csv_ingest(spark, sf_dir):
    """The customers feed as CSV files with a header, read as text, cleaned."""
    from kestrel.sources import io as IO

    path = _scratch(spark, "csv")
    raw(spark, sf_dir, "customers").write.option("header", True).option("ignoreLeadingWhiteSpace", False) \
        .option("ignoreTrailingWhiteSpace", False).csv(path)
    return ingest.silver(IO.read_raw_csv(spark, path, schemas.SILVER["customers"]), "customers")


@register("json_ingest")
def q_json_ingest(spark, sf_dir):
    """The sales feed as JSON lines, read as text, cleaned."""
    from kestrel.sources import io as IO

    path = _scratch(spark, "json")
    raw(spark, sf_dir, "sales").write.json(path)
    return ingest.silver(IO.read_raw_json(spark, path, schemas.SILVER["sales"]), "sales")


@register("append_round_trip")
def q_append_round_trip(spark, sf_dir):
    """Two appends of the product gold table, read back by path."""
    from kestrel.sources import io as IO

    path = _scratch(spark, "append")
    g = gold.product_sales(silver(spark, sf_dir, "sales"))
    IO.append(g.filter(F.col("product_id").isNotNull()), path)
    IO.append(g.filter(F.col("product_id").isNull()), path)
    return edge(IO.read_path(spark, path))


@register("drilldown_export")
def q_drilldown_export(spark, sf_dir):
    """The drill-down exported as CSV and read back."""
    from kestrel.sources import io as IO

    path = _scratch(spark, "drilldown")
    df = q_customer_drilldown(spark, sf_dir)
    IO.export_csv(df, path)
    return spark.read.schema(df.schema).option("header", True).csv(path)


@register("output_validation")
def q_output_validation(spark, sf_dir):
    """Row count and schema check of every silver table."""
    from kestrel.sources import io as IO

    out = None
    for feed in FEEDS:
        v = IO.validate_output(silver(spark, sf_dir, feed), schemas.SILVER[feed]).withColumn("table_name", F.lit(schemas.SILVER_TABLE_NAMES[feed]))
        out = v if out is None else out.unionByName(v)
    return out


@register("event_parts")
def q_event_parts(spark, sf_dir):
    """P25: year, month and month start of the sale date."""
    return ingest.with_event_parts(silver(spark, sf_dir, "sales").select("sale_id", "sale_date"), "sale_date")


@register("silver_range_checks")
def q_silver_range_checks(spark, sf_dir):
    """P25: rows quarantined by silver range checks, counted per table and reason."""
    out = None
    as_of = F.lit(AS_OF)
    for feed in FEEDS:
        q = ingest.quarantine(raw(spark, sf_dir, feed), feed, ingest.silver_range_checks(feed, as_of))
        q = q.select(F.lit(schemas.SILVER_TABLE_NAMES[feed]).alias("table_name"), "quarantine_reason")
        out = q if out is None else out.unionByName(q)
    return out.groupBy("table_name", "quarantine_reason").agg(F.count(F.lit(1)).alias("rows"))


# ---------------------------------------------------------------- run over run
def history_log(spark, sf_dir):
    """Two runs of the profiler: the raw feeds (run_000) and silver (run_001)."""
    raws = {schemas.SILVER_TABLE_NAMES[f]: ingest.enforce(raw(spark, sf_dir, f), schemas.SILVER[f]) for f in FEEDS}
    base = {schemas.SILVER_TABLE_NAMES[f]: schemas.SILVER[f] for f in FEEDS}
    r0 = Q.profile_tables(raws, "run_000", "2024-01-31T00:00:00", baselines=base, as_of=AS_OF)
    return r0.unionByName(quality_log(spark, sf_dir))


@register("run_over_run")
def q_run_over_run(spark, sf_dir):
    """Q22: each profiling run against the previous run of the same table."""
    return Q.run_over_run(history_log(spark, sf_dir))


# ---------------------------------------------------------------- text layer
from kestrel.operators import docs as DOC  # noqa: E402
from kestrel.operators import summaries as SUM  # noqa: E402
from kestrel.functions import text as TF  # noqa: E402


@register("llm_inputs")
def q_llm_inputs(spark, sf_dir):
    """Q12: model inputs from the quality log (JSON context, payload)."""
    return SUM.build_inputs(quality_log(spark, sf_dir))


@register("render_prompts")
def q_render_prompts(spark, sf_dir):
    """F8 + Q19: the three rendered prompts and the template version hash."""
    return SUM.render_prompts(SUM.build_inputs(quality_log(spark, sf_dir))).drop(*SUM.CONTEXT)


@register("generate_dry_run")
def q_generate_dry_run(spark, sf_dir):
    """Q13 dry run: "[DRY_RUN]" + prompt, no generator call."""
    return SUM.generate(SUM.build_inputs(quality_log(spark, sf_dir)), dry_run=True)


def raw_outputs(spark, sf_dir):
    return SUM.generate(SUM.build_inputs(history_log(spark, sf_dir)))


@register("generate_summaries")
def q_generate_summaries(spark, sf_dir):
    """Q13 live: generator over Arrow batches (mapInPandas) -> llm_raw_outputs."""
    return raw_outputs(spark, sf_dir)


def llm_summaries(spark, sf_dir):
    return SUM.clean_outputs(raw_outputs(spark, sf_dir))


@register("clean_summaries")
def q_clean_summaries(spark, sf_dir):
    """Q14: sanitised paragraphs and filtered root-cause bullets -> llm_summaries."""
    return llm_summaries(spark, sf_dir)


@register("validate_summaries")
def q_validate_summaries(spark, sf_dir):
    """Q21: prompt-rule compliance flags per generated summary."""
    return SUM.validate_summaries(llm_summaries(spark, sf_dir))


@register("summary_export")
def q_summary_export(spark, sf_dir):
    return SUM.summary_export(llm_summaries(spark, sf_dir))


@register("run_metadata")
def q_run_metadata(spark, sf_dir):
    return SUM.run_metadata(llm_summaries(spark, sf_dir))


@register("sanitize_text")
def q_sanitize_text(spark, sf_dir):
    """F10 over every document (whole texts; the 4000-character cap is the contract)."""
    d = feeds.table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select("doc_id", TF.sanitize_text(F.col("text")).alias("clean_text"))


@register("clean_root_causes")
def q_clean_root_causes(spark, sf_dir):
    """F11 over every conversation turn (whole texts)."""
    c = feeds.table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return c.select("conv_id", "turn", TF.clean_root_causes(F.col("text")).alias("bullets"))


@register("clean_root_causes_documents")
def q_clean_root_causes_documents(spark, sf_dir):
    """F11/O4 where bullets occur and the cut at four is reached: every document line as a bullet."""
    d = feeds.table(spark, sf_dir, "documents").select("doc_id", "text")
    bullets = F.concat(F.lit("- "), F.replace(F.col("text"), F.lit("\n"), F.lit("\n- ")))
    return d.select("doc_id", TF.clean_root_causes(bullets).alias("bullets"))


# ---------------------------------------------------------------- findings / classification
def findings(spark, sf_dir):
    return DOC.findings(history_log(spark, sf_dir))


@register("classify_anomaly")
def q_classify_anomaly(spark, sf_dir):
    """Q9 over every finding of both profiling runs."""
    return DOC.classify(findings(spark, sf_dir)).drop("affected_pct")


@register("anomaly_severity")
def q_anomaly_severity(spark, sf_dir):
    """Severity score and band per classified finding."""
    return edge(DOC.severity(DOC.classify(findings(spark, sf_dir))))


def stored_silver(spark, sf_dir):
    return {feed: stored(spark, silver(spark, sf_dir, feed), f"silver-{feed}") for feed in FEEDS}


def suggestions(spark, tables):
    """T9 over stored silver tables, whose profiles (one row a column) are stored too: the rules read both several times."""
    out = None
    for feed, df in tables.items():
        profile = stored(spark, P.column_profile(df), f"profile-{feed}")
        s = DOC.suggested_rules(profile, schemas.SILVER_TABLE_NAMES[feed], df, max_set=5)
        out = s if out is None else out.unionByName(s)
    return out


@register("suggested_rules")
def q_suggested_rules(spark, sf_dir):
    """Rules suggested from the silver profiles."""
    return suggestions(spark, stored_silver(spark, sf_dir))


@register("parse_rules")
def q_parse_rules(spark, sf_dir):
    """Q10 over the suggested rule texts (flattened structs)."""
    p = R.parse_rules(suggestions(spark, stored_silver(spark, sf_dir)).select("table_name", "rule_text"), created_at=str(AS_OF))
    return p.select("table_name", "rule_id", "description", "column", "rule_type",
                    F.col("thresholds.max").alias("threshold_max"), "severity", "action")


#: Rules that an analyst states beside the suggested ones.
ANALYST_RULES = [
    ("sales_silver", "Flag sales_silver rows where product_id is missing"),
    ("sales_silver", "Flag sales_silver rows where quantity above 50"),
    ("sales_silver", "Flag sales_silver rows where amount above 90,000"),
    ("transactions_silver", "Flag transactions_silver rows where customer_id is missing"),
    ("transactions_silver", "Flag transactions_silver rows where amount above 100"),
]


@register("evaluate_rules")
def q_evaluate_rules(spark, sf_dir):
    """Q11: checks implied by the suggested and the stated rules, counted on each silver table (one pass each).

    A rule that implies no check has a row of its own, with the error 'not checkable'."""
    tables = stored_silver(spark, sf_dir)
    texts = suggestions(spark, tables).select("table_name", "rule_text").unionByName(
        spark.createDataFrame(ANALYST_RULES, "table_name string, rule_text string"))
    parsed = stored(spark, R.parse_rules(texts, created_at=str(AS_OF)), "parsed-rules")
    out = None
    for feed in FEEDS:
        name = schemas.SILVER_TABLE_NAMES[feed]
        checks = R.rule_checks(parsed.filter(F.col("table_name") == name))
        e = R.evaluate_rules(tables[feed], checks).withColumn("table_name", F.lit(name))
        out = e if out is None else out.unionByName(e)
    return out


@register("table_documentation")
def q_table_documentation(spark, sf_dir):
    """Q16: documentation per silver table from schema, rules and classified findings."""
    from kestrel.operators.drift import schema_snapshot

    snaps = None
    for feed in FEEDS:
        s = schema_snapshot(spark, schemas.SILVER_TABLE_NAMES[feed], schemas.SILVER[feed])
        snaps = s if snaps is None else snaps.unionByName(s)
    rules = spark.createDataFrame(
        [(t, i, f"{r}: flags rows where {p.replace('{as_of}', 'the run date')}", "high")
         for i, (t, r, p) in enumerate(R.DEFAULT_RULES)],
        "table_name string, ordinal int, description string, severity string")
    anomalies = DOC.classify(DOC.findings(quality_log(spark, sf_dir)))
    return DOC.table_documentation(snaps, rules, anomalies, RUN_TS)


@register("metadata_summary")
def q_metadata_summary(spark, sf_dir):
    """Q15 over S20 ingest metadata of the silver tables."""
    from kestrel.sources import io as IO

    meta, snap, nulls = None, None, None
    for feed in FEEDS:
        name = schemas.SILVER_TABLE_NAMES[feed]
        path = SS.scratch(spark, f"ingest-{name}")
        IO.write_path(silver(spark, sf_dir, feed), path)
        df = IO.read_path(spark, path)
        m = IO.ingest_metadata(df, name, path)
        n = P.null_anomalies(df).select(F.lit(name).alias("table_name"), "ordinal", "column_name", "null_percentage")
        s = D.schema_snapshot(spark, name, df)
        meta = m if meta is None else meta.unionByName(m)
        nulls = n if nulls is None else nulls.unionByName(n)
        snap = s if snap is None else snap.unionByName(s)
    return DOC.metadata_summary(meta.select("table_name", "row_count", "file_size_mb"), snap, nulls)


@register("rules_end_to_end")
def q_rules_end_to_end(spark, sf_dir):
    """Q17: parse -> evaluate -> classify the violated checks and the rules that could not be checked, per table."""
    ev = q_evaluate_rules(spark, sf_dir)
    # a check that no row violates is no finding
    text = F.when(F.col("error").isNotNull(), F.concat(F.col("error"), F.lit(": "), F.col("description"))).otherwise(
        F.concat(F.col("violations").cast("string"), F.lit(" rows violate rule: "), F.col("description")))
    return DOC.classify(ev.filter((F.col("violations") > 0) | F.col("error").isNotNull()).withColumn("anomaly_text", text), "anomaly_text")


# ---------------------------------------------------------------- KPIs
from kestrel.operators import kpi as K  # noqa: E402


def gold_sales(spark, sf_dir):
    return gold.customer_sales(silver(spark, sf_dir, "sales"), silver(spark, sf_dir, "customers"))


@register("kpi_customers")
def q_kpi_customers(spark, sf_dir):
    return edge(K.customer_kpis(gold_sales(spark, sf_dir)))


@register("kpi_cards")
def q_kpi_cards(spark, sf_dir):
    return K.kpi_cards(K.customer_kpis(gold_sales(spark, sf_dir)))


@register("kpi_health")
def q_kpi_health(spark, sf_dir):
    return K.health_counts(llm_summaries(spark, sf_dir))


@register("daily_usage")
def q_daily_usage(spark, sf_dir):
    """A14 over the events table as the usage log."""
    return K.daily_counts(feeds.table(spark, sf_dir, "events"), "ts")


@register("top_customers")
def q_top_customers(spark, sf_dir):
    return edge(K.top_customers(gold_sales(spark, sf_dir), 10))


@register("customer_drilldown")
def q_customer_drilldown(spark, sf_dir):
    return edge(K.customer_drilldown(gold_sales(spark, sf_dir), 1_500_000, F.lit(AS_OF)))


@register("sum_by_key")
def q_sum_by_key(spark, sf_dir):
    """P18 + A16: sales above 50000, total amount per customer."""
    return K.sum_by_key(silver(spark, sf_dir, "sales"), "customer_id", "amount", 50000)


@register("run_selector")
def q_run_selector(spark, sf_dir):
    """A15 + P16 + O3: run ids of one table, and the first row of the selection."""
    log = history_log(spark, sf_dir).select("table_name", "run_id", "timestamp", "quality_score")
    sel = K.select_run(log, "ALL", "sales_silver")
    return K.first_rows(sel, [F.col("timestamp").desc(), F.col("run_id").desc()], 1)


@register("selector_values")
def q_selector_values(spark, sf_dir):
    log = history_log(spark, sf_dir)
    return K.distinct_values(log, "run_id", F.col("table_name") == "customers_silver")


# ---------------------------------------------------------------- ML
from kestrel.operators import ml as ML  # noqa: E402


def label(gold_rows):
    """Labels with cuts that suit this feed's amounts, so that both classes occur (the defaults are 5000 and 200)."""
    return ML.label_high_value(gold_rows, spend=2_500_000, aov=41_000)


def labelled(spark, sf_dir):
    return label(gold_sales(spark, sf_dir))


def stored_gold(spark, sf_dir):
    """Gold sales stored once: a forest reads its rows many times while it is fitted, and scoring reads them again."""
    return stored(spark, gold_sales(spark, sf_dir), "gold-sales")


@register("high_value_label")
def q_high_value_label(spark, sf_dir):
    return edge(labelled(spark, sf_dir))


@register("train_test_split")
def q_train_test_split(spark, sf_dir):
    lab = labelled(spark, sf_dir)
    return lab.withColumn("split", F.when(ML.split_flag(F.col("customer_id")), "train").otherwise("test")) \
        .groupBy("split", ML.LABEL).agg(F.count(F.lit(1)).alias("rows"))


@register("baseline_classifier_metrics")
def q_baseline_classifier_metrics(spark, sf_dir):
    """M2 + A18: accuracy and F1 of the midpoint model on the test split, which the forest is held against."""
    return edge(ML.classification_metrics(ML.midpoint_predictions(*ML.train_test_split(label(stored_gold(spark, sf_dir))))))


@register("baseline_regression_metrics")
def q_baseline_regression_metrics(spark, sf_dir):
    """M2 + A19: MAE, RMSE and R^2 of the ratio model on the test split, which the forest is held against."""
    return edge(ML.regression_metrics(ML.ratio_predictions(*ML.train_test_split(ML.regression_features(stored_gold(spark, sf_dir))))))


def _fit(spark, sf_dir, gold_rows=None):
    lab = label(stored_gold(spark, sf_dir) if gold_rows is None else gold_rows)
    train, test = ML.train_test_split(lab)
    return ML.fit_classifier(train), test, lab


def scored(gold_rows):
    """Every gold customer with the features; unlike the training frame, also those with a null feature."""
    return gold_rows.select("customer_id", *ML.FEATURES)


@register("rf_metrics")
def q_rf_metrics(spark, sf_dir):
    """M3 + M4: random forest on the train split, accuracy / F1 on the test split."""
    model, test, _ = _fit(spark, sf_dir)
    return ML.classification_metrics(model.transform(test))


@register("rf_predictions")
def q_rf_predictions(spark, sf_dir):
    """M5: batch scoring of every gold customer."""
    rows = stored_gold(spark, sf_dir)
    model, _, _ = _fit(spark, sf_dir, rows)
    return ML.predict(model, scored(rows))


@register("clv_regression_metrics")
def q_clv_regression_metrics(spark, sf_dir):
    """M6: random-forest regression of total_spend; MAE / RMSE / R^2 on the test split."""
    feats = ML.regression_features(stored_gold(spark, sf_dir))
    train, test = ML.train_test_split(feats)
    model = ML.regressor_pipeline().fit(train)
    return ML.regression_metrics(model.transform(test))


# ---------------------------------------------------------------- streaming (batch forms)
from kestrel.streaming import monitors as MON  # noqa: E402


def tx_events(spark, sf_dir):
    """Raw transactions with their event time (the transaction stream, as a batch)."""
    ev = feeds.table(spark, sf_dir, "events")
    return feeds.transactions_from_events(ev, keep=("ts",))


@register("rolling_quality")
def q_rolling_quality(spark, sf_dir):
    """T5 batch form: daily windows of transaction quality rates."""
    return edge(MON.quality_windows(tx_events(spark, sf_dir), "ts", "1 day"))


@register("volume_alerts")
def q_volume_alerts(spark, sf_dir):
    """T6 batch form: hourly event volume per type with trailing-24 alerting."""
    counts = MON.volume_counts(feeds.table(spark, sf_dir, "events"), "ts", "1 hour", "event_type")
    return edge(MON.volume_alerts(counts, "event_type", history=24, k=3.0))


@register("sessions")
def q_sessions(spark, sf_dir):
    """T10 batch form: 30-minute-gap sessions per user, skew-safe (bucketed) plan."""
    return edge(MON.sessions_bucketed(feeds.table(spark, sf_dir, "events"), "ts", 30, "user_id", 60))


# ---------------------------------------------------------------- streaming (live)
from kestrel.streaming import batches as SB  # noqa: E402
from kestrel.streaming import sources as SS  # noqa: E402

def _event_stream(spark, sf_dir):
    """The given events table as a file stream."""
    return SS.with_event_time(SS.read_stream(spark, f"{sf_dir.rstrip('/')}/events*.parquet", SS.EVENTS_SCHEMA,
                                             max_files_per_trigger=None))


def _complete(spark, df, name, transform=None):
    """Drain a stateful query in complete mode: open windows and sessions are in its result."""
    sink = SB.ReplaceResult(SS.scratch(spark, name), transform)
    SS.drain(SS.run_foreach_batch(df, sink, SS.scratch(spark, f"{name}-ck"), mode="complete"))
    out = sink.read(spark)
    # the tables hold timestamps without a zone, and so do the batch forms
    return out.select(*(F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else f.name
                        for f in out.schema.fields))


@register("stream_bronze")
def q_stream_bronze(spark, sf_dir):
    """T1 + T2 + T11: landed event files -> append-only bronze (checkpointed)."""
    out, ck = SS.scratch(spark, "bronze"), SS.scratch(spark, "bronze-ck")
    SS.drain(SS.write_files(SS.bronze_stream(_event_stream(spark, sf_dir), "events"), out, ck))
    return spark.read.parquet(out).select("event_id", "ts", "user_id", "event_type", "value", "_source")


@register("stream_windows")
def q_stream_windows(spark, sf_dir):
    """T5 on a stream: daily windows in complete mode (state is one row a day)."""
    tx = feeds.transactions_from_events(_event_stream(spark, sf_dir), keep=("event_time",))
    return edge(_complete(spark, MON.quality_windows(tx, "event_time", "1 day"), "windows"))


@register("stream_sessions")
def q_stream_sessions(spark, sf_dir):
    """T10 on a stream: all sessions, the open ones too.

    An endless stream passes a watermark and appends closed sessions (see ``monitors.sessions``).
    """
    s = MON.sessions(_event_stream(spark, sf_dir), "event_time", "30 minutes", "user_id")
    return edge(_complete(spark, s, "sessions"))


def _stream_profile_paths(spark, sf_dir):
    log, alerts, drift = (SS.scratch(spark, n) for n in ("stream-log", "stream-alerts", "stream-drift"))
    ck = SS.scratch(spark, "stream-profile-ck")
    name = schemas.SILVER_TABLE_NAMES["transactions"]
    sink = SB.ProfileBatches(
        name, log, alerts, drift,
        prepare=lambda b: ingest.silver(feeds.transactions_from_events(b), "transactions"),
        baseline=schemas.TRANSACTIONS_SILVER, as_of=AS_OF, payload_col="props", payload_keys=["k"])
    SS.drain(SS.run_foreach_batch(_event_stream(spark, sf_dir), sink, ck))
    return log, alerts, drift


@register("stream_profile")
def q_stream_profile(spark, sf_dir):
    """T3 + T11: every micro-batch of transactions profiled into the quality log."""
    log, _, _ = _stream_profile_paths(spark, sf_dir)
    return spark.read.parquet(log).select("table_name", "run_id", "quality_score", "ai_summary",
                                          "business_rules_json", "null_anomalies_json", "outlier_report_json")


@register("stream_classify")
def q_stream_classify(spark, sf_dir):
    """T7 + T12: findings of each micro-batch classified and scored as alerts."""
    _, alerts, _ = _stream_profile_paths(spark, sf_dir)
    return spark.read.parquet(alerts)


@register("stream_schema_drift")
def q_stream_schema_drift(spark, sf_dir):
    """Per micro-batch, table schema and JSON payload keys against the baseline."""
    _, _, drift = _stream_profile_paths(spark, sf_dir)
    return spark.read.parquet(drift)


@register("stream_incremental_summaries")
def q_stream_incremental_summaries(spark, sf_dir):
    """T4: the quality log read as a stream; only runs not yet summarised are summarised."""
    log, _, _ = _stream_profile_paths(spark, sf_dir)
    summaries, ck = SS.scratch(spark, "stream-summaries"), SS.scratch(spark, "stream-summaries-ck")
    schema = spark.read.parquet(log).schema
    stream = spark.readStream.schema(schema).parquet(log)
    SS.drain(SS.run_foreach_batch(stream, SB.SummarizeNewRuns(summaries), ck))
    return spark.read.parquet(summaries)


@register("stream_volume_alerts")
def q_stream_volume_alerts(spark, sf_dir):
    """T6 on a stream: hourly counts in complete mode, scored against the trailing windows."""
    counts = MON.volume_counts(_event_stream(spark, sf_dir), "event_time", "1 hour", "event_type")
    return edge(_complete(spark, counts, "volume", lambda c: MON.volume_alerts(c, "event_type", history=24, k=3.0)))


# many batches: every delivery of the feed resumes the query from its checkpoint
from kestrel.streaming import slices as SL  # noqa: E402

DELIVERIES, DELAY, NTH = 4, "1 hour", 50


def _feed(spark, sf_dir, replayed=False):
    """The events in four deliveries by time; one in fifty arrives two deliveries late."""
    dealt = SL.deal(feeds.table(spark, sf_dir, "events"), "ts", DELIVERIES, nth=None if replayed else NTH)
    if replayed:  # the next delivery repeats every fifth event, and its own first event is delivered twice
        again = dealt.where("event_id % 5 = 0").withColumn("_slice", F.least(F.col("_slice") + 1, F.lit(DELIVERIES - 1)))
        dealt = dealt.unionByName(again)
    return SL.Feed(dealt, DELIVERIES)


def _appended(spark, feed, build, name, first=0, last=None, out=None, ck=None):
    """Drain the closed rows of ``build(stream)`` into a file sink, delivery by delivery."""
    out, ck = out or SS.scratch(spark, name), ck or SS.scratch(spark, f"{name}-ck")
    reports = feed.drain(lambda: SS.write_files(build(feed.stream("ts")), out, ck), first, last)
    return out, ck, reports


def _plain_times(df):
    return df.select(*(F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else f.name for f in df.schema.fields))


def _closed_windows(stream):
    return MON.volume_counts(stream, "event_time", "1 day", "event_type", watermark=DELAY)


@register("stream_closed_windows")
def q_stream_closed_windows(spark, sf_dir):
    """T5 + T11: daily counts over four resumed batches, appended as the watermark closes them; late rows are not in them."""
    out, _, _ = _appended(spark, _feed(spark, sf_dir), _closed_windows, "closed-windows")
    return edge(_plain_times(spark.read.parquet(out)))


@register("stream_late_rows")
def q_stream_late_rows(spark, sf_dir):
    """The rows that came after their daily window was closed, set aside in a table."""
    feed = _feed(spark, sf_dir)
    sink = SL.LateRows(SS.scratch(spark, "late"), "ts", lambda t: F.date_trunc("day", t) + F.expr("INTERVAL 1 DAY"), 3_600_000_000)
    ck = SS.scratch(spark, "late-ck")
    feed.drain(lambda: SS.run_foreach_batch(feed.stream("ts").drop("event_time"), sink, ck))
    return sink.read(spark)


@register("stream_closed_sessions")
def q_stream_closed_sessions(spark, sf_dir):
    """30-minute sessions over four resumed batches, appended and evicted once the watermark has passed their end."""
    out, _, _ = _appended(spark, _feed(spark, sf_dir), lambda s: MON.sessions(s, "event_time", "30 minutes", "user_id", watermark=DELAY), "closed-sessions")
    return edge(_plain_times(spark.read.parquet(out)))


@register("stream_dedupe")
def q_stream_dedupe(spark, sf_dir):
    """Events replayed by the next delivery pass once; keys expire with the watermark (a delivery's span and a day)."""
    feed = _feed(spark, sf_dir, replayed=True)
    low, high = feeds.table(spark, sf_dir, "events").agg(F.min(SL.micros(F.col("ts"))), F.max(SL.micros(F.col("ts")))).first()
    span = f"{(high - low) // DELIVERIES // 1_000_000 + 86_400} seconds" if low is not None else "1 day"
    out, _, _ = _appended(spark, feed, lambda s: MON.dedupe_events(s, "event_id", "event_time", span).drop("event_time"), "deduped")
    return spark.read.parquet(out)


@register("stream_resume")
def q_stream_resume(spark, sf_dir):
    """T11 + T14: a query on a processing-time trigger is stopped after two deliveries; another one resumes from its checkpoint."""
    feed = _feed(spark, sf_dir)
    out, ck = SS.scratch(spark, "resumed"), SS.scratch(spark, "resumed-ck")
    q = SS.write_files(_closed_windows(feed.stream("ts")), out, ck, trigger="1 second")
    try:
        for i in range(2):
            feed.land(i)
            q.processAllAvailable()
    finally:
        q.stop()
    _appended(spark, feed, _closed_windows, "resumed", 2, None, out, ck)
    return edge(_plain_times(spark.read.parquet(out)))


@register("stream_trailing_alerts")
def q_stream_trailing_alerts(spark, sf_dir):
    """Closed hourly counts over four resumed batches, each scored against the last 24 counts a key kept as state."""
    feed = _feed(spark, sf_dir)
    sink, ck = SB.TrailingAlertBatches(SS.scratch(spark, "trailing")), SS.scratch(spark, "trailing-ck")
    hourly = lambda: MON.volume_counts(feed.stream("ts"), "event_time", "1 hour", "event_type", watermark=DELAY)
    feed.drain(lambda: SS.run_foreach_batch(hourly(), sink, ck))
    return edge(_plain_times(sink.read(spark)))


def _changing_payloads(spark, sf_dir):
    """Four deliveries of the events; their producer adds a key to the second, drops one from the third and retypes one in the fourth."""
    dealt = SL.deal(feeds.table(spark, sf_dir, "events"), "ts", DELIVERIES)
    k, channel = F.get_json_object("props", "$.k"), F.col("event_type").alias("channel")
    props = (F.when(F.col("_slice") == 1, F.to_json(F.struct(k.cast("long").alias("k"), channel)))
             .when(F.col("_slice") == 2, F.to_json(F.struct(channel)))
             .when(F.col("_slice") == 3, F.to_json(F.struct(k.alias("k")))).otherwise(F.col("props")))
    return SL.Feed(dealt.withColumn("props", props), DELIVERIES)


@register("stream_payload_drift")
def q_stream_payload_drift(spark, sf_dir):
    """A new, a missing and a retyped payload key, each found in the batch in which it first arrives."""
    feed = _changing_payloads(spark, sf_dir)
    sink, ck = SB.PayloadDriftBatches(SS.scratch(spark, "payload"), "events", "props", {"k": "BIGINT"}, "payload"), SS.scratch(spark, "payload-ck")
    feed.drain(lambda: SS.run_foreach_batch(feed.stream("ts"), sink, ck))
    return sink.read(spark)


from kestrel.operators import sketches as SK  # noqa: E402


@register("merged_profile")
def q_merged_profile(spark, sf_dir):
    """T3 + Q18: sketches stored by each of four micro-batches, merged; the estimate is held against the exact distinct count."""
    feed = _feed(spark, sf_dir)
    sink = SK.SketchBatches(SS.scratch(spark, "sketches"), ["event_id", "user_id", "value"])
    ck = SS.scratch(spark, "sketches-ck")
    feed.drain(lambda: SS.run_foreach_batch(feed.stream("ts"), sink, ck))
    events = feeds.table(spark, sf_dir, "events")
    exact = events.agg(*(F.count_distinct(c).alias(c) for c in sink.columns)).select(
        F.inline(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("distinct_count")) for c in sink.columns))))
    close = F.abs(F.col("distinct_estimate") - F.col("distinct_count")) <= 0.03 * F.col("distinct_count")
    return edge(SK.merged(sink.read(spark)).join(exact, "column_name").select(
        "column_name", "runs", "rows", "nulls", "mean", "stddev", "low", "high", "distinct_count", close.alias("within_3_percent")))


# ---------------------------------------------------------------- catalog tables, layout, stored models
def _table_name(kind):
    return f"kestrel_{kind}_{SS.uuid.uuid4().hex[:12]}"


def catalog_tables(spark, sf_dir, buckets=8):
    """Silver sales and deduplicated customers as bucketed catalog tables; sales are created twice (overwrite) and once by CTAS."""
    from kestrel.sources import io as IO

    sales, customers = silver(spark, sf_dir, "sales"), silver(spark, sf_dir, "customers")
    names = {k: _table_name(k) for k in ("sales", "customers", "ctas")}
    first = IO.table_or_empty(spark, names["sales"], sales.schema)  # no table yet: typed and empty
    where = SS.scratch(spark, names["sales"])
    IO.save_bucketed(first, names["sales"], ["customer_id"], buckets, where)
    IO.save_bucketed(sales, names["sales"], ["customer_id"], buckets, where)
    IO.ctas(spark, names["ctas"], where, location=SS.scratch(spark, names["ctas"]))
    IO.save_bucketed(ingest.dedupe_on_key(customers, "customer_id"), names["customers"], ["customer_id"], buckets, SS.scratch(spark, names["customers"]))
    return names


@register("catalog_enriched_sales")
def q_catalog_enriched_sales(spark, sf_dir):
    """S3 + S4 + S6 + S11 + J1: the enrichment join over bucketed catalog tables, without a shuffle."""
    from kestrel.sources import io as IO

    names = catalog_tables(spark, sf_dir)
    return gold.enrich_sales(IO.read_table(spark, names["sales"]), IO.read_table(spark, names["customers"]), dedupe=False)


@register("catalog_ctas")
def q_catalog_ctas(spark, sf_dir):
    """S14 + S11: silver sales through CREATE TABLE AS SELECT."""
    from kestrel.sources import io as IO

    return IO.read_table(spark, catalog_tables(spark, sf_dir)["ctas"])


@register("zorder_ranges")
def q_zorder_ranges(spark, sf_dir):
    """Events clustered by (user_id, ts) in 64 files; a range of either column is found in a fraction of them."""
    from kestrel.sources import layout

    path = SS.scratch(spark, "zorder")
    events = feeds.table(spark, sf_dir, "events")
    layout.z_ordered(events, ["user_id", "ts"], files=64).write.parquet(path)
    stored = spark.read.parquet(path)
    tenth = events.agg(F.expr("max(user_id) div 10")).first()[0]
    ranges = {"user_id": F.col("user_id") <= F.lit(tenth), "ts": F.col("ts") < F.lit("2024-01-03").cast("timestamp_ntz")}
    out = None
    for name, cond in ranges.items():
        one = layout.files_with(stored, cond).select(F.lit(name).alias("by"), "rows", (F.col("files_hit") <= F.col("files") * 0.4).alias("skips"))
        out = one if out is None else out.unionByName(one)
    return out


@register("model_round_trip")
def q_model_round_trip(spark, sf_dir):
    """M7: a fitted model stored in the shared folder and loaded again; importances as a table, predictions compared."""
    gold_rows = stored_gold(spark, sf_dir)
    model, _, _ = _fit(spark, sf_dir, gold_rows)
    path = SS.scratch(spark, "model")
    ML.save_model(model, path)
    again = ML.load_model(path)
    rows = scored(gold_rows)
    a, b = ML.predict(model, rows), ML.predict(again, rows)
    differ = a.select("customer_id", "prediction").exceptAll(b.select("customer_id", "prediction")).agg(F.count(F.lit(1)).alias("differing"))
    imp = spark.createDataFrame(ML.feature_importances(again, ML.FEATURES), "feature string, importance double")
    total = imp.agg((F.abs(F.sum("importance") - 1) < 1e-9).alias("sums_to_one"))
    return imp.crossJoin(total).crossJoin(differ).select("feature", (F.col("importance") > 0).alias("used"), "sums_to_one", "differing")


@register("stream_predict")
def q_stream_predict(spark, sf_dir):
    """A model fitted on gold scores gold rows as they land (streaming transform)."""
    gold_rows = stored_gold(spark, sf_dir)
    model, _, _ = _fit(spark, sf_dir, gold_rows)
    rows = scored(gold_rows)
    landing = SS.scratch(spark, "landing-gold")
    rows.write.parquet(landing)
    stream = SS.read_stream(spark, landing, rows.schema.simpleString()[len("struct<"):-1].replace(":", " "))
    out, ck = SS.scratch(spark, "predict"), SS.scratch(spark, "predict-ck")
    SS.drain(SS.write_files(ML.predict(model, stream), out, ck))
    return spark.read.parquet(out)


# ---------------------------------------------------------------- small operators
@register("sales_with_product")
def q_sales_with_product(spark, sf_dir):
    """P13 + P19: sales that name a product, three columns."""
    return ingest.select_columns(ingest.filter_not_null(silver(spark, sf_dir, "sales"), "product_id"),
                                 ["sale_id", "product_id", "amount"])


@register("column_sets")
def q_column_sets(spark, sf_dir):
    """Added / removed / common columns, declared contract vs the raw feed as it arrives."""
    base = cur = None
    for feed in FEEDS:
        name = schemas.SILVER_TABLE_NAMES[feed]
        b = D.schema_snapshot(spark, name, schemas.SILVER[feed])
        c = D.infer_types(raw_as_text(spark, sf_dir, feed), name)
        base = b if base is None else base.unionByName(b)
        cur = c if cur is None else cur.unionByName(c)
    return D.column_sets(base, cur)


@register("quality_log_flat")
def q_quality_log_flat(spark, sf_dir):
    """Q18 as the flat columns the reference's log holds (JSON text of drift, nulls and rules)."""
    return quality_log(spark, sf_dir).select("table_name", "run_id", "timestamp", "quality_score", "ai_summary",
                                             "schema_drift_json", "null_anomalies_json", "business_rules_json")


# ---------------------------------------------------------------- a feed whose schema changed
def _changed(customers):
    """The customers feed after its producer dropped, added and retyped a column."""
    return customers.drop("city").withColumn("loyalty_tier", F.upper(F.substring(F.trim("country"), 1, 1)))


def _changed_types(spark, sf_dir):
    feed = _changed(raw(spark, sf_dir, "customers")).withColumn("signup_date", F.date_format("signup_date", "dd/MM/yyyy"))
    return D.infer_types(feed.select([F.col(c).cast("string").alias(c) for c in feed.columns]), "customers_silver")


def _declared_customers(spark):
    return D.schema_snapshot(spark, "customers_silver", schemas.SILVER["customers"])


@register("changed_feed_drift")
def q_changed_feed_drift(spark, sf_dir):
    """Q3: a missing, a new and retyped columns against the declared contract, types inferred from the values."""
    return D.schema_drift(_declared_customers(spark), _changed_types(spark, sf_dir))


@register("changed_feed_report")
def q_changed_feed_report(spark, sf_dir):
    """Q3 text with all three blocks."""
    names = spark.createDataFrame([("customers_silver",)], "table_name string")
    return D.drift_report(q_changed_feed_drift(spark, sf_dir), names)


@register("changed_feed_columns")
def q_changed_feed_columns(spark, sf_dir):
    """U1 with added and removed columns."""
    return D.column_sets(_declared_customers(spark), _changed_types(spark, sf_dir))


def _changed_log(spark, sf_dir):
    table = _changed(silver(spark, sf_dir, "customers")).withColumn("signup_date", F.col("signup_date").cast("string"))
    return Q.table_quality(table, "customers_silver", RUN_ID, RUN_TS, schemas.SILVER["customers"], as_of=AS_OF)


@register("changed_feed_quality")
def q_changed_feed_quality(spark, sf_dir):
    """Q6/Q7/Q18 with drift: all three penalties and the drift line."""
    return _changed_log(spark, sf_dir).select("table_name", "quality_score", "ai_summary", "schema_drift_json")


@register("changed_feed_runs")
def q_changed_feed_runs(spark, sf_dir):
    """Q22: the run before the change and the run after it."""
    before = Q.table_quality(silver(spark, sf_dir, "customers"), "customers_silver", "run_000", "2024-01-31T00:00:00",
                             schemas.SILVER["customers"], as_of=AS_OF)
    return Q.run_over_run(before.unionByName(_changed_log(spark, sf_dir)))


# ---------------------------------------------------------------- log layout and evolution
@register("log_schema_evolution")
def q_log_schema_evolution(spark, sf_dir):
    """The flat log generation (run_time_utc + JSON) unioned with the typed one by name."""
    from kestrel.sources import io as IO

    log = quality_log(spark, sf_dir)
    old = log.select("table_name", F.col("timestamp").alias("run_time_utc"), "quality_score", "ai_summary",
                     "business_rules_json")
    new = log.select("table_name", "run_id", "timestamp", "quality_score", "ai_summary")
    return IO.union_evolving(old, new)


@register("partitioned_log")
def q_partitioned_log(spark, sf_dir):
    """Log written by table/date (clustered by run), read back with partition pruning."""
    from kestrel.sources import io as IO

    path = SS.scratch(spark, "partitioned-log")
    IO.write_partitioned_log(quality_log(spark, sf_dir).select("table_name", "run_id", "timestamp", "quality_score"),
                             path)
    return IO.read_log(spark, path).filter(F.col("table_name") == "sales_silver")


@register("business_rules_documented")
def q_business_rules_documented(spark, sf_dir):
    """The documented customer rules (negative age, malformed email) as data, one pass."""
    return R.business_rules(silver(spark, sf_dir, "customers"), "customers_silver", rules=R.DOCUMENTED_RULES)
