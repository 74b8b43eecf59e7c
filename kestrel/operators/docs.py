"""Findings, anomaly classification, suggested rules, metadata summaries and
table documentation -- all derived from the quality log and profiles.

Text documents are assembled per table with grouped ``collect_list``; each
group holds one entry per column / rule / finding of that table, so group
size is bounded by schema width, never by row count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.functions import text as tf


# ---------------------------------------------------------------- findings
def findings(log: DataFrame) -> DataFrame:
    """Anomaly descriptions from quality-log rows (one per flagged item).

    (table_name, run_id, column_name, source, description, affected_pct).
    One projection builds every finding of a log row as an array of structs
    and one ``explode`` emits them, so the log is read once.
    """
    total = F.aggregate(F.map_values("null_summary"), F.lit(0).cast("long"),
                        lambda acc, v: F.greatest(acc, v["total_rows"]))
    pct = lambda n: F.when(total > 0, F.round(n * 100.0 / total, 2)).otherwise(F.lit(0.0))
    item = lambda c, src, d, p: F.struct(c.alias("column_name"), F.lit(src).alias("source"),
                                         d.alias("description"), p.cast("double").alias("affected_pct"))
    nulls = F.transform(
        F.filter(F.map_entries("null_summary"), lambda e: e["value"]["issue"] != "OK"),
        lambda e: item(e["key"], "nulls",
                       F.concat(F.lit("Column "), e["key"], F.lit(" has "),
                                e["value"]["null_percentage"].cast("string"), F.lit("% null values")),
                       e["value"]["null_percentage"]))
    outl = F.transform(
        F.filter(F.map_entries("outlier_summary"), lambda e: F.coalesce(e["value"]["outlier_count"], F.lit(0)) > 0),
        lambda e: item(e["key"], "outliers",
                       F.concat(e["value"]["outlier_count"].cast("string"), F.lit(" values in "), e["key"],
                                F.lit(" lie above 3 standard deviations from the mean")),
                       pct(e["value"]["outlier_count"])))
    rules = F.transform(
        F.filter(F.map_entries("business_rule_violations"), lambda e: e["value"] > 0),
        lambda e: item(e["key"], "rules",
                       F.concat(F.lit("Rule "), e["key"], F.lit(" has "), e["value"].cast("string"),
                                F.lit(" violating rows")),
                       pct(e["value"])))
    hundred = F.lit(100.0)
    drift = F.concat(
        F.transform("schema_drift_summary.missing_columns",
                    lambda c: item(c, "schema", F.concat(F.lit("Schema change: column "), c,
                                                         F.lit(" is missing from the table")), hundred)),
        F.transform("schema_drift_summary.new_columns",
                    lambda c: item(c, "schema", F.concat(F.lit("Schema change: new column "), c,
                                                         F.lit(" appeared")), hundred)),
        F.transform("schema_drift_summary.type_mismatches",
                    lambda m: item(m["column"], "schema",
                                   F.concat(F.lit("Schema change: column mismatch on "), m["column"], F.lit(" ("),
                                            m["baseline_type"], F.lit(" to "), m["current_type"], F.lit(")")),
                                   hundred)))
    return (log.select("table_name", "run_id", F.explode(F.concat(nulls, outl, rules, drift)).alias("f"))
            .select("table_name", "run_id", "f.*"))


def classify(df: DataFrame, text_col: str = "description") -> DataFrame:
    """Q9 on any text column: adds anomaly_type, severity, explanation."""
    c = tf.classify_anomaly(F.col(text_col))
    return df.withColumns({"anomaly_type": c["type"], "severity": c["severity"], "explanation": c["explanation"]})


def severity(df: DataFrame) -> DataFrame:
    """Numeric severity score and band from type x affected share."""
    s = tf.severity_score(F.col("anomaly_type"), F.col("affected_pct"))
    return df.withColumns({"severity_score": s, "severity_band": tf.severity_band(s)})


# ---------------------------------------------------------------- T9
def suggested_rules(profile: DataFrame, table_name: str, df: DataFrame | None = None,
                    max_set: int = 5) -> DataFrame:
    """Validation rules suggested by a column profile (Q1 rows).

    Not-null where a column had no nulls; an upper bound at the observed max
    for numeric columns; and, when the profiled ``df`` is given, an allowed
    value set for string columns with at most ``max_set`` distinct values.
    Each suggestion is a natural-language text plus the SQL predicate that is
    TRUE for a violating row.
    """
    t = F.lit(table_name)
    not_null = (profile.filter((F.col("null_count") == 0) & (F.col("count") > 0))
                .select(t.alias("table_name"), "ordinal", "column_name", F.lit("not_null").alias("kind"),
                        F.concat(F.lit("Flag "), t, F.lit(" rows where "), F.col("column_name"),
                                 F.lit(" is missing")).alias("rule_text"),
                        F.concat(F.col("column_name"), F.lit(" IS NULL")).alias("predicate")))
    upper = (profile.filter((F.col("kind") == "numeric") & F.col("max").isNotNull())
             .select(t.alias("table_name"), "ordinal", "column_name", F.lit("upper_bound").alias("kind"),
                     F.concat(F.lit("Flag "), t, F.lit(" rows where "), F.col("column_name"), F.lit(" above "),
                              F.col("max")).alias("rule_text"),
                     F.concat(F.col("column_name"), F.lit(" > "), F.col("max")).alias("predicate")))
    out = not_null.unionByName(upper)
    if df is not None:
        out = out.unionByName(allowed_value_rules(df, profile, table_name, max_set))
    return out


def allowed_value_rules(df: DataFrame, profile: DataFrame, table_name: str, max_set: int = 5) -> DataFrame:
    """T9 allowed sets: one rule per low-cardinality string column.

    The profile (one row per column) is read on the driver to pick the
    columns with 1..``max_set`` distinct values; only those columns are then
    scanned, and each group collects at most ``max_set`` values.
    """
    low = [(r["ordinal"], r["column_name"]) for r in profile.filter(
        (F.col("kind") == "string") & (F.col("distinct_count") > 0) & (F.col("distinct_count") <= max_set)
    ).select("ordinal", "column_name").collect()]
    schema = "table_name string, ordinal int, column_name string, kind string, rule_text string, predicate string"
    if not low:
        return df.sparkSession.createDataFrame([], schema)
    pairs = F.array(*[F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("column_name"),
                               F.col(f"`{c}`").alias("value")) for i, c in low])
    values = (df.select(F.explode(pairs).alias("p")).select("p.*").filter(F.col("value").isNotNull())
              .groupBy("ordinal", "column_name").agg(F.sort_array(F.collect_set("value")).alias("vals")))
    quoted = F.transform("vals", lambda v: F.concat(F.lit("'"), F.replace(v, F.lit("'"), F.lit("''")), F.lit("'")))
    return values.select(
        F.lit(table_name).alias("table_name"), F.col("ordinal").cast("int").alias("ordinal"), "column_name",
        F.lit("allowed_set").alias("kind"),
        F.concat(F.lit("Flag "), F.lit(table_name), F.lit(" rows where "), F.col("column_name"),
                 F.lit(" is not one of: "), F.array_join("vals", ", ")).alias("rule_text"),
        F.concat(F.lit("NOT "), F.col("column_name"), F.lit(" IN ("), F.array_join(quoted, ", "),
                 F.lit(")")).alias("predicate"))


# ---------------------------------------------------------------- Q15 / S20
def metadata_summary(meta: DataFrame, schema: DataFrame, null_pct: DataFrame, high: float = 50.0) -> DataFrame:
    """Q15 re-aimed: one Markdown overview per table of ``ingest_metadata``.

    ``meta``: (table_name, row_count, file_size_mb); ``schema``: snapshot
    rows; ``null_pct``: (table_name, ordinal, column_name, null_percentage).
    """
    sch = schema.groupBy("table_name").agg(F.sort_array(F.collect_list(F.struct(
        "ordinal", F.concat(F.lit("- "), F.col("column_name"), F.lit(": "), F.col("data_type")).alias("l")))).alias("s"))
    nul = null_pct.groupBy("table_name").agg(F.sort_array(F.collect_list(F.struct(
        "ordinal", F.col("column_name"), F.col("null_percentage")))).alias("n"))
    j = meta.join(sch, "table_name", "left").join(nul, "table_name", "left")
    null_lines = F.when(F.size(F.coalesce(F.col("n"), F.array())) > 0, F.array_join(F.transform(
        "n", lambda x: F.concat(F.lit("- "), x["column_name"], F.lit(": "), x["null_percentage"].cast("string"),
                                F.lit("% nulls"))), "\n")).otherwise(F.lit("No null statistics available."))
    high_cols = F.transform(F.filter(F.coalesce(F.col("n"), F.array()), lambda x: x["null_percentage"] > high),
                            lambda x: x["column_name"])
    health = (F.when(F.col("row_count") == 0, F.lit("- Table is empty. Needs immediate inspection."))
              .when(F.col("file_size_mb") == 0, F.lit("- File size is zero but row_count > 0 (possible corruption)."))
              .otherwise(F.lit("- Schema and metadata look valid.")))
    extra = F.when(F.size(high_cols) > 0, F.concat(F.lit("\n- High null percentages in: "),
                                                   F.array_join(high_cols, ", "))).otherwise(F.lit(""))
    doc = F.concat(
        F.lit("# Table Overview: "), F.col("table_name"), F.lit("\n\n## Basic Stats\n- Row count: "),
        F.col("row_count").cast("string"), F.lit("\n- File size: "), F.col("file_size_mb").cast("string"),
        F.lit(" MB\n\n## Schema Overview\n"),
        F.array_join(F.transform(F.coalesce(F.col("s"), F.array()), lambda x: x["l"]), "\n"),
        F.lit("\n\n## Null Value Summary\n"), null_lines, F.lit("\n\n## Data Health Observations\n"), health, extra)
    return j.select("table_name", doc.alias("summary"))


# ---------------------------------------------------------------- Q16
PURPOSE = "This table stores transactional or analytical data for `{t}`, used across ingestion, profiling, and ML workflows."


def table_documentation(schema: DataFrame, rules: DataFrame, anomalies: DataFrame, generated_at: str) -> DataFrame:
    """Q16 re-aimed: one Markdown document per table from three tables.

    ``schema``: snapshot rows; ``rules``: (table_name, ordinal, description,
    severity); ``anomalies``: (table_name, anomaly_type, explanation, severity).
    """
    sch = schema.groupBy("table_name").agg(F.sort_array(F.collect_list(F.struct(
        "ordinal", F.concat(F.lit("- "), F.col("column_name"), F.lit(": "), F.col("data_type")).alias("l")))).alias("s"))
    rl = rules.groupBy("table_name").agg(F.sort_array(F.collect_list(F.struct(
        "ordinal", F.concat(F.lit("- "), F.col("description"), F.lit(" (severity: "),
                            F.coalesce(F.col("severity"), F.lit("None")), F.lit(")")).alias("l")))).alias("r"))
    an = anomalies.groupBy("table_name").agg(F.sort_array(F.collect_list(F.struct(
        F.concat(F.lit("- "), F.col("anomaly_type"), F.lit(": "), F.col("explanation"), F.lit(" (severity: "),
                 F.col("severity"), F.lit(")")).alias("l")))).alias("a"))
    j = sch.join(rl, "table_name", "left").join(an, "table_name", "left")
    lines = lambda c, empty: F.when(F.size(F.coalesce(F.col(c), F.array())) > 0,
                                    F.array_join(F.transform(c, lambda x: x["l"]), "\n")).otherwise(F.lit(empty))
    t = F.col("table_name")
    pre, post = PURPOSE.split("{t}")
    doc = F.concat(
        F.lit("# Documentation for Table: "), t, F.lit("\n\nGenerated at: " + generated_at + "\n\n## Purpose\n"),
        F.lit(pre), t, F.lit(post), F.lit("\n\n## Schema Overview\n"),
        F.array_join(F.transform(F.coalesce(F.col("s"), F.array()), lambda x: x["l"]), "\n"),
        F.lit("\n\n## Data Quality Rules\n"), lines("r", "- No rules defined."),
        F.lit("\n\n## Anomaly Summary\n"), lines("a", "- No anomalies detected."), F.lit("\n"))
    return j.select("table_name", doc.alias("documentation"))
