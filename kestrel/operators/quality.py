"""The fused table profile, quality score, readable summary and quality log.

``table_quality`` produces the complete quality-log row of a table with
**two scans**: pass 1 is one global aggregate holding every profile
statistic, null count, rule violation count, mean and stddev; pass 2 counts
z-score outliers against the one-row statistics (broadcast).  Score, text
summary and JSON columns are expressions over those two one-row frames.
The reference needs 1 + C + 2N + 4 actions per table for the same output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.operators import profile as P
from kestrel.operators import rules as R
from kestrel.schemas import type_text

# The summary lines (⚠ = finding, ✔ = clean) -- drift, no drift,
# high nulls, no high nulls, outliers, no outliers, closing -- of the master
# profiler (canonical) and of the three per-table profilers; {t} is the table
# name and {cols} the comma-joined column list.
SUMMARY_TEMPLATES = {
    "master": (
        "⚠ Schema drift detected in {t}. Please review structural changes.",
        "✔ No schema drift detected in {t}. Schema matches baseline.",
        "⚠ High null percentages found in: {cols}.",
        "✔ No significant null anomalies detected in {t}.",
        "⚠ Outliers detected in numeric columns: {cols}.",
        "✔ No numeric outliers detected in {t}.",
        "✔ Overall, {t} looks healthy and ready for downstream use.",
    ),
    "customers": (
        "⚠ Schema drift detected. Please review the structural changes.",
        "✔ No schema drift detected. The structure matches the baseline schema.",
        "⚠ High null percentages found in: {cols}.",
        "✔ No significant null anomalies detected. All columns are complete.",
        "⚠ Outliers detected in: {cols}.",
        "✔ No numeric outliers detected. Value distributions look normal.",
        "✔ Dataset appears clean, consistent, and ready for downstream transformations.",
    ),
    "sales": (
        "⚠ Schema drift detected in sales_silver. Please review the changes.",
        "✔ No schema drift detected in sales_silver. Schema matches baseline.",
        "⚠ High null percentages in: {cols}.",
        "✔ No significant null anomalies detected in sales_silver.",
        "⚠ Outliers detected in numeric columns: {cols}.",
        "✔ No numeric outliers detected in sales_silver.",
        "✔ Dataset looks healthy and ready for GOLD aggregations.",
    ),
    "transactions": (
        "⚠ Schema drift detected in transactions_silver. Please review the structural changes.",
        "✔ No schema drift detected in transactions_silver. Schema matches the baseline.",
        "⚠ High null percentages found in: {cols}.",
        "✔ No significant null anomalies detected in transactions_silver.",
        "⚠ Outliers detected in numeric columns: {cols}.",
        "✔ No numeric outliers detected in transactions_silver.",
        "✔ Dataset appears consistent and ready for downstream fraud analysis or payment behavior modelling.",
    ),
}
# Score penalties.
PENALTY_MISSING, PENALTY_NEW, PENALTY_MISMATCH = 30, 10, 20
PENALTY_NULL_COLUMN, PENALTY_OUTLIER_COLUMN = 10, 5

MISMATCH_T = "array<struct<column:string,baseline_type:string,current_type:string>>"


def drift_struct(baseline: T.StructType | dict[str, str] | None, current: T.StructType) -> Column:
    """Drift of two in-hand schemas as a literal struct (schema-sized metadata).

    ``baseline`` is a declared schema or a stored snapshot as
    ``{column: type text}``; with none (first run) the current schema is the
    baseline.
    """
    if isinstance(baseline, dict):
        b = dict(baseline)
    else:
        b = {f.name: type_text(f.dataType) for f in (baseline or current).fields}
    c = {f.name: type_text(f.dataType) for f in current.fields}
    missing = sorted(x for x in b if x not in c)
    new = sorted(x for x in c if x not in b)
    mism = sorted((x, b[x], c[x]) for x in b if x in c and b[x] != c[x])
    arr = lambda xs: F.array(*[F.lit(x) for x in xs]).cast("array<string>")
    mm = F.array(*[F.struct(F.lit(x).alias("column"), F.lit(y).alias("baseline_type"),
                            F.lit(z).alias("current_type")) for x, y, z in mism]).cast(MISMATCH_T)
    return F.struct(arr(missing).alias("missing_columns"), arr(new).alias("new_columns"),
                    mm.alias("type_mismatches"))


def has_drift(drift: Column) -> Column:
    return ((F.size(drift["missing_columns"]) > 0) | (F.size(drift["new_columns"]) > 0)
            | (F.size(drift["type_mismatches"]) > 0))


def high_null_columns(nulls: Column, threshold: float = 20.0) -> Column:
    """Columns whose *rounded* null percentage exceeds the threshold, in order."""
    return F.transform(F.filter(nulls, lambda x: x["null_percentage"] > threshold), lambda x: x["column_name"])


def outlier_columns(outliers: Column) -> Column:
    return F.transform(F.filter(outliers, lambda x: F.coalesce(x["outlier_count"], F.lit(0)) > 0),
                       lambda x: x["column_name"])


def quality_score(drift: Column, nulls: Column, outliers: Column, threshold: float = 20.0) -> Column:
    """Q6: 100 minus penalties, floored at 0."""
    score = (F.lit(100)
             - F.when(F.size(drift["missing_columns"]) > 0, PENALTY_MISSING).otherwise(0)
             - F.when(F.size(drift["new_columns"]) > 0, PENALTY_NEW).otherwise(0)
             - F.when(F.size(drift["type_mismatches"]) > 0, PENALTY_MISMATCH).otherwise(0)
             - PENALTY_NULL_COLUMN * F.size(high_null_columns(nulls, threshold))
             - PENALTY_OUTLIER_COLUMN * F.size(outlier_columns(outliers)))
    return F.greatest(score, F.lit(0)).cast("int")


def _fmt(template: str, t: Column, cols: Column | None = None) -> Column:
    parts = []
    rest = template
    while rest:
        i_t, i_c = rest.find("{t}"), rest.find("{cols}")
        cands = [(i, k) for i, k in ((i_t, "t"), (i_c, "cols")) if i >= 0]
        if not cands:
            parts.append(F.lit(rest))
            break
        i, k = min(cands)
        if i:
            parts.append(F.lit(rest[:i]))
        parts.append(t if k == "t" else F.array_join(cols, ", "))
        rest = rest[i + (3 if k == "t" else 6):]
    return F.concat(*parts)


def quality_summary(table: Column, drift: Column, nulls: Column, outliers: Column,
                    threshold: float = 20.0, template: str = "master") -> Column:
    """Q7: four lines (drift / nulls / outliers / closing) joined by newline.

    ``template`` selects the wording: "master" (canonical) or one of the
    per-table variants "customers", "sales", "transactions".
    """
    drift_l, ok_drift, null_l, ok_null, out_l, ok_out, closing = SUMMARY_TEMPLATES[template]
    hn, oc = high_null_columns(nulls, threshold), outlier_columns(outliers)
    return F.concat_ws(
        "\n",
        F.when(has_drift(drift), _fmt(drift_l, table)).otherwise(_fmt(ok_drift, table)),
        F.when(F.size(hn) > 0, _fmt(null_l, table, hn)).otherwise(_fmt(ok_null, table)),
        F.when(F.size(oc) > 0, _fmt(out_l, table, oc)).otherwise(_fmt(ok_out, table)),
        _fmt(closing, table),
    )


def _as_map(arr: Column, value_fields: list[str]) -> Column:
    return F.map_from_entries(F.transform(arr, lambda x: F.struct(
        x["column_name"], F.struct(*[x[f].alias(f) for f in value_fields]))))


def table_quality(df: DataFrame, table_name: str, run_id: str, timestamp: str,
                  baseline: T.StructType | dict[str, str] | None = None, rules=None, as_of=None,
                  k: float = 3.0, threshold: float = 20.0, approx: bool = True,
                  summary_template: str = "master", distinct_chunk: int | None = None) -> DataFrame:
    """Q18 for one table: the full quality-log row, from two scans of ``df``.

    Distinct counts in the log are HyperLogLog++ estimates by default: exact ones would
    multiply every row by the column count and shuffle every distinct value.
    ``approx=False`` counts exactly; ``distinct_chunk`` (very wide tables) then takes
    extra passes of that many columns each.
    """
    rs = R.rules_for(table_name, rules, as_of)
    wide = P.profile_row(df, approx, R.rule_measures(rs), distinct_chunk)      # pass 1
    numeric = P._columns(df, ("numeric",))
    both = P.outlier_counts(df, wide, k) if numeric else wide                  # pass 2
    t = F.lit(table_name)
    drift = drift_struct(baseline, df.schema)
    nulls = P.null_stats_array(df, threshold)
    outl = P.outlier_stats_array(df)
    row = both.select(
        t.alias("table_name"), F.lit(run_id).alias("run_id"), F.lit(timestamp).alias("timestamp"),
        P.column_stats_array(df).alias("statistics"), nulls.alias("_nulls"), outl.alias("_outliers"),
        drift.alias("schema_drift_summary"), R.rule_map(rs).alias("business_rule_violations"),
    )
    row = row.select(
        "table_name", "run_id", "timestamp",
        quality_score(F.col("schema_drift_summary"), F.col("_nulls"), F.col("_outliers"), threshold).alias("quality_score"),
        quality_summary(t, F.col("schema_drift_summary"), F.col("_nulls"), F.col("_outliers"), threshold,
                        summary_template).alias("ai_summary"),
        "statistics",
        _as_map(F.col("_nulls"), ["null_count", "total_rows", "null_percentage", "issue"]).alias("null_summary"),
        _as_map(F.col("_outliers"), ["mean", "stddev", "outlier_count", "reason"]).alias("outlier_summary"),
        "schema_drift_summary", "business_rule_violations",
    )
    return with_json_columns(row)


def with_json_columns(log: DataFrame) -> DataFrame:
    """The four flat JSON columns of the reference's log, from the typed ones."""
    return log.withColumns({
        "schema_drift_json": F.to_json("schema_drift_summary"),
        "null_anomalies_json": F.to_json("null_summary"),
        "outlier_report_json": F.to_json("outlier_summary"),
        "business_rules_json": F.to_json("business_rule_violations"),
    })


def profile_tables(tables: dict[str, DataFrame], run_id: str, timestamp: str,
                   baselines: dict[str, T.StructType] | None = None, **kw) -> DataFrame:
    """Q18: one log row per table, unioned (U2).  Append it with ``sinks.append``."""
    out = None
    for name, df in tables.items():
        r = table_quality(df, name, run_id, timestamp, (baselines or {}).get(name), **kw)
        out = r if out is None else out.unionByName(r)
    return out


def run_over_run(log: DataFrame) -> DataFrame:
    """Q22: each run against the previous run of the same table.

    Adds previous run id, score change, and the columns that newly drifted,
    newly crossed the null threshold or newly show outliers.
    """
    from pyspark.sql import Window

    w = Window.partitionBy("table_name").orderBy("timestamp", "run_id")
    drifted = F.array_union(F.array_union(F.col("schema_drift_summary.missing_columns"),
                                          F.col("schema_drift_summary.new_columns")),
                            F.transform(F.col("schema_drift_summary.type_mismatches"), lambda x: x["column"]))
    high_null = F.map_keys(F.map_filter("null_summary", lambda k, v: v["issue"] != "OK"))
    outl = F.map_keys(F.map_filter("outlier_summary", lambda k, v: F.coalesce(v["outlier_count"], F.lit(0)) > 0))
    cur = log.select("table_name", "run_id", "timestamp", "quality_score",
                     F.array_sort(drifted).alias("d"), F.array_sort(high_null).alias("hn"),
                     F.array_sort(outl).alias("oc"))
    prev = lambda c: F.lag(c).over(w)
    none = F.array().cast("array<string>")
    return cur.select(
        "table_name", "run_id", "timestamp", "quality_score",
        prev("run_id").alias("previous_run_id"),
        (F.col("quality_score") - prev("quality_score")).alias("score_change"),
        F.array_except("d", F.coalesce(prev("d"), none)).alias("newly_drifted_columns"),
        F.array_except("hn", F.coalesce(prev("hn"), none)).alias("new_high_null_columns"),
        F.array_except("oc", F.coalesce(prev("oc"), none)).alias("new_outlier_columns"),
    )
