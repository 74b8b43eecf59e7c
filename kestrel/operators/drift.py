"""Schema snapshots, drift between two snapshots, the drift report, and
type inference over raw text columns.

A snapshot is a DataFrame ``(table_name, column_name, data_type, ordinal)``.
Drift is a **full outer join** of two snapshots on (table, column): a column
only in the baseline is *missing*, only in the current is *new*, in both with
different types is a *type_mismatch*.  Snapshots are schema-sized.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.sources.io import read_if_exists

from kestrel.schemas import type_text

SNAPSHOT_SCHEMA = "table_name string, column_name string, data_type string, ordinal int"


def schema_snapshot(spark: SparkSession, table_name: str, schema: T.StructType | DataFrame) -> DataFrame:
    """Q2: the schema of a table (or of a DataFrame) as rows."""
    st = schema.schema if isinstance(schema, DataFrame) else schema
    rows = [(table_name, f.name, type_text(f.dataType), i) for i, f in enumerate(st.fields)]
    return spark.createDataFrame(rows, SNAPSHOT_SCHEMA)


def payload_snapshot(df: DataFrame, json_col: str, table_name: str) -> DataFrame:
    """The keys of a JSON object column with their types merged over all rows, as a snapshot (one row a key).

    Types merge as in ``schema_of_variant_agg``: numbers widen, a null fits any type, and others become VARIANT.
    Null and malformed text and values that are no objects give no key.  Merging starts before the shuffle.
    """
    payloads = df.select(F.try_parse_json(json_col).alias("_payload"))
    fields = payloads.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_payload").outer()))
    types = fields.where("key IS NOT NULL").groupBy("key").agg(F.schema_of_variant_agg("value").alias("data_type"))
    return types.select(F.lit(table_name).alias("table_name"), F.col("key").alias("column_name"), "data_type", F.lit(0).alias("ordinal"))


def schema_drift(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """(table_name, column_name, change_type, baseline_type, current_type).

    change_type is ``missing`` / ``new`` / ``type_mismatch``; equal columns
    produce no row.
    """
    b = baseline.select("table_name", "column_name", F.col("data_type").alias("baseline_type"),
                        F.col("ordinal").alias("b_ord"))
    c = current.select("table_name", "column_name", F.col("data_type").alias("current_type"),
                       F.col("ordinal").alias("c_ord"))
    j = b.join(c, ["table_name", "column_name"], "full_outer")
    change = (F.when(F.col("current_type").isNull(), F.lit("missing"))
              .when(F.col("baseline_type").isNull(), F.lit("new"))
              .when(F.col("baseline_type") != F.col("current_type"), F.lit("type_mismatch")))
    return (j.withColumn("change_type", change).filter(F.col("change_type").isNotNull())
            .select("table_name", "column_name", "change_type", "baseline_type", "current_type"))


def drift_summary(drift: DataFrame) -> DataFrame:
    """Per table: struct(missing_columns, new_columns, type_mismatches), names sorted.

    The per-table groups hold one entry per drifted column (schema-sized).
    """
    mm = F.struct(F.col("column_name").alias("column"), F.col("baseline_type"), F.col("current_type"))
    return drift.groupBy("table_name").agg(
        F.sort_array(F.collect_list(F.when(F.col("change_type") == "missing", F.col("column_name")))).alias("missing_columns"),
        F.sort_array(F.collect_list(F.when(F.col("change_type") == "new", F.col("column_name")))).alias("new_columns"),
        F.sort_array(F.collect_list(F.when(F.col("change_type") == "type_mismatch", mm))).alias("type_mismatches"),
    )


def drift_report(drift: DataFrame, tables: DataFrame | None = None) -> DataFrame:
    """Q3 text: "# Schema Drift Summary" with Added / Removed / Changed blocks.

    ``tables`` (one column ``table_name``) lists tables to report even when
    they have no drift ("No schema drift detected.").  Columns are sorted by
    name inside each block.
    """
    lines = F.sort_array(F.collect_list(F.struct(
        F.col("column_name"), F.col("change_type"), F.col("baseline_type"), F.col("current_type"))))

    def block(kind: str, title: str, fmt) -> F.Column:
        items = F.filter(F.col("items"), lambda x: x["change_type"] == kind)
        body = F.array_join(F.transform(items, fmt), "\n")
        return F.when(F.size(items) > 0, F.concat(F.lit(title + "\n"), body, F.lit("\n\n"))).otherwise(F.lit(""))

    per = drift.groupBy("table_name").agg(lines.alias("items"))
    if tables is not None:
        per = tables.select("table_name").distinct().join(per, "table_name", "left")
    added = block("new", "## Added Columns:",
                  lambda x: F.concat(F.lit("- "), x["column_name"], F.lit(": "), x["current_type"]))
    removed = block("missing", "## Removed Columns:",
                    lambda x: F.concat(F.lit("- "), x["column_name"], F.lit(": previously "), x["baseline_type"]))
    changed = block("type_mismatch", "## Columns With Changed Datatypes:",
                    lambda x: F.concat(F.lit("- "), x["column_name"], F.lit(": "), x["baseline_type"],
                                       F.lit(" → "), x["current_type"]))
    has = F.coalesce(F.size(F.col("items")), F.lit(0)) > 0
    body = F.when(has, F.regexp_replace(F.concat(added, removed, changed), "\n\\z", "")).otherwise(
        F.lit("No schema drift detected."))
    return per.select("table_name", F.concat(F.lit("# Schema Drift Summary\n\n"), body).alias("report"))


# ---------------------------------------------------------------- S1 inference
INT_RE = r"^[+-]?[0-9]+\z"
DEC_RE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
DATE_RE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"


# What a present value rules out; PRESENT alone would be a value of every type.
NOT_INT, NOT_LONG, NOT_DOUBLE, NOT_DATE, PRESENT = 1, 2, 4, 8, 16


def type_mask(v: F.Column) -> F.Column:
    """The types that a trimmed text rules out, as bits; 0 for null or blank.

    A failing cast raises inside the task, which costs more than all else, so casts are tried only on texts
    of the right form, and texts that cannot begin a number or date meet no pattern.
    """
    real = F.lit(PRESENT | NOT_INT | NOT_LONG | NOT_DATE)
    as_long = v.try_cast("long")
    whole = (F.when(F.length(v) <= 9, F.lit(PRESENT | NOT_DATE))
             .when(as_long.between(-2**31, 2**31 - 1), F.lit(PRESENT | NOT_DATE))
             .when(as_long.isNotNull(), F.lit(PRESENT | NOT_DATE | NOT_INT)).otherwise(real))
    none = F.lit(PRESENT | NOT_INT | NOT_LONG | NOT_DOUBLE | NOT_DATE)
    return (F.when(v.isNull() | (v == ""), F.lit(0))
            .when((v < "+") | (v >= ":"), none)
            .when(v.rlike(INT_RE), whole)
            .when(v.rlike(DEC_RE), real)
            .when(v.rlike(DATE_RE), F.when(v.try_cast("date").isNotNull(), F.lit(PRESENT | NOT_INT | NOT_LONG | NOT_DOUBLE))
                  .otherwise(none))
            .otherwise(none))


def infer_types(df: DataFrame, table_name: str) -> DataFrame:
    """Infer a type for every text column from its values, in one aggregate.

    Mirrors CSV ``inferSchema``: integer if every non-null value is an
    integer in 32-bit range, long if in 64-bit range, double if numeric,
    date if ``yyyy-MM-dd``, else string.  Output is a snapshot frame, so it
    plugs straight into :func:`schema_drift`.
    """
    names = df.columns
    items = []
    for i, name in enumerate(names):
        m = F.coalesce(F.col(f"m{i}"), F.lit(0))
        t = (F.when(m == 0, F.lit("StringType()"))
             .when(m.bitwiseAND(NOT_INT) == 0, F.lit("IntegerType()"))
             .when(m.bitwiseAND(NOT_LONG) == 0, F.lit("LongType()"))
             .when(m.bitwiseAND(NOT_DOUBLE) == 0, F.lit("DoubleType()"))
             .when(m.bitwiseAND(NOT_DATE) == 0, F.lit("DateType()"))
             .otherwise(F.lit("StringType()")))
        items.append(F.struct(F.lit(table_name).alias("table_name"), F.lit(name).alias("column_name"),
                              t.alias("data_type"), F.lit(i).alias("ordinal")))
    masks = [F.bit_or(type_mask(F.trim(F.col(f"`{name}`").cast("string")))).alias(f"m{i}") for i, name in enumerate(names)]
    return df.agg(*masks).select(F.inline(F.array(*items)))


def column_sets(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """Per table, sorted added / removed / common column names (set algebra on arrays)."""
    b = baseline.groupBy("table_name").agg(F.collect_set("column_name").alias("b"))
    c = current.groupBy("table_name").agg(F.collect_set("column_name").alias("c"))
    e = F.array().cast("array<string>")
    j = b.join(c, "table_name", "full_outer").select("table_name", F.coalesce("b", e).alias("b"),
                                                     F.coalesce("c", e).alias("c"))
    return j.select("table_name", F.array_sort(F.array_except("c", "b")).alias("added"),
                    F.array_sort(F.array_except("b", "c")).alias("removed"),
                    F.array_sort(F.array_intersect("b", "c")).alias("common"))


def store_snapshots(snapshots: DataFrame, path: str, run_id: str, fmt: str = "parquet") -> None:
    """Append this run's schema snapshots (table, column, type, ordinal, run_id).

    Only (table, run) pairs not stored yet are appended, so a retried run is
    harmless.  Snapshot tables are schema-sized.
    """
    spark = snapshots.sparkSession
    snap = snapshots.withColumns({"run_id": F.lit(run_id), "stored_at": F.current_timestamp()})
    stored = read_if_exists(spark, path, fmt)
    if stored is not None:
        snap = snap.join(stored.select("table_name", "run_id").distinct(), ["table_name", "run_id"], "left_anti")
    snap.write.mode("append").format(fmt).save(path)


def stored_baselines(spark: SparkSession, path: str, fmt: str = "parquet") -> dict[str, dict[str, str]]:
    """The first stored snapshot of every table as ``{table: {column: type}}``.

    Read on the driver: one row per column of each table (schema-sized).
    """
    snaps = read_if_exists(spark, path, fmt)
    if snaps is None:
        return {}
    first = snaps.groupBy("table_name").agg(F.min_by("run_id", F.struct("stored_at", "run_id")).alias("run_id"))
    rows = snaps.join(first, ["table_name", "run_id"]).select("table_name", "column_name", "data_type").collect()
    out: dict[str, dict[str, str]] = {}
    for r in rows:
        out.setdefault(r["table_name"], {})[r["column_name"]] = r["data_type"]
    return out
