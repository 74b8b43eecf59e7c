"""Business rules kept as data; natural-language rule parsing and evaluation.

A rule is a row ``(table_name, rule_name, predicate)`` where ``predicate`` is
a SQL boolean expression that is TRUE for a violating row.  All rules of a
table are evaluated as ``count_if`` columns of **one** aggregate; a NULL
predicate is not a violation (three-valued logic).  The rules table is small
by construction (one row per rule), so reading it on the driver to build the
aggregate is bounded by the number of rules, never by the data.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.functions import text as tf

# The twelve default rules (names as in the reference; the
# status / payment-method lists compared in lower case, as silver stores them).
DEFAULT_RULES = [
    ("customers_silver", "age_valid", "age < 18 OR age > 90"),
    ("customers_silver", "email_valid", "NOT contains(email, '@')"),
    ("customers_silver", "phone_valid", "length(phone) != 10"),
    ("customers_silver", "signup_date_valid", "signup_date > {as_of}"),
    ("sales_silver", "quantity_positive", "quantity <= 0"),
    ("sales_silver", "amount_positive", "amount <= 0"),
    ("sales_silver", "product_id_not_null", "product_id IS NULL"),
    ("sales_silver", "sale_date_valid", "sale_date > {as_of}"),
    ("transactions_silver", "amount_positive", "amount <= 0"),
    ("transactions_silver", "status_valid", "NOT lower(trim(status)) IN ('success', 'failed')"),
    ("transactions_silver", "payment_method_valid",
     "NOT lower(trim(payment_method)) IN ('upi', 'card', 'netbanking', 'wallet')"),
    ("transactions_silver", "transaction_date_valid", "transaction_date > {as_of}"),
]


# The two customer rules the documentation and the consumer-side
# log fixture name (age_negative, invalid_email_format); the email pattern is
# "something@something.something".
DOCUMENTED_RULES = [
    ("customers_silver", "age_negative", "age < 0"),
    ("customers_silver", "invalid_email_format", "NOT email LIKE '%_@_%._%'"),
]


def _as_of_sql(as_of) -> str:
    if as_of is None:
        return "current_date()"
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        return f"DATE '{as_of:%Y-%m-%d}'"
    return f"DATE '{as_of}'"


def rules_frame(spark: SparkSession, rules=None) -> DataFrame:
    """The rule set as a DataFrame (table_name, rule_name, predicate)."""
    return spark.createDataFrame(rules or DEFAULT_RULES, "table_name string, rule_name string, predicate string")


def rules_for(table_name: str, rules=None, as_of=None) -> list[tuple[str, Column]]:
    """(rule_name, predicate Column) for one table, ``{as_of}`` substituted."""
    a = _as_of_sql(as_of)
    return [(r, F.expr(p.replace("{as_of}", a))) for t, r, p in (rules or DEFAULT_RULES) if t == table_name]


def rule_measures(rules: list[tuple[str, Column]]) -> list[Column]:
    return [F.count_if(pred).alias(f"rule{j}") for j, (_, pred) in enumerate(rules)]


def rule_map(rules: list[tuple[str, Column]]) -> Column:
    """map<rule_name, violations> over a frame holding ``rule_measures``."""
    if not rules:
        return F.create_map().cast("map<string,bigint>")
    return F.map_from_arrays(F.array(*[F.lit(r) for r, _ in rules]),
                             F.array(*[F.col(f"rule{j}") for j in range(len(rules))]))


def business_rules(df: DataFrame, table_name: str, rules=None, as_of=None) -> DataFrame:
    """Q8: (rule_name, violations) for every rule of ``table_name`` in one pass."""
    rs = rules_for(table_name, rules, as_of)
    if not rs:
        return df.sparkSession.createDataFrame([], "rule_name string, violations bigint")
    items = [F.struct(F.lit(r).alias("rule_name"), F.col(f"rule{j}").alias("violations"))
             for j, (r, _) in enumerate(rs)]
    return df.agg(*rule_measures(rs)).select(F.inline(F.array(*items)))


# ---------------------------------------------------------------- Q10
def parse_rules(rules_text: DataFrame, text_col: str = "rule_text",
                created_at: str | None = None, generated_by: str = "kestrel") -> DataFrame:
    """Q10: natural-language rule -> structured rule, as column expressions.

    Keeps the input columns and adds rule_id (deterministic: sha1 of the
    text), description, column (comma list), rule_type, thresholds struct,
    severity, action and metadata struct.
    """
    t = F.col(text_col)
    max_threshold = tf.rule_threshold(t)
    created = F.lit(created_at) if created_at else F.date_format(F.current_date(), "yyyy-MM-dd")
    return rules_text.select(
        "*",
        tf.rule_id(t).alias("rule_id"),
        t.alias("description"),
        tf.rule_columns(t).alias("column"),
        tf.rule_type(t).alias("rule_type"),
        F.struct(F.lit(None).cast("double").alias("min"), max_threshold.alias("max"),
                 F.lit(None).cast("string").alias("regex")).alias("thresholds"),
        tf.rule_severity(max_threshold).alias("severity"),
        F.lit("flag").alias("action"),
        F.struct(created.alias("created_at"), F.lit(generated_by).alias("generated_by")).alias("metadata"),
    )


# ---------------------------------------------------------------- Q11
CHECK_ARRAY = "array<struct<check:string,column_name:string,threshold:double>>"
NOT_CHECKABLE = "not checkable"

def rule_checks(parsed: DataFrame) -> DataFrame:
    """The checks a parsed rule implies, one row each (rule_id, check, column_name, threshold).

    null_check rules check IS NULL on every listed column; a max threshold
    checks ``first column > max``; a rule with neither yields one row without a check.
    """
    cols = tf.split_list(F.col("column"))
    nulls = F.when(F.col("rule_type") == "null_check",
                   F.transform(cols, lambda c: F.struct(F.lit("is_null").alias("check"), c.alias("column_name"),
                                                        F.lit(None).cast("double").alias("threshold"))))
    maxc = F.when(F.col("thresholds.max").isNotNull() & (F.size(cols) > 0),
                  F.array(F.struct(F.lit("greater_than").alias("check"), cols[0].alias("column_name"),
                                   F.col("thresholds.max").alias("threshold"))))
    none = F.array().cast(CHECK_ARRAY)
    all_checks = F.concat(F.coalesce(nulls, none), F.coalesce(maxc, none))
    return parsed.select("rule_id", "description", F.posexplode_outer(all_checks).alias("check_no", "c")).select(
        "rule_id", "description", "check_no", "c.check", "c.column_name", "c.threshold")


def evaluate_rules(df: DataFrame, checks: DataFrame) -> DataFrame:
    """Q11: violations per check, all checks in **one** pass over ``df``.

    ``checks`` (one row per check, bounded by the rule count) is read on the
    driver to build ``count_if`` columns.  A check on a column ``df`` lacks
    yields ``violations = NULL`` and an error text instead of failing, and so
    does a rule without a check.
    """
    spec = checks.select("rule_id", "description", "check_no", "check", "column_name", "threshold").collect()
    have = set(df.columns)
    aggs, items = [], []
    for j, r in enumerate(spec):
        ok = r["column_name"] in have
        if ok:
            c = F.col(f"`{r['column_name']}`")
            pred = c.isNull() if r["check"] == "is_null" else (c > F.lit(r["threshold"]))
            aggs.append(F.count_if(pred).alias(f"chk{j}"))
        items.append(F.struct(
            F.lit(r["rule_id"]).alias("rule_id"), F.lit(r["description"]).alias("description"),
            F.lit(r["check_no"]).cast("int").alias("check_no"), F.lit(r["check"]).cast("string").alias("check"),
            F.lit(r["column_name"]).cast("string").alias("column_name"),
            F.lit(r["threshold"]).cast("double").alias("threshold"),
            (F.col(f"chk{j}") if ok else F.lit(None).cast("long")).alias("violations"),
            F.lit(None if ok else NOT_CHECKABLE if r["check"] is None else f"unknown column: {r['column_name']}")
            .cast("string").alias("error"),
        ))
    schema = ("rule_id string, description string, check_no int, check string, column_name string, "
              "threshold double, violations bigint, error string")
    if not items:
        return df.sparkSession.createDataFrame([], schema)
    base = df.agg(*aggs) if aggs else df.sparkSession.range(1)
    return base.select(F.inline(F.array(*items)))
