"""Oracle SQL per registered query (DuckDB dialect, same column names)."""

from __future__ import annotations

from kestrel.plans.oracle_sql import with_ctes

ORACLES: dict[str, str] = {}


def oracle(name: str, body: str, extra: dict[str, str] | None = None) -> None:
    ORACLES[name] = with_ctes(body, extra)


# ---------------------------------------------------------------- ingestion
oracle("clean_customers", "SELECT * FROM customers_silver")
oracle("clean_sales", "SELECT * FROM sales_silver")
oracle("clean_transactions", "SELECT * FROM transactions_silver")

# ---------------------------------------------------------------- gold
_CUST_ATTRS = "c.first_name, c.last_name, c.email, c.phone, c.city, c.country, c.signup_date, c.age"
oracle("customer_sales_enriched", f"""
SELECT s.sale_id, s.customer_id, s.product_id, s.sale_date, s.quantity, s.amount, {_CUST_ATTRS}
FROM sales_silver s LEFT JOIN customers_dedup c ON s.customer_id = c.customer_id""")
oracle("customer_transactions_enriched", f"""
SELECT t.transaction_id, t.customer_id, t.transaction_date, t.payment_method, t.status, t.amount, {_CUST_ATTRS}
FROM transactions_silver t LEFT JOIN customers_dedup c ON t.customer_id = c.customer_id""")
oracle("gold_customer_sales", """
SELECT s.customer_id, CAST(sum(s.amount) AS BIGINT) AS total_spend, count(s.sale_id) AS total_orders,
       round(avg(s.amount), 4) AS avg_order_value, min(s.sale_date) AS first_purchase_date,
       max(s.sale_date) AS last_purchase_date
FROM sales_silver s LEFT JOIN customers_dedup c ON s.customer_id = c.customer_id
GROUP BY s.customer_id""")
oracle("gold_product_sales", """
SELECT product_id, CAST(sum(quantity) AS BIGINT) AS total_quantity_sold, CAST(sum(amount) AS BIGINT) AS total_revenue,
       round(avg(amount), 4) AS avg_price, min(sale_date) AS first_sale_date, max(sale_date) AS last_sale_date
FROM sales_silver GROUP BY product_id""")

_PAYMENT_COUNTS = """SELECT customer_id, payment_method, count(payment_method) AS method_count
FROM transactions_silver GROUP BY customer_id, payment_method"""
_TOP_METHOD = """SELECT customer_id, payment_method AS most_used_payment_method FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY method_count DESC, payment_method ASC NULLS LAST) AS rn
  FROM payment_counts) WHERE rn = 1"""
oracle("payment_method_counts", "SELECT * FROM payment_counts", {"payment_counts": _PAYMENT_COUNTS})
oracle("top_payment_method", _TOP_METHOD, {"payment_counts": _PAYMENT_COUNTS})
oracle("gold_customer_transactions", """
SELECT b.*, t.most_used_payment_method FROM (
  SELECT customer_id, CAST(sum(amount) AS BIGINT) AS total_transaction_amount, count(transaction_id) AS transaction_count,
         CAST(sum(CASE WHEN status = 'success' THEN 1 ELSE 0 END) AS BIGINT) AS success_count,
         CAST(sum(CASE WHEN status = 'failed' THEN 1 ELSE 0 END) AS BIGINT) AS failed_count,
         min(transaction_date) AS first_transaction_date, max(transaction_date) AS last_transaction_date
  FROM transactions_silver GROUP BY customer_id) b
LEFT JOIN top_method t ON b.customer_id = t.customer_id""",
       {"payment_counts": _PAYMENT_COUNTS, "top_method": _TOP_METHOD})

# ---------------------------------------------------------------- profiling
from kestrel import schemas  # noqa: E402
from kestrel.operators.rules import DEFAULT_RULES  # noqa: E402
from kestrel.schemas import kind_of  # noqa: E402

FEEDS = ("customers", "sales", "transactions")
AS_OF_SQL = "DATE '2024-02-01'"


def _cols(feed):
    return [(i, f.name, kind_of(f.dataType)) for i, f in enumerate(schemas.SILVER[feed].fields)]


def _silver(feed):
    return schemas.SILVER_TABLE_NAMES[feed]


def profile_sql(feed):
    parts = []
    for i, c, k in _cols(feed):
        if k == "other":
            continue
        avg = f"round(avg({c}), 4)" if k == "numeric" else "CAST(NULL AS DOUBLE)"
        mn = f"CAST(min({c}) AS VARCHAR)" if k in ("numeric", "date") else "CAST(NULL AS VARCHAR)"
        mx = f"CAST(max({c}) AS VARCHAR)" if k in ("numeric", "date") else "CAST(NULL AS VARCHAR)"
        parts.append(f"SELECT {i} AS ordinal, '{c}' AS column_name, '{k}' AS kind, count({c}) AS count, "
                     f"count(DISTINCT {c}) AS distinct_count, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
                     f"{avg} AS avg, {mn} AS min, {mx} AS max FROM {_silver(feed)}")
    return "\nUNION ALL ".join(parts)


def nulls_sql(feed, columns=None, threshold=20, src=None):
    src = src or _silver(feed)
    parts = []
    for i, c, _ in _cols(feed):
        if columns and c not in columns:
            continue
        pct = f"(CASE WHEN count(*) > 0 THEN count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*) ELSE 0.0 END)"
        parts.append(f"SELECT {i} AS ordinal, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
                     f"count(*) AS total_rows, round({pct}, 2) AS null_percentage, "
                     f"CASE WHEN {pct} > {threshold} THEN 'High null percentage' ELSE 'OK' END AS issue "
                     f"FROM {src}")
    return "\nUNION ALL ".join(parts)


def zscore_sql(feed, k=3, src=None):
    src = src or _silver(feed)
    num = [(i, c) for i, c, kind in _cols(feed) if kind == "numeric"]
    stats = ", ".join(f"avg({c}) AS a{i}, stddev_samp({c}) AS s{i}" for i, c in num)
    counts = ", ".join(
        f"count(*) FILTER (WHERE st.s{i} IS NOT NULL AND st.s{i} <> 0 AND (t.{c} - st.a{i}) / st.s{i} > {k}) AS o{i}"
        for i, c in num)
    parts = []
    for i, c in num:
        var = f"(s{i} IS NOT NULL AND s{i} <> 0)"
        parts.append(f"SELECT {i} AS ordinal, '{c}' AS column_name, CASE WHEN {var} THEN round(a{i}, 4) END AS mean, "
                     f"CASE WHEN {var} THEN round(s{i}, 4) END AS stddev, CASE WHEN {var} THEN o{i} ELSE 0 END AS outlier_count, "
                     f"CASE WHEN {var} THEN NULL ELSE 'No variance' END AS reason FROM st, oc")
    return ("WITH st AS (SELECT " + stats + f" FROM {src}), oc AS (SELECT " + counts +
            f" FROM {src} t, st) " + "\nUNION ALL ".join(parts))


def rules_sql(feed, src=None):
    name = _silver(feed)
    src = src or name
    parts = [f"SELECT '{r}' AS rule_name, count(*) FILTER (WHERE {p.replace('{as_of}', AS_OF_SQL)}) AS violations FROM {src}"
             for t, r, p in DEFAULT_RULES if t == name]
    return "\nUNION ALL ".join(parts)


for _f in FEEDS:
    oracle(f"column_profile_{_f}", profile_sql(_f))
    oracle(f"null_anomalies_{_f}", nulls_sql(_f))
    oracle(f"zscore_outliers_{_f}", f"SELECT * FROM ({zscore_sql(_f)})")
    oracle(f"business_rules_{_f}", rules_sql(_f))

oracle("null_anomalies_selected", nulls_sql("customers", ["email", "phone"]))

oracle("outlier_examples", """
SELECT column_name, list(value ORDER BY value DESC) AS examples FROM (
  SELECT column_name, value, row_number() OVER (PARTITION BY column_name ORDER BY value DESC) AS rn FROM (
    SELECT 'quantity' AS column_name, CAST(quantity AS DOUBLE) AS value FROM sales_silver, st
      WHERE sq IS NOT NULL AND sq <> 0 AND (quantity - aq) / sq > 3
    UNION ALL
    SELECT 'amount', CAST(amount AS DOUBLE) FROM sales_silver, st
      WHERE sa IS NOT NULL AND sa <> 0 AND (amount - aa) / sa > 3))
WHERE rn <= 5 GROUP BY column_name""",
       {"st": "SELECT avg(quantity) AS aq, stddev_samp(quantity) AS sq, avg(amount) AS aa, stddev_samp(amount) AS sa FROM sales_silver"})

oracle("range_outliers", """
SELECT 'age' AS column_name, CAST(18.0 AS DOUBLE) AS low, CAST(90.0 AS DOUBLE) AS high, count(*) FILTER (WHERE age < 18 OR age > 90) AS out_of_range_count,
       'customers_silver' AS table_name FROM customers_silver
UNION ALL SELECT 'quantity', 1.0, 50.0, count(*) FILTER (WHERE quantity < 1 OR quantity > 50), 'sales_silver' FROM sales_silver
UNION ALL SELECT 'amount', 1.0, 100000.0, count(*) FILTER (WHERE amount < 1 OR amount > 100000), 'sales_silver' FROM sales_silver""")


# ---------------------------------------------------------------- schema drift
def _infer_sql(feed):
    raw = f"{feed}_raw"
    parts = []
    for i, f in enumerate(schemas.SILVER[feed].fields):
        v = f"trim(CAST({f.name} AS VARCHAR))"
        present = f"({v} IS NOT NULL AND {v} <> '')"
        isint = f"regexp_full_match({v}, '[+-]?[0-9]+')"
        n = f"count(*) FILTER (WHERE {present})"
        i32 = f"count(*) FILTER (WHERE {present} AND {isint} AND TRY_CAST({v} AS BIGINT) BETWEEN -2147483648 AND 2147483647)"
        i64 = f"count(*) FILTER (WHERE {present} AND {isint} AND TRY_CAST({v} AS BIGINT) IS NOT NULL)"
        dec = f"count(*) FILTER (WHERE {present} AND regexp_full_match({v}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?'))"
        dte = f"count(*) FILTER (WHERE {present} AND regexp_full_match({v}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND TRY_CAST({v} AS DATE) IS NOT NULL)"
        typ = (f"CASE WHEN {n} = 0 THEN 'StringType()' WHEN {i32} = {n} THEN 'IntegerType()' "
               f"WHEN {i64} = {n} THEN 'LongType()' WHEN {dec} = {n} THEN 'DoubleType()' "
               f"WHEN {dte} = {n} THEN 'DateType()' ELSE 'StringType()' END")
        parts.append(f"SELECT '{_silver(feed)}' AS table_name, '{f.name}' AS column_name, {typ} AS data_type, "
                     f"{i} AS ordinal FROM {raw}")
    return "\nUNION ALL ".join(parts)


def _declared_sql():
    rows = []
    for feed in FEEDS:
        for i, f in enumerate(schemas.SILVER[feed].fields):
            rows.append(f"('{_silver(feed)}', '{f.name}', '{f.dataType}', {i})")
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") AS v(table_name, column_name, data_type, ordinal)"


_INFERRED = "\nUNION ALL ".join(f"SELECT * FROM ({_infer_sql(f)})" for f in FEEDS)
_DRIFT = """
SELECT coalesce(b.table_name, c.table_name) AS table_name, coalesce(b.column_name, c.column_name) AS column_name,
       CASE WHEN c.data_type IS NULL THEN 'missing' WHEN b.data_type IS NULL THEN 'new' ELSE 'type_mismatch' END AS change_type,
       b.data_type AS baseline_type, c.data_type AS current_type
FROM declared b FULL OUTER JOIN inferred c ON b.table_name = c.table_name AND b.column_name = c.column_name
WHERE b.data_type IS NULL OR c.data_type IS NULL OR b.data_type <> c.data_type"""
_DRIFT_CTES = {"declared": _declared_sql(), "inferred": _INFERRED, "drift": _DRIFT}

oracle("inferred_schema", "SELECT * FROM inferred", _DRIFT_CTES)
oracle("schema_drift", "SELECT * FROM drift", _DRIFT_CTES)
_REPORT = r"""
SELECT t.table_name, '# Schema Drift Summary' || chr(10) || chr(10) ||
  CASE WHEN count(d.column_name) = 0 THEN 'No schema drift detected.' ELSE
    regexp_replace(
      coalesce('## Added Columns:' || chr(10) || string_agg(CASE WHEN d.change_type = 'new' THEN '- ' || d.column_name || ': ' || d.current_type END, chr(10) ORDER BY d.column_name) || chr(10) || chr(10), '') ||
      coalesce('## Removed Columns:' || chr(10) || string_agg(CASE WHEN d.change_type = 'missing' THEN '- ' || d.column_name || ': previously ' || d.baseline_type END, chr(10) ORDER BY d.column_name) || chr(10) || chr(10), '') ||
      coalesce('## Columns With Changed Datatypes:' || chr(10) || string_agg(CASE WHEN d.change_type = 'type_mismatch' THEN '- ' || d.column_name || ': ' || d.baseline_type || ' → ' || d.current_type END, chr(10) ORDER BY d.column_name) || chr(10) || chr(10), ''),
      '\n$', '')
  END AS report
FROM (SELECT DISTINCT table_name FROM declared) t LEFT JOIN drift d ON t.table_name = d.table_name
GROUP BY t.table_name"""
oracle("schema_drift_report", _REPORT, _DRIFT_CTES)


# ---------------------------------------------------------------- quality score / summary
def _quality_sql(feed, threshold=20):
    t = _silver(feed)
    nulls = f"SELECT * FROM ({nulls_sql(feed)})"
    outl = f"SELECT * FROM ({zscore_sql(feed)})"
    return f"""
SELECT '{t}' AS table_name,
  CAST(greatest(100 - 10 * (SELECT count(*) FROM n_{feed} WHERE null_percentage > {threshold})
                    - 5 * (SELECT count(*) FROM o_{feed} WHERE outlier_count > 0), 0) AS INTEGER) AS quality_score,
  concat_ws(chr(10),
    '✔ No schema drift detected in {t}. Schema matches baseline.',
    CASE WHEN (SELECT count(*) FROM n_{feed} WHERE null_percentage > {threshold}) > 0
         THEN '⚠ High null percentages found in: ' || (SELECT string_agg(column_name, ', ' ORDER BY ordinal) FROM n_{feed} WHERE null_percentage > {threshold}) || '.'
         ELSE '✔ No significant null anomalies detected in {t}.' END,
    CASE WHEN (SELECT count(*) FROM o_{feed} WHERE outlier_count > 0) > 0
         THEN '⚠ Outliers detected in numeric columns: ' || (SELECT string_agg(column_name, ', ' ORDER BY ordinal) FROM o_{feed} WHERE outlier_count > 0) || '.'
         ELSE '✔ No numeric outliers detected in {t}.' END,
    '✔ Overall, {t} looks healthy and ready for downstream use.') AS ai_summary""", {f"n_{feed}": nulls, f"o_{feed}": outl}


def _quality_all():
    parts, ctes = [], {}
    for f in FEEDS:
        body, c = _quality_sql(f)
        parts.append(body)
        ctes.update(c)
    return "\nUNION ALL ".join(parts), ctes


_Q_BODY, _Q_CTES = _quality_all()
_Q_CTES["quality"] = _Q_BODY
oracle("quality_score", "SELECT table_name, quality_score FROM quality", _Q_CTES)
oracle("quality_summary", "SELECT table_name, quality_score, ai_summary FROM quality", _Q_CTES)


# ---------------------------------------------------------------- quarantine
_KEYS = {"customers": "customer_id", "sales": "sale_id", "transactions": "transaction_id"}
oracle("quarantine_null_keys", "\nUNION ALL ".join(
    f"SELECT '{_silver(f)}' AS table_name, CAST(NULL AS VARCHAR) AS record_key, '{_KEYS[f]}_is_null' AS quarantine_reason "
    f"FROM {f}_raw WHERE trim({_KEYS[f]}) IS NULL" for f in FEEDS))

_RANGE_REASONS = {
    "customers": [("age_out_of_range", "age < 0 OR age > 120"), ("signup_in_future", f"signup_date > {AS_OF_SQL}")],
    "sales": [("quantity_not_positive", "quantity <= 0"), ("amount_negative", "amount < 0"),
              ("sale_in_future", f"sale_date > {AS_OF_SQL}")],
    "transactions": [("amount_negative", "amount < 0"), ("transaction_in_future", f"transaction_date > {AS_OF_SQL}")],
}
_CLEAN = {"customers": "SELECT trim(customer_id) AS customer_id, age, signup_date FROM customers_raw",
          "sales": "SELECT DISTINCT trim(sale_id) AS sale_id, trim(customer_id) AS customer_id, trim(product_id) AS product_id, sale_date, quantity, amount FROM sales_raw",
          "transactions": "SELECT DISTINCT trim(transaction_id) AS transaction_id, trim(customer_id) AS customer_id, transaction_date, lower(trim(payment_method)) AS payment_method, lower(trim(status)) AS status, amount FROM transactions_raw"}


def _reason_sql(f):
    checks = [(f"{_KEYS[f]}_is_null", f"{_KEYS[f]} IS NULL")] + _RANGE_REASONS[f]
    parts = ", ".join(f"CASE WHEN {p} THEN '{n}' END" for n, p in checks)
    return (f"SELECT '{_silver(f)}' AS table_name, concat_ws(',', {parts}) AS quarantine_reason "
            f"FROM ({_CLEAN[f]})")


oracle("silver_range_checks", "SELECT table_name, quarantine_reason, count(*) AS rows FROM (" +
       "\nUNION ALL ".join(_reason_sql(f) for f in FEEDS) + ") WHERE quarantine_reason <> '' GROUP BY ALL")

# ---------------------------------------------------------------- whole-text functions
PY_WS = r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
_STRIP = lambda e: f"regexp_replace({e}, '^{PY_WS}+|{PY_WS}+$', '', 'g')"
oracle("sanitize_text", f"""
SELECT doc_id, CASE WHEN length(c) > 4000 THEN substring(c, 1, 3997) || '...' ELSE c END AS clean_text FROM (
  SELECT doc_id, {_STRIP(f"regexp_replace(coalesce(text, ''), '{PY_WS}+', ' ', 'g')")} AS c FROM documents)""")

from kestrel.functions.text import ROOT_CAUSE_SKIP  # noqa: E402

_SKIP = " OR ".join(f"contains(lower(x), '{p}')" for p in ROOT_CAUSE_SKIP)
oracle("clean_root_causes", f"""
SELECT conv_id, turn, array_to_string(list_slice(list_filter(
         list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: {_STRIP('x')}),
         lambda x: starts_with(x, '- ') AND NOT ({_SKIP})), 1, 4), chr(10)) AS bullets
FROM conversations""")


# ---------------------------------------------------------------- findings / classification
def _findings_sql(feed, run, src):
    t = _silver(feed)
    total = f"(SELECT count(*) FROM {src})"
    return f"""
SELECT '{t}' AS table_name, '{run}' AS run_id, column_name, 'nulls' AS source,
       'Column ' || column_name || ' has ' || CAST(null_percentage AS VARCHAR) || '% null values' AS description,
       null_percentage AS affected_pct FROM ({nulls_sql(feed, src=src)}) WHERE issue <> 'OK'
UNION ALL
SELECT '{t}', '{run}', column_name, 'outliers',
       CAST(outlier_count AS VARCHAR) || ' values in ' || column_name || ' lie above 3 standard deviations from the mean',
       CASE WHEN {total} > 0 THEN round(outlier_count * 100.0 / {total}, 2) ELSE 0.0 END
FROM ({zscore_sql(feed, src=src)}) WHERE outlier_count > 0
UNION ALL
SELECT '{t}', '{run}', rule_name, 'rules', 'Rule ' || rule_name || ' has ' || CAST(violations AS VARCHAR) || ' violating rows',
       CASE WHEN {total} > 0 THEN round(violations * 100.0 / {total}, 2) ELSE 0.0 END
FROM ({rules_sql(feed, src=src)}) WHERE violations > 0"""


_FINDINGS = "\nUNION ALL ".join(
    f"SELECT * FROM ({_findings_sql(f, run, src)})"
    for f in FEEDS for run, src in (("run_000", f"{f}_raw"), ("run_001", _silver(f))))
_CLASSIFIED = """
SELECT *, CASE
  WHEN contains(l, 'new column') OR contains(l, 'column mismatch') OR contains(l, 'schema') THEN 'schema_drift'
  WHEN contains(l, 'null') OR contains(l, 'missing') THEN 'missing_values'
  WHEN regexp_matches(l, '\\b(outlier|above|below|greater than|> )\\b') THEN 'outlier'
  WHEN contains(l, 'distribution') OR contains(l, 'skew') OR contains(l, 'drift') THEN 'distribution_shift'
  WHEN contains(l, 'rule') OR contains(l, 'violation') OR contains(l, 'constraint') THEN 'business_rule_violation'
  ELSE 'unknown' END AS anomaly_type
FROM (SELECT *, lower(description) AS l FROM findings)"""
_EXPLAIN = """
SELECT table_name, run_id, column_name, source, description, affected_pct, anomaly_type,
  CASE anomaly_type WHEN 'distribution_shift' THEN 'medium' WHEN 'unknown' THEN 'medium' ELSE 'high' END AS severity,
  CASE anomaly_type
    WHEN 'schema_drift' THEN 'A schema-level change was detected.'
    WHEN 'missing_values' THEN 'Records contain missing or null values.'
    WHEN 'outlier' THEN 'Several values fall outside expected numeric range.'
    WHEN 'distribution_shift' THEN 'Data distribution has changed compared to historical patterns.'
    WHEN 'business_rule_violation' THEN 'Detected a violation of predefined business logic.'
    ELSE 'Unable to determine anomaly type from description.' END AS explanation
FROM classified"""
_F_CTES = {"findings": _FINDINGS, "classified": _CLASSIFIED, "explained": _EXPLAIN}
oracle("classify_anomaly", "SELECT * EXCLUDE (affected_pct) FROM explained", _F_CTES)
oracle("anomaly_severity", """
SELECT *, CASE WHEN severity_score >= 50 THEN 'critical' WHEN severity_score >= 20 THEN 'high'
               WHEN severity_score >= 5 THEN 'medium' ELSE 'low' END AS severity_band FROM (
  SELECT *, round(CAST(CASE anomaly_type WHEN 'schema_drift' THEN 1.0 WHEN 'missing_values' THEN 0.8
                   WHEN 'business_rule_violation' THEN 0.7 WHEN 'outlier' THEN 0.6 WHEN 'distribution_shift' THEN 0.5
                   ELSE 0.3 END AS DOUBLE) * least(greatest(coalesce(affected_pct, 100.0), 0.0), 100.0), 2) AS severity_score
  FROM explained)""", _F_CTES)


# ---------------------------------------------------------------- suggested / parsed rules
def _values_sql(feed):
    return "\nUNION ALL ".join(
        f"SELECT '{c.name}' AS column_name, list_sort(list(DISTINCT {c.name}) FILTER (WHERE {c.name} IS NOT NULL)) AS vals "
        f"FROM {_silver(feed)}" for c in schemas.SILVER[feed].fields if kind_of(c.dataType) == "string")

_SUGGEST = "\nUNION ALL ".join(f"""
SELECT '{_silver(f)}' AS table_name, ordinal, column_name, 'not_null' AS kind,
       'Flag {_silver(f)} rows where ' || column_name || ' is missing' AS rule_text, column_name || ' IS NULL' AS predicate
FROM ({profile_sql(f)}) WHERE null_count = 0 AND count > 0
UNION ALL
SELECT '{_silver(f)}', ordinal, column_name, 'upper_bound',
       'Flag {_silver(f)} rows where ' || column_name || ' above ' || max, column_name || ' > ' || max
FROM ({profile_sql(f)}) WHERE kind = 'numeric' AND max IS NOT NULL
UNION ALL
SELECT '{_silver(f)}', ordinal, column_name, 'allowed_set',
       'Flag {_silver(f)} rows where ' || column_name || ' is not one of: ' || array_to_string(vals, ', '),
       'NOT ' || column_name || ' IN (' || array_to_string(list_transform(vals, lambda v: chr(39) || replace(v, chr(39), chr(39) || chr(39)) || chr(39)), ', ') || ')'
FROM (SELECT p.ordinal, p.column_name, v.vals FROM ({profile_sql(f)}) p
      JOIN ({_values_sql(f)}) v ON p.column_name = v.column_name
      WHERE p.kind = 'string' AND p.distinct_count > 0 AND p.distinct_count <= 5)""" for f in FEEDS)
oracle("suggested_rules", "SELECT * FROM suggest", {"suggest": _SUGGEST})
oracle("parse_rules", r"""
SELECT table_name, 'rule_' || substring(sha1(rule_text), 1, 6) AS rule_id, rule_text AS description,
       array_to_string(list_transform(regexp_extract_all(rule_text, '(?i)\b([a-z_]+_id|amount|price|quantity|date)\b', 1), lambda x: lower(x)), ',') AS column,
       CASE WHEN contains(lower(rule_text), 'missing') OR contains(lower(rule_text), 'null') THEN 'null_check' ELSE 'business_rule' END AS rule_type,
       thr AS threshold_max,
       CASE WHEN thr IS NOT NULL AND thr <> 0 THEN 'high' ELSE 'medium' END AS severity, 'flag' AS action
FROM (SELECT *, TRY_CAST(NULLIF(replace(regexp_extract(rule_text, '(?i)(?:>|greater than|above)\s*([\d,]+)', 1), ',', ''), '') AS DOUBLE) AS thr
      FROM suggest)""", {"suggest": _SUGGEST})

# ---------------------------------------------------------------- KPIs / labels
_GOLD_SALES = """SELECT customer_id, sum(amount) AS total_spend, count(sale_id) AS total_orders, avg(amount) AS avg_order_value,
  min(sale_date) AS first_purchase_date, max(sale_date) AS last_purchase_date FROM sales_silver GROUP BY customer_id"""
_G = {"gold_sales": _GOLD_SALES}
oracle("kpi_customers", """SELECT count(*) AS customers, round(coalesce(avg(avg_order_value), 0.0), 4) AS avg_order_value,
  round(coalesce(CAST(sum(total_spend) AS DOUBLE), 0.0), 4) AS total_revenue FROM gold_sales""", _G)
oracle("kpi_cards", """SELECT CAST(count(*) AS VARCHAR) AS customers_card,
  '₹' || format('{:,.0f}', coalesce(CAST(sum(total_spend) AS DOUBLE), 0.0)) AS revenue_card,
  '₹' || format('{:,.2f}', coalesce(avg(avg_order_value), 0.0)) AS aov_card FROM gold_sales""", _G)
oracle("daily_usage", "SELECT CAST(ts AS DATE) AS date, count(*) AS events FROM events GROUP BY 1")
oracle("top_customers", """SELECT customer_id, CAST(total_spend AS BIGINT) AS total_spend, total_orders,
  round(avg_order_value, 4) AS avg_order_value, first_purchase_date, last_purchase_date
  FROM gold_sales ORDER BY total_spend DESC, customer_id LIMIT 10""", _G)
oracle("customer_drilldown", f"""SELECT customer_id, CAST(total_spend AS BIGINT) AS total_spend, total_orders,
  round(avg_order_value, 4) AS avg_order_value, first_purchase_date, last_purchase_date,
  CAST(datediff('day', last_purchase_date, {AS_OF_SQL}) AS INTEGER) AS days_since_last_purchase
  FROM gold_sales WHERE total_spend >= 1500000""", _G)
oracle("sum_by_key", """SELECT customer_id, CAST(sum(amount) AS BIGINT) AS total_amount FROM sales_silver
  WHERE amount > 50000 GROUP BY customer_id""")
oracle("high_value_label", """SELECT customer_id, CAST(total_spend AS BIGINT) AS total_spend, total_orders,
  round(avg_order_value, 4) AS avg_order_value,
  CAST(CASE WHEN total_spend >= 2500000 OR avg_order_value >= 41000 THEN 1 ELSE 0 END AS INTEGER) AS is_high_value
  FROM gold_sales WHERE total_spend IS NOT NULL AND total_orders IS NOT NULL AND avg_order_value IS NOT NULL""", _G)


_SPLIT = "('0x' || substr(md5(customer_id || ':42'), 1, 8))::BIGINT % 100 < 80 AS train"
_LABELLED = {**_G, "labelled": f"""
SELECT customer_id, total_spend, total_orders, avg_order_value, {_SPLIT},
  CASE WHEN total_spend >= 2500000 OR avg_order_value >= 41000 THEN 1 ELSE 0 END AS is_high_value
FROM gold_sales WHERE total_spend IS NOT NULL AND total_orders IS NOT NULL AND avg_order_value IS NOT NULL"""}
oracle("train_test_split", """SELECT CASE WHEN train THEN 'train' ELSE 'test' END AS split, CAST(is_high_value AS INTEGER) AS is_high_value,
  count(*) AS rows FROM labelled GROUP BY 1, 2""", _LABELLED)
oracle("baseline_classifier_metrics", """
SELECT tp, fp, fn, tn, tp + fp + fn + tn AS n, CASE WHEN tp + fp + fn + tn > 0 THEN round((tp + tn) / (tp + fp + fn + tn), 4) END AS accuracy,
  round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 4) AS f1
FROM (SELECT count(*) FILTER (y = 1 AND p) AS tp, count(*) FILTER (y = 0 AND p) AS fp, count(*) FILTER (y = 1 AND NOT p) AS fn, count(*) FILTER (y = 0 AND NOT p) AS tn
      FROM (SELECT is_high_value AS y, coalesce(total_spend >= middle, only_class = 1) AS p FROM labelled,
              (SELECT (avg(total_spend) FILTER (is_high_value = 1) + avg(total_spend) FILTER (is_high_value = 0)) / 2 AS middle, max(is_high_value) AS only_class
               FROM labelled WHERE train)
            WHERE NOT train))""", _LABELLED)
oracle("baseline_regression_metrics", f"""
SELECT count(*) AS n, round(avg(abs(p - y)), 4) AS mae, round(sqrt(avg((p - y) * (p - y))), 4) AS rmse,
  round(1 - sum((p - y) * (p - y)) / (var_pop(y) * count(*)), 4) AS r2
FROM (SELECT total_spend::DOUBLE AS y, ratio * total_orders AS p FROM rows,
        (SELECT sum(total_spend)::DOUBLE / sum(total_orders) AS ratio FROM rows WHERE train) WHERE NOT train)""",
       {**_G, "rows": f"SELECT *, {_SPLIT} FROM gold_sales WHERE total_spend IS NOT NULL AND avg_order_value IS NOT NULL AND first_purchase_date IS NOT NULL"})


# ---------------------------------------------------------------- windowed monitors (batch forms)
_TX_EVENTS = TRANSACTIONS_RAW_WITH_TS = """
SELECT ts, CASE WHEN event_id % 90 = 0 THEN NULL ELSE 'C' || lpad(CAST(user_id AS VARCHAR), 6, '0') END AS customer_id,
       CASE event_id % 5 WHEN 0 THEN 'UPI ' WHEN 1 THEN 'Card' WHEN 2 THEN 'NetBanking' WHEN 3 THEN ' wallet'
            ELSE CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'Cheque' END END AS payment_method,
       CASE event_type WHEN 'purchase' THEN ' SUCCESS' WHEN 'error' THEN 'Failed ' ELSE event_type END AS status,
       CASE WHEN event_id % 70 = 4 THEN 0 ELSE CAST(floor(value) AS INT) END AS amount
FROM events"""
oracle("rolling_quality", """
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, rows, null_customer, null_method, bad_status,
       bad_method, bad_amount,
       round(null_customer * 100.0 / rows, 2) AS null_customer_pct, round(bad_status * 100.0 / rows, 2) AS bad_status_pct,
       round(bad_method * 100.0 / rows, 2) AS bad_method_pct, round(bad_amount * 100.0 / rows, 2) AS bad_amount_pct
FROM (SELECT date_trunc('day', ts) AS window_start, count(*) AS rows,
             count(*) FILTER (WHERE customer_id IS NULL) AS null_customer,
             count(*) FILTER (WHERE payment_method IS NULL) AS null_method,
             count(*) FILTER (WHERE NOT lower(trim(status)) IN ('success', 'failed')) AS bad_status,
             count(*) FILTER (WHERE NOT lower(trim(payment_method)) IN ('upi', 'card', 'netbanking', 'wallet')) AS bad_method,
             count(*) FILTER (WHERE amount <= 0) AS bad_amount
      FROM tx_events GROUP BY 1)""", {"tx_events": _TX_EVENTS})

oracle("volume_alerts", """
SELECT *, CASE WHEN is_alert THEN CASE WHEN events > trailing_mean THEN 'spike' ELSE 'drop' END END AS direction FROM (
  SELECT event_type, window_start, window_end, events, round(trailing_mean, 4) AS trailing_mean,
         round(trailing_sd, 4) AS trailing_sd, trailing_n,
         coalesce(trailing_n >= 3 AND trailing_sd IS NOT NULL AND trailing_sd > 0
                  AND abs(events - trailing_mean) > 3 * trailing_sd, false) AS is_alert
  FROM (SELECT *, avg(events) OVER w AS trailing_mean, stddev_samp(events) OVER w AS trailing_sd,
               count(events) OVER w AS trailing_n
        FROM (SELECT event_type, date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
                     count(*) AS events FROM events GROUP BY 1, 2, 3)
        WINDOW w AS (PARTITION BY event_type ORDER BY window_start ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)))""")

oracle("sessions", """
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS events,
       round(sum(value), 4) AS total_value
FROM (SELECT *, sum(CASE WHEN prev IS NULL OR ts >= prev + INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
                  OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sid
      FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events))
GROUP BY user_id, sid""")


# ---------------------------------------------------------------- history (two runs) and run-over-run
_RUNS = (("run_000", "2024-01-31T00:00:00", "{f}_raw"), ("run_001", "2024-02-01T00:00:00", "{s}"))


def _history_sql():
    parts = []
    for f in FEEDS:
        t = _silver(f)
        for run, ts, src_t in _RUNS:
            src = src_t.format(f=f, s=t)
            n, z = nulls_sql(f, src=src), zscore_sql(f, src=src)
            parts.append(f"""
SELECT '{t}' AS table_name, '{run}' AS run_id, '{ts}' AS timestamp,
  CAST(greatest(100 - 10 * (SELECT count(*) FROM ({n}) WHERE null_percentage > 20)
                    - 5 * (SELECT count(*) FROM ({z}) WHERE outlier_count > 0), 0) AS INTEGER) AS quality_score,
  coalesce((SELECT list_sort(list(column_name)) FROM ({n}) WHERE issue <> 'OK'), []::VARCHAR[]) AS hn,
  coalesce((SELECT list_sort(list(column_name)) FROM ({z}) WHERE outlier_count > 0), []::VARCHAR[]) AS oc""")
    return "\nUNION ALL ".join(f"SELECT * FROM ({p})" for p in parts)


_H = {"history": _history_sql()}
oracle("run_over_run", """
SELECT table_name, run_id, timestamp, quality_score, previous_run_id, quality_score - prev_score AS score_change,
       []::VARCHAR[] AS newly_drifted_columns,
       list_filter(hn, lambda x: NOT list_contains(coalesce(prev_hn, []::VARCHAR[]), x)) AS new_high_null_columns,
       list_filter(oc, lambda x: NOT list_contains(coalesce(prev_oc, []::VARCHAR[]), x)) AS new_outlier_columns
FROM (SELECT *, lag(run_id) OVER w AS previous_run_id, lag(quality_score) OVER w AS prev_score,
             lag(hn) OVER w AS prev_hn, lag(oc) OVER w AS prev_oc
      FROM history WINDOW w AS (PARTITION BY table_name ORDER BY timestamp, run_id))""", _H)
oracle("selector_values", "SELECT DISTINCT run_id FROM history WHERE table_name = 'customers_silver'", _H)
oracle("run_selector", """SELECT table_name, run_id, timestamp, quality_score FROM history
WHERE table_name = 'sales_silver' ORDER BY timestamp DESC, run_id DESC LIMIT 1""", _H)


# ---------------------------------------------------------------- evaluate_rules
_PARSED = r"""
SELECT table_name, rule_text AS description, 'rule_' || substring(sha1(rule_text), 1, 6) AS rule_id,
       list_filter(list_transform(regexp_extract_all(rule_text, '(?i)\b([a-z_]+_id|amount|price|quantity|date)\b', 1),
                                  lambda x: lower(x)), lambda x: trim(x) <> '') AS cols,
       CASE WHEN contains(lower(rule_text), 'missing') OR contains(lower(rule_text), 'null') THEN 'null_check' ELSE 'business_rule' END AS rule_type,
       TRY_CAST(NULLIF(replace(regexp_extract(rule_text, '(?i)(?:>|greater than|above)\s*([\d,]+)', 1), ',', ''), '') AS DOUBLE) AS thr
FROM (SELECT table_name, rule_text FROM suggest UNION ALL
      VALUES ('sales_silver', 'Flag sales_silver rows where product_id is missing'),
             ('sales_silver', 'Flag sales_silver rows where quantity above 50'),
             ('sales_silver', 'Flag sales_silver rows where amount above 90,000'),
             ('transactions_silver', 'Flag transactions_silver rows where customer_id is missing'),
             ('transactions_silver', 'Flag transactions_silver rows where amount above 100'))"""
_CHECKS = """
SELECT table_name, rule_id, description, CAST(i - 1 AS INTEGER) AS check_no, 'is_null' AS "check", cols[i] AS column_name,
       CAST(NULL AS DOUBLE) AS threshold
FROM (SELECT *, generate_subscripts(cols, 1) AS i FROM parsed WHERE rule_type = 'null_check' AND len(cols) > 0)
UNION ALL
SELECT table_name, rule_id, description, CAST(CASE WHEN rule_type = 'null_check' THEN len(cols) ELSE 0 END AS INTEGER), 'greater_than',
       cols[1], thr
FROM parsed WHERE thr IS NOT NULL AND len(cols) > 0"""


def _long_sql():
    parts = []
    for f in FEEDS:
        for c in schemas.SILVER[f].fields:
            parts.append(f"SELECT '{_silver(f)}' AS table_name, '{c.name}' AS column_name, {c.name} IS NULL AS isn, "
                         f"TRY_CAST({c.name} AS DOUBLE) AS v FROM {_silver(f)}")
    return "\nUNION ALL ".join(parts)


ORACLES_EVAL = """
SELECT k.rule_id, k.description, k.check_no, k."check", k.column_name, k.threshold,
       count(*) FILTER (WHERE (k."check" = 'is_null' AND l.isn) OR (k."check" = 'greater_than' AND l.v > k.threshold)) AS violations,
       CAST(NULL AS VARCHAR) AS error, k.table_name
FROM checks k JOIN long_values l ON k.table_name = l.table_name AND k.column_name = l.column_name
GROUP BY ALL
UNION ALL
SELECT rule_id, description, NULL, NULL, NULL, NULL, NULL, 'not checkable', table_name
FROM parsed WHERE len(cols) = 0 OR (rule_type <> 'null_check' AND thr IS NULL)"""
oracle("evaluate_rules", "SELECT * FROM evaluated",
       {"suggest": _SUGGEST, "parsed": _PARSED, "checks": _CHECKS, "long_values": _long_sql(), "evaluated": ORACLES_EVAL})


# ---------------------------------------------------------------- table_documentation
def _doc_static():
    sch, rl = [], []
    for f in FEEDS:
        for i, c in enumerate(schemas.SILVER[f].fields):
            sch.append(f"('{_silver(f)}', {i}, '- {c.name}: {c.dataType}')")
    for i, (t, r, p) in enumerate(DEFAULT_RULES):
        line = f"- {r}: flags rows where {p.replace('{as_of}', 'the run date')} (severity: high)".replace("'", "''")
        rl.append(f"('{t}', {i}, '{line}')")
    return ("SELECT * FROM (VALUES " + ", ".join(sch) + ") AS s(table_name, ordinal, l)",
            "SELECT * FROM (VALUES " + ", ".join(rl) + ") AS r(table_name, ordinal, l)")


_DOC_S, _DOC_R = _doc_static()
_DOC_CTES = dict(_F_CTES)
_DOC_CTES.update({"doc_schema": _DOC_S, "doc_rules": _DOC_R})
oracle("table_documentation", """
SELECT s.table_name,
  '# Documentation for Table: ' || s.table_name || chr(10) || chr(10) || 'Generated at: 2024-02-01T00:00:00' || chr(10) || chr(10) ||
  '## Purpose' || chr(10) || 'This table stores transactional or analytical data for `' || s.table_name ||
  '`, used across ingestion, profiling, and ML workflows.' || chr(10) || chr(10) || '## Schema Overview' || chr(10) || s.lines ||
  chr(10) || chr(10) || '## Data Quality Rules' || chr(10) || coalesce(r.lines, '- No rules defined.') || chr(10) || chr(10) ||
  '## Anomaly Summary' || chr(10) || coalesce(a.lines, '- No anomalies detected.') || chr(10) AS documentation
FROM (SELECT table_name, string_agg(l, chr(10) ORDER BY ordinal) AS lines FROM doc_schema GROUP BY 1) s
LEFT JOIN (SELECT table_name, string_agg(l, chr(10) ORDER BY ordinal) AS lines FROM doc_rules GROUP BY 1) r USING (table_name)
LEFT JOIN (SELECT table_name, string_agg(l, chr(10) ORDER BY l) AS lines FROM (
             SELECT table_name, '- ' || anomaly_type || ': ' || explanation || ' (severity: ' || severity || ')' AS l
             FROM explained WHERE run_id = 'run_001') GROUP BY 1) a USING (table_name)""", _DOC_CTES)

oracle("sales_with_product", "SELECT sale_id, product_id, amount FROM sales_silver WHERE product_id IS NOT NULL")
oracle("column_sets", """
SELECT coalesce(b.table_name, c.table_name) AS table_name,
       list_sort(list_filter(coalesce(c.cols, []::VARCHAR[]), lambda x: NOT list_contains(coalesce(b.cols, []::VARCHAR[]), x))) AS added,
       list_sort(list_filter(coalesce(b.cols, []::VARCHAR[]), lambda x: NOT list_contains(coalesce(c.cols, []::VARCHAR[]), x))) AS removed,
       list_sort(list_filter(coalesce(b.cols, []::VARCHAR[]), lambda x: list_contains(coalesce(c.cols, []::VARCHAR[]), x))) AS common
FROM (SELECT table_name, list(DISTINCT column_name) AS cols FROM declared GROUP BY 1) b
FULL OUTER JOIN (SELECT table_name, list(DISTINCT column_name) AS cols FROM inferred GROUP BY 1) c
  ON b.table_name = c.table_name""", _DRIFT_CTES)

oracle("rules_end_to_end", """
SELECT *, CASE anomaly_type WHEN 'distribution_shift' THEN 'medium' WHEN 'unknown' THEN 'medium' ELSE 'high' END AS severity,
  CASE anomaly_type
    WHEN 'schema_drift' THEN 'A schema-level change was detected.'
    WHEN 'missing_values' THEN 'Records contain missing or null values.'
    WHEN 'outlier' THEN 'Several values fall outside expected numeric range.'
    WHEN 'distribution_shift' THEN 'Data distribution has changed compared to historical patterns.'
    WHEN 'business_rule_violation' THEN 'Detected a violation of predefined business logic.'
    ELSE 'Unable to determine anomaly type from description.' END AS explanation
FROM (SELECT * EXCLUDE (l), CASE
  WHEN contains(l, 'new column') OR contains(l, 'column mismatch') OR contains(l, 'schema') THEN 'schema_drift'
  WHEN contains(l, 'null') OR contains(l, 'missing') THEN 'missing_values'
  WHEN regexp_matches(l, '\\b(outlier|above|below|greater than|> )\\b') THEN 'outlier'
  WHEN contains(l, 'distribution') OR contains(l, 'skew') OR contains(l, 'drift') THEN 'distribution_shift'
  WHEN contains(l, 'rule') OR contains(l, 'violation') OR contains(l, 'constraint') THEN 'business_rule_violation'
  ELSE 'unknown' END AS anomaly_type
  FROM (SELECT *, lower(anomaly_text) AS l FROM (
          SELECT *, CASE WHEN error IS NOT NULL THEN error || ': ' || description
                         ELSE CAST(violations AS VARCHAR) || ' rows violate rule: ' || description END AS anomaly_text
          FROM evaluated WHERE violations > 0 OR error IS NOT NULL)))""", {"suggest": _SUGGEST, "parsed": _PARSED, "checks": _CHECKS,
                                                          "long_values": _long_sql(), "evaluated": ORACLES_EVAL})


def _flat_sql(feed):
    t = _silver(feed)
    rules = [(r, p) for tt, r, p in DEFAULT_RULES if tt == t]
    n = nulls_sql(feed)
    order = "CASE rule_name " + " ".join(f"WHEN '{r}' THEN {i}" for i, (r, _) in enumerate(rules)) + " END"
    return f"""
SELECT '{t}' AS table_name,
  (SELECT '{{' || string_agg('"' || column_name || '":{{"null_count":' || CAST(null_count AS VARCHAR) || ',"total_rows":' ||
          CAST(total_rows AS VARCHAR) || ',"null_percentage":' || CAST(null_percentage AS VARCHAR) || ',"issue":"' || issue || '"}}',
          ',' ORDER BY ordinal) || '}}' FROM ({n})) AS null_anomalies_json,
  (SELECT '{{' || string_agg('"' || rule_name || '":' || CAST(violations AS VARCHAR), ',' ORDER BY k) || '}}'
   FROM (SELECT {order} AS k, * FROM ({rules_sql(feed)}))) AS business_rules_json"""


oracle("quality_log_flat", """
SELECT q.table_name, 'run_001' AS run_id, '2024-02-01T00:00:00' AS timestamp, q.quality_score, q.ai_summary,
       '{"missing_columns":[],"new_columns":[],"type_mismatches":[]}' AS schema_drift_json,
       f.null_anomalies_json, f.business_rules_json
FROM quality q JOIN (""" + "\nUNION ALL ".join(f"SELECT * FROM ({_flat_sql(f)})" for f in FEEDS) + """) f USING (table_name)""",
       _Q_CTES)

oracle("stream_bronze", "SELECT event_id, ts, user_id, event_type, value, 'events' AS _source FROM events")

oracle("log_schema_evolution", """
SELECT q.table_name, '2024-02-01T00:00:00' AS run_time_utc, q.quality_score, q.ai_summary, f.business_rules_json,
       CAST(NULL AS VARCHAR) AS run_id, CAST(NULL AS VARCHAR) AS timestamp
FROM quality q JOIN (""" + "\nUNION ALL ".join(f"SELECT * FROM ({_flat_sql(f)})" for f in FEEDS) + """) f USING (table_name)
UNION ALL
SELECT table_name, NULL, quality_score, ai_summary, NULL, 'run_001', '2024-02-01T00:00:00' FROM quality""", _Q_CTES)
oracle("partitioned_log", """SELECT table_name, 'run_001' AS run_id, '2024-02-01T00:00:00' AS timestamp, quality_score,
  DATE '2024-02-01' AS run_date FROM quality WHERE table_name = 'sales_silver'""", _Q_CTES)

from kestrel.operators.rules import DOCUMENTED_RULES  # noqa: E402

oracle("business_rules_documented", "\nUNION ALL ".join(
    f"SELECT '{r}' AS rule_name, count(*) FILTER (WHERE {p}) AS violations FROM customers_silver"
    for t, r, p in DOCUMENTED_RULES))


# ---------------------------------------------------------------- streams: the same result as the batch form
for _stream, _batch in (("stream_windows", "rolling_quality"), ("stream_sessions", "sessions"), ("stream_volume_alerts", "volume_alerts")):
    ORACLES[_stream] = ORACLES[_batch]


# ---------------------------------------------------------------- streams over four deliveries
_DEALT = """
SELECT *, CASE WHEN event_id % 50 = 7 AND own + 2 < 4 THEN own + 2 ELSE own END AS delivery
FROM (SELECT e.*, ((epoch_us(ts) - low) * 4) // (high - low + 1) AS own
      FROM events e, (SELECT min(epoch_us(ts)) AS low, max(epoch_us(ts)) AS high FROM events))"""
#: The watermark while a delivery is read: the latest time of the deliveries before it, in milliseconds, less an hour.
_MARKED = """
SELECT d.*, m.mark FROM dealt d LEFT JOIN (
  SELECT k.delivery, max(date_trunc('millisecond', d.ts)) - INTERVAL 1 HOUR AS mark
  FROM (SELECT DISTINCT delivery FROM dealt) k JOIN dealt d ON d.delivery < k.delivery GROUP BY k.delivery) m ON d.delivery = m.delivery"""
_LAST = "(SELECT max(date_trunc('millisecond', ts)) - INTERVAL 1 HOUR FROM events)"
_SLICES = {"dealt": _DEALT, "marked": _MARKED}
oracle("stream_closed_windows", f"""
SELECT event_type, date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, count(*) AS events
FROM marked WHERE mark IS NULL OR date_trunc('day', ts) + INTERVAL 1 DAY > mark
GROUP BY 1, 2, 3 HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= {_LAST}""", _SLICES)
ORACLES["stream_resume"] = ORACLES["stream_closed_windows"]
oracle("stream_late_rows", """
SELECT event_id, ts, user_id, event_type, value, props FROM marked WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= mark""", _SLICES)
oracle("stream_closed_sessions", f"""
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS events, round(sum(value), 4) AS total_value
FROM (SELECT *, sum(CASE WHEN prev IS NULL OR ts >= prev + INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
                  OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sid
      FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev
            FROM marked WHERE mark IS NULL OR ts + INTERVAL 30 MINUTE > mark))
GROUP BY user_id, sid HAVING max(ts) + INTERVAL 30 MINUTE <= {_LAST}""", _SLICES)
oracle("stream_trailing_alerts", f"""
SELECT *, CASE WHEN is_alert THEN CASE WHEN events > trailing_mean THEN 'spike' ELSE 'drop' END END AS direction FROM (
  SELECT event_type, window_start, window_end, events, round(trailing_mean, 4) AS trailing_mean,
         round(trailing_sd, 4) AS trailing_sd, trailing_n,
         coalesce(trailing_n >= 3 AND trailing_sd IS NOT NULL AND trailing_sd > 0
                  AND abs(events - trailing_mean) > 3 * trailing_sd, false) AS is_alert
  FROM (SELECT *, avg(events) OVER w AS trailing_mean, stddev_samp(events) OVER w AS trailing_sd, count(events) OVER w AS trailing_n
        FROM (SELECT event_type, date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, count(*) AS events
              FROM marked WHERE mark IS NULL OR date_trunc('hour', ts) + INTERVAL 1 HOUR > mark
              GROUP BY 1, 2, 3 HAVING date_trunc('hour', ts) + INTERVAL 1 HOUR <= {_LAST})
        WINDOW w AS (PARTITION BY event_type ORDER BY window_start ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)))""", _SLICES)
oracle("stream_payload_drift", """
SELECT 'events' AS table_name, column_name, CASE WHEN current_type IS NULL THEN 'missing' WHEN baseline_type IS NULL THEN 'new' ELSE 'type_mismatch' END AS change_type,
       baseline_type, current_type, 'payload_00000' || delivery AS run_id
FROM (SELECT own AS delivery, 'k' AS column_name, 'BIGINT' AS baseline_type FROM (SELECT DISTINCT own FROM dealt))
FULL JOIN (SELECT delivery, column_name, max(data_type) AS current_type FROM (
  SELECT delivery, column_name, CASE json_type(props, '$.' || column_name) WHEN 'VARCHAR' THEN 'STRING' ELSE 'BIGINT' END AS data_type
  FROM (SELECT delivery, props, unnest(json_keys(props)) AS column_name FROM (
    SELECT own AS delivery, CASE own WHEN 1 THEN json_object('k', json_extract(props, '$.k'), 'channel', event_type)
      WHEN 2 THEN json_object('channel', event_type) WHEN 3 THEN json_object('k', json_extract_string(props, '$.k')) ELSE props::JSON END AS props FROM dealt)))
  GROUP BY 1, 2) USING (delivery, column_name)
WHERE baseline_type IS DISTINCT FROM current_type""", _SLICES)
oracle("stream_dedupe", "SELECT DISTINCT event_id, ts, user_id, event_type, value, props FROM events")


# ---------------------------------------------------------------- merged profiles, catalog tables, layout, stored models
oracle("merged_profile", " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, 4 AS runs, count(*) AS rows, count(*) - count({c}) AS nulls, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev,
       round(min({c})::DOUBLE, 4) AS low, round(max({c})::DOUBLE, 4) AS high, count(DISTINCT {c}) AS distinct_count, TRUE AS within_3_percent FROM events"""
                                             for c in ("event_id", "user_id", "value")))
ORACLES["catalog_enriched_sales"] = ORACLES["customer_sales_enriched"]
ORACLES["catalog_ctas"] = ORACLES["clean_sales"]
oracle("zorder_ranges", """
SELECT 'user_id' AS "by", count(*) AS rows, TRUE AS skips FROM events WHERE user_id <= (SELECT max(user_id) // 10 FROM events)
UNION ALL SELECT 'ts', count(*), TRUE FROM events WHERE ts < TIMESTAMP '2024-01-03'""")
oracle("model_round_trip", """
SELECT feature, TRUE AS used, TRUE AS sums_to_one, 0 AS differing
FROM (VALUES ('total_spend'), ('total_orders'), ('avg_order_value')) f(feature)""")


# ---------------------------------------------------------------- a feed whose schema changed
_CHANGED = f"""
SELECT table_name, column_name, CASE WHEN column_name = 'signup_date' THEN 'StringType()' ELSE data_type END AS data_type, ordinal
FROM ({_infer_sql("customers")}) WHERE column_name <> 'city'
UNION ALL SELECT 'customers_silver', 'loyalty_tier', 'StringType()', 8"""
_CHANGED_CTES = {"declared": f"SELECT * FROM ({_declared_sql()}) WHERE table_name = 'customers_silver'", "inferred": _CHANGED, "drift": _DRIFT}
oracle("changed_feed_drift", "SELECT * FROM drift", _CHANGED_CTES)
oracle("changed_feed_report", _REPORT, _CHANGED_CTES)
oracle("changed_feed_columns", """
SELECT 'customers_silver' AS table_name,
  (SELECT list(column_name ORDER BY column_name) FROM inferred WHERE column_name NOT IN (SELECT column_name FROM declared)) AS added,
  (SELECT list(column_name ORDER BY column_name) FROM declared WHERE column_name NOT IN (SELECT column_name FROM inferred)) AS removed,
  (SELECT list(column_name ORDER BY column_name) FROM declared WHERE column_name IN (SELECT column_name FROM inferred)) AS common""", _CHANGED_CTES)
_CQ = {
    "old_n": f"SELECT * FROM ({nulls_sql('customers')})", "o": f"SELECT * FROM ({zscore_sql('customers')})",
    "n": "SELECT ordinal, column_name, null_percentage FROM old_n WHERE column_name <> 'city' "
         "UNION ALL SELECT 99, 'loyalty_tier', null_percentage FROM old_n WHERE column_name = 'country'",
    "old_score": "SELECT 100 - 10 * (SELECT count(*) FROM old_n WHERE null_percentage > 20) - 5 * (SELECT count(*) FROM o WHERE outlier_count > 0) AS s",
    "new_score": "SELECT 100 - 30 - 10 - 20 - 10 * (SELECT count(*) FROM n WHERE null_percentage > 20) - 5 * (SELECT count(*) FROM o WHERE outlier_count > 0) AS s",
}
oracle("changed_feed_quality", """
SELECT 'customers_silver' AS table_name, CAST(greatest(s, 0) AS INTEGER) AS quality_score,
  concat_ws(chr(10), '⚠ Schema drift detected in customers_silver. Please review structural changes.',
    coalesce((SELECT '⚠ High null percentages found in: ' || string_agg(column_name, ', ' ORDER BY ordinal) || '.' FROM n WHERE null_percentage > 20 HAVING count(*) > 0),
             '✔ No significant null anomalies detected in customers_silver.'),
    coalesce((SELECT '⚠ Outliers detected in numeric columns: ' || string_agg(column_name, ', ' ORDER BY ordinal) || '.' FROM o WHERE outlier_count > 0 HAVING count(*) > 0),
             '✔ No numeric outliers detected in customers_silver.'),
    '✔ Overall, customers_silver looks healthy and ready for downstream use.') AS ai_summary,
  '{"missing_columns":["city"],"new_columns":["loyalty_tier"],"type_mismatches":[{"column":"signup_date","baseline_type":"DateType()","current_type":"StringType()"}]}' AS schema_drift_json
FROM new_score""", _CQ)
oracle("changed_feed_runs", """
SELECT 'customers_silver' AS table_name, 'run_001' AS run_id, '2024-02-01T00:00:00' AS timestamp, CAST(greatest(n.s, 0) AS INTEGER) AS quality_score,
  'run_000' AS previous_run_id, CAST(greatest(n.s, 0) - greatest(o.s, 0) AS INTEGER) AS score_change,
  ['city', 'loyalty_tier', 'signup_date'] AS newly_drifted_columns, []::VARCHAR[] AS new_high_null_columns, []::VARCHAR[] AS new_outlier_columns
FROM new_score n, old_score o
UNION ALL
SELECT 'customers_silver', 'run_000', '2024-01-31T00:00:00', CAST(greatest(s, 0) AS INTEGER), NULL, NULL, []::VARCHAR[],
  coalesce((SELECT list(column_name ORDER BY column_name) FROM old_n WHERE null_percentage > 20), []::VARCHAR[]),
  coalesce((SELECT list(column_name ORDER BY column_name) FROM o WHERE outlier_count > 0), []::VARCHAR[])
FROM old_score""", _CQ)


# ---------------------------------------------------------------- ingest and sinks, round trip
oracle("csv_ingest", "SELECT * FROM customers_silver")
oracle("json_ingest", "SELECT * FROM sales_silver")
ORACLES["append_round_trip"] = ORACLES["gold_product_sales"]
ORACLES["drilldown_export"] = ORACLES["customer_drilldown"]
oracle("output_validation", "\nUNION ALL ".join(f"SELECT count(*) AS row_count, true AS schema_matches, '{_silver(f)}' AS table_name FROM {_silver(f)}" for f in FEEDS))
oracle("event_parts", """SELECT sale_id, sale_date, CAST(year(sale_date) AS INTEGER) AS sale_date_year, CAST(month(sale_date) AS INTEGER) AS sale_date_month,
  CAST(date_trunc('month', sale_date) AS DATE) AS sale_date_month_start FROM sales_silver""")
oracle("quarantine_keyless_transactions", """
SELECT DISTINCT CAST(NULL AS VARCHAR) AS transaction_id, CAST(NULL AS VARCHAR) AS customer_id, transaction_date, payment_method, status, amount,
  'transaction_id_is_null' AS quarantine_reason FROM transactions_silver WHERE customer_id IS NULL""")
oracle("clean_root_causes_documents", f"""
SELECT doc_id, array_to_string(list_slice(list_filter(
         list_transform(string_split('- ' || replace(text, chr(10), chr(10) || '- '), chr(10)), lambda x: {_STRIP('x')}),
         lambda x: starts_with(x, '- ') AND NOT ({_SKIP})), 1, 4), chr(10)) AS bullets
FROM documents""")
