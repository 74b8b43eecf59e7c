"""Column-level text functions (all JVM-side, no Python UDF).

Every function takes and returns ``Column`` so it runs inside whole-stage
codegen on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``str.split()`` / ``\s`` / ``strip()``
# treat as whitespace (Java's ``\s`` alone covers only the ASCII six).
PY_WS_CLASS = r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def py_strip(c: Column) -> Column:
    """``str.strip()``: remove leading/trailing whitespace of any kind."""
    return F.regexp_replace(c, f"^{PY_WS_CLASS}+|{PY_WS_CLASS}+$", "")


# ---------------------------------------------------------------- F10
def sanitize_text(c: Column, max_len: int = 4000) -> Column:
    """Collapse every whitespace run to one space, strip, cap at ``max_len``.

    NULL becomes "".  Text longer than ``max_len`` keeps its first
    ``max_len - 3`` characters followed by ``...``; the whole text is
    processed (the cap is the function's contract, applied after cleaning).
    """
    collapsed = py_strip(F.regexp_replace(F.coalesce(c, F.lit("")), f"{PY_WS_CLASS}+", " "))
    return F.when(F.length(collapsed) > max_len,
                  F.concat(F.substring(collapsed, 1, max_len - 3), F.lit("..."))).otherwise(collapsed)


# ---------------------------------------------------------------- F11
# Phrases that disqualify a root-cause bullet, tested on the
# lower-cased line, in the reference's order.
ROOT_CAUSE_SKIP = [
    "use only", "invented", "hallucination", "chat", "code", "markdown", "rules",
    "stop after", "output must", "statistics", "nulls:", "schema", "business rule",
    "bullet points are allowed", "generic advice", "repetition", "outliers:", "{",
]


def clean_root_causes(c: Column, max_bullets: int = 4) -> Column:
    """Keep the first ``max_bullets`` "- " bullet lines without a skip phrase.

    Lines are split on newline and stripped; the kept lines are re-joined
    with newline.  NULL or "" gives "".
    """
    lines = F.transform(F.split(F.coalesce(c, F.lit("")), "\n", -1), py_strip)

    def keep(x: Column) -> Column:
        low = F.lower(x)
        bad = None
        for phrase in ROOT_CAUSE_SKIP:
            hit = F.contains(low, F.lit(phrase))
            bad = hit if bad is None else (bad | hit)
        return F.startswith(x, F.lit("- ")) & ~bad

    return F.array_join(F.slice(F.filter(lines, keep), 1, max_bullets), "\n")


# ---------------------------------------------------------------- F7 / P21
def value_text(c: Column, complex_type: bool = True) -> Column:
    """complex value -> JSON text, scalar -> its text; NULL -> the text "None"."""
    text = F.to_json(c) if complex_type else c.cast("string")
    return F.when(c.isNotNull(), text).otherwise(F.lit("None"))


# ---------------------------------------------------------------- F8
def render_template(template: str | Column, context: list[tuple[str, Column]]) -> Column:
    """Replace ``{{key}}`` placeholders in key order (NULL value -> "").

    Replacement is sequential, like repeated ``str.replace``: a value that
    itself contains a later placeholder is substituted too.
    """
    out = F.lit(template) if isinstance(template, str) else template
    for key, value in context:
        out = F.replace(out, F.lit("{{" + key + "}}"), F.coalesce(value.cast("string"), F.lit("")))
    return out


# ---------------------------------------------------------------- F9 / F20
def short_sha1(c: Column, n: int = 10) -> Column:
    """First ``n`` hex digits of SHA-1 of the UTF-8 text."""
    return F.substring(F.sha1(c.cast("binary")), 1, n)


def rule_id(c: Column) -> Column:
    """Deterministic rule id: ``rule_`` + 6 hex digits of the text's SHA-1."""
    return F.concat(F.lit("rule_"), short_sha1(c, 6))


# ---------------------------------------------------------------- F13/F14/F16
THRESHOLD_RE = r"(?i)(?:>|greater than|above)\s*([\d,]+)"
COLUMN_RE = r"(?i)\b([a-z_]+_id|amount|price|quantity|date)\b"


def rule_threshold(c: Column) -> Column:
    """First number after ">", "greater than" or "above"; commas dropped; double."""
    raw = F.regexp_extract(c, THRESHOLD_RE, 1)
    return F.when(raw != "", F.replace(raw, F.lit(","), F.lit("")).try_cast("double"))


def rule_columns(c: Column) -> Column:
    """Comma list of the column words a rule mentions, lower-cased, in order."""
    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(COLUMN_RE), 1), F.lower), ",")


def rule_type(c: Column) -> Column:
    low = F.lower(c)
    return F.when(F.contains(low, F.lit("missing")) | F.contains(low, F.lit("null")),
                  F.lit("null_check")).otherwise(F.lit("business_rule"))


def rule_severity(max_threshold: Column) -> Column:
    return F.when(max_threshold.isNotNull() & (max_threshold != 0), F.lit("high")).otherwise(F.lit("medium"))


def split_list(c: Column) -> Column:
    """Comma list -> trimmed, non-empty items."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), py_strip), lambda x: x != "")


# ---------------------------------------------------------------- Q9
# Anomaly classes in precedence order -- (type, severity,
# explanation) -- and the keywords / pattern that select each.
ANOMALY_CLASSES = [
    ("schema_drift", "high", "A schema-level change was detected."),
    ("missing_values", "high", "Records contain missing or null values."),
    ("outlier", "high", "Several values fall outside expected numeric range."),
    ("distribution_shift", "medium", "Data distribution has changed compared to historical patterns."),
    ("business_rule_violation", "high", "Detected a violation of predefined business logic."),
]
UNKNOWN_CLASS = ("unknown", "medium", "Unable to determine anomaly type from description.")
OUTLIER_RE = r"\b(outlier|above|below|greater than|> )\b"


def _any_contains(low: Column, words: list[str]) -> Column:
    out = None
    for w in words:
        hit = F.contains(low, F.lit(w))
        out = hit if out is None else (out | hit)
    return out


def classify_anomaly(c: Column) -> Column:
    """Q9: struct(type, severity, explanation) of an anomaly description."""
    low = F.lower(F.coalesce(c, F.lit("")))
    tests = [
        _any_contains(low, ["new column", "column mismatch", "schema"]),
        _any_contains(low, ["null", "missing"]),
        low.rlike(OUTLIER_RE),
        _any_contains(low, ["distribution", "skew", "drift"]),
        _any_contains(low, ["rule", "violation", "constraint"]),
    ]

    def pick(field: int) -> Column:
        expr = None
        for test, cls in zip(tests, ANOMALY_CLASSES):
            expr = F.when(test, F.lit(cls[field])) if expr is None else expr.when(test, F.lit(cls[field]))
        return expr.otherwise(F.lit(UNKNOWN_CLASS[field]))

    return F.struct(pick(0).alias("type"), pick(1).alias("severity"), pick(2).alias("explanation"))


# ---------------------------------------------------------------- T12
def severity_score(anomaly_type: Column, affected_pct: Column) -> Column:
    """0-100 score = class weight x share of rows affected, banded.

    Weights: schema drift 1.0, missing values 0.8, business rule 0.7,
    outlier 0.6, distribution shift 0.5, unknown 0.3.
    """
    weight = (F.when(anomaly_type == "schema_drift", 1.0).when(anomaly_type == "missing_values", 0.8)
              .when(anomaly_type == "business_rule_violation", 0.7).when(anomaly_type == "outlier", 0.6)
              .when(anomaly_type == "distribution_shift", 0.5).otherwise(0.3))
    pct = F.least(F.greatest(F.coalesce(affected_pct, F.lit(100.0)), F.lit(0.0)), F.lit(100.0))
    return F.round(weight * pct, 2)


def severity_band(score: Column) -> Column:
    return (F.when(score >= 50, F.lit("critical")).when(score >= 20, F.lit("high"))
            .when(score >= 5, F.lit("medium")).otherwise(F.lit("low")))
