"""Prompt templates and the validator preamble of the text layer."""

from __future__ import annotations

# The three prompt templates, byte for byte (their SHA-1 is the
# prompt version stamped on every generated row), with the five placeholders
# statistics, null_summary, outlier_summary, schema_drift_summary and
# business_rule_violations.
ANOMALY_SUMMARY_TEMPLATE = """You are an expert Data Quality Analyst.

Your task is to produce a clear, accurate 4–7 sentence summary of the anomalies found in the dataset.

Use ONLY the information provided below:
- Statistics: {{statistics}}
- Nulls: {{null_summary}}
- Outliers: {{outlier_summary}}
- Schema drift: {{schema_drift_summary}}
- Business rule violations: {{business_rule_violations}}

Rules:
- No invented numbers or assumptions.
- No repeating the prompt text.
- No code, no markdown, no bullet points.
- Write in one clean paragraph.

Write a concise anomaly summary based strictly on the data.
"""

DATA_HEALTH_TEMPLATE = """You are an AI system that writes plain-language data health summaries.

Use ONLY the information provided below:
- Statistics: {{statistics}}
- Nulls: {{null_summary}}
- Outliers: {{outlier_summary}}
- Schema drift: {{schema_drift_summary}}
- Business rule violations: {{business_rule_violations}}

Write a 5–7 sentence paragraph that includes:
- Overall data quality (good / moderate / poor)
- Most important issues
- Severity of problems
- Simple next steps to improve quality

Rules:
- No invented metrics or examples.
- No extra commentary.
- No markdown formatting.
- Output must be one paragraph.
"""

ROOT_CAUSE_TEMPLATE = """You are a Senior Data Engineer specializing in root-cause analysis.

Use ONLY the information provided below:
- Statistics: {{statistics}}
- Nulls: {{null_summary}}
- Outliers: {{outlier_summary}}
- Schema drift: {{schema_drift_summary}}
- Business rule violations: {{business_rule_violations}}

Write 2–4 bullet points describing the likely root causes of the issues.
Each bullet should be 1 sentence.
All root causes must be supported by the data.

Rules:
- Bullet points are allowed.
- No markdown other than "-" for bullets.
- No invented explanations or systems.
- No generic advice.
"""

# The validator block put in front of every live prompt.
VALIDATOR = """
[ROLE]
You are an AI Data Quality Analyst.

RULES:
- Use ONLY the provided statistics/nulls/outliers/schema drift/business rule violations.
- No invented numbers.
- No hallucination.
- No chat dialogue.
- No code.
- No markdown except '-' for bullets (root causes only).
- Stop after producing the required content.
- Output must be clean and focused.

[ANSWER]
"""

CONTEXT_KEYS = ["statistics", "null_summary", "outlier_summary", "schema_drift_summary",
                "business_rule_violations"]

TEMPLATES = {
    "anomaly_summary": ANOMALY_SUMMARY_TEMPLATE,
    "data_health": DATA_HEALTH_TEMPLATE,
    "root_causes": ROOT_CAUSE_TEMPLATE,
}
