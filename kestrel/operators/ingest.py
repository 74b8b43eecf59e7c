"""Raw -> silver: cleaning projection, schema enforcement, dedup, quarantine.

Each cleaner is a single ``select`` (trim / lower / try_cast) followed, for the
feeds that need it, by a full-row ``dropDuplicates``.  Enforcement casts every
column to the declared contract with ``try_cast`` so a bad value becomes NULL
instead of failing the job under ANSI mode, and rows whose key is NULL are
routed to a quarantine frame instead of the silver table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel import schemas


def enforce(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Project ``df`` onto ``contract``: same names, order and types (try_cast)."""
    return df.select([F.col(f.name).try_cast(f.dataType).alias(f.name) for f in contract.fields])


def _trim(c: str) -> Column:
    return F.trim(F.col(c)).alias(c)


def _lower_trim(c: str) -> Column:
    return F.lower(F.trim(F.col(c))).alias(c)


def clean_customers(raw: DataFrame) -> DataFrame:
    """Trim names/ids, lower-case email, phone as text, typed date and age.

    Customers are not deduplicated here (the reference does not); see
    :func:`dedupe_on_key` for the keyed dedup used before joins.
    """
    cleaned = raw.select(
        _trim("customer_id"), _trim("first_name"), _trim("last_name"), _lower_trim("email"),
        F.col("phone").cast("string").alias("phone"), _trim("city"), _trim("country"),
        F.col("signup_date"), F.col("age"),
    )
    return enforce(cleaned, schemas.CUSTOMERS_SILVER)


def clean_sales(raw: DataFrame) -> DataFrame:
    """Trim ids, type date/quantity/amount, drop exact duplicate rows."""
    cleaned = raw.select(
        _trim("sale_id"), _trim("customer_id"), _trim("product_id"),
        F.col("sale_date"), F.col("quantity"), F.col("amount"),
    )
    return enforce(cleaned, schemas.SALES_SILVER).dropDuplicates()


def clean_transactions(raw: DataFrame) -> DataFrame:
    """Trim ids, lower-case method and status, type date/amount, dedupe rows."""
    cleaned = raw.select(
        _trim("transaction_id"), _trim("customer_id"), F.col("transaction_date"),
        _lower_trim("payment_method"), _lower_trim("status"), F.col("amount"),
    )
    return enforce(cleaned, schemas.TRANSACTIONS_SILVER).dropDuplicates()


CLEANERS = {
    "customers": clean_customers,
    "sales": clean_sales,
    "transactions": clean_transactions,
}


def split_on_key(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine): rows whose key is NULL violate the non-null contract."""
    return df.filter(F.col(key).isNotNull()), df.filter(F.col(key).isNull())


def silver(raw: DataFrame, feed: str) -> DataFrame:
    """Clean + enforce + keep only rows that honour the non-null key."""
    good, _ = split_on_key(CLEANERS[feed](raw), schemas.KEYS[feed])
    return good


def quarantine(raw: DataFrame, feed: str, reason_checks: dict[str, Column] | None = None) -> DataFrame:
    """Rows that may not enter silver, with the reason(s) they were held back.

    Always checks the non-null key; ``reason_checks`` adds range checks
    (``name -> predicate that is TRUE for a bad row``).  A NULL predicate is
    not a violation (three-valued logic), matching the business rules.
    """
    return with_reason(CLEANERS[feed](raw), feed, reason_checks).filter(F.col("quarantine_reason") != "")


def with_reason(cleaned: DataFrame, feed: str, reason_checks: dict[str, Column] | None = None) -> DataFrame:
    """Cleaned rows with ``quarantine_reason``: comma-joined reasons, empty for a row that may enter silver.

    Each row is in exactly one of the two tables split on it.
    """
    key = schemas.KEYS[feed]
    checks = {f"{key}_is_null": F.col(key).isNull(), **(reason_checks or {})}
    reasons = F.array_compact(F.array(*[F.when(pred, F.lit(name)) for name, pred in checks.items()]))
    return cleaned.withColumn("quarantine_reason", F.array_join(reasons, ","))


# Range checks for silver (docs: "validate numeric ranges, extract timestamps").
# A row that fails one is quarantined; the limits are parameters.
def silver_range_checks(feed: str, as_of: Column | None = None) -> dict[str, Column]:
    as_of = as_of if as_of is not None else F.current_date()
    if feed == "customers":
        return {"age_out_of_range": (F.col("age") < 0) | (F.col("age") > 120),
                "signup_in_future": F.col("signup_date") > as_of}
    if feed == "sales":
        return {"quantity_not_positive": F.col("quantity") <= 0,
                "amount_negative": F.col("amount") < 0,
                "sale_in_future": F.col("sale_date") > as_of}
    return {"amount_negative": F.col("amount") < 0,
            "transaction_in_future": F.col("transaction_date") > as_of}


def dedupe_on_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key, deterministically: the greatest row (all columns) wins.

    A grouped ``max(struct(...))`` is partially aggregated on the map side, so
    a key that holds a third of all rows never lands in one task whole.
    """
    others = [c for c in df.columns if c != key]
    best = F.max(F.struct(*[F.col(c) for c in others])).alias("_best")
    return df.groupBy(key).agg(best).select(key, *[F.col(f"_best.{c}").alias(c) for c in others])


def with_event_parts(df: DataFrame, date_col: str) -> DataFrame:
    """Timestamp extraction for silver: year, month and the month start of a date."""
    d = F.col(date_col)
    return df.withColumns({
        f"{date_col}_year": F.year(d),
        f"{date_col}_month": F.month(d),
        f"{date_col}_month_start": F.trunc(d, "month"),
    })


def filter_not_null(df: DataFrame, *cols: str) -> DataFrame:
    """Keep rows where every listed column is present."""
    cond = None
    for c in cols:
        t = F.col(c).isNotNull()
        cond = t if cond is None else cond & t
    return df.filter(cond) if cond is not None else df


def filter_null(df: DataFrame, col: str) -> DataFrame:
    """Rows where ``col`` is NULL."""
    return df.filter(F.col(col).isNull())


def select_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Column-list projection (unknown names fail at analysis, not at run time)."""
    return df.select(*[F.col(f"`{c}`") for c in cols])


def run_timestamp() -> Column:
    """the run's UTC timestamp as ISO text (session time zone is UTC)."""
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
