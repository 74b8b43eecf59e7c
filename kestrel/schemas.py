"""Declared table contracts (silver, gold, quality log) and type classes."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, D, L, DB = T.StringType(), T.IntegerType(), T.DateType(), T.LongType(), T.DoubleType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


CUSTOMERS_SILVER = _struct(
    ("customer_id", S, False), ("first_name", S, True), ("last_name", S, True),
    ("email", S, True), ("phone", S, True), ("city", S, True), ("country", S, True),
    ("signup_date", D, True), ("age", I, True),
)
SALES_SILVER = _struct(
    ("sale_id", S, False), ("customer_id", S, True), ("product_id", S, True),
    ("sale_date", D, True), ("quantity", I, True), ("amount", I, True),
)
TRANSACTIONS_SILVER = _struct(
    ("transaction_id", S, False), ("customer_id", S, True), ("transaction_date", D, True),
    ("payment_method", S, True), ("status", S, True), ("amount", I, True),
)

SILVER = {
    "customers": CUSTOMERS_SILVER,
    "sales": SALES_SILVER,
    "transactions": TRANSACTIONS_SILVER,
}
KEYS = {"customers": "customer_id", "sales": "sale_id", "transactions": "transaction_id"}
SILVER_TABLE_NAMES = {"customers": "customers_silver", "sales": "sales_silver",
                      "transactions": "transactions_silver"}


def raw_string_schema(contract: T.StructType) -> T.StructType:
    """All-string, all-nullable version of a contract: how a raw CSV is read.

    Reading every raw column as text (instead of ``inferSchema``) keeps the
    leading zeros of digit-only values such as phone numbers and lets casts
    fail softly to NULL.
    """
    return T.StructType([T.StructField(f.name, S, True) for f in contract.fields])


# Type classes used by the profiler.  short, byte, decimal, boolean and
# timestamp columns get null checks only.
NUMERIC_TYPES = (T.IntegerType, T.LongType, T.DoubleType, T.FloatType)
STRING_TYPES = (T.StringType,)
DATE_TYPES = (T.DateType,)


def kind_of(dt: T.DataType) -> str:
    if isinstance(dt, NUMERIC_TYPES):
        return "numeric"
    if isinstance(dt, STRING_TYPES):
        return "string"
    if isinstance(dt, DATE_TYPES):
        return "date"
    return "other"


def type_text(dt: T.DataType) -> str:
    """Type name as Python prints a Spark type, e.g. ``IntegerType()``."""
    return str(dt)
