"""The retail feeds, derived from the driver tables.

The reference ingests three raw CSV files (customers, sales, transactions)
that are not part of its tree.  These functions derive the same three raw
feeds from the TPC-H-style driver tables with deterministic dirt (nulls,
bad emails, short phones, far-future dates, outliers, duplicates), exactly as
the portable SQL in FIXTURES.md §7 defines them.  They are plain DataFrame
plans: Catalyst prunes the scanned columns and pushes filters into parquet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (parquet) by name."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lpad_key(c: Column, width: int, pad: str) -> Column:
    return F.lpad(c.cast("string"), width, pad)


def customers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw customers feed: untrimmed ids, mixed-case emails, null phones, bad ages."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    return (
        c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(F.lit("  C"), _lpad_key(k, 6, "0"), F.lit(" ")).alias("customer_id"),
            F.concat(F.lit(" "), F.split_part(F.col("c_name"), F.lit("#"), F.lit(1))).alias("first_name"),
            F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("last_name"),
            F.when(k % 20 == 0, F.lit(None).cast("string"))
            .when(k % 20 == 1, F.lit("no-at-sign.example.com"))
            .otherwise(F.concat(F.upper(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))),
                                F.lit("@Example.COM ")))
            .alias("email"),
            F.when(k % 4 == 0, F.lit(None).cast("string"))
            .when(k % 17 == 1, _lpad_key(k, 9, "8"))
            .otherwise(_lpad_key(k, 10, "9"))
            .alias("phone"),
            F.concat(F.col("c_mktsegment"), F.lit(" ")).alias("city"),
            F.col("n_name").alias("country"),
            F.when(k % 101 == 7, F.lit("2099-01-01").cast("date"))
            .otherwise(F.date_add(F.lit("2015-01-01").cast("date"), (k % 3000).cast("int")))
            .alias("signup_date"),
            F.when(k % 97 == 3, F.lit(400))
            .when(k % 31 == 2, F.lit(12))
            .otherwise((F.lit(18) + k % 60).cast("int"))
            .alias("age"),
        )
    )


def sales_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw sales feed: one row per line item; lines of every 50th order arrive twice.

    The duplicate copy is produced by exploding a one- or two-element array,
    so lineitem and orders are scanned and joined once (not once per copy).
    What an order's lines share is built once per order, before the join.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(F.lit("S"), k.cast("string"), F.lit("-")).alias("_order"),
        F.concat(F.lit(" C"), _lpad_key(F.col("o_custkey"), 6, "0")).alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("sale_date"))
    p = F.col("l_partkey")
    q = F.col("l_quantity")
    joined = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    copies = F.when(F.col("l_orderkey") % 50 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (
        joined.withColumn("_copy", F.explode(copies))
        .select(
            F.concat(F.col("_order"), F.col("l_linenumber").cast("string"), F.lit("-"),
                     p.cast("string"), F.lit(" ")).alias("sale_id"),
            F.col("customer_id"),
            F.when(p % 40 == 0, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit("P"), p.cast("string"))).alias("product_id"),
            F.col("sale_date"),
            F.when(p % 60 == 5, -q).when(p % 211 == 9, q * 40).otherwise(q).cast("int").alias("quantity"),
            F.when(p % 75 == 3, F.lit(0)).otherwise(F.floor(F.col("l_extendedprice")).cast("int")).alias("amount"),
        )
    )


def transactions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions feed derived from ``events``."""
    return transactions_from_events(table(spark, sf_dir, "events"))


def transactions_from_events(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Row-wise mapping events -> raw transactions; works on batch or streaming frames.

    ``keep`` carries extra event columns through (e.g. the event time of a stream).
    """
    e = events
    eid = F.col("event_id")
    method = (
        F.when(eid % 5 == 0, F.lit("UPI "))
        .when(eid % 5 == 1, F.lit("Card"))
        .when(eid % 5 == 2, F.lit("NetBanking"))
        .when(eid % 5 == 3, F.lit(" wallet"))
        .when(eid % 3 == 0, F.lit(None).cast("string"))
        .otherwise(F.lit("Cheque"))
    )
    status = (
        F.when(F.col("event_type") == "purchase", F.lit(" SUCCESS"))
        .when(F.col("event_type") == "error", F.lit("Failed "))
        .otherwise(F.col("event_type"))
    )
    return e.select(
        *[F.col(k) for k in keep],
        F.concat(F.lit(" T"), eid.cast("string")).alias("transaction_id"),
        F.when(eid % 90 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("C"), _lpad_key(F.col("user_id"), 6, "0"))).alias("customer_id"),
        F.col("ts").cast("date").alias("transaction_date"),
        method.alias("payment_method"),
        status.alias("status"),
        F.when(eid % 70 == 4, F.lit(0)).otherwise(F.floor(F.col("value")).cast("int")).alias("amount"),
    )


RAW_FEEDS = {
    "customers": customers_raw,
    "sales": sales_raw,
    "transactions": transactions_raw,
}
