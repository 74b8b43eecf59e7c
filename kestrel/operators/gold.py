"""Silver -> gold: enrichment joins, customer/product metrics, top category.

Plans are written so the shuffle carries partial aggregates, not rows:
``groupBy().agg()`` is combined map-side before the exchange, so a customer
that owns a third of all sales costs one partial row per input partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.operators.ingest import dedupe_on_key

CUSTOMER_ATTRS = ["first_name", "last_name", "email", "phone", "city", "country", "signup_date", "age"]


def _enrich(facts: DataFrame, customers: DataFrame, fact_cols: list[str], dedupe: bool) -> DataFrame:
    """facts LEFT JOIN customers ON customer_id; customers deduped on the key first.

    Deduplicating the dimension first guarantees the left join can never fan
    out and inflate fact rows.  The join itself is left to Catalyst/AQE:
    broadcast when the measured dimension is small, sort-merge otherwise.
    """
    c = dedupe_on_key(customers, "customer_id") if dedupe else customers
    f = facts.alias("f")
    c = c.alias("c")
    return f.join(c, F.col("f.customer_id") == F.col("c.customer_id"), "left").select(
        *[F.col(f"f.{x}") for x in fact_cols], *[F.col(f"c.{x}") for x in CUSTOMER_ATTRS]
    )


def enrich_sales(sales: DataFrame, customers: DataFrame, dedupe: bool = True) -> DataFrame:
    """Every sale with its customer's attributes (NULL when unknown)."""
    return _enrich(sales, customers,
                   ["sale_id", "customer_id", "product_id", "sale_date", "quantity", "amount"], dedupe)


def enrich_transactions(tx: DataFrame, customers: DataFrame, dedupe: bool = True) -> DataFrame:
    """Every transaction with its customer's attributes."""
    return _enrich(tx, customers, ["transaction_id", "customer_id", "transaction_date",
                                   "payment_method", "status", "amount"], dedupe)


def customer_sales(sales: DataFrame, customers: DataFrame | None = None, dedupe: bool = True) -> DataFrame:
    """A1: spend, orders, average order value, first/last purchase per customer.

    With customers deduplicated on the key, the left join adds no rows and
    the metrics use no customer attribute, so the join is skipped: the result
    is identical and the plan is one partial+final aggregate.  Pass
    ``dedupe=False`` to keep the reference's fan-out-prone join.
    """
    src = sales if (customers is None or dedupe) else enrich_sales(sales, customers, dedupe=False)
    return src.groupBy("customer_id").agg(
        F.sum("amount").alias("total_spend"),
        F.count("sale_id").alias("total_orders"),
        F.avg("amount").alias("avg_order_value"),
        F.min("sale_date").alias("first_purchase_date"),
        F.max("sale_date").alias("last_purchase_date"),
    )


def product_sales(sales: DataFrame) -> DataFrame:
    """A4: quantity, revenue, mean line amount ("avg_price"), first/last sale per product."""
    return sales.groupBy("product_id").agg(
        F.sum("quantity").alias("total_quantity_sold"),
        F.sum("amount").alias("total_revenue"),
        F.avg("amount").alias("avg_price"),
        F.min("sale_date").alias("first_sale_date"),
        F.max("sale_date").alias("last_sale_date"),
    )


def payment_method_counts(tx: DataFrame) -> DataFrame:
    """A3: uses per (customer, method); a NULL method counts 0 uses."""
    return tx.groupBy("customer_id", "payment_method").agg(F.count("payment_method").alias("method_count"))


def top_per_group(df: DataFrame, keys: list[str], order: list, n: int = 1) -> DataFrame:
    """W1 in general form: first ``n`` rows per group under ``order`` (row_number).

    Spark plans ``row_number() <= n`` as a partial WindowGroupLimit before the
    shuffle and a final one after, so each task ships at most ``n`` rows per
    key -- hot keys included.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def method_order() -> list:
    return [F.col("method_count").desc(), F.col("payment_method").asc_nulls_last()]


def top_payment_method(counts: DataFrame) -> DataFrame:
    """The most used method per customer; ties go to the smaller method name."""
    return top_per_group(counts, ["customer_id"], method_order()).select(
        "customer_id", F.col("payment_method").alias("most_used_payment_method"))


def customer_transactions(tx: DataFrame) -> DataFrame:
    """A2 + A3 + W1 + J3 in one aggregation chain.

    Stage 1 aggregates per (customer, method) -- every base metric is additive
    (or min/max), so it can be rolled up later.  Stage 2 rolls up per customer
    and picks the top method with ``min_by`` over (-count, method is null,
    method): the same winner as ``row_number`` with the tie-break, but without
    a second scan, a window sort or a join.  The reference's USING join never
    matches a NULL key, so the NULL-customer group keeps a NULL top method.
    """
    per_method = tx.groupBy("customer_id", "payment_method").agg(
        F.sum("amount").alias("amt"),
        F.count("transaction_id").alias("n"),
        F.count_if(F.col("status") == "success").alias("ok"),
        F.count_if(F.col("status") == "failed").alias("bad"),
        F.min("transaction_date").alias("d0"),
        F.max("transaction_date").alias("d1"),
        F.count("payment_method").alias("method_count"),
    )
    rank_key = F.struct(-F.col("method_count"), F.col("payment_method").isNull(), F.col("payment_method"))
    return per_method.groupBy("customer_id").agg(
        F.sum("amt").alias("total_transaction_amount"),
        F.sum("n").alias("transaction_count"),
        F.sum("ok").alias("success_count"),
        F.sum("bad").alias("failed_count"),
        F.min("d0").alias("first_transaction_date"),
        F.max("d1").alias("last_transaction_date"),
        F.min_by("payment_method", rank_key).alias("_top"),
    ).select(
        "customer_id", "total_transaction_amount", "transaction_count", "success_count",
        "failed_count", "first_transaction_date", "last_transaction_date",
        F.when(F.col("customer_id").isNotNull(), F.col("_top")).alias("most_used_payment_method"),
    )


def customer_transactions_by_join(tx: DataFrame) -> DataFrame:
    """The reference's shape (base metrics LEFT JOIN top method); kept for tests."""
    base = tx.groupBy("customer_id").agg(
        F.sum("amount").alias("total_transaction_amount"),
        F.count("transaction_id").alias("transaction_count"),
        F.sum(F.when(F.col("status") == "success", 1).otherwise(0)).cast("long").alias("success_count"),
        F.sum(F.when(F.col("status") == "failed", 1).otherwise(0)).cast("long").alias("failed_count"),
        F.min("transaction_date").alias("first_transaction_date"),
        F.max("transaction_date").alias("last_transaction_date"),
    )
    return base.join(top_payment_method(payment_method_counts(tx)), on="customer_id", how="left")
