"""Dashboard queries (KPIs, health counts, daily usage, top-k, drill-down,
selectors) as DataFrame operators; the UI itself is out of scope.

Every KPI is a global or grouped aggregate, so only the result -- a handful
of rows -- ever needs to leave the cluster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def customer_kpis(gold_sales: DataFrame) -> DataFrame:
    """Customers, mean of avg_order_value, total revenue (0 when empty)."""
    return gold_sales.agg(
        F.count(F.lit(1)).alias("customers"),
        F.coalesce(F.avg("avg_order_value"), F.lit(0.0)).alias("avg_order_value"),
        F.coalesce(F.sum("total_spend").cast("double"), F.lit(0.0)).alias("total_revenue"),
    )


def kpi_cards(kpis: DataFrame, currency: str = "₹") -> DataFrame:
    """the KPI card texts, thousands-separated."""
    return kpis.select(
        F.col("customers").cast("string").alias("customers_card"),
        F.concat(F.lit(currency), F.format_number("total_revenue", 0)).alias("revenue_card"),
        F.concat(F.lit(currency), F.format_number("avg_order_value", 2)).alias("aov_card"),
    )


def health_counts(summaries: DataFrame) -> DataFrame:
    """Poor / moderate (substring, case-folded), good = rest, tables mentioning nulls."""
    h = F.lower(F.coalesce(F.col("data_health"), F.lit("")))
    poor = F.count_if(F.contains(h, F.lit("poor")))
    moderate = F.count_if(F.contains(h, F.lit("moderate")))
    return summaries.agg(
        poor.alias("poor_health_tables"),
        moderate.alias("moderate_health_tables"),
        F.greatest(F.count(F.lit(1)) - poor - moderate, F.lit(0)).alias("good_health_tables"),
        F.count_if(F.contains(F.lower(F.coalesce(F.col("anomaly_summary"), F.lit(""))), F.lit("null")))
        .alias("tables_with_nulls"),
    )


def daily_counts(events: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """Events per calendar day."""
    return events.groupBy(F.to_date(F.col(ts_col)).alias("date")).agg(F.count(F.lit(1)).alias("events"))


def distinct_values(df: DataFrame, col: str, where: Column | None = None) -> DataFrame:
    """Selector options (distinct values, optionally within a filter)."""
    src = df.filter(where) if where is not None else df
    return src.select(col).distinct()


def select_run(df: DataFrame, run_id: str = "ALL", table_name: str = "ALL") -> DataFrame:
    """Equality filters where the value "ALL" means no filter."""
    out = df
    if run_id != "ALL":
        out = out.filter(F.col("run_id") == run_id)
    if table_name != "ALL":
        out = out.filter(F.col("table_name") == table_name)
    return out


def first_rows(df: DataFrame, order: list, n: int = 1) -> DataFrame:
    """O3: the first ``n`` rows of a selection under a total order."""
    return df.orderBy(*order).limit(n)


def sum_by_key(df: DataFrame, key: str, value: str = "amount", min_value: float | None = None,
               out: str = "total_amount") -> DataFrame:
    """P18 + A16: optional threshold filter, then groupBy(key).sum(value)."""
    src = df.filter(F.col(value) > min_value) if min_value is not None else df
    return src.groupBy(key).agg(F.sum(value).alias(out))


def top_customers(gold_sales: DataFrame, n: int = 10) -> DataFrame:
    """O1: top ``n`` by spend; ties broken by customer_id (TakeOrderedAndProject)."""
    return gold_sales.orderBy(F.col("total_spend").desc(), F.col("customer_id").asc()).limit(n)


def customer_drilldown(gold_sales: DataFrame, min_revenue: float = 0, as_of: Column | None = None) -> DataFrame:
    """P17 + F18 + O2: customers with spend >= threshold, days since last purchase, sorted."""
    as_of = as_of if as_of is not None else F.current_date()
    return (gold_sales.filter(F.col("total_spend") >= min_revenue)
            .withColumn("days_since_last_purchase", F.datediff(as_of, F.to_date("last_purchase_date")))
            .orderBy(F.col("total_spend").desc(), F.col("customer_id").asc()))
