"""Windowed monitors that run unchanged on batch and streaming frames
(T5 rolling quality, T6 volume, T10 sessions) plus the alert rule over
closed windows.

On a stream, pass ``watermark`` so state is evicted once a window closes;
late rows beyond the watermark are dropped from these stateful operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ALLOWED_STATUS = ["success", "failed"]
ALLOWED_METHODS = ["upi", "card", "netbanking", "wallet"]


def _watermarked(df: DataFrame, time_col: str, watermark: str | None) -> DataFrame:
    return df.withWatermark(time_col, watermark) if watermark else df


def quality_windows(tx: DataFrame, time_col: str, size: str = "1 day", slide: str | None = None,
                    watermark: str | None = None) -> DataFrame:
    """T5: per event-time window, row count and the rate of each quality problem.

    ``tx`` holds raw transaction columns; the checks mirror the transaction
    rules (lower-cased lists, NULL is not a violation) plus the null key.
    """
    s, m = F.lower(F.trim(F.col("status"))), F.lower(F.trim(F.col("payment_method")))
    w = F.window(F.col(time_col), size, slide) if slide else F.window(F.col(time_col), size)
    agg = _watermarked(tx, time_col, watermark).groupBy(w.alias("window")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("customer_id").isNull()).alias("null_customer"),
        F.count_if(F.col("payment_method").isNull()).alias("null_method"),
        F.count_if(~s.isin(ALLOWED_STATUS)).alias("bad_status"),
        F.count_if(~m.isin(ALLOWED_METHODS)).alias("bad_method"),
        F.count_if(F.col("amount") <= 0).alias("bad_amount"),
    )
    rate = lambda c: F.round(F.col(c) * 100.0 / F.col("rows"), 2)
    return agg.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "rows",
        "null_customer", "null_method", "bad_status", "bad_method", "bad_amount",
        rate("null_customer").alias("null_customer_pct"), rate("bad_status").alias("bad_status_pct"),
        rate("bad_method").alias("bad_method_pct"), rate("bad_amount").alias("bad_amount_pct"))


def volume_counts(events: DataFrame, time_col: str, size: str = "1 hour", key: str = "event_type",
                  watermark: str | None = None) -> DataFrame:
    """T6 input: events per (key, tumbling window)."""
    return (_watermarked(events, time_col, watermark)
            .groupBy(F.col(key), F.window(F.col(time_col), size).alias("window"))
            .agg(F.count(F.lit(1)).alias("events"))
            .select(key, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                    "events"))


def volume_alerts(counts: DataFrame, key: str = "event_type", history: int = 24, k: float = 3.0,
                  min_history: int = 3) -> DataFrame:
    """Flag windows whose count departs from the trailing mean by more than k sd.

    Trailing statistics come from the previous ``history`` closed windows of
    the same key (``rowsBetween(-history, -1)``); partitioning by key keeps
    each series in its own task.
    """
    w = Window.partitionBy(key).orderBy("window_start").rowsBetween(-history, -1)
    mean, sd, n = F.avg("events").over(w), F.stddev_samp("events").over(w), F.count("events").over(w)
    out = counts.withColumns({"trailing_mean": mean, "trailing_sd": sd, "trailing_n": n})
    dev = F.abs(F.col("events") - F.col("trailing_mean"))
    alert = ((F.col("trailing_n") >= min_history) & F.col("trailing_sd").isNotNull() & (F.col("trailing_sd") > 0)
             & (dev > k * F.col("trailing_sd")))
    direction = F.when(F.col("events") > F.col("trailing_mean"), F.lit("spike")).otherwise(F.lit("drop"))
    return out.withColumns({"is_alert": alert, "direction": F.when(alert, direction)})


def sessions(events: DataFrame, time_col: str, gap: str = "30 minutes", key: str = "user_id",
             watermark: str | None = None) -> DataFrame:
    """Session windows per key (gap-based), with event count and value sum."""
    return (_watermarked(events, time_col, watermark)
            .groupBy(F.col(key), F.session_window(F.col(time_col), gap).alias("session"))
            .agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("total_value"))
            .select(key, F.col("session.start").alias("session_start"), F.col("session.end").alias("session_end"),
                    "events", "total_value"))


def dedupe_events(events: DataFrame, key: str, time_col: str, watermark: str) -> DataFrame:
    """T10 state helper: drop replayed events within the watermark."""
    return events.withWatermark(time_col, watermark).dropDuplicatesWithinWatermark([key])


def payload_keys(df: DataFrame, json_col: str = "props") -> DataFrame:
    """T8 input: the distinct top-level keys of a JSON payload column."""
    return df.select(F.explode(F.json_object_keys(F.col(json_col))).alias("key")).distinct()


def sessions_bucketed(events: DataFrame, time_col: str, gap_minutes: int = 30, key: str = "user_id",
                      bucket_minutes: int = 60) -> DataFrame:
    """T10 batch form that stays parallel when one key owns a large share of events.

    ``session_window`` orders all events of a key in one task.  Here:

    1. events are sessionized locally inside (key, time bucket) partitions
       (lag + running sum), so a hot key is spread over its buckets;
    2. each bucket is summarised to one row (first/last event, local session
       count) and a running sum over those per-key bucket rows -- one row per
       bucket, not per event -- numbers the sessions globally, joining the
       first local session of a bucket to the previous bucket's last one when
       the gap is shorter than ``gap_minutes``;
    3. local sessions are rolled up by (key, global session number).

    Same sessions as ``session_window(ts, gap)``: a new session starts when an
    event is at least ``gap`` after the previous one; the end is last + gap.
    """
    gap_us, bucket_us = gap_minutes * 60_000_000, bucket_minutes * 60_000_000
    ts = F.col(time_col)
    is_ntz = dict(events.dtypes)[time_col] == "timestamp_ntz"
    epoch = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'" if is_ntz else "TIMESTAMP '1970-01-01 00:00:00+00:00'")
    us = F.timestamp_diff("MICROSECOND", epoch, ts)
    e = events.select(F.col(key), ts.alias("_t"), F.col("value"), us.alias("_us")) \
        .withColumn("_b", F.floor(F.col("_us") / bucket_us))
    w = Window.partitionBy(key, "_b").orderBy("_us")
    prev = F.lag("_us").over(w)
    e = e.withColumn("_new", F.when(prev.isNull() | (F.col("_us") - prev >= gap_us), 1).otherwise(0))
    e = e.withColumn("_ls", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    local = e.groupBy(key, "_b", "_ls").agg(
        F.min("_t").alias("_start"), F.max("_t").alias("_last"), F.min("_us").alias("_start_us"),
        F.max("_us").alias("_last_us"), F.count(F.lit(1)).alias("events"), F.sum("value").alias("total_value"))
    wb = Window.partitionBy(key).orderBy("_b")
    buckets = local.groupBy(key, "_b").agg(F.min("_start_us").alias("_first_us"), F.max("_last_us").alias("_blast"),
                                           F.count(F.lit(1)).alias("_k"))
    prev_last = F.lag("_blast").over(wb)
    buckets = buckets.withColumn("_first_new", F.when(prev_last.isNull() | (F.col("_first_us") - prev_last >= gap_us), 1)
                                 .otherwise(0))
    starts = F.col("_first_new") + F.col("_k") - 1
    buckets = buckets.withColumn("_before", F.coalesce(
        F.sum(starts).over(wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    numbered = local.join(buckets.select(key, "_b", "_first_new", "_before"), [key, "_b"]) \
        .withColumn("_gid", F.col("_before") + F.col("_first_new") + F.col("_ls") - 1)
    return numbered.groupBy(key, "_gid").agg(
        F.min("_start").alias("session_start"), F.max("_last").alias("_end_last"),
        F.sum("events").alias("events"), F.sum("total_value").alias("total_value"),
    ).select(key, "session_start", (F.col("_end_last") + F.expr(f"INTERVAL {gap_minutes} MINUTES")).alias("session_end"),
             "events", "total_value")
