"""Streaming results against the batch form; late data; idempotent replays."""

import datetime as dt

from pyspark.sql import functions as F

from kestrel.operators import ingest
from kestrel.plans import catalog
from kestrel.sources import feeds
from kestrel.streaming import batches as SB
from kestrel.streaming import monitors as MON
from kestrel.streaming import sources as SS
from tests.conftest import SF_SMALL


def test_stream_windows_equal_batch_on_closed_windows(spark):
    stream_rows = catalog.q_stream_windows(spark, SF_SMALL).collect()
    batch = {r["window_start"]: r for r in MON.quality_windows(catalog.tx_events(spark, SF_SMALL), "ts", "1 day").collect()}
    assert stream_rows
    for r in stream_rows:
        b = batch[r["window_start"].replace(tzinfo=None)] if r["window_start"] not in batch else batch[r["window_start"]]
        assert (r["rows"], r["bad_status"], r["bad_method"], r["null_customer"]) == (
            b["rows"], b["bad_status"], b["bad_method"], b["null_customer"])


def test_stream_sessions_are_batch_sessions(spark):
    s = {(r["user_id"], r["events"], round(r["total_value"], 6)) for r in catalog.q_stream_sessions(spark, SF_SMALL).collect()}
    b = {(r["user_id"], r["events"], round(r["total_value"], 6))
         for r in MON.sessions(feeds.table(spark, SF_SMALL, "events"), "ts").collect()}
    assert s and s <= b


def test_late_rows_beyond_watermark_are_dropped(spark):
    path = SS.scratch(spark, "late")
    t0 = dt.datetime(2024, 1, 1, 0, 0)
    first = [(i, t0 + dt.timedelta(hours=i), 1, "purchase", 1.0, "{}") for i in range(72)]
    late = [(1000, t0 + dt.timedelta(hours=1), 1, "purchase", 1.0, "{}")]          # 2.9 days late
    fresh = [(2000, t0 + dt.timedelta(days=5), 1, "purchase", 1.0, "{}")]
    spark.createDataFrame(first, SS.EVENTS_SCHEMA).coalesce(1).write.parquet(path + "/a")
    stream = SS.with_event_time(SS.read_stream(spark, path + "/*", SS.EVENTS_SCHEMA))
    out, ck = SS.scratch(spark, "late-out"), SS.scratch(spark, "late-ck")
    q = SS.write_files(MON.volume_counts(stream, "event_time", "1 day", "event_type", "1 hour"), out, ck)
    SS.drain(q)
    spark.createDataFrame(late + fresh, SS.EVENTS_SCHEMA).coalesce(1).write.parquet(path + "/b")
    SS.drain(SS.write_files(MON.volume_counts(stream, "event_time", "1 day", "event_type", "1 hour"), out, ck))
    got = {r["window_start"].date(): r["events"] for r in spark.read.parquet(out).collect()}
    assert got[dt.date(2024, 1, 1)] == 24   # the late row did not reopen the closed day


def test_foreach_batch_profile_is_idempotent(spark):
    paths = [SS.scratch(spark, n) for n in ("log", "alerts", "drift")]
    sink = SB.ProfileBatches("transactions_silver", *paths,
                             prepare=lambda b: ingest.silver(feeds.transactions_from_events(b), "transactions"))
    batch = feeds.table(spark, SF_SMALL, "events")
    sink(batch, 7)
    sink(batch, 7)  # replay of the same micro-batch
    sink(batch, 8)
    log = spark.read.parquet(paths[0])
    assert sorted(r["run_id"] for r in log.select("run_id").collect()) == ["batch_000007", "batch_000008"]
    assert spark.read.parquet(paths[2]).filter(F.col("has_drift")).count() == 0


def test_bucketed_sessions_equal_session_window_with_hot_user(spark):
    # user 0 owns a third of the events, including sessions that chain across many hourly buckets
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        if i % 3 == 0:
            rows.append((i, t0 + dt.timedelta(minutes=10 * (i // 3) + (400 if i > 1500 else 0)), 0, "v", 1.0, "{}"))
        else:
            rows.append((i, t0 + dt.timedelta(minutes=7 * i), 1 + i % 50, "v", float(i % 7), "{}"))
    ev = spark.createDataFrame(rows, SS.EVENTS_SCHEMA)
    a = {(r["user_id"], r["session_start"], r["session_end"], r["events"], round(r["total_value"], 6))
         for r in MON.sessions_bucketed(ev, "ts", 30, "user_id", 60).collect()}
    b = {(r["user_id"], r["session_start"], r["session_end"], r["events"], round(r["total_value"], 6))
         for r in MON.sessions(ev, "ts", "30 minutes", "user_id").collect()}
    assert a == b
    hot = sorted((r for r in a if r[0] == 0), key=lambda r: r[1])
    assert len(hot) == 2 and hot[0][3] > 400    # one long chained session, then a new one after the gap


def test_incremental_summaries_skip_summarised_runs(spark):
    log = catalog.quality_log(spark, SF_SMALL)
    path = SS.scratch(spark, "summaries")
    sink = SB.SummarizeNewRuns(path)
    sink(log, 0)
    sink(log, 0)                                   # replay: nothing new to summarise
    sink(log.withColumn("run_id", F.lit("run_002")), 1)
    got = spark.read.parquet(path).groupBy("run_id").count().collect()
    assert sorted((r["run_id"], r["count"]) for r in got) == [("run_001", 3), ("run_002", 3)]


def test_stream_volume_alerts_match_batch_on_closed_windows(spark):
    got = catalog.q_stream_volume_alerts(spark, SF_SMALL)
    rows = got.collect()
    assert rows and got.groupBy("event_type", "window_start").count().filter("count > 1").count() == 0
    ev = SS.with_event_time(feeds.table(spark, SF_SMALL, "events"))
    batch = {(r["event_type"], r["window_start"]): (r["events"], r["is_alert"])
             for r in MON.volume_alerts(MON.volume_counts(ev, "event_time", "1 hour", "event_type")).collect()}
    for r in rows:
        assert (r["events"], r["is_alert"]) == batch[(r["event_type"], r["window_start"])]


def test_payload_key_drift_is_flagged(spark):
    paths = [SS.scratch(spark, n) for n in ("log2", "alerts2", "drift2")]
    sink = SB.ProfileBatches("events", *paths, payload_col="props", payload_keys=["k", "gone"])
    t0 = dt.datetime(2024, 1, 1)
    batch = spark.createDataFrame([(1, t0, 1, "view", 1.0, '{"k": 1, "extra": 2}'),
                                   (2, t0, 2, "view", 2.0, '{"k": 3}')], SS.EVENTS_SCHEMA)
    sink(batch, 3)
    r = spark.read.parquet(paths[2]).first()
    assert r["has_drift"] and r["run_id"] == "batch_000003"
    assert r["new_columns"] == ["extra"] and r["missing_columns"] == ["gone"]


def test_stream_over_landed_files_equals_batch(spark):
    """Several micro-batches in complete mode give the batch result, open windows included."""
    from tests.landing import land

    ev = feeds.table(spark, SF_SMALL, "events")
    path = land(ev, SS.scratch(spark, "landing"), 3, "ts")
    stream = SS.with_event_time(SS.read_stream(spark, path, SS.EVENTS_SCHEMA))
    sink = SB.ReplaceResult(SS.scratch(spark, "sessions"))
    SS.drain(SS.run_foreach_batch(MON.sessions(stream, "event_time", "30 minutes"), sink, SS.scratch(spark, "ck"), mode="complete"))
    got, want = sink.read(spark), MON.sessions(SS.with_event_time(ev), "event_time", "30 minutes")
    assert got.count() == want.count() and got.drop("total_value").exceptAll(want.drop("total_value")).count() == 0


def test_two_tables_share_a_log(spark):
    path = SS.scratch(spark, "shared-log")
    for name in ("a", "b"):
        SB.write_run(spark.createDataFrame([(name, SB.run_id_of(0), 1)], "table_name string, run_id string, x int"), path)
    assert sorted(r["table_name"] for r in spark.read.parquet(path).collect()) == ["a", "b"]


def test_missing_table_is_told_from_a_failed_read(spark):
    import pytest
    from kestrel.sources.io import read_if_exists

    assert read_if_exists(spark, SS.scratch(spark, "nothing")) is None
    with pytest.raises(Exception):
        read_if_exists(spark, SS.scratch(spark, "nothing"), "no_such_format")
