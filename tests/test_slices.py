"""Streams over several deliveries: state stays bounded, replays of a batch change nothing, rows without a time."""

import datetime as dt

from pyspark.sql import functions as F

from kestrel.plans import catalog
from kestrel.sources import feeds
from kestrel.streaming import monitors as MON
from kestrel.streaming import slices as SL
from kestrel.streaming import sources as SS
from tests.conftest import SF_SMALL


def test_closed_state_is_evicted(spark):
    """After each delivery the state holds what the watermark has not closed, not all that was ever seen."""
    feed = catalog._feed(spark, SF_SMALL)
    build = lambda s: MON.sessions(s, "event_time", "30 minutes", "user_id", watermark=catalog.DELAY)
    out, _, reports = catalog._appended(spark, feed, build, "bounded")
    held = [sum(s["numRowsTotal"] for s in r["stateOperators"]) for r in reports]
    closed = spark.read.parquet(out).count()
    assert len(held) == catalog.DELIVERIES and closed > 500
    last_hours = feeds.table(spark, SF_SMALL, "events").where(F.col("ts") > dt.datetime(2024, 1, 30, 20)).count()
    assert max(held) < closed / 10 and held[-1] <= last_hours


def test_resumed_query_equals_one_run(spark):
    once = catalog.q_stream_closed_windows(spark, SF_SMALL)
    resumed = catalog.q_stream_resume(spark, SF_SMALL)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, resumed.collect()))


def test_replayed_batch_of_late_rows_changes_nothing(spark):
    sink = SL.LateRows(SS.scratch(spark, "late-test"), "ts", lambda t: t, 0)
    t = dt.datetime(2024, 1, 1)
    batch = lambda *hours: spark.createDataFrame([(h, t + dt.timedelta(hours=h)) for h in hours], "event_id long, ts timestamp_ntz")
    for i, b in ((0, batch(5, 6)), (1, batch(3, 7)), (1, batch(3, 7)), (2, batch(6, 8))):
        sink(b, i)
    assert sorted(r.event_id for r in sink.read(spark).collect()) == [3, 6]


def test_deal_keeps_every_row(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(i, t + dt.timedelta(hours=i)) for i in range(100)] + [(100, None)]
    dealt = SL.deal(spark.createDataFrame(rows, "event_id long, ts timestamp_ntz"), "ts", 4, nth=10).collect()
    by = {r.event_id: r._slice for r in dealt}
    assert len(by) == 101 and by[100] == 0 and by[7] == 2 and by[6] == 0 and by[97] == 3 and by[57] == 2
    assert SL.deal(spark.createDataFrame([], "event_id long, ts timestamp_ntz"), "ts", 4).count() == 0
