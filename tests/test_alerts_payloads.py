"""Alerts with bounded state, payload types, the repeatable split and the simple models."""

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from kestrel.operators import drift as D
from kestrel.operators import ml as ML
from kestrel.plans import catalog
from kestrel.streaming import batches as SB
from kestrel.streaming import monitors as MON
from kestrel.streaming import sources as SS
from tests.conftest import SF_MID

T0 = dt.datetime(2024, 1, 1)
COUNTS = "event_type string, window_start timestamp_ntz, window_end timestamp_ntz, events long"


def hours(spark, key, numbers, first=0):
    rows = [(key, T0 + dt.timedelta(hours=first + i), T0 + dt.timedelta(hours=first + i + 1), n) for i, n in enumerate(numbers)]
    return spark.createDataFrame(rows, COUNTS)


def as_rows(df):
    return sorted(map(tuple, df.select("event_type", "window_start", "events", "trailing_n", "is_alert", "direction").collect()), key=repr)


def test_trailing_alerts_equal_batch_with_bounded_state(spark):
    """A key that pauses, a null key, a spike just after a batch's border; state never exceeds keys x history."""
    n = [10 + i % 3 for i in range(60)]
    n[40] = 500
    parts = [(0, 40), (40, 41), (41, 41), (41, 60)]
    sink = SB.TrailingAlertBatches(SS.scratch(spark, "trailing-test"), history=6)
    batches = []
    for i, (a, b) in enumerate(parts):
        batch = hours(spark, "click", n[a:b], a).union(hours(spark, None, n[a:b], a))
        if i != 1:
            batch = batch.union(hours(spark, "view", [5] * (b - a), a))
        batches.append(batch)
        sink(batch, i)
        if i == 1:
            sink(batch, i)  # replayed
        kept = spark.read.parquet(sink.state_path(i)).groupBy(F.col("event_type")).count().collect()
        assert len(kept) == 3 and all(r["count"] == 6 for r in kept)
    whole = batches[0].union(batches[1]).union(batches[2]).union(batches[3])
    expected = MON.volume_alerts(whole, "event_type", history=6)
    assert as_rows(sink.read(spark)) == as_rows(expected)
    spikes = sink.read(spark).where("is_alert").collect()
    assert {(r.event_type, r.direction) for r in spikes} == {("click", "spike"), (None, "spike")}


def test_trailing_alerts_of_an_empty_first_batch(spark):
    sink = SB.TrailingAlertBatches(SS.scratch(spark, "trailing-empty"))
    sink(spark.createDataFrame([], COUNTS), 0)
    sink(hours(spark, "click", [1, 2]), 1)
    assert [r.trailing_n for r in sink.read(spark).orderBy("window_start").collect()] == [0, 1]


def test_payload_types_merge(spark):
    texts = ['{"a": 1, "b": "x", "c": null}', '{"a": 2.5, "c": true, "d": [1, 2]}', '{"b": 7, "e": {"f": 1}}', None, "", "{broken", "[1, 2]", "5"]
    df = spark.createDataFrame([(t,) for t in texts], "props string").repartition(3)
    got = {r.column_name: r.data_type for r in D.payload_snapshot(df, "props", "t").collect()}
    assert got["a"].startswith("DECIMAL") and got["b"] == "VARIANT" and got["c"] == "BOOLEAN"
    assert got["d"] == "ARRAY<BIGINT>" and got["e"] == "OBJECT<f: BIGINT>" and len(got) == 5
    assert D.payload_snapshot(df.where("false"), "props", "t").count() == 0


def test_payload_drift_is_replaced_on_replay(spark):
    sink = SB.PayloadDriftBatches(SS.scratch(spark, "payload-test"), "events", "props", {"k": "BIGINT"}, "s")
    good = spark.createDataFrame([('{"k": 1}',)], "props string")
    bad = spark.createDataFrame([('{"k": "1", "new": 2}',)], "props string")
    for i, batch in ((0, good), (1, bad), (1, bad), (2, good.where("false")), (3, spark.createDataFrame([(None,)], "props string"))):
        sink(batch, i)
    got = sorted((r.run_id, r.column_name, r.change_type, r.baseline_type, r.current_type) for r in sink.read(spark).collect())
    assert [g[:3] for g in got] == [("s_000001", "k", "type_mismatch"), ("s_000001", "new", "new"), ("s_000003", "k", "missing")]
    assert got[0][3:] == ("BIGINT", "STRING")


def test_split_is_the_md5_of_the_key(spark):
    keys = [f"C{i:06d}" for i in range(500)] + [None]
    df = spark.createDataFrame([(k,) for k in keys], "customer_id string")
    train, test = ML.train_test_split(df)
    expected = {k for k in keys if k and int(hashlib.md5(f"{k}:42".encode()).hexdigest()[:8], 16) % 100 < 80}
    assert {r.customer_id for r in train.collect()} - {None} == expected
    assert train.count() + test.count() == len(keys) and 350 < len(expected) < 450


def test_forest_beats_the_simple_models(spark):
    simple = catalog.q_baseline_classifier_metrics(spark, SF_MID).first()
    forest = catalog.q_rf_metrics(spark, SF_MID).first()
    assert simple.n == forest.n and simple.accuracy > 0.5 and forest.accuracy >= simple.accuracy
    line, trees = (q(spark, SF_MID).first() for q in (catalog.q_baseline_regression_metrics, catalog.q_clv_regression_metrics))
    assert line.n == trees.n and line.r2 > 0 and line.rmse >= line.mae


def test_simple_models_without_training_rows(spark):
    df = spark.createDataFrame([("a", 5, 1, 5.0, 1)], "customer_id string, total_spend long, total_orders long, avg_order_value double, is_high_value int")
    assert ML.midpoint_predictions(df, df).first().prediction == 1
    assert ML.midpoint_predictions(df.where("false"), df).first().prediction is None
    assert ML.ratio_predictions(df.where("false"), df).first().prediction is None
