"""Per-micro-batch jobs for ``foreachBatch``.

Every sink writes with dynamic partition overwrite keyed by table and run id,
and the run id names the stream, so a micro-batch replayed after a failure replaces its own
output instead of duplicating it (idempotent, effectively exactly-once), and
several tables or streams share a log without touching each other's rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.operators import docs as DOC
from kestrel.operators import drift as D
from kestrel.operators import quality as Q
from kestrel.operators import summaries as SUM
from kestrel.sources.io import read_if_exists


def run_id_of(batch_id: int, stream: str = "batch") -> str:
    """``stream`` tells streams (checkpoints) apart: batch numbers start anew with each."""
    return f"{stream}_{batch_id:06d}"


def write_run(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace exactly the partitions (table, run id) present in ``df``."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .format(fmt).partitionBy("table_name", "run_id").save(path))


class ProfileBatches:
    """T3 + T7 + T8: profile each micro-batch, classify its findings, check drift.

    ``prepare`` maps the raw micro-batch to the table to profile (e.g. the
    silver cleaning of the feed).  Outputs: quality-log rows, classified
    alerts and schema-drift rows, each partitioned by run id.
    """

    def __init__(self, table_name: str, log_path: str, alerts_path: str, drift_path: str,
                 prepare=None, baseline: T.StructType | None = None, as_of=None,
                 payload_col: str | None = None, payload_keys: list[str] | None = None, stream: str = "batch"):
        self.stream = stream
        self.table_name, self.log_path, self.alerts_path, self.drift_path = table_name, log_path, alerts_path, drift_path
        self.prepare, self.baseline, self.as_of = prepare, baseline, as_of
        self.payload_col, self.payload_keys = payload_col, payload_keys

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run_id = run_id_of(batch_id, self.stream)
        df = self.prepare(batch) if self.prepare else batch
        df = df.persist()
        log = None
        try:
            ts = f"batch-{batch_id:06d}"
            log = Q.table_quality(df, self.table_name, run_id, ts, self.baseline, as_of=self.as_of)
            log = log.persist()
            write_run(log, self.log_path)
            alerts = DOC.severity(DOC.classify(DOC.findings(log)))
            write_run(alerts, self.alerts_path)
            drift = D.schema_drift(D.schema_snapshot(spark, self.table_name, self.baseline or df.schema),
                                   D.schema_snapshot(spark, self.table_name, df.schema))
            if self.payload_col:
                seen = (batch.select(F.explode(F.json_object_keys(F.col(self.payload_col))).alias("column_name"))
                        .distinct().select(F.lit(self.table_name).alias("table_name"), "column_name",
                                           F.lit("json_key").alias("data_type"), F.lit(0).alias("ordinal")))
                expected = spark.createDataFrame([(self.table_name, k, "json_key", 0) for k in self.payload_keys or []],
                                                 D.SNAPSHOT_SCHEMA)
                drift = drift.unionByName(D.schema_drift(expected, seen))
            write_run(drift_status(drift, self.table_name, run_id), self.drift_path)
        finally:
            if log is not None:
                log.unpersist()
            df.unpersist()


def drift_status(drift: DataFrame, table_name: str, run_id: str) -> DataFrame:
    """One row per micro-batch (even without drift): drifted columns by kind.

    A global aggregate over the schema-sized drift rows.
    """
    names = lambda kind: F.sort_array(F.collect_list(F.when(F.col("change_type") == kind, F.col("column_name"))))
    return drift.agg(
        names("missing").alias("missing_columns"), names("new").alias("new_columns"),
        names("type_mismatch").alias("type_mismatches"), F.count(F.lit(1)).alias("drifted"),
    ).select(F.lit(table_name).alias("table_name"), F.lit(run_id).alias("run_id"), "missing_columns",
             "new_columns", "type_mismatches", "drifted", (F.col("drifted") > 0).alias("has_drift"))


class ReplaceResult:
    """Sink for complete mode: every micro-batch writes the whole current result to a folder of its own.

    ``read`` returns the last one, which holds open windows and sessions too,
    so a drained stream equals the batch result.
    """

    def __init__(self, path: str, transform=None):
        self.path, self.transform = path, transform

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        out = self.transform(batch) if self.transform else batch
        out.withColumn("_batch", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy("_batch").parquet(self.path)

    def read(self, spark) -> DataFrame:
        stored = spark.read.parquet(self.path)
        last = stored.agg(F.max("_batch").alias("_last"))
        return stored.join(last, F.col("_batch") == F.col("_last")).drop("_batch", "_last")


class SummarizeNewRuns:
    """T4: summarise only quality-log rows not summarised yet (left anti join).

    The summary table is keyed by (run_id, table_name); a replayed batch
    finds its rows already present and writes nothing new.
    """

    def __init__(self, summaries_path: str, generator=None):
        self.summaries_path, self.generator = summaries_path, generator

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stored = read_if_exists(spark, self.summaries_path)
        new = batch if stored is None else batch.join(stored.select("run_id", "table_name"), ["run_id", "table_name"], "left_anti")
        out = SUM.clean_outputs(SUM.generate(SUM.build_inputs(new), self.generator))
        out.write.mode("append").parquet(self.summaries_path)


class VolumeAlertBatches:
    """T6 as event-based alerting: each micro-batch of closed window counts is
    appended to the counts history, and alerts are raised for exactly those
    windows against the trailing windows of the same key.

    The history is one row per (key, window) -- bounded by time span, not by
    events -- and both appends skip (key, window) rows already stored, so a
    replayed micro-batch changes nothing.
    """

    def __init__(self, counts_path: str, alerts_path: str, key: str = "event_type", history: int = 24,
                 k: float = 3.0):
        self.counts_path, self.alerts_path = counts_path, alerts_path
        self.key, self.history, self.k = key, history, k

    def _append_new(self, df: DataFrame, path: str) -> None:
        stored = read_if_exists(df.sparkSession, path)
        if stored is not None:
            df = df.join(stored.select(self.key, "window_start"), [self.key, "window_start"], "left_anti")
        df.write.mode("append").parquet(path)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        from kestrel.streaming.monitors import volume_alerts

        batch = batch.persist()
        try:
            self._append_new(batch, self.counts_path)
            history = batch.sparkSession.read.parquet(self.counts_path)
            scored = volume_alerts(history, self.key, self.history, self.k)
            fresh = scored.join(batch.select(self.key, "window_start"), [self.key, "window_start"], "left_semi")
            self._append_new(fresh.withColumn("batch_id", F.lit(batch_id)), self.alerts_path)
        finally:
            batch.unpersist()


class TrailingAlertBatches:
    """T6 on an endless stream: closed window counts in, alerts out, with bounded state.

    The state is the last ``history`` counts of every key.  A batch reads the state that the batch before it has left and
    its own windows, never older counts, so what it reads does not grow with the stream's age.  Two state folders
    take turns: a replayed batch finds its predecessor's untouched and overwrites its own, as it does its alerts.
    Windows must arrive in the order of their start within a key, as appended windows of one size do.
    """

    def __init__(self, path: str, key: str = "event_type", history: int = 24, k: float = 3.0):
        self.path, self.key, self.history, self.k = path, key, history, k

    def state_path(self, batch_id: int) -> str:
        return f"{self.path}/state-{batch_id % 2}"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        from kestrel.streaming.monitors import volume_alerts

        batch = batch.select(self.key, "window_start", "window_end", "events")
        counts = batch.withColumn("_new", F.lit(True))
        if batch_id:
            state = batch.sparkSession.read.schema(batch.schema).parquet(self.state_path(batch_id - 1))
            counts = counts.unionByName(state.withColumn("_new", F.lit(False)))
        counts = counts.persist()
        try:
            scored = volume_alerts(counts, self.key, self.history, self.k).where("_new").drop("_new")
            scored.write.mode("overwrite").parquet(f"{self.path}/alerts/batch={batch_id}")
            newest = Window.partitionBy(self.key).orderBy(F.col("window_start").desc())
            last = counts.drop("_new").withColumn("_nth", F.row_number().over(newest)).where(F.col("_nth") <= self.history).drop("_nth")
            last.write.mode("overwrite").parquet(self.state_path(batch_id))
        finally:
            counts.unpersist()

    def read(self, spark) -> DataFrame:
        return spark.read.parquet(f"{self.path}/alerts").drop("batch")


class PayloadDriftBatches:
    """Each micro-batch's JSON payload, keys and merged types, against the expected ones (``{key: type}``).

    One row per missing, new or retyped key, stored per batch; a replayed batch replaces its rows.
    A batch without rows has no payload to compare and gives none.
    """

    def __init__(self, path: str, table_name: str, payload_col: str, expected: dict[str, str], stream: str = "batch"):
        self.path, self.table_name, self.payload_col, self.expected, self.stream = path, table_name, payload_col, expected, stream

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = [(self.table_name, k, t, 0) for k, t in self.expected.items()]
        expected = spark.createDataFrame(rows if not batch.isEmpty() else [], D.SNAPSHOT_SCHEMA)
        drift = D.schema_drift(expected, D.payload_snapshot(batch, self.payload_col, self.table_name))
        run_id = run_id_of(batch_id, self.stream)
        drift.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def read(self, spark) -> DataFrame:
        return spark.read.parquet(self.path).drop("batch")
