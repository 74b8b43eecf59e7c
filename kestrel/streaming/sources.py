"""Streaming sources, sinks and triggers.

Streams read files from a landing folder with an explicit schema; offsets
and state live in a checkpoint folder under the cluster's shared checkpoint
directory, so a restarted query resumes exactly where it stopped.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from kestrel.session import checkpoint_dir

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return f"{checkpoint_dir(spark)}/streams/{name}-{uuid.uuid4().hex[:12]}"


def read_stream(spark: SparkSession, path: str, schema: str, fmt: str = "parquet",
                max_files_per_trigger: int | None = 1) -> DataFrame:
    """Continuous file ingest with a fixed schema."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def with_event_time(df: DataFrame, col: str = "ts", out: str = "event_time") -> DataFrame:
    """Event time as TIMESTAMP (watermarks reject TIMESTAMP_NTZ); session zone is UTC."""
    return df.withColumn(out, F.col(col).cast("timestamp"))


def with_trigger(w: DataStreamWriter, trigger: str | None = None) -> DataStreamWriter:
    """``None``/"availableNow" drains what is there and stops; else a processing interval."""
    if trigger in (None, "availableNow"):
        return w.trigger(availableNow=True)
    if trigger == "once":
        return w.trigger(once=True)
    return w.trigger(processingTime=trigger)


def bronze_stream(events: DataFrame, source: str) -> DataFrame:
    """Append-only raw copy with ingest time and source file."""
    return events.withColumns({"_ingest_ts": F.current_timestamp(), "_source_file": F.input_file_name(),
                               "_source": F.lit(source)})


def write_files(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", mode: str = "append",
                trigger: str | None = None, partition_by: list[str] | None = None) -> StreamingQuery:
    """File sink (exactly-once through the sink's commit log) and start."""
    w = df.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", checkpoint).option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    return with_trigger(w, trigger).start()


def run_foreach_batch(df: DataFrame, fn, checkpoint: str, mode: str = "append",
                      trigger: str | None = None) -> StreamingQuery:
    """``fn(batch_df, batch_id)`` per micro-batch; fn must be idempotent per batch id."""
    w = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(fn)
    return with_trigger(w, trigger).start()


def drain(q: StreamingQuery) -> None:
    """Wait, however long it takes, for an availableNow query to finish; its failure is raised."""
    q.awaitTermination()
