"""Streams over many small batches: delivery in time slices, closed results, late rows, resumption.

``deal`` turns a stored table into deliveries: rows go to equal slices of its time range, and every ``nth`` row arrives
``late_by`` slices after its time.  ``Feed`` lands one delivery after another and drains the query on
its checkpoint each time, so every delivery is a resumption from stored offsets and state.

Stateful results are appended once the watermark has closed them, and their state is evicted with them.  Rows that come after
their window or session was closed are dropped by the stateful operators; ``LateRows`` keeps them in a table of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.streaming import sources as SS


def micros(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp"))


def deal(events: DataFrame, time_col: str, slices: int, nth: int | None = None, late_by: int = 2, id_col: str = "event_id") -> DataFrame:
    """``events`` with ``_slice``, the delivery in which a row arrives (0 .. slices - 1).

    Rows whose time is null arrive in the first delivery.  A row that would come after the last delivery is on time.
    """
    us = micros(F.col(time_col))
    low, high = events.agg(F.min(us), F.max(us)).first()
    if low is None:
        return events.withColumn("_slice", F.lit(0))
    own = F.coalesce(F.floor((us - F.lit(low)) * slices / F.lit(high - low + 1)).cast("int"), F.lit(0))
    out = events.withColumn("_slice", own)
    if nth:
        late = (F.pmod(F.col(id_col), F.lit(nth)) == 7 % nth) & (F.col("_slice") + late_by < slices)
        out = out.withColumn("_slice", F.when(late, F.col("_slice") + late_by).otherwise(F.col("_slice")))
    return out


class Feed:
    """Delivers the slices of a dealt table to a landing folder, one after another."""

    def __init__(self, dealt: DataFrame, slices: int):
        self.spark: SparkSession = dealt.sparkSession
        self.slices = slices
        self.staged = SS.scratch(self.spark, "staged")
        self.landing = SS.scratch(self.spark, "landing")
        dealt.write.partitionBy("_slice").parquet(self.staged)
        self.schema = dealt.drop("_slice").schema
        self.spark.createDataFrame([], self.schema).write.parquet(self.landing)

    def land(self, i: int) -> None:
        rows = self.spark.read.parquet(self.staged).where(F.col("_slice") == i)
        rows.select(*self.schema.names).write.mode("append").parquet(self.landing)

    def stream(self, time_col: str) -> DataFrame:
        return SS.with_event_time(self.spark.readStream.schema(self.schema).parquet(self.landing), time_col)

    def drain(self, start: Callable[[], object], first: int = 0, last: int | None = None) -> list[dict]:
        """Land the deliveries ``first`` to ``last`` and run the query to their end after each; the last progress report of every run."""
        reports = []
        for i in range(first, self.slices if last is None else last + 1):
            self.land(i)
            q = start()
            SS.drain(q)
            reports.append(q.lastProgress)
        return reports


class LateRows:
    """foreachBatch sink: rows that arrive after ``delay`` past their closing time go to ``path``.

    The mark of a batch is the latest time of the batches before it, as the engine's watermark.  Marks and late rows are stored
    per batch and overwritten when a batch is replayed.
    """

    def __init__(self, path: str, time_col: str, closes: Callable[[Column], Column], delay_us: int):
        self.path, self.time_col, self.closes, self.delay_us = path, time_col, closes, delay_us

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        us = micros(F.col(self.time_col))
        # engine times are milliseconds
        batch.agg(F.floor(F.max(us) / 1000).alias("ms")).write.mode("overwrite").parquet(f"{self.path}/marks/batch={batch_id}")
        marks = spark.read.schema("ms bigint, batch int").parquet(f"{self.path}/marks")
        mark = marks.where(F.col("batch") < batch_id).agg(F.max("ms")).first()[0]
        late = batch.where(micros(self.closes(F.col(self.time_col))) <= F.lit((mark or 0) * 1000 - self.delay_us)) if mark is not None else batch.where("false")
        late.write.mode("overwrite").parquet(f"{self.path}/rows/batch={batch_id}")

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/rows").drop("batch")
