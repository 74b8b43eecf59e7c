"""Mergeable column profiles: one stored row per run and column, merged for any period without reading the data again.

Counts, extremes and HyperLogLog sketches merge by sum, min, max and union.  Mean and deviation are kept as
(count, mean, M2), which merge exactly up to rounding: M2 of a union is the sum of the parts' M2 plus the
count-weighted squared distances of their means from the common one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: 2**14 registers: a standard error of about 0.65 percent.
LG_K = 14


def run_sketch(df: DataFrame, columns: list[str], run_id) -> DataFrame:
    """(run_id, column_name, rows, n, mean, m2, low, high, sketch) of ``columns``, from one aggregate over ``df``.

    Numbers are profiled as doubles.  A column without values has n 0 and null moments and extremes.
    """
    one = df.agg(F.count(F.lit(1)).alias("rows"), *(x for c in columns for x in (
        F.count(c).alias(f"n_{c}"), F.avg(c).cast("double").alias(f"mean_{c}"), (F.var_pop(c) * F.count(c)).alias(f"m2_{c}"),
        F.min(c).cast("double").alias(f"low_{c}"), F.max(c).cast("double").alias(f"high_{c}"),
        F.hll_sketch_agg(F.col(c).cast("string"), F.lit(LG_K)).alias(f"sketch_{c}"))))
    each = [F.struct(F.lit(c).alias("column_name"), "rows", *(F.col(f"{m}_{c}").alias(m) for m in ("n", "mean", "m2", "low", "high", "sketch"))) for c in columns]
    return one.select(F.lit(run_id).alias("run_id"), F.inline(F.array(*each)))


def merged(sketches: DataFrame) -> DataFrame:
    """(column_name, runs, rows, nulls, mean, stddev, low, high, distinct_estimate) over the runs in ``sketches``."""
    s = sketches.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("runs"), F.sum("rows").alias("rows"), F.sum("n").alias("n"),
        (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("mean"),
        # around a common pivot, so that large means don't cancel
        F.sum("m2").alias("m2"), F.collect_list(F.struct("n", "mean")).alias("parts"),  # one entry a run
        F.min("low").alias("low"), F.max("high").alias("high"), F.hll_union_agg("sketch").alias("sketch"))
    between = F.aggregate(F.filter("parts", lambda p: p["n"] > 0), F.lit(0.0), lambda acc, p: acc + p["n"] * (p["mean"] - F.col("mean")) ** 2)
    return s.select("column_name", "runs", "rows", (F.col("rows") - F.col("n")).alias("nulls"), "mean",
                    F.when(F.col("n") > 1, F.sqrt((F.col("m2") + between) / (F.col("n") - 1))).alias("stddev"),
                    "low", "high", F.hll_sketch_estimate("sketch").alias("distinct_estimate"))


class SketchBatches:
    """foreachBatch sink: the sketch rows of every micro-batch; a replayed batch overwrites its own."""

    def __init__(self, path: str, columns: list[str]):
        self.path, self.columns = path, columns

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        run_sketch(batch, self.columns, int(batch_id)).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path).drop("batch")
