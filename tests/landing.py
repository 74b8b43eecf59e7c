"""Stands in for an upstream writer: several files that arrive one after another."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def land(df: DataFrame, path: str, files: int, order_col: str) -> str:
    """Write ``df`` into a landing folder as ``files`` time slices, in time order.

    The file source processes files by modification time, so the slices are
    appended one after another (oldest first), the way an upstream writer
    delivers them.  The data is range-partitioned and staged once; each
    append then reads only its own staged partition.
    """
    staging = path.rstrip("/") + "-staging"
    (df.repartitionByRange(files, F.col(order_col)).withColumn("_slice", F.spark_partition_id())
     .write.mode("overwrite").partitionBy("_slice").parquet(staging))
    staged = df.sparkSession.read.parquet(staging)
    for i in range(files):
        staged.filter(F.col("_slice") == i).drop("_slice").sortWithinPartitions(order_col) \
            .coalesce(1).write.mode("append").parquet(path)
    return path
