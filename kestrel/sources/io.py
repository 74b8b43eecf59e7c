"""Scans, sinks and catalog helpers.

All reads take an explicit schema where the format allows, so no inference
job runs and nothing is guessed; all writes are plain DataFrameWriter calls
with the format as a parameter (Delta where its jar is present, Parquet by
default).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.schemas import raw_string_schema

CORRUPT = "_corrupt_record"


# ---------------------------------------------------------------- scans
def read_raw_csv(spark: SparkSession, path: str, contract: T.StructType, corrupt: bool = True) -> DataFrame:
    """Header CSV with every contract column read as text (PERMISSIVE).

    Malformed lines keep their text in ``_corrupt_record`` instead of failing
    the job or being silently dropped.
    """
    schema = raw_string_schema(contract)
    if corrupt:
        schema = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType(), True)])
    return (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).csv(path))


def read_raw_json(spark: SparkSession, path: str, contract: T.StructType) -> DataFrame:
    """JSON-lines raw input with an explicit all-text schema."""
    return spark.read.schema(raw_string_schema(contract)).json(path)


def read_path(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Table by path."""
    return spark.read.format(fmt).load(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table."""
    return spark.table(name)


def table_or_empty(spark: SparkSession, name: str, schema: T.StructType | str) -> DataFrame:
    """The table if it exists, else an empty frame of the expected schema."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.createDataFrame([], schema)


# ---------------------------------------------------------------- sinks
def write_path(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
               partition_by: list[str] | None = None) -> None:
    """Overwrite (or append) to a path."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def save_table(df: DataFrame, name: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Overwrite a catalog table."""
    df.write.mode(mode).format(fmt).saveAsTable(name)


def save_bucketed(df: DataFrame, name: str, columns: list[str], buckets: int, path: str, fmt: str = "parquet") -> DataFrame:
    """Overwrite a catalog table stored at ``path``, bucketed and sorted by ``columns``.

    Tables with equal buckets join and group on these columns without a shuffle.  A hot key makes its bucket
    large, so this is for keys of bounded frequency (customers of a dimension), not for skewed facts.
    """
    (df.repartition(buckets, *columns).write.mode("overwrite").format(fmt).option("path", path)
     .bucketBy(buckets, *columns).sortBy(*columns).saveAsTable(name))
    return df.sparkSession.table(name)


def append(df: DataFrame, target: str, fmt: str = "parquet", by_path: bool = True,
           merge_schema: bool = True) -> None:
    """Append, letting new columns extend the stored schema."""
    w = df.write.mode("append").format(fmt)
    if merge_schema:
        w = w.option("mergeSchema", "true")
    (w.save(target) if by_path else w.saveAsTable(target))


def export_csv(df: DataFrame, path: str) -> None:
    """CSV export with a header (one file per partition, no driver copy)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_partitioned_log(log: DataFrame, path: str, fmt: str = "parquet",
                          partition_cols: tuple[str, ...] = ("table_name", "run_date")) -> None:
    """Quality log laid out by table and date, clustered by run inside.

    ``repartition`` on the partition columns writes one file per output
    partition instead of one per task, and ``sortWithinPartitions`` keeps
    files sorted by run_id so min/max statistics skip row groups.
    """
    out = log.withColumn("run_date", F.to_date(F.substring("timestamp", 1, 10)))
    (out.repartition(*partition_cols).sortWithinPartitions("run_id")
     .write.mode("append").format(fmt).partitionBy(*partition_cols).save(path))


def read_if_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The stored table, or None if nothing is stored there; any other failure is raised.

    A storage hiccup must not be taken for an empty history.
    """
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def append_new_runs(log: DataFrame, path: str, fmt: str = "parquet",
                    keys: tuple[str, ...] = ("table_name", "run_id")) -> None:
    """S7 made re-runnable: append only (table, run) rows the log does not hold yet.

    The stored key set is one row per table and run (small); a retried job
    therefore appends nothing twice.
    """
    stored = read_if_exists(log.sparkSession, path, fmt)
    done = None if stored is None else stored.select(*keys).distinct()
    new = log.join(done, list(keys), "left_anti") if done is not None else log
    write_partitioned_log(new, path, fmt)


def read_log(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """S18 read side: merge the schemas of every appended generation."""
    return spark.read.format(fmt).option("mergeSchema", "true").load(path)


def union_evolving(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union two generations of a table; columns missing on one side are NULL."""
    return old.unionByName(new, allowMissingColumns=True)


def bronze(raw: DataFrame, source: str, source_file: bool = True) -> DataFrame:
    """Raw copy plus ingest timestamp, source and (for a feed read from one source) source file."""
    extra = {"_ingest_ts": F.current_timestamp(), "_source": F.lit(source)}
    if source_file:
        extra["_source_file"] = F.input_file_name()
    return raw.withColumns(extra)


def ctas(spark: SparkSession, name: str, path: str, fmt: str = "parquet", location: str | None = None) -> DataFrame:
    """CREATE TABLE ... AS SELECT from a path (stored at ``location``, else in the warehouse)."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING {fmt}{where} AS SELECT * FROM {fmt}.`{path}`")
    return spark.table(name)


def ensure_database(spark: SparkSession, name: str) -> None:
    """S16."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def drop_table(spark: SparkSession, name: str) -> None:
    """S16."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def list_tables(spark: SparkSession, database: str = "default") -> list[str]:
    """Catalog listing (metadata only)."""
    return [t.name for t in spark.catalog.listTables(database)]


def validate_output(df: DataFrame, expected: T.StructType) -> DataFrame:
    """One row: schema equal (names + types) and row count, from one aggregate."""
    same = [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in expected.fields]
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn("schema_matches", F.lit(same))


# ---------------------------------------------------------------- S20
def ingest_metadata(df: DataFrame, table_name: str, path: str) -> DataFrame:
    """(table_name, row_count, file_size_mb, files, schema_json) of an ingest.

    ``path`` is where the table is stored.  Row count is an aggregate; file sizes
    come from the ``binaryFile`` source's ``length`` column -- file contents
    are never read, and no file list reaches the driver.
    """
    spark = df.sparkSession
    rows = df.agg(F.count(F.lit(1)).alias("row_count"))
    sizes = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(path)
             .agg(F.sum("length").alias("bytes"), F.count(F.lit(1)).alias("files")))
    return rows.crossJoin(sizes).select(
        F.lit(table_name).alias("table_name"), "row_count",
        F.round(F.coalesce(F.col("bytes"), F.lit(0)) / (1024 * 1024), 2).alias("file_size_mb"),
        "files", F.lit(df.schema.json()).alias("schema_json"))


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """A bounded peek (``limit``), for the edge of a job only."""
    return df.limit(n)


def materialize(df: DataFrame, name: str, fmt: str = "parquet") -> DataFrame:
    """Cut lineage: write ``df`` under the shared checkpoint folder and read it back.

    A lost executor then recomputes from the written files, not from the
    raw sources.  (``localCheckpoint`` is never used: it dies with the executor.)
    """
    from kestrel.session import scratch_path

    path = scratch_path(df.sparkSession, f"tables/{name}")
    df.write.mode("overwrite").format(fmt).save(path)
    return df.sparkSession.read.format(fmt).load(path)
