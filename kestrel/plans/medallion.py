"""The end-to-end job: raw feeds -> silver -> gold -> quality log -> summaries.

Raw feeds are first stored as bronze (with ingest time and source).  Each layer is written once to storage and read back, so every later step
works from the stored table (lineage cut at each layer; a lost executor
recomputes from files, not from the raw sources), and profiling reads the
stored silver twice instead of re-running its cleaning and dedup.  Silver
and gold are overwritten; the quality log and summaries only receive
(table, run) keys they lack, so re-running a failed job is safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel import schemas
from kestrel.operators import drift as D
from kestrel.operators import gold, ingest
from kestrel.operators import quality as Q
from kestrel.streaming.batches import SummarizeNewRuns
from kestrel.sources import feeds
from kestrel.sources import io as IO

FEEDS = ("customers", "sales", "transactions")


def run(spark: SparkSession, sf_dir: str, out_dir: str, run_id: str, timestamp: str,
        as_of=None, fmt: str = "parquet", raw_feeds=None) -> dict[str, DataFrame]:
    """Run every layer; returns the stored tables (as DataFrames over the files).

    Each feed is cleaned once; the stored result is split into silver and quarantine, which
    together hold every cleaned row exactly once.  ``raw_feeds`` maps a feed to a function of
    (spark, input folder) for other inputs, such as :func:`csv_feeds`.
    """
    out: dict[str, DataFrame] = {}
    for feed in FEEDS:
        name = schemas.SILVER_TABLE_NAMES[feed]
        raw = (raw_feeds or feeds.RAW_FEEDS)[feed](spark, sf_dir)
        IO.write_path(IO.bronze(raw, feed, source_file=raw_feeds is not None), f"{out_dir}/bronze/{feed}", fmt)
        stored = IO.read_path(spark, f"{out_dir}/bronze/{feed}", fmt).select(*raw.columns)
        checks = ingest.silver_range_checks(feed, F.lit(as_of) if as_of is not None else None)
        IO.write_path(ingest.with_reason(ingest.CLEANERS[feed](stored), feed, checks), f"{out_dir}/cleaned/{name}", fmt)
        cleaned = IO.read_path(spark, f"{out_dir}/cleaned/{name}", fmt)
        IO.write_path(cleaned.filter(F.col("quarantine_reason") != ""), f"{out_dir}/quarantine/{name}", fmt)
        IO.write_path(cleaned.filter(F.col("quarantine_reason") == "").drop("quarantine_reason"), f"{out_dir}/silver/{name}", fmt)
        out[f"quarantine_{name}"] = IO.read_path(spark, f"{out_dir}/quarantine/{name}", fmt)
        out[name] = IO.read_path(spark, f"{out_dir}/silver/{name}", fmt)
    sales, tx, cust = out["sales_silver"], out["transactions_silver"], out["customers_silver"]
    for name, df in (("gold_customer_sales", gold.customer_sales(sales, cust)),
                     ("gold_customer_transactions", gold.customer_transactions(tx)),
                     ("gold_product_sales", gold.product_sales(sales))):
        IO.write_path(df, f"{out_dir}/gold/{name}", fmt)
        out[name] = IO.read_path(spark, f"{out_dir}/gold/{name}", fmt)
    silver_names = [schemas.SILVER_TABLE_NAMES[f] for f in FEEDS]
    # Drift baseline: the first stored snapshot of each table; the declared contract before any run.
    stored = D.stored_baselines(spark, f"{out_dir}/schema_snapshots", fmt)
    baselines = {schemas.SILVER_TABLE_NAMES[f]: stored.get(schemas.SILVER_TABLE_NAMES[f], schemas.SILVER[f])
                 for f in FEEDS}
    log = Q.profile_tables({n: out[n] for n in silver_names}, run_id, timestamp, baselines=baselines, as_of=as_of)
    snaps = None
    for n in silver_names:
        s = D.schema_snapshot(spark, n, out[n])
        snaps = s if snaps is None else snaps.unionByName(s)
    D.store_snapshots(snaps, f"{out_dir}/schema_snapshots", run_id, fmt)
    IO.append_new_runs(log, f"{out_dir}/quality_log", fmt)
    out["quality_log"] = IO.read_log(spark, f"{out_dir}/quality_log", fmt)
    this_run = out["quality_log"].filter(f"run_id = '{run_id}'")
    SummarizeNewRuns(f"{out_dir}/llm_summaries")(this_run, 0)
    out["llm_summaries"] = IO.read_path(spark, f"{out_dir}/llm_summaries", fmt)
    return out


def csv_feeds() -> dict:
    """Raw feeds read as CSV files (header, all columns text) from ``<input>/<feed>``."""
    def reader(feed):
        return lambda spark, folder: IO.read_raw_csv(spark, f"{folder}/{feed}", schemas.SILVER[feed])

    return {feed: reader(feed) for feed in FEEDS}


def main(argv: list[str] | None = None) -> None:
    """Job entry point: ``python -m kestrel.plans.medallion <input_dir> <output_dir> <run_id> [timestamp]``.

    The master, executors, shuffle partitions and ``spark.checkpoint.dir``
    come from spark-submit / the cluster; only unset scale options are added.
    """
    import json
    import sys
    from datetime import datetime, timezone

    from kestrel.session import get_session

    args = list(sys.argv[1:] if argv is None else argv)
    if len(args) < 3:
        raise SystemExit("usage: medallion <input_dir> <output_dir> <run_id> [timestamp]")
    in_dir, out_dir, run_id = args[:3]
    ts = args[3] if len(args) > 3 else datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")
    spark = get_session()
    out = run(spark, in_dir, out_dir, run_id, ts)
    scores = {r["table_name"]: r["quality_score"]
              for r in out["quality_log"].filter(f"run_id = '{run_id}'").select("table_name", "quality_score").collect()}
    print(json.dumps({"run_id": run_id, "output": out_dir, "quality_scores": scores}))


if __name__ == "__main__":
    main()
