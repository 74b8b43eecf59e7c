"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale; every one of them is a plain Spark option.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE coalesces small shuffle partitions toward 128 MB each.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    # Broadcast only sides that the planner *measured* below 32 MB.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

_LOCAL_SCRATCH: dict[int, str] = {}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "kestrel", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the scale settings above.

    On a cluster ``master`` stays ``None`` so the launcher decides.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and materialised intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; only when that is unset
    on a local master (tests) do we pick a private scratch folder of our own.
    Executors of a real cluster would not see such a folder, so there it is an error.
    """
    configured = (spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
                  or spark.conf.get("spark.checkpoint.dir", None))
    if configured:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    key = id(spark.sparkContext)
    if key not in _LOCAL_SCRATCH:
        local = tempfile.mkdtemp(prefix="kestrel-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.sparkContext.setCheckpointDir(local)
        _LOCAL_SCRATCH[key] = local
    return _LOCAL_SCRATCH[key]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediates."""
    return f"{checkpoint_dir(spark)}/{name}"
