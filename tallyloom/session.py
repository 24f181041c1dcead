"""Session defaults.

Only settings that change results or plan quality are fixed here.  Memory and
executor counts belong to the caller, and shuffle partition counts are left to
AQE coalescing unless the caller passes a number (local runs do).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RUNTIME_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key is split even when a later operator then needs another shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(
    app_name: str = "tallyloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_runtime_defaults(spark: SparkSession) -> SparkSession:
    """Set the result-relevant settings on a session somebody else created."""
    for key, value in RUNTIME_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder: the one that spark.checkpoint.dir names.

    Where it is unset, one below the warehouse in local mode; on a cluster that
    may be a folder of the driver's machine, so there it has to be set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        configured = f"{warehouse}/tallyloom-checkpoints"
    sc.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise to the shared checkpoint folder so lost executors replay nothing."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
