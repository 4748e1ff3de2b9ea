"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every oddsframe job expects. Time zone is pinned so that timestamp
# literals and date parts mean the same thing on every executor; AQE re-plans
# joins from runtime sizes (broadcast only when the measured side is small,
# skew splitting for hot keys, partition coalescing).
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "oddsframe",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable defaults to a session someone else built."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only when a local session names none (tests) is ``fallback`` (or a fresh
    folder under the system temp dir) used and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if fallback is None and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        if fallback is None:
            import tempfile
            fallback = tempfile.mkdtemp(prefix="oddsframe-ckpt-")
        named = fallback
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir() or named


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as a table into a folder of this application under the shared checkpoint folder, and read back: a
    lost executor costs a re-read, and the plan so far is cut. (``checkpoint()`` computes its rows twice.)"""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/oddsframe-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def env_int(name: str, default: int) -> int:
    try:
        return int(os.environ.get(name, default))
    except ValueError:
        return default
