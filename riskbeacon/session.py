"""Spark session with the settings every job here relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_BASE_CONF = {
    # Incident timestamps are naive; pin the session zone so dates never shift.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffles, split skewed join partitions,
    # turn sort-merge joins into broadcast joins when the real size is small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # size partitions by bytes (advisory 64 MB), not by core count: small
    # stages collapse to a few tasks, large ones keep their parallelism
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "riskbeacon",
                shuffle_partitions: int | None = None,
                extra_conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    conf = dict(_BASE_CONF)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is the only executor
            conf.setdefault("spark.driver.memory", os.environ.get("RISKBEACON_DRIVER_MEMORY", "8g"))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.ui") and not k.startswith("spark.driver"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf of an already running session
                pass
    ensure_checkpoint_dir(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Apply the session-level SQL settings to a session created elsewhere."""
    for k, v in _BASE_CONF.items():
        if k.startswith("spark.sql."):
            try:
                spark.conf.set(k, v)
            except Exception:
                pass


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is. Only when it is unset (local tests) a scratch folder is created.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir: executors of their own can't share a scratch folder")
        configured = tempfile.mkdtemp(prefix="riskbeacon-ckpt-", dir=os.environ.get("TMPDIR") or "/tmp")
    spark.sparkContext.setCheckpointDir(configured)
    return configured
