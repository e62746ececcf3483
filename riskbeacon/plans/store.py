"""Materialized intermediates in the cluster's shared checkpoint folder.

Panel-sized intermediates (window counts, features, predictions) are
written once as Parquet under ``spark.checkpoint.dir`` and read back. This
cuts the lineage (downstream plans start at a small scan instead of a deep
window/join plan), survives lost executors (the files are on shared
storage, unlike cached blocks) and keeps Parquet statistics for the
optimizer. Nothing is written to a machine-local folder on a cluster: the
folder is the one the session names (tests set their own only when unset).
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from riskbeacon.session import ensure_checkpoint_dir


def table_root(spark: SparkSession) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), "riskbeacon-tables")


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    path = os.path.join(table_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
