"""Prediction tables published as runs.

Layout of a store (a folder all executors share):

* ``predictions/run=/time_window_days=/dataset=/model=/seed=``: the rows of
  all runs, appended;
* ``commits``: one row for each partition of a run with its number of rows,
  appended in one job after the run's rows are complete.

A run without commit rows is unfinished and never read. Look-ups join the
table with the one-row frame of the newest valid run on the partition column
``run``, so that Spark prunes the other runs' folders when the query runs,
and filter the other partition columns statically.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskbeacon.operators.serving import check_columns, serving_frame
from riskbeacon.sources.readers import newest_valid_run

KEYS = ["time_window_days", "dataset", "model", "seed"]
COMMITS = ("run string, time_window_days int, dataset string, model string, seed int, n_rows long, "
           "committed_at timestamp")
ROWS = "region_id string, time_id string, y int, y_count double, y_score double, y_pred int"
PARTITIONS = "run string, time_window_days int, dataset string, model string, seed int"


def write_rows(pred: DataFrame, store: str, run: str) -> None:
    """Append a run's rows without committing it. Rows are gathered by
    partition before the write; a large one is split by size."""
    check_columns(pred)
    rows = pred.select(F.lit(run).alias("run"), *[F.col(k) for k in KEYS],
                       F.col("region_id").cast("string").alias("region_id"), F.col("time_id").cast("string").alias("time_id"),
                       *[F.col(c).cast(t).alias(c) for c, t in (("y", "int"), ("y_count", "double"),
                                                               ("y_score", "double"), ("y_pred", "int"))])
    (rows.hint("rebalance", *KEYS).write.mode("append").partitionBy("run", *KEYS)
     .parquet(f"{store}/predictions"))


def commit(spark: SparkSession, store: str, run: str, committed_at: dt.datetime | None = None) -> None:
    """Declare the run's written rows complete."""
    at = F.lit(committed_at).cast("timestamp") if committed_at else F.current_timestamp()
    counts = (table(spark, store).filter(F.col("run") == run).groupBy("run", *KEYS)
              .agg(F.count(F.lit(1)).alias("n_rows")).withColumn("committed_at", at))
    counts.coalesce(1).write.mode("append").parquet(f"{store}/commits")  # one row a partition of one run


def publish(pred: DataFrame, store: str, run: str | None = None, committed_at: dt.datetime | None = None) -> str:
    run = run or f"run-{uuid.uuid4().hex[:12]}"
    write_rows(pred, store, run)
    commit(pred.sparkSession, store, run, committed_at)
    return run


def table(spark: SparkSession, store: str) -> DataFrame:
    """Rows of all runs, finished or not."""
    return spark.read.schema(f"{ROWS}, {PARTITIONS}").parquet(f"{store}/predictions")


def commits(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.schema(COMMITS).parquet(f"{store}/commits")


def newest(spark: SparkSession, store: str, windows=(7, 3)) -> DataFrame:
    """One row (run): the newest committed run with rows for every window."""
    done = commits(spark, store).filter(F.col("n_rows") > 0)
    return newest_valid_run(done.select(F.col("run").alias("run_id"), "time_window_days",
                                        F.col("committed_at").alias("modified_ts")), windows).select(
        F.col("run_id").alias("run")).filter("run IS NOT NULL")


def partitions(spark: SparkSession, store: str, windows=(7, 3)) -> DataFrame:
    """Commit rows of the newest valid run: its choices and their sizes, without reading predictions."""
    return commits(spark, store).join(F.broadcast(newest(spark, store, windows)), "run")  # a single row


def serving(spark: SparkSession, store: str, seed: int = 0, windows=(7, 3)) -> DataFrame:
    """A8 over the newest valid run. An error if there is none, or if a window has no rows of the seed."""
    have = {r.time_window_days for r in partitions(spark, store, windows).filter(F.col("seed") == int(seed))
            .select("time_window_days").distinct().collect()}
    if not have and newest(spark, store, windows).isEmpty():
        raise ValueError(f"no valid run in {store}: windows {tuple(windows)} must be committed")
    for w in windows:
        if w not in have:
            raise ValueError(f"no rows of seed {seed} for the {w}-day window in {store}")
    rows = table(spark, store).join(F.broadcast(newest(spark, store, windows)), "run")
    return serving_frame(rows.drop("run"), seed)
