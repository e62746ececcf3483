"""Time split, threshold, labels, region train statistics, Xy contract."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskbeacon.config import FEATURE_NUMERIC, THRESHOLD_QUANTILE

STAT_COLS = ["region_train_mean", "region_train_std", "region_train_count"]



def window_of(ts, window_days: int, anchor: str = "2015-01-01") -> dt.date | None:
    """Window start of one timestamp (driver-side twin of ``time_bin``)."""
    if int(window_days) not in (3, 7):
        raise ValueError("window must be 7 or 3 days")
    if ts is None:
        return None
    d = ts.date() if isinstance(ts, dt.datetime) else ts
    if int(window_days) == 7:
        return d - dt.timedelta(days=d.weekday())
    a = dt.date.fromisoformat(anchor)
    return a + dt.timedelta(days=((d - a).days // 3) * 3)


def split_train_test(supervised: DataFrame, test_start: dt.date, test_end: dt.date) -> tuple[DataFrame, DataFrame]:
    """Train: window and its target window before the test start. Test:
    windows from the start whose target window ends by the last test window.
    The window straddling the boundary is in neither."""
    s, e = F.lit(test_start), F.lit(test_end)
    train = supervised.filter((F.col("time_id") < s) & (F.col("next_time") < s))
    test = supervised.filter((F.col("time_id") >= s) & (F.col("next_time") <= e))
    return train, test


# ------------------------------------------------------------------ C18 ----
def threshold_frame(train: DataFrame, quantile: float = THRESHOLD_QUANTILE, group_col: str | None = None) -> DataFrame:
    """max(1, ceil(exact linear-interpolated quantile of y_count))."""
    q = F.percentile(F.col("y_count"), F.lit(quantile))
    thr = F.greatest(F.lit(1), F.ceil(q)).cast("int").alias("threshold")
    if group_col:
        return train.groupBy(group_col).agg(thr)
    return train.agg(thr)


def compute_threshold(train: DataFrame, quantile: float = THRESHOLD_QUANTILE) -> int:
    v = threshold_frame(train, quantile).first()["threshold"]
    return int(v) if v is not None else 1


# ------------------------------------------------------------------ C20 ----
def add_label(df: DataFrame, threshold: int) -> DataFrame:
    return df.withColumn("y", (F.col("y_count") >= F.lit(int(threshold))).cast("int"))


def add_label_by_group(df: DataFrame, thresholds: DataFrame, group_col: str = "crime_group",
                       default_threshold: int | None = None) -> DataFrame:
    """Labels by each group's own threshold. Rows of an unseen or null group
    take the default: the largest threshold, at least 1. The thresholds are
    joined without a hint (the group column is free), the default is one row."""
    t = thresholds.select(F.col(group_col).cast("string").alias("__g"), F.col("threshold").alias("__thr"))
    default = (F.lit(int(default_threshold)) if default_threshold is not None
               else F.greatest(F.lit(1), F.max("__thr")))
    rest = t.agg(default.cast("int").alias("__rest")).withColumn("__one", F.lit(1))
    out = (df.withColumn("__g", F.col(group_col).cast("string")).join(t, "__g", "left")
           .withColumn("__one", F.lit(1)).join(F.broadcast(rest), "__one"))
    hit = F.col("y_count") >= F.coalesce("__thr", "__rest")
    return out.withColumn("y", F.coalesce(hit, F.lit(False)).cast("int")).drop("__g", "__thr", "__rest", "__one")


# ------------------------------------------------------------------ C21 ----
def region_train_stats(train: DataFrame) -> DataFrame:
    return train.groupBy("region_id").agg(
        F.avg("lag_0").alias("region_train_mean"),
        F.coalesce(F.stddev_samp("lag_0"), F.lit(0.0)).alias("region_train_std"),
        F.count("lag_0").cast("double").alias("region_train_count"),
    )


# ------------------------------------------------------------------ C22 ----
def region_stat_defaults(stats: DataFrame) -> DataFrame:
    """One row: the unweighted mean over regions of every statistic."""
    return stats.agg(*[F.avg(c).alias(f"__d_{c}") for c in STAT_COLS])


def apply_region_stats(df: DataFrame, stats: DataFrame, defaults: DataFrame | None = None) -> DataFrame:
    """Left join the per-region train stats; unseen regions get the unweighted
    mean over regions of each statistic and a 0 seen-flag.

    The stats table has one row per region (bounded by the region count, not
    by events); AQE broadcasts it when its measured size is small. The
    defaults are a one-row frame joined on a constant key.
    """
    d = (defaults if defaults is not None else region_stat_defaults(stats)).withColumn("__one", F.lit(1))
    s = stats.select("region_id", *STAT_COLS, F.lit(1).alias("__seen"))
    j = (df.join(s, "region_id", "left").withColumn("__one", F.lit(1))
         .join(F.broadcast(d), "__one", "inner"))
    return j.select(*[F.col(c) for c in df.columns],
                    *[F.coalesce(F.col(c), F.col(f"__d_{c}"), F.lit(0.0)).alias(c) for c in STAT_COLS],
                    F.coalesce(F.col("__seen"), F.lit(0)).cast("double").alias("region_seen_in_train"))


# ------------------------------------------------------------------ C23 ----
def enforce_xy(df: DataFrame, features=FEATURE_NUMERIC, name: str = "xy") -> DataFrame:
    """Ordered, typed Xy contract; raises when a column is missing."""
    cols = ["region_id", "time_id"] + list(features) + ["y", "y_count"]
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{name}: missing columns {missing}")
    return df.select(
        F.col("region_id").cast("string").alias("region_id"),
        F.date_format(F.col("time_id"), "yyyy-MM-dd").alias("time_id"),
        *[F.col(c).cast("double").alias(c) for c in features],
        F.col("y").cast("int").alias("y"),
        F.col("y_count").cast("double").alias("y_count"),
    )


# ------------------------------------------------------------------ C24 ----
def schema_consistency(spark, frames: dict[str, DataFrame]) -> DataFrame:
    """(dataset, position, column, type, matches_base) for every frame against
    the first one - computed from schemas only, no data is read."""
    names = list(frames)
    base = frames[names[0]].schema
    rows = []
    for name in names:
        sch = frames[name].schema
        for i, f in enumerate(sch.fields):
            ok = i < len(base.fields) and base.fields[i].name == f.name and base.fields[i].dataType == f.dataType
            rows.append((name, i, f.name, f.dataType.simpleString(), bool(ok and len(sch) == len(base))))
    return spark.createDataFrame(rows, "dataset string, position int, column string, type string, matches_base boolean")
