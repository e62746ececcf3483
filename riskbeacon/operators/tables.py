"""Report tables built from events, Xy frames and metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskbeacon.config import CRIME_GROUPS
from riskbeacon.functions.expr import side_by_side


def _group_axis(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, g) for i, g in enumerate(CRIME_GROUPS)], "ord int, crime_group string")


# ------------------------------------------------------------------ E30 ----
def distribution_table(spark: SparkSession, events: dict[str, DataFrame], xys: dict[str, DataFrame]) -> DataFrame:
    """Per crime group and dataset: incident count, share, positive rate.
    The Xy frames carry no crime group, so the positive rate is the overall
    rate of the dataset's labels (as in the original)."""
    axis = _group_axis(spark)
    parts = []
    for name, ev in events.items():
        cnt = ev.groupBy("crime_group").agg(F.count(F.lit(1)).alias("n"))
        tot = cnt.agg(F.sum("n").alias("__t"))
        pos = xys[name].agg(F.avg(F.col("y").cast("double")).alias("positive_rate"))
        j = side_by_side(F.broadcast(axis).join(cnt, "crime_group", "left"), tot, pos)
        parts.append(j.select(F.lit(name).alias("dataset"), "ord", "crime_group",
                              F.coalesce("n", F.lit(0)).cast("long").alias("incidents_n"),
                              (F.coalesce("n", F.lit(0)) / F.greatest(F.col("__t"), F.lit(1))).alias("incidents_pct"),
                              F.coalesce("positive_rate", F.lit(0.0)).alias("positive_rate")))
    return reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------------------ E31 ----
def results_numeric(mlong: DataFrame) -> DataFrame:
    o = mlong.filter(F.col("slice") == "overall")
    return o.groupBy("model", "domain", "metric").agg(
        F.avg("value").alias("mean"), F.coalesce(F.stddev_samp("value"), F.lit(0.0)).alias("std"))


def results_formatted(mlong: DataFrame) -> DataFrame:
    """model x (domain_metric) cells formatted 'mean ± std' with 3 decimals."""
    n = results_numeric(mlong)
    cell = F.format_string("%.3f ± %.3f", F.col("mean"), F.coalesce(F.col("std"), F.lit(0.0)))
    return n.select("model", F.concat_ws("_", "domain", "metric").alias("column"), cell.alias("cell"))


RESULT_DOMAINS = ("in_domain", "out_domain")
RESULT_METRICS = ("auc", "f1", "recall", "precision")


def results_wide(mlong: DataFrame, domains=RESULT_DOMAINS, metrics=RESULT_METRICS) -> DataFrame:
    """One row per model, a 'mean ± std' cell for each domain and metric; a
    cell without rows is NA."""
    columns = [f"{d}_{m}" for d in domains for m in metrics]
    wide = results_formatted(mlong).groupBy("model").pivot("column", columns).agg(F.first("cell"))
    return wide.fillna("NA", subset=columns)


# ------------------------------------------------------------------ E32 ----
def processed_group_counts(spark: SparkSession, events: dict[str, DataFrame]) -> DataFrame:
    axis = _group_axis(spark)
    parts = []
    for name, ev in events.items():
        cnt = ev.groupBy("crime_group").agg(F.count(F.lit(1)).alias("n"))
        parts.append(F.broadcast(axis).join(cnt, "crime_group", "left").select(
            F.lit(name).alias("dataset"), "ord", "crime_group", F.coalesce("n", F.lit(0)).cast("long").alias("count")))
    return reduce(DataFrame.unionByName, parts)


# ------------------------------------------------------------------ E33 ----
def model_bucket_matrix(bucket_metrics: DataFrame, metric: str, buckets=("Q1", "Q2", "Q3", "Q4")) -> DataFrame:
    return bucket_metrics.groupBy("model").pivot("region_bucket", list(buckets)).agg(F.avg(metric))


# ------------------------------------------------------------------ E34 ----
def mean_std(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Seed mean and sample std (NULL -> 0) of a metric series for figures."""
    return df.groupBy(*keys).agg(F.avg(value).alias("mean"),
                                 F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("std"))


# ------------------------------------------------------------------ E35 ----
def window_report(thresholds: DataFrame, overall: DataFrame, gaps: DataFrame) -> DataFrame:
    """Combined two-window report in one tidy table: (section, time_window,
    model, domain, metric, value)."""
    t = thresholds.select(F.lit("threshold").alias("section"), F.col("time_window_days").alias("time_window"),
                          F.lit("").alias("model"), F.lit("").alias("domain"), F.lit("threshold").alias("metric"),
                          F.col("threshold").cast("double").alias("value"))
    o = overall.select(F.lit("overall").alias("section"), F.col("time_window_days").alias("time_window"), "model",
                       "domain", "metric", F.col("mean").alias("value"))
    g = gaps.select(F.lit("gap").alias("section"), F.col("time_window_days").alias("time_window"), "model",
                    F.lit("in-out").alias("domain"), "metric", F.col("mean").alias("value"))
    return t.unionByName(o).unionByName(g)
