"""Top-K ranking quality over the prediction table.

Ranking is ``row_number`` over ``W(slice, time_id).orderBy(score desc,
region_id)`` - deterministic ties, one sort per (slice, window) partition.
Every window partition holds one row per region, so partitions are bounded
by the region count however the events were distributed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskbeacon.config import DATASET_IN, DOMAIN_ORDER, TOPK_CANDIDATES


def _rank(df: DataFrame, keys: list[str], score: str) -> DataFrame:
    w = Window.partitionBy(*keys, "time_id").orderBy(F.col(score).desc_nulls_last(), F.col("region_id"))
    return df.withColumn("rank", F.row_number().over(w))


# ------------------------------------------------------------------ E18 ----
def topk_hit_rate(pred: DataFrame, k_values=(1, 3, 5)) -> DataFrame:
    """Per (dataset, model): collapse seeds to max score / max label per
    (time, region); per window the mean label of the top min(K, R) regions;
    averaged over windows. Slices with a single region are skipped."""
    agg = pred.groupBy("dataset", "model", "time_id", "region_id").agg(
        F.max("y_score").alias("score"), F.max(F.col("y").cast("int")).alias("y_true"))
    n_reg = agg.groupBy("dataset", "model").agg(F.count_distinct("region_id").alias("n_regions"))
    ranked = _rank(agg, ["dataset", "model"], "score").join(n_reg, ["dataset", "model"])
    ks = F.explode(F.array(*[F.lit(int(k)) for k in k_values])).alias("k_req")
    per_k = ranked.filter(F.col("n_regions") > 1).select("*", ks).withColumn(
        "k", F.least(F.col("k_req"), F.col("n_regions")))
    weekly = (per_k.filter(F.col("rank") <= F.col("k"))
              .groupBy("dataset", "model", "k_req", "k", "time_id").agg(F.avg("y_true").alias("hit")))
    return weekly.groupBy("dataset", "model", "k_req", "k").agg(
        F.count(F.lit(1)).alias("weekly_count"), F.avg("hit").alias("topk_hit_rate")).drop("k_req")


# ------------------------------------------------------------------ E19 ----
def topk_coverage_by_seed(pred: DataFrame, k_candidates=TOPK_CANDIDATES, domains=DOMAIN_ORDER) -> DataFrame:
    """Share of next-window incidents that fall in the top-K regions.

    K runs over the candidates not above the domain's region count (or just
    the region count when none fits). Windows with zero incidents give NULL
    and are skipped by the mean, as in the original.
    """
    sub = pred.filter(F.col("dataset").isin(*domains))
    agg = sub.groupBy("dataset", "seed", "model", "time_id", "region_id").agg(
        F.max("y_score").alias("risk_score"), F.sum("y_count").alias("true_incidents"))
    n_reg = agg.groupBy("dataset").agg(F.count_distinct("region_id").alias("n_regions"))
    cand = F.filter(F.array(*[F.lit(int(k)) for k in k_candidates]), lambda k: k <= F.col("n_regions"))
    klist = F.when(F.size(cand) > 0, cand).otherwise(F.array(F.greatest(F.lit(1), F.col("n_regions"))))
    ranked = _rank(agg, ["dataset", "seed", "model"], "risk_score")
    # Per window: cumulative incidents at each K without re-ranking per K.
    per_win = ranked.join(F.broadcast(n_reg.select("dataset", klist.alias("ks"))), "dataset")
    per_k = per_win.select("*", F.explode("ks").alias("k"))
    cov = per_k.groupBy("dataset", "seed", "model", "time_id", "k").agg(
        F.sum(F.when(F.col("rank") <= F.col("k"), F.col("true_incidents")).otherwise(0.0)).alias("top"),
        F.sum("true_incidents").alias("total"))
    cov = cov.withColumn("coverage", F.when(F.col("total") > 0, F.col("top") / F.col("total")))
    return cov.groupBy(F.col("dataset").alias("domain"), "seed", "model", "k").agg(
        F.avg("coverage").alias("coverage"))


# ------------------------------------------------------------------ E20 ----
def topk_coverage_seed_mean(by_seed: DataFrame) -> DataFrame:
    return by_seed.groupBy(F.col("domain").alias("dataset"), "model", "k").agg(
        F.avg("coverage").alias("topk_hit_rate"))


# ------------------------------------------------------------------ E21 ----
def topk_selection_frequency(pred: DataFrame, k: int = 5, dataset: str = DATASET_IN) -> DataFrame:
    """Share of windows in which each region is in the top-K, per (seed, model)."""
    sub = pred.filter(F.col("dataset") == dataset)
    n_win = sub.groupBy("seed", "model", "time_id").agg(F.count_distinct("region_id").alias("__n"))
    ranked = (_rank(sub, ["seed", "model"], "y_score").join(n_win, ["seed", "model", "time_id"])
              .withColumn("__kk", F.greatest(F.lit(1), F.least(F.lit(int(k)), F.col("__n")))))
    windows = sub.groupBy("seed", "model").agg(F.count_distinct("time_id").alias("__windows"))
    per_region = ranked.groupBy("seed", "model", "region_id").agg(
        F.sum((F.col("rank") <= F.col("__kk")).cast("int")).alias("__sel"))
    return (per_region.join(windows, ["seed", "model"])
            .select("seed", "model", "region_id",
                    (F.col("__sel") / F.greatest(F.col("__windows"), F.lit(1))).alias("topk_selection_rate")))
