"""H1-H3 decision-support tables and D10-D12 importance summaries.

The published tables carry no code; the formulas below are the ones that
reproduce the published rows (see SURVEY H1/H2). Tier cut-offs are
parameters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values: default tier cut-offs and labels -------------------------
STAFFING_TIERS = [
    (0.8, "Peak (surge staffing)"),
    (0.5, "High (reinforced patrol)"),
    (0.4, "Moderate (baseline+)"),
]
STAFFING_FLOOR = "Low (baseline)"
DISTRICT_TIERS = [
    (0.5, "Tier-1 (persistent hotspot)"),
    (0.3, "Tier-2 (elevated)"),
]
DISTRICT_FLOOR = "Tier-3 (monitor)"
STAFFING_WEIGHTS = (0.7, 0.3)


def avg_pct_rank(col: str) -> Column:
    """Average-tie percentile rank: (rank + (ties - 1) / 2) / n, ascending.
    (NOT percent_rank.) Used on month-sized tables only."""
    w_all = Window.partitionBy()
    w = Window.orderBy(F.col(col))
    ties = F.count(F.lit(1)).over(Window.partitionBy(F.col(col)))
    return (F.rank().over(w) + (ties - 1) / 2.0) / F.count(F.lit(1)).over(w_all)


def _tier(score: Column, tiers, floor: str) -> Column:
    out = F.lit(floor)
    for cut, label in reversed(tiers):
        out = F.when(score >= cut, F.lit(label)).otherwise(out)
    return out


# ------------------------------------------------------------------ H1 -----
def monthly_activity(test_xy: DataFrame, suffix: str) -> DataFrame:
    m = F.date_format(F.to_date(F.col("time_id")), "yyyy-MM")
    return test_xy.groupBy(m.alias("month")).agg(
        F.sum("y_count").cast("double").alias(f"incidents_{suffix}"),
        F.avg(F.col("y").cast("double")).alias(f"posrate_{suffix}"))


def staffing_priority(test7: DataFrame, test3: DataFrame, tiers=STAFFING_TIERS,
                      weights=STAFFING_WEIGHTS) -> DataFrame:
    """Per month: incidents and positive rate in both windows, averaged
    percentile ranks, weighted risk score and a staffing tier. The monthly
    table has at most a few dozen rows, so its global rank windows are tiny."""
    m = monthly_activity(test7, "7d").join(monthly_activity(test3, "3d"), "month", "inner")
    return staffing_scores(m, tiers, weights)


def staffing_scores(m: DataFrame, tiers=STAFFING_TIERS, weights=STAFFING_WEIGHTS) -> DataFrame:
    """Rank scores, risk score and tier from (month, incidents_7d,
    incidents_3d, posrate_7d, posrate_3d)."""
    m = (m.withColumn("__i7", avg_pct_rank("incidents_7d")).withColumn("__i3", avg_pct_rank("incidents_3d"))
         .withColumn("__p7", avg_pct_rank("posrate_7d")).withColumn("__p3", avg_pct_rank("posrate_3d")))
    m = (m.withColumn("incident_rank_score", (F.col("__i7") + F.col("__i3")) / 2)
         .withColumn("pos_rank_score", (F.col("__p7") + F.col("__p3")) / 2))
    m = m.withColumn("risk_score", F.lit(weights[0]) * F.col("incident_rank_score")
                     + F.lit(weights[1]) * F.col("pos_rank_score"))
    return m.select("month", "incidents_7d", "incidents_3d", "posrate_7d", "posrate_3d", "incident_rank_score",
                    "pos_rank_score", "risk_score",
                    _tier(F.col("risk_score"), tiers, STAFFING_FLOOR).alias("staffing_tier"))


# ------------------------------------------------------------------ H2 -----
def district_priority(test7: DataFrame, test3: DataFrame, sel7: DataFrame, sel3: DataFrame,
                      tiers=DISTRICT_TIERS) -> DataFrame:
    """Per region: mean workload and positive rate per window, the seed-mean
    Top-K selection rate of each window's best model, and a policy tier."""
    def act(t, sfx):
        return t.groupBy("region_id").agg(F.avg("y_count").alias(f"avg_y_count_{sfx}"),
                                          F.avg(F.col("y").cast("double")).alias(f"pos_rate_{sfx}"))

    def sel(s, sfx):
        return s.groupBy("region_id").agg(F.avg("topk_selection_rate").alias(f"topk_sel_rate_{sfx}"))

    out = (act(test7, "7d").join(sel(sel7, "7d"), "region_id", "left")
           .join(act(test3, "3d"), "region_id", "left").join(sel(sel3, "3d"), "region_id", "left"))
    return out.select("region_id", "avg_y_count_7d", "pos_rate_7d", "topk_sel_rate_7d", "avg_y_count_3d",
                      "pos_rate_3d", "topk_sel_rate_3d",
                      _tier(F.col("pos_rate_7d"), tiers, DISTRICT_FLOOR).alias("policy_tier"))


# ------------------------------------------------------------------ D11 ----
def normalize_importance(raw: DataFrame, keys=("window", "seed", "dataset", "model")) -> DataFrame:
    """Non-finite -> 0, clip at 0, divide by the slice sum (sum 0 -> unchanged)."""
    v = F.col("importance_raw").cast("double")
    clean = F.when(v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")), F.lit(0.0)).otherwise(F.greatest(v, F.lit(0.0)))
    w = Window.partitionBy(*keys)
    r = raw.withColumn("__c", clean).withColumn("__s", F.sum("__c").over(w))
    return r.withColumn("importance_norm", F.when(F.col("__s") > 0, F.col("__c") / F.col("__s"))
                        .otherwise(F.col("__c"))).drop("__c", "__s")


# ------------------------------------------------------------------ D12 ----
def summarize_importance(by_seed: DataFrame) -> DataFrame:
    """Mean / sample std (NULL -> 0) over seeds, seed count, and the rank
    inside (window, model) by mean desc with ties by feature name, then method."""
    g = by_seed.groupBy("window", "model", "feature", "method").agg(
        F.avg("importance_norm").alias("importance_norm_mean"),
        F.coalesce(F.stddev_samp("importance_norm"), F.lit(0.0)).alias("importance_norm_std"),
        F.avg("importance_raw").alias("importance_raw_mean"),
        F.coalesce(F.stddev_samp("importance_raw"), F.lit(0.0)).alias("importance_raw_std"),
        F.count_distinct("seed").alias("seed_n"))
    w = Window.partitionBy("window", "model").orderBy(F.col("importance_norm_mean").desc(), "feature", "method")
    return g.withColumn("rank_in_model", F.row_number().over(w))


# ------------------------------------------------------------------ H3 -----
def top_features(summary: DataFrame, n: int = 10) -> DataFrame:
    return summary.filter(F.col("rank_in_model") <= n)
