"""F1-F6 (+A8/A9): prediction-serving queries.

The serving table is the prediction table of both windows for one seed, read
from the store of published runs (``runs``): every look-up below is a scan of
the partitions that its window, dataset, model and seed name, followed by tiny
filters; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# fixed values: column names of a prediction file
REQUIRED_COLS = ["region_id", "time_id", "y", "y_count", "model", "dataset", "y_score", "y_pred", "seed"]


# ------------------------------------------------------------------ A8 -----
def check_columns(pred: DataFrame) -> None:
    missing = [c for c in REQUIRED_COLS if c not in pred.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def serving_frame(pred_both: DataFrame, seed: int = 0) -> DataFrame:
    """Required columns (error lists the missing ones), one seed, normalized
    time_id, numeric coercion, rows with a NULL key/value dropped."""
    check_columns(pred_both)
    num = {c: F.col(c).cast("string").try_cast("double") for c in ["y", "y_count", "y_score", "y_pred"]}
    out = pred_both.filter(F.col("seed").cast("int") == int(seed)).select(
        F.col("time_window_days").cast("int").alias("time_window_days"),
        F.col("region_id").cast("string").alias("region_id"),
        F.date_format(F.to_date(F.try_to_timestamp(F.col("time_id").cast("string"))), "yyyy-MM-dd").alias("time_id"),
        num["y"].alias("y"), num["y_count"].alias("y_count"), F.col("model").cast("string").alias("model"),
        F.col("dataset").cast("string").alias("dataset"), num["y_score"].alias("y_score"),
        num["y_pred"].alias("y_pred"), F.col("seed").cast("int").alias("seed"))
    out = out.dropna(subset=["region_id", "time_id", "y_score", "y_pred", "y_count", "y"])
    return out.withColumn("y", F.col("y").cast("int")).withColumn("y_pred", F.col("y_pred").cast("int"))


def require_found(found: DataFrame, message: str) -> DataFrame:
    """``found``, or an error if it has no row (one bounded look-up)."""
    if found.isEmpty():
        raise ValueError(message)
    return found


# ------------------------------------------------------------------ F1 -----
def available(serving: DataFrame, window_days: int, dataset: str | None = None, model: str | None = None) -> DataFrame:
    """Cascading choices: datasets of a window, models of a dataset, regions
    and times of a (dataset, model) - as (level, value) rows."""
    s = serving.filter(F.col("time_window_days") == int(window_days))
    out = s.select(F.lit("dataset").alias("level"), F.col("dataset").alias("value")).distinct()
    if dataset is not None:
        sd = s.filter(F.col("dataset") == dataset)
        out = out.unionByName(sd.select(F.lit("model").alias("level"), F.col("model").alias("value")).distinct())
        if model is not None:
            sm = sd.filter(F.col("model") == model)
            out = out.unionByName(sm.select(F.lit("region").alias("level"), F.col("region_id").alias("value")).distinct())
            out = out.unionByName(sm.select(F.lit("time").alias("level"), F.col("time_id").alias("value")).distinct())
    return out


# ------------------------------------------------------------------ F2 -----
def single_prediction(serving: DataFrame, window_days: int, dataset: str, model: str, region_id: str,
                      time_id: str) -> DataFrame:
    """Point lookup; an error if no prediction matches."""
    hit = serving.filter((F.col("time_window_days") == int(window_days)) & (F.col("dataset") == dataset)
                          & (F.col("model") == model) & (F.col("region_id") == region_id)
                          & (F.col("time_id") == time_id)).limit(1)
    return require_found(hit, f"no prediction for {window_days}d, {dataset}, {model}, {region_id}, {time_id}")


# ------------------------------------------------------------------ F3 -----
def area_trend(serving: DataFrame, window_days: int, dataset: str, model: str, region_id: str) -> DataFrame:
    return (serving.filter((F.col("time_window_days") == int(window_days)) & (F.col("dataset") == dataset)
                           & (F.col("model") == model) & (F.col("region_id") == region_id))
            .select("time_id", "y_score", "y_pred", "y_count", "y").orderBy("time_id"))


# ------------------------------------------------------------------ F4 -----
def topk_for_time(serving: DataFrame, window_days: int, dataset: str, model: str, time_id: str,
                  k: int) -> tuple[DataFrame, DataFrame]:
    """(table, stats): rank by (score desc, region asc); K clipped to [1, n];
    coverage@K = top incidents / all incidents (0 when none); hit rate =
    share of positives in the top K. An error if the window has no rows."""
    s = serving.filter((F.col("time_window_days") == int(window_days)) & (F.col("dataset") == dataset)
                       & (F.col("model") == model) & (F.col("time_id") == time_id))
    require_found(s, f"no rows for {window_days}d, {dataset}, {model} at {time_id}")
    part = Window.partitionBy("time_window_days", "dataset", "model", "time_id")
    ranked = (s.withColumn("rank", F.row_number().over(part.orderBy(F.col("y_score").desc(), F.col("region_id"))))
              .withColumn("n", F.count(F.lit(1)).over(part))
              .withColumn("total", F.sum("y_count").over(part)))
    kk = F.greatest(F.lit(1), F.least(F.lit(int(k)), F.col("n")))
    top = ranked.withColumn("k_eff", kk).filter(F.col("rank") <= F.col("k_eff"))
    table = top.select("rank", "region_id", "y_score", "y_pred", "y_count", "y")
    st = top.groupBy("k_eff", "n", "total").agg(F.sum("y_count").alias("topk_incidents"),
                                                 F.avg((F.col("y") == 1).cast("double")).alias("topk_hit_rate"))
    st = st.select(F.col("k_eff").cast("double").alias("k"), F.col("n").cast("double").alias("n_regions"),
                   F.when(F.col("total") > 0, F.col("topk_incidents") / F.col("total")).otherwise(F.lit(0.0))
                   .alias("coverage_at_k"),
                   F.coalesce("topk_hit_rate", F.lit(0.0)).alias("topk_hit_rate"),
                   F.col("total").cast("double").alias("total_incidents"),
                   F.col("topk_incidents").cast("double").alias("topk_incidents"))
    return table, st


# ------------------------------------------------------------------ F5 -----
def selected_rank(topk_table: DataFrame, region_id: str) -> DataFrame:
    """The selected region's rank in the Top-K, or NULL rank = outside."""
    hit = topk_table.filter(F.col("region_id") == region_id).agg(F.min("rank").alias("rank"))
    return hit.select(F.lit(region_id).alias("region_id"), "rank",
                      F.col("rank").isNotNull().alias("in_topk"))


# ------------------------------------------------------------------ F6 -----
def friendly_labels(df: DataFrame, window_days: int, in_domain_tag: str = "in_domain",
                    city: str = "Chicago") -> DataFrame:
    """Display columns: an area label parsed from region_id and a window
    label 'start to start+w-1 [start]'."""
    rid = F.col("region_id")
    dist = F.regexp_replace(F.element_at(F.split(rid, "CPD_DIST_"), -1), "^0+", "")
    dist = F.when(dist == "", F.lit("0")).otherwise(dist)
    parts = F.split(rid, "__", 2)
    area = (F.when((F.col("dataset") == in_domain_tag) & rid.contains("CPD_DIST_"),
                   F.concat(F.lit(f"{city} District "), dist, F.lit(" ["), rid, F.lit("]")))
            .when(rid.contains("__"), F.concat(parts[0], F.lit(" Agency "), parts[1], F.lit(" ["), rid, F.lit("]")))
            .otherwise(rid))
    t = F.to_date(F.col("time_id"))
    label = F.when(t.isNull(), F.col("time_id")).otherwise(
        F.concat(F.date_format(t, "yyyy-MM-dd"), F.lit(" to "),
                 F.date_format(F.date_add(t, int(window_days) - 1), "yyyy-MM-dd"),
                 F.lit(" ["), F.date_format(t, "yyyy-MM-dd"), F.lit("]")))
    return df.withColumn("area_label", area).withColumn("window_label", label)
