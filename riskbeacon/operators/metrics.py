"""Classification metrics over the long prediction table.

All metrics are computed for every slice at once. There is one path for the
AUC (``_slice_metrics``): counts by (slice, range of scores, score), summed
inside ranges and over ranges.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskbeacon.functions.expr import side_by_side
from riskbeacon.functions.order import ranked, value_range
from riskbeacon.config import DATASET_IN, DATASET_OUT, MODEL_ORDER, N_REGION_BUCKETS

Keep = Callable[[DataFrame, str], DataFrame]  # writes a table and reads it back
METRICS4 = ["auc", "f1", "recall", "precision"]


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den > 0, num.cast("double") / den).otherwise(F.lit(0.0))


# ------------------------------------------------------------- E1 ---------
def confusion_metrics(df: DataFrame, keys: list[str], y: str = "y", pred: str = "y_pred") -> DataFrame:
    """n_rows, positive_rate, precision, recall, f1 per slice (zero_division=0)."""
    yt, yp = F.col(y).cast("int"), F.col(pred).cast("int")
    agg = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(yt.cast("double")).alias("positive_rate"),
        F.sum(F.when((yt == 1) & (yp == 1), 1).otherwise(0)).alias("__tp"),
        F.sum(F.when((yt == 0) & (yp == 1), 1).otherwise(0)).alias("__fp"),
        F.sum(F.when((yt == 1) & (yp == 0), 1).otherwise(0)).alias("__fn"),
    )
    tp, fp, fn = F.col("__tp"), F.col("__fp"), F.col("__fn")
    return (agg.withColumn("precision", _ratio(tp, tp + fp))
            .withColumn("recall", _ratio(tp, tp + fn))
            .withColumn("f1", _ratio(2 * tp, 2 * tp + fp + fn))
            .drop("__tp", "__fp", "__fn"))


# ------------------------------------------------------------- E2 ---------
_COUNTS = ["pos", "neg", "tp", "fp", "fn"]


def outcome(y: str = "y", pred: str = "y_pred", score: str = "y_score") -> Column:
    """What one prediction adds to the counts of its slice."""
    yt, yp = F.col(y).cast("int") == 1, F.col(pred).cast("int") == 1
    yt, yp = F.coalesce(yt, F.lit(False)), F.coalesce(yp, F.lit(False))

    def one(c: Column, name: str) -> Column:
        return c.cast("long").alias(name)
    return F.struct(F.col(score).cast("double").alias("score"), one(yt, "pos"), one(~yt, "neg"), one(yt & yp, "tp"),
                    one(~yt & yp, "fp"), one(yt & ~yp, "fn"))


def _slice_metrics(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Metrics per slice of rows (keys, score, counts).

    The AUC is the Mann-Whitney statistic: sum over scores s of
    pos_s * (neg_below_s + neg_s / 2) / (P * N), exact with ties. Scores are
    dealt to fixed ranges of their leading bits (``value_range``). Inside a
    range the negatives below a score are a running sum over its distinct
    scores; what lies in lower ranges is added for the range as a whole:

        sum over ranges of (pos_r * neg_before_r + statistic inside r)

    So rows are counted by (slice, range, score), ordered by (slice, range),
    and only one row a range meets in the task of a slice. No cut points are
    looked for and nothing is joined back.
    """
    at = value_range(F.col("score"))
    hist = rows.withColumn("__r", at).groupBy(*keys, "__r", "score").agg(*[F.sum(c).alias(c) for c in _COUNTS])
    below = F.sum("neg").over(Window.partitionBy(*keys, "__r").orderBy("score").rowsBetween(Window.unboundedPreceding, -1))
    inside = F.col("pos") * (F.coalesce(below, F.lit(0)) + F.col("neg") / 2)
    scored = F.col("__r").isNotNull()
    ranges = hist.withColumn("__u", inside).groupBy(*keys, "__r").agg(
        *[F.sum(c).alias(c) for c in _COUNTS], F.sum(F.when(scored, F.col("__u"))).alias("__u"))
    before = F.sum(F.when(scored, F.col("neg"))).over(
        Window.partitionBy(*keys).orderBy("__r").rowsBetween(Window.unboundedPreceding, -1))
    out = ranges.withColumn("__b", F.coalesce(before, F.lit(0))).groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in _COUNTS],
        F.sum(F.when(scored, F.col("__u") + F.col("pos") * F.col("__b").cast("double"))).alias("__u"),
        F.sum(F.when(scored, F.col("pos"))).cast("double").alias("__p"),
        F.sum(F.when(scored, F.col("neg"))).cast("double").alias("__n"))
    tp, fp, fn, n = F.col("tp"), F.col("fp"), F.col("fn"), F.col("pos") + F.col("neg")
    return out.select(
        *keys, n.alias("n_rows"), (F.col("pos") / n).alias("positive_rate"),
        _ratio(tp, tp + fp).alias("precision"), _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        F.when((F.col("__p") > 0) & (F.col("__n") > 0), F.col("__u") / (F.col("__p") * F.col("__n"))).alias("auc"))


def classification_metrics(df: DataFrame, keys: list[str], y: str = "y", pred: str = "y_pred",
                           score: str = "y_score") -> DataFrame:
    """n_rows, positive_rate, precision, recall, f1, auc per slice; rows
    without a score count for all but the AUC, which is NULL for one class."""
    return _slice_metrics(df.select(*keys, outcome(y, pred, score).alias("__o")).select(*keys, "__o.*"), keys)


# ------------------------------------------------------------- E3 ---------
def summary_by_dataset_model(pred: DataFrame) -> DataFrame:
    m = classification_metrics(pred, ["dataset", "model"])
    return m.select("dataset", "model", "n_rows", "positive_rate", "precision", "recall", "f1",
                    F.col("auc").alias("auc_roc"))


# ------------------------------------------------------------- E4 ---------
def overall_by_seed(pred: DataFrame) -> DataFrame:
    m = classification_metrics(pred, ["seed", "dataset", "model"])
    return m.select("seed", F.col("dataset").alias("domain"), "model", "auc", "f1", "recall", "precision", "n_rows")


# ------------------------------------------------------------- E5/E6 ------
def period_bucket(time_col: str, period: str) -> Column:
    t = F.to_date(F.col(time_col))
    if period == "M":
        return F.date_format(t, "yyyy-MM")
    if period == "Q":
        return F.concat(F.year(t).cast("string"), F.lit("Q"), F.quarter(t).cast("string"))
    raise ValueError("period must be 'M' or 'Q'")


def temporal_metrics(pred: DataFrame, period: str = "M") -> DataFrame:
    p = pred.withColumn("period", period_bucket("time_id", period))
    m = classification_metrics(p, ["dataset", "model", "period"])
    return m.select("dataset", "model", "period", "n_rows", "precision", "recall", "f1",
                    F.col("auc").alias("auc_roc"))


def temporal_f1_by_seed(pred: DataFrame, period: str = "M") -> DataFrame:
    p = pred.withColumn("date_bucket", period_bucket("time_id", period))
    m = confusion_metrics(p, ["seed", "dataset", "model", "date_bucket"])
    return m.select("seed", F.col("dataset").alias("domain"), "model", "date_bucket",
                    F.lit("f1").alias("metric"), F.col("f1").alias("value"))


# ------------------------------------------------------------- E7 ---------
def simple_state(c: str = "region_id") -> Column:
    t = F.upper(F.trim(F.col(c).cast("string")))
    s = F.split(t, "__", 2).getItem(0)
    return F.when(s == "", F.lit("UNK")).otherwise(s)


def neighbor_truth(pred: DataFrame) -> DataFrame:
    """y_neighbor = 1 when the region or any same-state region is positive in
    that window: max(y) over (seed, dataset, model, state, time)."""
    w = Window.partitionBy("seed", "dataset", "model", "__state", "time_id")
    return (pred.withColumn("__state", simple_state())
            .withColumn("y_neighbor", F.max(F.col("y").cast("int")).over(w)).drop("__state"))


def neighbor_metrics_by_seed(pred: DataFrame) -> DataFrame:
    nb = neighbor_truth(pred)
    m = classification_metrics(nb, ["seed", "dataset", "model"], y="y_neighbor")
    return _unpivot(m.withColumnRenamed("dataset", "domain"), ["seed", "domain", "model"], METRICS4,
                    "neighbor_metric")


# ------------------------------------------------------------- E8 ---------
def group_metrics_by_seed(pred: DataFrame, group_col: str = "crime_group", dataset: str = DATASET_OUT) -> DataFrame:
    """AUC/F1 per (seed, model, group) on one dataset; empty when the column
    is missing or holds at most one group."""
    sub = pred.filter(F.col("dataset") == dataset)
    if group_col not in pred.columns:
        return sub.limit(0).select("seed", F.lit(dataset).alias("domain"), "model",
                                   F.lit("").alias("crime_group"), F.lit("").alias("metric"),
                                   F.lit(0.0).alias("value"))
    n_groups = sub.agg(F.count_distinct(group_col).alias("n"))
    m = side_by_side(classification_metrics(sub, ["seed", "model", group_col]), n_groups)
    m = m.filter(F.col("n") > 1).withColumn("domain", F.lit(dataset)).withColumnRenamed(group_col, "crime_group")
    return _unpivot(m, ["seed", "domain", "model", "crime_group"], ["auc", "f1"], "metric")


# ------------------------------------------------------------- E9 ---------
def region_buckets(pred: DataFrame, keep: Keep, dataset: str = DATASET_OUT,
                   n_buckets: int = N_REGION_BUCKETS) -> DataFrame:
    """Region -> workload quartile label. Mean y_count per region over the
    distinct (region, time, y, y_count) rows, ranked ascending (ties by
    region id) over ranges of regions; bucket = max(1, ceil(n (rank-1) / (R-1)))
    as pandas qcut on ranks does - NOT ntile. ``keep`` writes the ranked table."""
    base = pred.filter(F.col("dataset") == dataset).select("region_id", "time_id", "y", "y_count").distinct()
    work = base.groupBy("region_id").agg(F.avg("y_count").alias("workload"))
    r = ranked(work, ["workload", "region_id"], "__rank", keep)
    r = side_by_side(r, r.agg(F.count(F.lit(1)).alias("__R")))
    nb = F.least(F.lit(n_buckets), F.col("__R"))
    b = F.when(nb <= 1, F.lit(1)).otherwise(
        F.greatest(F.lit(1), F.ceil(nb * (F.col("__rank") - 1) / (F.col("__R") - 1)).cast("int")))
    return r.select("region_id", "workload", F.concat(F.lit("Q"), b.cast("string")).alias("region_bucket"))


def region_bucket_metrics_by_seed(pred: DataFrame, keep: Keep, dataset: str = DATASET_OUT,
                                  n_buckets: int = N_REGION_BUCKETS) -> DataFrame:
    buckets = region_buckets(pred, keep, dataset, n_buckets).select("region_id", "region_bucket")
    sub = pred.filter(F.col("dataset") == dataset).join(buckets, "region_id", "inner")
    m = classification_metrics(sub, ["seed", "model", "region_bucket"])
    return m.select("seed", "model", "region_bucket", "auc", "f1", "n_rows")


# ------------------------------------------------------------- E10 --------
def _unpivot(df: DataFrame, ids: list[str], metrics: list[str], name: str = "metric") -> DataFrame:
    return df.select(*ids, *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        ids, metrics, name, "value")


SLICE_KEYS = ["slice", "domain", "model", "seed", "crime_group", "date_bucket"]


def metrics_long(pred: DataFrame, window_days: int, group_col: str = "crime_group") -> DataFrame:
    """Tidy table: overall (4 metrics), monthly F1, per-group (AUC, F1 of the
    out-of-domain rows, if there is more than one group), neighbor-aware (4).

    Every prediction is counted once for each roll-up it belongs to and all
    roll-ups share one pass of ``_slice_metrics``."""
    grouped = group_col in pred.columns
    p = neighbor_truth(pred)
    own, none = outcome(), F.lit("")
    around = outcome(y="y_neighbor")
    group = F.coalesce(F.col(group_col).cast("string"), none) if grouped else none

    def roll_up(name: str, counts: Column, crime_group: Column = none, date_bucket: Column = none) -> Column:
        return F.struct(F.lit(name).alias("slice"), crime_group.alias("crime_group"), date_bucket.alias("date_bucket"),
                        counts.alias("counts"))
    shares = [roll_up("overall", own), roll_up("temporal", own, date_bucket=period_bucket("time_id", "M")),
              roll_up("neighbor_overall", around)]
    every = F.array(*shares)
    if grouped:
        every = F.when(F.col("dataset") == DATASET_OUT, F.array(*shares, roll_up("crime_group", own, group))).otherwise(every)
    rows = p.select(F.col("dataset").alias("domain"), "model", F.col("seed").cast("int").alias("seed"),
                    F.inline(every)).select(*SLICE_KEYS, "counts.*")
    # groups count where more than one occurs; a model without any is none
    m = _slice_metrics(rows, SLICE_KEYS).withColumn("__several", F.lit(True))
    if grouped:
        several = (pred.filter(F.col("dataset") == DATASET_OUT)
                   .agg((F.count_distinct(group_col) > 1).alias("__several")))
        m = side_by_side(m.drop("__several"), several)
    wanted = (F.when(F.col("slice") == "temporal", F.col("metric") == "f1")
              .when(F.col("slice") == "crime_group", F.col("metric").isin("auc", "f1") & F.col("__several"))
              .otherwise(F.lit(True)))
    return _unpivot(m, [*SLICE_KEYS, "__several"], METRICS4).filter(wanted).select(
        F.lit(int(window_days)).alias("time_window_days"), "domain", "model", "seed", "metric", "value", "crime_group",
        "date_bucket", "slice")


# ------------------------------------------------------------- E11 --------
def metrics_completeness(spark, mlong: DataFrame, models=MODEL_ORDER, seeds=(0, 1, 2),
                         domains=(DATASET_IN, DATASET_OUT)) -> DataFrame:
    """Expected (model, seed, domain, metric) overall rows missing from the
    metrics table (empty = complete). The expectation grid is tiny and
    built from parameters."""
    exp = spark.createDataFrame([(m, int(s), d, k) for m in models for s in seeds for d in domains for k in METRICS4],
                                "model string, seed int, domain string, metric string")
    have = mlong.filter(F.col("slice") == "overall").select("model", "seed", "domain", "metric").distinct()
    return exp.join(have, ["model", "seed", "domain", "metric"], "left_anti")


# ------------------------------------------------------------- E12/E13 ----
def seed_mean_overall(pred: DataFrame) -> DataFrame:
    return mean_over_seeds(overall_by_seed(pred))


def mean_over_seeds(by_seed: DataFrame) -> DataFrame:
    return by_seed.groupBy(F.col("domain").alias("dataset"), "model").agg(
        F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
        F.avg("f1").alias("f1"), F.avg("auc").alias("auc_roc"))


def seed_mean_monthly_f1(pred: DataFrame) -> DataFrame:
    t = temporal_f1_by_seed(pred, "M")
    return t.groupBy(F.col("domain").alias("dataset"), "model", F.col("date_bucket").alias("period")).agg(
        F.avg("value").alias("f1"))


# ------------------------------------------------------------- E14/E15 ----
def delta_auc(overall: DataFrame, in_ds: str = DATASET_IN, out_ds: str = DATASET_OUT) -> DataFrame:
    """AUC in-domain minus out-of-domain per model (models having both)."""
    g = overall.groupBy("model").agg(
        F.first(F.when(F.col("dataset") == in_ds, F.col("auc_roc")), ignorenulls=True).alias("auc_in_domain"),
        F.first(F.when(F.col("dataset") == out_ds, F.col("auc_roc")), ignorenulls=True).alias("auc_out_domain"),
        F.max((F.col("dataset") == in_ds).cast("int")).alias("__hi"),
        F.max((F.col("dataset") == out_ds).cast("int")).alias("__ho"))
    return (g.filter((F.col("__hi") == 1) & (F.col("__ho") == 1))
            .select("model", "auc_in_domain", "auc_out_domain",
                    (F.col("auc_in_domain") - F.col("auc_out_domain")).alias("delta_auc")))


def generalization_gap(overall: DataFrame, in_ds: str = DATASET_IN, out_ds: str = DATASET_OUT) -> DataFrame:
    g = overall.groupBy("model").agg(
        F.first(F.when(F.col("dataset") == in_ds, F.col("auc_roc")), ignorenulls=True).alias("auc_in"),
        F.first(F.when(F.col("dataset") == out_ds, F.col("auc_roc")), ignorenulls=True).alias("auc_out"),
        F.first(F.when(F.col("dataset") == in_ds, F.col("f1")), ignorenulls=True).alias("f1_in"),
        F.first(F.when(F.col("dataset") == out_ds, F.col("f1")), ignorenulls=True).alias("f1_out"))
    return g.select("model", (F.col("auc_in") - F.col("auc_out")).alias("delta_auc"),
                    (F.col("f1_in") - F.col("f1_out")).alias("delta_f1"))


# ------------------------------------------------------------- E16/E17 ----
def window_gap_by_seed(mlong: DataFrame, in_ds: str = DATASET_IN, out_ds: str = DATASET_OUT) -> DataFrame:
    """Per (window, model, seed, metric): in-domain minus out-of-domain value,
    then mean and sample std (NULL std -> 0) over seeds."""
    o = mlong.filter(F.col("slice") == "overall")
    g = o.groupBy("time_window_days", "model", "seed", "metric").agg(
        F.max(F.when(F.col("domain") == in_ds, F.col("value"))).alias("__i"),
        F.max(F.when(F.col("domain") == out_ds, F.col("value"))).alias("__o"))
    return g.select("time_window_days", "model", "seed", "metric", (F.col("__i") - F.col("__o")).alias("delta"))


def window_gap_summary(mlong: DataFrame) -> DataFrame:
    d = window_gap_by_seed(mlong)
    return d.groupBy("time_window_days", "model", "metric").agg(
        F.avg("delta").alias("mean"), F.coalesce(F.stddev_samp("delta"), F.lit(0.0)).alias("std"))


def window_overall_summary(mlong: DataFrame, metrics=("auc", "f1")) -> DataFrame:
    o = mlong.filter((F.col("slice") == "overall") & F.col("metric").isin(*metrics))
    return o.groupBy("time_window_days", "domain", "model", "metric").agg(
        F.avg("value").alias("mean"), F.coalesce(F.stddev_samp("value"), F.lit(0.0)).alias("std"))


# ------------------------------------------------------------- E22 --------
def best_model(mlong: DataFrame, domain: str = DATASET_IN, models=MODEL_ORDER) -> DataFrame:
    """Model with the highest mean overall in-domain F1 (ties -> model order); one row of nulls if there is none."""
    base = mlong.filter((F.col("slice") == "overall") & (F.col("domain") == domain) & (F.col("metric") == "f1")
                        & F.col("model").isin(*models))
    order = F.array_position(F.array(*[F.lit(m) for m in models]), F.col("model"))
    g = base.groupBy("model").agg(F.avg("value").alias("mean_f1")).withColumn("__o", order)
    return g.agg(F.max_by(F.struct("model", "mean_f1"), F.struct(F.col("mean_f1"), -F.col("__o"))).alias("b")) \
        .select(F.col("b.model").alias("model"), F.col("b.mean_f1").alias("mean_f1"))


def chosen_model(pred: DataFrame, domain: str = DATASET_IN, models=MODEL_ORDER) -> DataFrame:
    """One row (model, seed): E22's model, the first of ``models`` if none was
    scored, and the smallest seed of the predictions. Joined to a table it
    chooses rows at run time; the driver never sees it."""
    f1 = confusion_metrics(pred.filter(F.col("dataset") == domain), ["seed", "model"])
    mlong = f1.select(F.lit("overall").alias("slice"), F.lit(domain).alias("domain"), F.lit("f1").alias("metric"),
                      "model", F.col("f1").alias("value"))
    seed = pred.agg(F.coalesce(F.min(F.col("seed").cast("int")), F.lit(0)).alias("seed"))
    return side_by_side(best_model(mlong, domain, models), seed).select(
        F.coalesce("model", F.lit(models[0])).alias("model"), "seed")
