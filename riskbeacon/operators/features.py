"""Lag, rolling, EWMA, peer-region, calendar and composition features.

Plan shape: one exchange on (state, time) for the leave-one-out peer mean,
then one exchange on region_id; every per-region feature (lags, moving
frames, the EWMA scan, the lead label) shares ``W(region_id).orderBy(time_id)``
so Spark sorts once and chains the window operators without re-shuffling.
The panel is dense and each region holds exactly one row per window, so no
region can be skewed here, however skewed the raw events were.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskbeacon.config import CRIME_GROUPS, EWMA_SPAN, ROLL_WINDOW
from riskbeacon.functions.expr import GROUP_COUNT_COLS, calendar_columns, region_state

REQUIRED_NOT_NULL = ["lag_1", "lag_2", "lag_4", "neighbor_lag_1", "y_count"]



def ewma_scan(df: DataFrame, cols: dict[str, str], part: list[str], order: str, n_max: int,
              span: int = EWMA_SPAN) -> DataFrame:
    """Exponentially weighted mean with ``adjust=False`` (e1 = x1,
    e_t = (1-a) e_{t-1} + a x_t, a = 2/(span+1)) for each ``src -> dst``.

    The recursion is a linear first-order scan. It is evaluated as a
    log-depth prefix scan (Hillis-Steele): after round k every row holds the
    weighted sum of its last 2^k inputs, so ceil(log2(n_max)) rounds of
    ``lag`` over the same ordered window give the exact recursion with no
    per-row Python and no collect of a region's history.
    """
    alpha = 2.0 / (span + 1.0)
    decay = 1.0 - alpha
    window = Window.partitionBy(*part).orderBy(order)
    first = F.row_number().over(window) == 1
    tmp = {}
    for src, dst in cols.items():
        t = f"__scan_{dst}"
        tmp[dst] = t
        x = F.col(src).cast("double")
        df = df.withColumn(t, F.when(first, x).otherwise(F.lit(alpha) * x))
    # Each round is one SQL-expression projection (one analyzer pass, few
    # driver round-trips) over the same window spec.
    spec = f"PARTITION BY {', '.join(f'`{p}`' for p in part)} ORDER BY `{order}`"
    step = 1
    while step < max(n_max, 1):
        factor = repr(decay ** step)
        exprs = [f"`{c}`" if c not in tmp.values() else
                 f"`{c}` + {factor}D * coalesce(lag(`{c}`, {step}) OVER ({spec}), 0D) AS `{c}`" for c in df.columns]
        df = df.selectExpr(*exprs)
        step *= 2
    for dst, t in tmp.items():
        df = df.withColumnRenamed(t, dst)
    return df


def peer_mean(panel: DataFrame, keys: tuple = ()) -> DataFrame:
    """C9 + C10: leave-one-out mean of the other regions of the same state in
    the same window; 0 for a single-region state."""
    w = Window.partitionBy(*keys, "region_state", "time_id")
    tot = F.sum("count").over(w)
    n = F.count(F.lit(1)).over(w)
    nb = F.when(n > 1, (tot - F.col("count")).cast("double") / F.greatest(n - 1, F.lit(1))).otherwise(F.lit(0.0))
    return panel.withColumn("region_state", region_state("region_id")).withColumn("neighbor_lag_0", nb)


def build_supervised(panel: DataFrame, window_days: int, n_windows: int, keys: tuple = ()) -> DataFrame:
    """Panel -> supervised rows (all features, y_count, next_time), dropping
    rows without full history or without a next window (C16).

    ``keys`` are extra partition columns (e.g. a dataset tag) so several
    panels are featurized by one plan: every window is partitioned by them.
    """
    w = Window.partitionBy(*keys, "region_id").orderBy("time_id")
    prev4 = w.rowsBetween(-ROLL_WINDOW, -1)
    df = peer_mean(panel, keys)
    df = ewma_scan(df, {"count": "__ewm_count", "neighbor_lag_0": "__ewm_nb"}, [*keys, "region_id"], "time_id",
                   n_windows)

    cnt = F.col("count").cast("double")
    nb0 = F.col("neighbor_lag_0")
    cols: dict[str, Column] = {
        "lag_0": cnt,
        "lag_1": F.lag(cnt, 1).over(w),
        "lag_2": F.lag(cnt, 2).over(w),
        "lag_4": F.lag(cnt, 4).over(w),
        "rolling_mean_4": F.avg(cnt).over(prev4),
        "rolling_sum_4": F.sum(cnt).over(prev4),
        "ewma_4": F.lag("__ewm_count", 1).over(w),
        "neighbor_lag_1": F.lag(nb0, 1).over(w),
        "neighbor_roll_mean_4": F.avg(nb0).over(prev4),
        "neighbor_ewma_4": F.lag("__ewm_nb", 1).over(w),
        "self_neighbor_ratio_lag0": F.when(nb0 > 0, cnt / nb0).otherwise(cnt),
        "y_count": F.lead(cnt, 1).over(w),
        "next_time": F.date_add(F.col("time_id"), int(window_days)),
    }
    cols.update(calendar_columns("time_id"))
    lag_grp = {g: F.lag(F.col(c), 1).over(w) for g, c in zip(CRIME_GROUPS, GROUP_COUNT_COLS)}
    df = df.select("*", *[e.alias(k) for k, e in cols.items()],
                   *[e.alias(f"__lag1_{g}") for g, e in lag_grp.items()])
    lag_sum = sum((F.coalesce(F.col(f"__lag1_{g}"), F.lit(0.0)) for g in CRIME_GROUPS), F.lit(0.0))
    df = df.withColumn("__lag_sum", lag_sum)
    df = df.select("*", *[F.when(F.col("__lag_sum") > 0, F.col(f"__lag1_{g}") / F.col("__lag_sum"))
                         .otherwise(F.lit(0.0)).alias(f"lag1_share_{g}") for g in CRIME_GROUPS])
    df = df.drop("__lag_sum", "__ewm_count", "__ewm_nb", *[f"__lag1_{g}" for g in CRIME_GROUPS])
    return df.dropna(subset=REQUIRED_NOT_NULL)
