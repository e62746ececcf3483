"""Deterministic scorers and the long prediction table.

The prediction table (region_id, time_id, y, y_count, model, dataset,
y_score, y_pred, seed) is produced in ONE pass over the labelled rows: each
row is expanded into its (model, seed) scores with ``inline`` of an array of
structs - no per-model scan, no self-union of the source.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskbeacon.config import EVAL_SEEDS, MODEL_EWMA, MODEL_PERSISTENCE, MODEL_ROLLING


def scorer_specs(seeds=EVAL_SEEDS) -> list[tuple[str, int, str]]:
    """(model, seed, score column). Persistence scores the present count. None
    of the rules draws anything, so all seeds score alike."""
    columns = {MODEL_PERSISTENCE: "lag_0", MODEL_ROLLING: "rolling_mean_4", MODEL_EWMA: "ewma_4"}
    return [(m, int(s), c) for s in seeds for m, c in columns.items()]


def threshold_of(xy: DataFrame, threshold: int | Mapping[str, int]) -> Column:
    """The count from which a row is predicted positive. Of a map by crime
    group, a row takes its group's; rows of other groups, and all rows without
    that column, take the largest (at least 1)."""
    if not isinstance(threshold, Mapping):
        return F.lit(int(threshold))
    default = F.lit(max([1, *map(int, threshold.values())]))
    if "crime_group" not in xy.columns or not threshold:
        return default
    by_group = F.create_map(*[F.lit(v) for k, t in threshold.items() for v in (str(k), int(t))])
    return F.coalesce(by_group[F.col("crime_group").cast("string")], default)


def predictions_long(xy: DataFrame, dataset: str, threshold: int | Mapping[str, int], specs=None) -> DataFrame:
    """Score one labelled dataset with every (model, seed)."""
    specs = specs or scorer_specs()
    xy = xy.withColumn("__least", threshold_of(xy, threshold))
    arr = F.array(*[F.struct(F.lit(m).alias("model"), F.lit(s).alias("seed"),
                             F.col(c).cast("double").alias("y_score")) for m, s, c in specs])
    base = xy.select(F.col("region_id"), F.date_format(F.col("time_id"), "yyyy-MM-dd").alias("time_id")
                     if dict(xy.dtypes).get("time_id") == "date" else F.col("time_id"),
                     F.col("y").cast("int").alias("y"), F.col("y_count").cast("double").alias("y_count"),
                     "__least", F.inline(arr))
    return base.select(
        "region_id", "time_id", "y", "y_count", "model", F.lit(dataset).alias("dataset"), "y_score",
        (F.col("y_score") >= F.col("__least")).cast("int").alias("y_pred"),
        F.col("seed").cast("int").alias("seed"))
