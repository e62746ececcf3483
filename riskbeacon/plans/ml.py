"""Stored grids of fitted models per window on the stand-in Xy frames."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskbeacon.config import DATASET_IN, DATASET_OUT, EVAL_SEEDS, MODEL_PERSISTENCE
from riskbeacon.operators import models as ML
from riskbeacon.operators import prep
from riskbeacon.operators.support import normalize_importance
from riskbeacon.plans import pipeline
from riskbeacon.plans.store import materialize, table_root

_CACHE: dict = {}


@dataclass
class Grid:
    root: str               # folder of the stored grid, a new one for each
    log: DataFrame          # D13
    predictions: DataFrame  # D5, by models loaded from ``root``


def keeper(spark: SparkSession, name: str):
    return lambda df, part: materialize(spark, df, f"{name}-{part}")


def labelled(spark: SparkSession, sf_dir: str, w: int) -> DataFrame:
    """Both data sets to score, tagged."""
    r = pipeline.window_run(spark, sf_dir, w)
    return r.test.withColumn("dataset", F.lit(DATASET_IN)).unionByName(
        r.out.withColumn("dataset", F.lit(DATASET_OUT)), allowMissingColumns=True)


def reload_and_score(spark: SparkSession, sf_dir: str, w: int, root: str, seeds=EVAL_SEEDS) -> DataFrame:
    params, models = ML.load_grid(spark, root)
    return ML.score_all(labelled(spark, sf_dir, w), params, models, pipeline.window_run(spark, sf_dir, w).threshold, seeds)


def grid(spark: SparkSession, sf_dir: str, w: int) -> Grid:
    """All models x seeds of a window: fitted, stored, loaded and scored once a session."""
    key = (*pipeline.session_key(spark), "grid", sf_dir, w)
    with pipeline._lock(key):
        return _grid(spark, sf_dir, w, key)


def _grid(spark: SparkSession, sf_dir: str, w: int, key: tuple) -> Grid:
    if key not in _CACHE:
        root = f"{table_root(spark)}/models-{w}d-{uuid.uuid4().hex[:12]}"
        train = pipeline.window_run(spark, sf_dir, w).train
        log = ML.fit_grid(train, prep.numeric_params(train), root, keeper(spark, f"models-{w}d"))
        _CACHE[key] = Grid(root, log, materialize(spark, reload_and_score(spark, sf_dir, w, root), f"fitted-{w}d"))
    return _CACHE[key]


def grids(spark: SparkSession, sf_dir: str, windows=(7, 3)) -> dict[int, Grid]:
    pipeline.window_runs(spark, sf_dir, windows)
    return dict(zip(windows, pipeline.in_parallel(*[lambda w=w: grid(spark, sf_dir, w) for w in windows])))


def fit_one(spark: SparkSession, sf_dir: str, w: int, seed: int, model: str) -> DataFrame:
    """One model fitted anew, stored in a folder of its own, loaded and scored."""
    root = f"{table_root(spark)}/model-{uuid.uuid4().hex[:12]}"
    train = pipeline.window_run(spark, sf_dir, w).train
    ML.fit_grid(train, prep.numeric_params(train), root, keeper(spark, "model"), [seed], [model])
    return reload_and_score(spark, sf_dir, w, root, [seed]).filter(F.col("model") == model)


def both_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long prediction table of persistence and the fitted models, both windows."""
    return reduce(DataFrame.unionByName, [g.predictions.withColumn("time_window_days", F.lit(w))
                                          for w, g in grids(spark, sf_dir).items()])


_STORES: dict = {}


def serving_store(spark: SparkSession, sf_dir: str) -> str:
    """Folder of a published run of the fitted models' predictions."""
    key = (*pipeline.session_key(spark), sf_dir)
    if key not in _STORES:
        store = f"{table_root(spark)}/serving-fitted-{uuid.uuid4().hex[:12]}"
        pipeline.runs.publish(both_windows(spark, sf_dir), store)
        _STORES[key] = store
    return _STORES[key]


def importance_by_seed(spark: SparkSession, sf_dir: str, w: int, seeds=EVAL_SEEDS) -> DataFrame:
    """Normalized importances of persistence, logistic and forest per seed, from the stored models."""
    root = grid(spark, sf_dir, w).root
    frames = []
    logistic = ML.LOADERS[ML.MODEL_LR].load(ML.model_path(root, ML.MODEL_LR, 0))  # one fit serves all seeds
    for s in seeds:
        for df, name in ((ML.persistence_importance(spark), MODEL_PERSISTENCE),
                         (ML.logistic_importance(spark, logistic), ML.MODEL_LR),
                         (ML.forest_split_counts(spark, ML.model_path(root, ML.MODEL_RF, s)), ML.MODEL_RF)):
            frames.append(df.select(F.lit(f"{w}d").alias("window"), F.lit(int(s)).alias("seed"),
                                    F.lit(DATASET_IN).alias("dataset"), F.lit(name).alias("model"),
                                    "feature", "method", "importance_raw"))
    return normalize_importance(reduce(DataFrame.unionByName, frames))


def importance_both_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    grids(spark, sf_dir)  # fitted side by side
    return reduce(DataFrame.unionByName, [importance_by_seed(spark, sf_dir, w) for w in (7, 3)])


def clear_cache() -> None:
    _CACHE.clear()
    _STORES.clear()
