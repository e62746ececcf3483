"""MLlib models over the Xy contract.

Training is distributed by MLlib (the reference trains single-process
Torch / hand-written trees).

* Preprocessing (C26, C28) has values fitted on train: scaled features as a
  vector, and the scaled features of the last L windows of a region as one,
  left-padded with zeros.
* D2 logistic regression: class weight n_neg/n_pos on positives, no
  regularization. The loss is convex and the optimizer draws nothing, so one
  fit serves all seeds.
* D3 random forest: 120 trees, depth 10, bootstrap, sqrt features, Gini,
  min 3 rows per leaf; score = P(class 1).
* D4 sequence classifier: the reference's LSTM role, re-aimed as an MLlib
  multilayer perceptron over the flattened L x 27 sequence (C28), with
  deterministic over-sampling of positives for class balance.

A grid of fits is stored as it is made (preprocessor values, one folder a
model and seed, log last) and loaded again for scoring: every model adds its
probability to the same rows, so a data set is read and prepared once.
"""

from __future__ import annotations

import json
import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.classification import (LogisticRegression, LogisticRegressionModel, MultilayerPerceptronClassificationModel,
                                       MultilayerPerceptronClassifier, RandomForestClassificationModel,
                                       RandomForestClassifier)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskbeacon.config import EVAL_SEEDS, FEATURE_NUMERIC, MODEL_PERSISTENCE, SEQUENCE_LENGTH
from riskbeacon.operators.predict import threshold_of

MODEL_LR = "logistic_regression"
MODEL_RF = "random_forest"
MODEL_SEQ = "sequence_mlp"
FITTED_MODELS = [MODEL_LR, MODEL_RF, MODEL_SEQ]
FITTED_ORDER = [MODEL_PERSISTENCE, *FITTED_MODELS]
SEEDLESS = {MODEL_LR}
INPUT = {MODEL_LR: "features", MODEL_RF: "features", MODEL_SEQ: "sequence"}
LOADERS = {MODEL_LR: LogisticRegressionModel, MODEL_RF: RandomForestClassificationModel,
           MODEL_SEQ: MultilayerPerceptronClassificationModel}
FOREST_PARAMS = dict(numTrees=120, maxDepth=10, minInstancesPerNode=3, featureSubsetStrategy="sqrt",
                     impurity="gini", bootstrap=True, subsamplingRate=1.0)
SEQUENCE_PARAMS = dict(hidden=32, maxIter=80)
ROWS_A_TASK = 500  # least rows of a task when a small train set, or rows to score, are spread
MOST_ROWS_A_TASK, TASKS_A_CORE = 50_000, 4  # of rows to score: more rows make more tasks than these a core


# ------------------------------------------------------ C26, C28 as vectors
def vectors(df: DataFrame, params: Mapping[str, tuple[float, float, float]], features: Sequence[str] = FEATURE_NUMERIC,
            length: int = SEQUENCE_LENGTH) -> DataFrame:
    """Rows of the Xy contract with their ``dataset`` and two vectors:
    ``features``, scaled, and ``sequence``, the scaled features of the last
    ``length`` windows of the region in its data set behind zeros."""
    scaled = F.array(*[(F.coalesce(F.col(f).cast("double"), F.lit(params[f][0])) - F.lit(params[f][1])) / F.lit(params[f][2])
                       for f in features])
    w = Window.partitionBy("dataset", "region_id").orderBy("time_id").rowsBetween(-(length - 1), 0)
    past = F.collect_list("__z").over(w)
    zeros = F.array_repeat(F.lit(0.0), (F.lit(length) - F.size("__past")) * F.lit(len(features)))
    return (df.withColumn("__z", scaled).withColumn("__past", past)
            .withColumn("features", array_to_vector("__z"))
            .withColumn("sequence", array_to_vector(F.concat(zeros, F.flatten("__past")))).drop("__z", "__past"))


def class_weight(train: DataFrame, label: str = "y") -> float:
    row = train.agg(F.sum(F.col(label).cast("double")).alias("p"), F.count(F.lit(1)).alias("n")).first()
    pos = float(row["p"] or 0.0)
    return (float(row["n"]) - pos) / max(pos, 1.0)


def _columns(model: str, seed: int) -> dict:
    """Names of what a model adds to a row, so that many can score the same rows."""
    tag = f"{model}_{int(seed)}"
    return dict(featuresCol=INPUT[model], probabilityCol=f"p_{tag}", rawPredictionCol=f"r_{tag}", predictionCol=f"c_{tag}")


# ------------------------------------------------------------------ D2 -----
def fit_logistic(train: DataFrame, seed: int = 0):
    w = class_weight(train)
    data = train.withColumn("w", F.when(F.col("y") == 1, F.lit(w)).otherwise(F.lit(1.0)))
    return LogisticRegression(labelCol="y", weightCol="w", regParam=0.0, maxIter=200, standardization=False,
                              **_columns(MODEL_LR, seed)).fit(data)


# ------------------------------------------------------------------ D3 -----
def fit_forest(train: DataFrame, seed: int):
    return RandomForestClassifier(labelCol="y", seed=int(seed), **FOREST_PARAMS, **_columns(MODEL_RF, seed)).fit(train)


# ------------------------------------------------------------------ D4 -----
def fit_sequence(train: DataFrame, seed: int, width: int = len(FEATURE_NUMERIC) * SEQUENCE_LENGTH):
    ratio = max(1, int(round(class_weight(train))))
    copies = F.when(F.col("y") == 1, F.lit(ratio)).otherwise(F.lit(1))
    balanced = train.withColumn("__i", F.explode(F.sequence(F.lit(1), copies))).drop("__i")
    return MultilayerPerceptronClassifier(
        labelCol="y", layers=[width, SEQUENCE_PARAMS["hidden"], 2], seed=int(seed), maxIter=SEQUENCE_PARAMS["maxIter"],
        **_columns(MODEL_SEQ, seed)).fit(balanced.withColumn("y", F.col("y").cast("double")))


FITS = {MODEL_LR: fit_logistic, MODEL_RF: fit_forest, MODEL_SEQ: fit_sequence}
PARAMS = {MODEL_LR: {"regParam": 0.0, "class_weight": "n_neg/n_pos", "seeds": "one fit serves all"},
          MODEL_RF: FOREST_PARAMS, MODEL_SEQ: SEQUENCE_PARAMS}


# ----------------------------------------------------------- D13, D14 ------
FIT_LOG = "model string, seed int, fit_seconds double, n_rows long, n_features int, params string"


def model_path(root: str, model: str, seed: int) -> str:
    return f"{root}/{model}-seed{0 if model in SEEDLESS else int(seed)}"


PREPROCESSOR = "feature string, median double, mean double, std double"
AT_ONCE = 4  # fits submitted side by side: their many short jobs leave cores idle


def fit_grid(train: DataFrame, params: Mapping, root: str, keep, seeds: Sequence[int] = EVAL_SEEDS,
             models: Sequence[str] = FITTED_MODELS) -> DataFrame:
    """Fit all models for all seeds on the labelled ``train``, store them and
    the preprocessor under ``root``, which must be new, and return the log
    (written last). Times are wall times of fits that run side by side."""
    unknown = [m for m in models if m not in FITS]
    if unknown:
        raise ValueError(f"no such model: {unknown}")
    spark = train.sparkSession
    rows = [(f, *map(float, v)) for f, v in params.items()]
    spark.createDataFrame(rows, PREPROCESSOR).coalesce(1).write.parquet(f"{root}/preprocessor")
    ready = vectors(train.withColumn("dataset", F.lit("train")), params)
    n = train.count()
    # iterations take long for few bytes: a small train set is spread over the cores, a large one lies as read
    if n < ROWS_A_TASK * spark.sparkContext.defaultParallelism:
        ready = ready.repartition(max(1, n // ROWS_A_TASK), "region_id", "time_id")
    ready = keep(ready.select("features", "sequence", "y"), "train-vectors")

    def fit(task: tuple[str, int]) -> float:
        t0 = time.perf_counter()
        FITS[task[0]](ready, task[1]).write().save(model_path(root, *task))
        return time.perf_counter() - t0
    tasks = list(dict.fromkeys((m, 0 if m in SEEDLESS else int(s)) for m in models for s in seeds))
    with ThreadPoolExecutor(AT_ONCE) as pool:
        took = dict(zip(tasks, pool.map(fit, tasks)))
    log = [(m, int(s), took[m, 0 if m in SEEDLESS else int(s)], n, len(params), json.dumps(PARAMS[m], sort_keys=True))
           for m in models for s in seeds]
    spark.createDataFrame(log, FIT_LOG).coalesce(1).write.parquet(f"{root}/log")
    return read_log(spark, root)


def read_log(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(FIT_LOG).parquet(f"{root}/log")


def load_grid(spark: SparkSession, root: str) -> tuple[dict, dict]:
    """(preprocessor values, {(model, seed): fitted model}) of a finished grid, by its log."""
    pairs = [(r.model, r.seed) for r in read_log(spark, root).select("model", "seed").collect()]
    params = {r.feature: (r.median, r.mean, r.std)
              for r in spark.read.schema(PREPROCESSOR).parquet(f"{root}/preprocessor").collect()}
    stored = [(m, s) for m, s in pairs if m not in SEEDLESS or s == 0]
    with ThreadPoolExecutor(AT_ONCE) as pool:
        loaded = dict(zip(stored, pool.map(lambda task: LOADERS[task[0]].load(model_path(root, *task)), stored)))
    return params, loaded | {(m, s): None for m, s in pairs if m in SEEDLESS and s != 0}


# ------------------------------------------------------------------ D5 -----
def score_all(rows: DataFrame, params: Mapping, models: Mapping, threshold: int | Mapping[str, int],
              seeds: Sequence[int] = EVAL_SEEDS) -> DataFrame:
    """The long prediction table of labelled ``rows`` (with ``dataset``):
    persistence by its threshold and every fitted model at 0.5, from one pass."""
    # few bytes a row, but hundreds of trees: tasks are cut by rows, in the exchange that ``vectors`` needs anyway
    n, cores = rows.count(), rows.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(n // ROWS_A_TASK, max(TASKS_A_CORE * cores, n // MOST_ROWS_A_TASK)))
    scored = vectors(rows.withColumn("__least", threshold_of(rows, threshold)).repartition(tasks, "dataset", "region_id"),
                     params)
    for model in filter(None, models.values()):
        scored = model.transform(scored)

    def entry(model, seed, score, pred):
        return F.struct(F.lit(model).alias("model"), F.lit(int(seed)).alias("seed"), score.alias("y_score"),
                        pred.cast("int").alias("y_pred"))
    count = F.col("lag_0").cast("double")
    entries = [entry(MODEL_PERSISTENCE, s, count, count >= F.col("__least")) for s in seeds]
    for m, s in sorted(models):
        p = vector_to_array(F.col(_columns(m, 0 if m in SEEDLESS else s)["probabilityCol"]))[1]
        entries.append(entry(m, s, p, p >= 0.5))
    return scored.select("region_id", F.date_format("time_id", "yyyy-MM-dd").alias("time_id"),
                         F.col("y").cast("int").alias("y"), F.col("y_count").cast("double").alias("y_count"), "dataset",
                         F.inline(F.array(*entries))).select(
        "region_id", "time_id", "y", "y_count", "model", "dataset", "y_score", "y_pred", "seed")


# ------------------------------------------------------------------ D8 -----
def logistic_importance(spark: SparkSession, model, features=FEATURE_NUMERIC) -> DataFrame:
    coefs = [abs(float(c)) for c in model.coefficients.toArray()]
    return spark.createDataFrame(list(zip(features, coefs)), "feature string, importance_raw double") \
        .withColumn("method", F.lit("coef_abs"))


# ------------------------------------------------------------------ D9 ----
def forest_split_counts(spark: SparkSession, path: str, features=FEATURE_NUMERIC) -> DataFrame:
    """Internal-node split counts per feature over all trees, read from the
    stored model's node table (a distributed scan of the Parquet)."""
    nodes = spark.read.parquet(f"{path}/data")
    internal = nodes.filter(F.col("nodeData.leftChild") >= 0).select(
        F.col("nodeData.split.featureIndex").alias("idx"))
    counts = internal.groupBy("idx").agg(F.count(F.lit(1)).cast("double").alias("importance_raw"))
    names = spark.createDataFrame(list(enumerate(features)), "idx int, feature string")
    return (names.join(counts, "idx", "left")
            .select("feature", F.coalesce("importance_raw", F.lit(0.0)).alias("importance_raw"))
            .withColumn("method", F.lit("split_count")))


# ------------------------------------------------------------------ D10 ----
def persistence_importance(spark: SparkSession, used_feature: str = "lag_0", features=FEATURE_NUMERIC) -> DataFrame:
    return spark.createDataFrame([(f, 1.0 if f == used_feature else 0.0) for f in features],
                                 "feature string, importance_raw double").withColumn("method", F.lit("rule_based"))


# ------------------------------------------------------------------ D6 -----
def prediction_coverage(pred: DataFrame, expected: DataFrame) -> DataFrame:
    """(seed, dataset, model) groups whose row count differs from the
    expected rows of their dataset - empty when every model covered every row."""
    got = pred.groupBy("seed", "dataset", "model").agg(F.count(F.lit(1)).alias("n_rows"))
    return (got.join(F.broadcast(expected), "dataset", "left")
            .filter(F.col("expected_rows").isNull() | (F.col("n_rows") != F.col("expected_rows")))
            .select("seed", "dataset", "model", "n_rows", "expected_rows"))
