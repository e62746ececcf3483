"""Fitted models: stored grids, reloaded scores, importances, and the queries that take them."""

import math
import threading

import pytest
from pyspark.sql import functions as F

from riskbeacon.operators import metrics, support
from riskbeacon.operators import models as ML
from riskbeacon.plans import ml as MLP
from riskbeacon.plans import pipeline
from riskbeacon.plans.catalog import load_all

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def grid(spark):
    return MLP.grid(spark, SF_SMALL, 7)


def test_all_models_and_seeds_cover_all_rows(spark, grid):
    r = pipeline.window_run(spark, SF_SMALL, 7)
    want = {"in_domain": r.test.count(), "out_domain": r.out.count()}
    got = {(x.model, x.seed, x.dataset): x["count"]
           for x in grid.predictions.groupBy("model", "seed", "dataset").count().collect()}
    assert got == {(m, s, d): n for m in ML.FITTED_ORDER for s in (0, 1, 2) for d, n in want.items()}
    p = grid.predictions.filter(F.col("model") != "baseline_persistence")
    assert p.filter("y_score IS NULL OR y_score < 0 OR y_score > 1 OR y_pred <> CAST(y_score >= 0.5 AS INT)").isEmpty()
    for x in metrics.classification_metrics(p, ["dataset", "model"]).filter("dataset = 'in_domain'").collect():
        assert x.model == "sequence_mlp" or x.auc > 0.6


def test_seeds_differ_where_models_draw(grid):
    wide = grid.predictions.groupBy("model", "dataset", "region_id", "time_id").agg(
        F.count_distinct("y_score").alias("n")).groupBy("model").agg(F.max("n").alias("n"))
    got = {r.model: r.n for r in wide.collect()}
    assert got["random_forest"] > 1 and got["sequence_mlp"] > 1
    assert got["baseline_persistence"] == got["logistic_regression"] == 1


def test_stored_models_score_alike(spark, grid):
    keys = ["region_id", "time_id", "dataset", "model", "seed"]
    again = MLP.reload_and_score(spark, SF_SMALL, 7, grid.root).select(*keys, F.col("y_score").alias("again"))
    both = grid.predictions.join(again, keys, "full")
    assert both.count() == grid.predictions.count()
    assert both.filter("again IS NULL OR abs(y_score - again) > 1e-12").isEmpty()
    log = ML.read_log(spark, grid.root).collect()
    assert {(r.model, r.seed) for r in log} == {(m, s) for m in ML.FITTED_MODELS for s in (0, 1, 2)}
    assert {r.n_rows for r in log} == {pipeline.window_run(spark, SF_SMALL, 7).train.count()}


def test_rows_are_scored_by_many_tasks(spark, grid):
    """Rows of few bytes aren't scored by one task, which hundreds of trees keep busy for long."""
    again = MLP.reload_and_score(spark, SF_SMALL, 7, grid.root)
    assert again.rdd.getNumPartitions() > 1
    assert again.count() == grid.predictions.count()


def test_sequence_vector_is_the_padded_history(spark):
    rows = [("d", "r", f"2000-01-0{i + 1}", float(i)) for i in range(3)] + [("e", "r", "2000-01-09", 7.0)]
    df = spark.createDataFrame(rows, "dataset string, region_id string, time_id string, x double")
    out = ML.vectors(df, {"x": (0.0, 1.0, 2.0)}, ["x"], 3)
    got = {(r.dataset, r.time_id): (r.features.toArray().tolist(), r.sequence.toArray().tolist()) for r in out.collect()}
    assert got["d", "2000-01-02"] == ([0.0], [0.0, -0.5, 0.0])
    assert got["d", "2000-01-03"] == ([0.5], [-0.5, 0.0, 0.5]) and got["e", "2000-01-09"] == ([3.0], [0.0, 0.0, 3.0])
    assert out.columns == ["dataset", "region_id", "time_id", "x", "features", "sequence"]


def test_logistic_scores_by_hand(spark, grid):
    params, models = ML.load_grid(spark, grid.root)
    m = models["logistic_regression", 0]
    rows = ML.vectors(MLP.labelled(spark, SF_SMALL, 7), params).limit(50)
    got = grid.predictions.filter("model = 'logistic_regression' AND seed = 0").select(
        "dataset", "region_id", F.to_date("time_id").alias("time_id"), "y_score")
    for r in rows.join(got, ["dataset", "region_id", "time_id"]).collect():
        z = float(r.features.toArray() @ m.coefficients.toArray()) + m.intercept
        assert r.y_score == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-12)


def test_importances_normalized(spark, grid):
    imp = MLP.importance_by_seed(spark, SF_SMALL, 7)
    sums = imp.groupBy("model", "seed").agg(F.sum("importance_norm").alias("s")).collect()
    assert len(sums) == 9 and all(abs(r.s - 1.0) < 1e-9 for r in sums)
    assert imp.filter("model = 'baseline_persistence' AND feature = 'lag_0'").first().importance_norm == 1.0
    splits = imp.filter("model = 'random_forest' AND seed = 0").agg(F.sum("importance_raw")).first()[0]
    forest = ML.LOADERS[ML.MODEL_RF].load(ML.model_path(grid.root, ML.MODEL_RF, 0))
    assert splits == sum((t.numNodes - 1) / 2 for t in forest.trees)
    top = support.top_features(support.summarize_importance(imp), 10)
    assert {r["count"] for r in top.groupBy("model").count().collect()} == {10}


def test_evaluation_takes_the_fitted_models(spark, grid):
    """The tables over fitted models agree with counts made from the stored predictions."""
    specs = load_all()
    p = grid.predictions.toPandas()
    e4 = {(r.seed, r.domain, r.model): r for r in specs["op_e4_fitted_by_seed"].build(spark, SF_SMALL).collect()}
    assert len(e4) == 24
    for (seed, ds, model), g in p.groupby(["seed", "dataset", "model"]):
        tp = int(((g.y == 1) & (g.y_pred == 1)).sum())
        wrong = int((g.y != g.y_pred).sum())
        f1 = 2 * tp / (2 * tp + wrong) if tp + wrong else 0.0
        assert e4[seed, ds, model].f1 == pytest.approx(f1, abs=1e-6) and e4[seed, ds, model].n_rows == len(g)
    mean = {m: sum(e4[s, "in_domain", m].f1 for s in (0, 1, 2)) / 3 for m in ML.FITTED_ORDER}
    best = max(ML.FITTED_ORDER, key=lambda m: (round(mean[m], 6), -ML.FITTED_ORDER.index(m)))
    assert specs["op_e22_fitted_best_model"].build(spark, SF_SMALL).first().model == best
    hits = specs["op_e27_fitted_hit_summary"].build(spark, SF_SMALL).first()
    assert (hits.model, hits.seed) == (best, 0)


@pytest.mark.parametrize("name", ["op_d8_logistic_importance", "op_e16_fitted_window_gap", "op_h2_fitted_district_priority"])
def test_windows_are_fitted_side_by_side(spark, monkeypatch, name):
    both = threading.Barrier(2)

    def fit(spark, sf_dir, w):
        both.wait(20)
        raise LookupError("both windows are here")
    monkeypatch.setattr(MLP, "grid", fit)
    with pytest.raises(LookupError, match="both windows"):
        load_all()[name].build(spark, SF_SMALL)
