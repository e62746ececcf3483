"""Property checks on the stand-in pipeline (sf0.001)."""

import pytest
from pyspark.sql import functions as F

from riskbeacon.config import CRIME_GROUPS
from riskbeacon.operators import metrics, topk
from riskbeacon.plans import pipeline

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def run(spark):
    return pipeline.window_run(spark, SF_SMALL, 7)


def test_panel_is_dense_and_conserves_events(spark, run):
    p = run.panel_in
    n_regions = p.select("region_id").distinct().count()
    assert p.count() == n_regions * run.bounds_in.n_windows
    n_events = pipeline.in_domain_events(spark, SF_SMALL).count()
    assert p.agg(F.sum("count")).first()[0] == n_events
    assert p.groupBy("region_id", "time_id").count().filter("count > 1").count() == 0


def test_shares_sum_to_zero_or_one(run):
    s = run.supervised_in.select(sum(F.col(f"lag1_share_{g}") for g in CRIME_GROUPS).alias("s"))
    bad = s.filter(~((F.abs(F.col("s")) < 1e-9) | (F.abs(F.col("s") - 1) < 1e-9))).count()
    assert bad == 0


def test_coverage_monotone_and_full_at_all_regions(run):
    cov = topk.topk_coverage_by_seed(run.predictions, k_candidates=(1, 2, 3, 5, 8, 10, 25))
    rows = cov.filter(F.col("coverage").isNotNull()).orderBy("domain", "seed", "model", "k").collect()
    by = {}
    for r in rows:
        by.setdefault((r.domain, r.seed, r.model), []).append((r.k, r.coverage))
    for series in by.values():
        vals = [c for _, c in series]
        assert all(b >= a - 1e-12 for a, b in zip(vals, vals[1:]))
    n_reg = run.predictions.filter("dataset = 'in_domain'").select("region_id").distinct().count()
    full = topk.topk_coverage_by_seed(run.predictions, k_candidates=(n_reg,), domains=["in_domain"]).collect()
    assert all(r.coverage == pytest.approx(1.0) for r in full)


def test_prediction_rows_per_model_seed(run):
    counts = run.predictions.groupBy("dataset", "model", "seed").count().collect()
    per_ds = {}
    for r in counts:
        per_ds.setdefault(r.dataset, set()).add(r["count"])
    assert all(len(v) == 1 for v in per_ds.values())


def test_auc_symmetry_on_pipeline(run):
    p = run.predictions
    a = {(r.dataset, r.model, r.seed): r.auc for r in metrics.classification_metrics(p, ["dataset", "model", "seed"]).collect()}
    b = {(r.dataset, r.model, r.seed): r.auc
         for r in metrics.classification_metrics(p.withColumn("y_score", -F.col("y_score")), ["dataset", "model", "seed"]).collect()}
    for k, v in a.items():
        if v is not None:
            assert b[k] == pytest.approx(1 - v)


def test_both_windows_take_one_look_at_the_events(spark, monkeypatch):
    looks = []
    for module, name in ((pipeline, "in_domain_events"), (pipeline.standin, "out_domain_events")):
        monkeypatch.setattr(module, name, lambda *a, _f=getattr(module, name), _n=name: looks.append(_n) or _f(*a))
    pipeline.window_runs(spark, f"{SF_SMALL}/.", (7, 3))  # a path of its own, so nothing is remembered
    assert sorted(looks) == ["in_domain_events", "out_domain_events"]
