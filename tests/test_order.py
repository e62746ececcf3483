"""Fixed ranges, distributed ranks, exact medians and the metrics built on them."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskbeacon.functions import quantile
from riskbeacon.functions.order import ranked, value_range
from riskbeacon.operators import metrics, prep
from riskbeacon.plans.store import materialize


def test_ranges_rise_with_the_values(spark):
    rng = np.random.default_rng(0)
    powers = [s * 2.0 ** e * f for e in range(-1074, 1024, 7) for s in (1, -1) for f in (1, 1 - 2 ** -53, 1 + 2 ** -52)]
    odd = [0.0, -0.0, math.inf, -math.inf, math.nan, 5e-324, -5e-324, 1.7976931348623157e308]
    values = powers + odd + list(rng.normal(0, 1, 300)) + list(rng.uniform(0, 1, 300)) + list(range(-5, 300))
    got = spark.createDataFrame([(float(v),) for v in values], "x double").withColumn("r", value_range(F.col("x"))).collect()
    plain = sorted((r for r in got if not math.isnan(r.x)), key=lambda r: r.x)
    assert all(a.r <= b.r for a, b in zip(plain, plain[1:]))
    assert all(a.r == b.r for a, b in zip(plain, plain[1:]) if a.x == b.x)
    assert max(r.r for r in plain) < [r.r for r in got if math.isnan(r.x)][0]
    assert len({r.r for r in plain if 0.9 <= r.x <= 1}) > 20


def test_ranked_over_ranges(spark):
    df = spark.createDataFrame([(i % 50, f"k{i}") for i in range(2000)], "v long, k string").repartition(7)
    got = ranked(df, ["v", "k"], "place", lambda d, n: materialize(spark, d, n)).collect()
    want = sorted((r.v, r.k) for r in got)
    assert [(r.v, r.k) for r in sorted(got, key=lambda r: r.place)] == want
    assert sorted(r.place for r in got) == list(range(1, 2001))
    assert ranked(df.limit(0), ["v"], "place", lambda d, n: materialize(spark, d, n)).count() == 0


@pytest.mark.parametrize("accuracy", [10000, 40])
def test_medians_of_many_columns(spark, monkeypatch, accuracy):
    """Also with a coarse sketch, whose guesses need further rounds."""
    monkeypatch.setattr(quantile, "GUESS_ACCURACY", accuracy)
    rng = np.random.default_rng(2)
    n = 700
    cols = {"a": rng.normal(0, 1, n), "b": rng.integers(0, 4, n).astype(float), "c": np.full(n, 3.5),
            "d": rng.uniform(0, 1e9, n), "e": np.where(rng.uniform(size=n) < 0.6, None, rng.normal(5, 2, n)),
            "f": np.full(n, None), "g": np.where(np.arange(n) == 17, 4.0, None), "h": rng.exponential(1, n) ** 9}
    df = spark.createDataFrame([tuple(None if cols[c][i] is None else float(cols[c][i]) for c in cols) for i in range(n)],
                               ", ".join(f"{c} double" for c in cols)).repartition(5)
    for frame, size in ((df, n), (df.limit(0), 0)):
        got = quantile.exact_medians(frame, list(cols))
        for c, v in cols.items():
            v = np.array([x for x in v if x is not None], float) if size else np.zeros(0)
            assert got[c]["n"] == len(v) and got[c]["rows"] == size
            assert got[c]["median"] == (pytest.approx(np.median(v), rel=1e-14) if len(v) else None), c
            if len(v):
                assert got[c]["mean"] == pytest.approx(v.mean()) and got[c]["var"] == pytest.approx(v.var(), rel=1e-9, abs=1e-9)


def test_filled_moments(spark):
    rows = [(1.0, None), (None, None), (2.0, None), (9.0, None), (None, None)]
    got = prep.numeric_params(spark.createDataFrame(rows, "x double, y double"), ["x", "y"])
    filled = np.array([1.0, 2.0, 2.0, 9.0, 2.0])
    assert got["x"] == pytest.approx((2.0, filled.mean(), filled.std())) and got["y"] == (0.0, 0.0, 1.0)


def brute_auc(rows):
    pos, neg = [s for y, s in rows if y == 1], [s for y, s in rows if y != 1]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_metrics_of_slices(spark):
    """Ties, negative, equal, missing and one-class scores, against all pairs."""
    rng = np.random.default_rng(3)
    rows = []
    for g, scores in {"smooth": rng.uniform(0.9, 1, 150), "ties": rng.integers(0, 5, 150) * 1.0,
                      "signed": rng.normal(0, 1e-3, 150), "wide": 10.0 ** rng.uniform(-300, 300, 150),
                      "same": np.full(30, 0.25), "zero": np.where(rng.uniform(size=60) < 0.5, 0.0, -0.0)}.items():
        rows += [(g, int(rng.integers(0, 2)), int(rng.integers(0, 2)), float(s)) for s in scores]
    rows += [("one", 1, 1, 0.5), ("one", 1, 0, 0.6), ("none", 0, 1, None), ("none", 1, 1, None), ("none", 1, None, 2.0),
             ("none", 0, 0, 1.0)]
    df = spark.createDataFrame(rows, "g string, y int, y_pred int, y_score double")
    got = {r.g: r for r in metrics.classification_metrics(df, ["g"]).collect()}
    for g in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == g]
        want = brute_auc([(y, s) for _, y, _, s in own if s is not None])
        assert got[g].auc == (None if want is None else pytest.approx(want)), g
        tp = sum(y == 1 and p == 1 for _, y, p, _ in own)
        fp, fn = sum(y != 1 and p == 1 for _, y, p, _ in own), sum(y == 1 and p != 1 for _, y, p, _ in own)
        assert got[g].n_rows == len(own) and got[g].f1 == pytest.approx(2 * tp / (2 * tp + fp + fn) if tp + fp + fn else 0)
    assert metrics.classification_metrics(df.limit(0), ["g"]).count() == 0


def test_metrics_long_equals_its_slices(spark):
    rng = np.random.default_rng(4)
    rows = [(f"S{r % 3}__{r}", f"2000-0{m}-03", int(rng.integers(0, 2)), 1.0, model, ds, float(rng.uniform()),
             int(rng.integers(0, 2)), seed, f"S{r % 3}") for r in range(9) for m in (1, 2) for model in ("m", "n")
            for ds in ("in_domain", "out_domain") for seed in (0, 1)]
    p = spark.createDataFrame(rows, "region_id string, time_id string, y int, y_count double, model string, dataset string, "
                                    "y_score double, y_pred int, seed int, crime_group string")
    got = {(r["slice"], r.domain, r.model, r.seed, r.crime_group, r.date_bucket, r.metric):
           r.value for r in metrics.metrics_long(p, 7).collect()}
    want = {}
    for r in metrics.overall_by_seed(p).collect():
        want |= {("overall", r.domain, r.model, r.seed, "", "", m): r[m] for m in metrics.METRICS4}
    for r in metrics.temporal_f1_by_seed(p).collect():
        want["temporal", r.domain, r.model, r.seed, "", r.date_bucket, "f1"] = r.value
    for r in metrics.group_metrics_by_seed(p).collect():
        want["crime_group", r.domain, r.model, r.seed, r.crime_group, "", r.metric] = r.value
    for r in metrics.neighbor_metrics_by_seed(p).collect():
        want["neighbor_overall", r.domain, r.model, r.seed, "", "", r.neighbor_metric] = r.value
    assert got.keys() == want.keys() and all(got[k] == (None if v is None else pytest.approx(v)) for k, v in want.items())
    one = metrics.metrics_long(p.withColumn("crime_group", F.lit("only")), 7)
    assert one.filter("slice = 'crime_group'").count() == 0
    assert metrics.metrics_long(p.drop("crime_group"), 7).filter("slice = 'crime_group'").count() == 0
