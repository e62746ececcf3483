"""Operator fixtures: EWMA, thresholds, AUC, buckets, Top-K, region stats,
one-hot, serving, cube (hand-computed expectations)."""

import datetime as dt
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskbeacon.operators import cube, features, labels, metrics, panel, prep, serving, topk
from riskbeacon.plans.store import materialize


def test_ewma_scan_matches_recursion(spark):
    xs = [1, 4, 9, 16, 25]
    df = spark.createDataFrame([("r", i, x) for i, x in enumerate(xs)], "region_id string, t int, x int")
    got = [r.e for r in features.ewma_scan(df, {"x": "e"}, ["region_id"], "t", len(xs)).orderBy("t").collect()]
    assert got == pytest.approx([1, 2.2, 4.92, 9.352, 15.6112])


def test_ewma_scan_long_series_equals_loop(spark):
    xs = [(i * 7919) % 23 for i in range(300)]
    df = spark.createDataFrame([("r", i, x) for i, x in enumerate(xs)], "region_id string, t int, x int")
    got = [r.e for r in features.ewma_scan(df, {"x": "e"}, ["region_id"], "t", len(xs)).orderBy("t").collect()]
    e, exp = None, []
    for x in xs:
        e = float(x) if e is None else 0.6 * e + 0.4 * x
        exp.append(e)
    assert got == pytest.approx(exp, rel=1e-12)


def test_windows_are_summed_from_days(spark):
    """Late hours, days before the anchor, and rows without date or region: as if each event were binned."""
    at = [dt.datetime(2014, 12, 31, 23, 59, 59) + dt.timedelta(hours=7 * i) for i in range(60)]
    groups = ["robbery", "burglary", None]
    rows = [(t, "AB"[i % 2], groups[i % 3]) for i, t in enumerate(at)] + [(None, "A", "robbery"), (at[0], None, "robbery")]
    days = panel.day_counts(spark.createDataFrame(rows, "event_date timestamp, region_id string, crime_group string"),
                            "2015-01-05")
    for w in (7, 3):
        want = {}
        for t, region, g in rows[:-2]:
            want.setdefault((region, labels.window_of(t, w)), []).append((t, g))
        got = {(r.region_id, r.time_id): r for r in panel.window_counts(days, w).collect()}
        assert got.keys() == want.keys()
        for k, ev in want.items():
            assert (got[k]["count"], got[k].count_grp_robbery) == (len(ev), sum(g == "robbery" for _, g in ev))
            assert got[k].last_date == max(t for t, _ in ev)
            assert got[k].first_from == min((t for t, _ in ev if t >= dt.datetime(2015, 1, 5)), default=None)


def test_threshold(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 10]], "y_count double")
    assert labels.compute_threshold(df) == 5  # q75 = 4.75 -> ceil 5
    zeros = spark.createDataFrame([(0.0,)] * 4, "y_count double")
    assert labels.compute_threshold(zeros) == 1


def _brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


def test_auc_with_ties_and_one_class(spark):
    rows = [(1, 0.9), (0, 0.9), (1, 0.5), (0, 0.1), (0, 0.5), (1, 0.7), (0, 0.7), (1, 0.2)]
    df = spark.createDataFrame([("a", y, 1 if s >= 0.5 else 0, s) for y, s in rows],
                               "g string, y int, y_pred int, y_score double")
    one = spark.createDataFrame([("b", 1, 0, 0.3), ("b", 1, 0, 0.4)], "g string, y int, y_pred int, y_score double")
    m = {r.g: r for r in metrics.classification_metrics(df.unionByName(one), ["g"]).collect()}
    assert m["a"].auc == pytest.approx(_brute_auc(rows))
    assert m["b"].auc is None and m["b"].f1 == 0.0
    # AUC(score) = 1 - AUC(-score)
    neg = metrics.classification_metrics(df.withColumn("y_score", -F.col("y_score")), ["g"]).first().auc
    assert neg == pytest.approx(1 - m["a"].auc)


@pytest.mark.parametrize("n_regions,sizes", [(10, [3, 2, 2, 3]), (1, [1]), (3, [1, 1, 1])])
def test_region_buckets_match_qcut(spark, n_regions, sizes):
    rows = [(f"R{i:02d}", "t", 0, float(i), "out_domain") for i in range(n_regions)]
    df = spark.createDataFrame(rows, "region_id string, time_id string, y int, y_count double, dataset string")
    keep = lambda d, name: materialize(spark, d, name)
    got = metrics.region_buckets(df, keep).groupBy("region_bucket").count().orderBy("region_bucket").collect()
    assert [r["count"] for r in got] == sizes


def _preds(spark, rows):
    return spark.createDataFrame(
        rows, "dataset string, seed int, model string, time_id string, region_id string, y_score double, "
              "y_count double, y int, y_pred int")


def test_topk_ties_and_zero_window(spark):
    t1, t2 = "2025-01-06", "2025-01-13"
    rows = [("in_domain", 0, "m", t1, r, 1.0, c, 0, 0) for r, c in [("B", 5.0), ("A", 1.0), ("C", 4.0)]]
    rows += [("in_domain", 0, "m", t2, r, 0.5, 0.0, 0, 0) for r in ["A", "B", "C"]]
    p = _preds(spark, rows)
    cov = {r.k: r.coverage for r in topk.topk_coverage_by_seed(p, k_candidates=(5, 10), domains=["in_domain"])
           .collect()}
    # no candidate fits 3 regions -> K = 3; window t2 has no incidents -> NULL, skipped
    assert list(cov) == [3] and cov[3] == pytest.approx(1.0)
    cov2 = {r.k: r.coverage for r in topk.topk_coverage_by_seed(p, k_candidates=(1, 2), domains=["in_domain"])
            .collect()}
    assert cov2[1] == pytest.approx(0.1) and cov2[2] == pytest.approx(0.6)
    s = serving.serving_frame(p.withColumn("time_window_days", F.lit(7)), 0)
    table, stats = serving.topk_for_time(s, 7, "in_domain", "m", t2, 10)
    st = stats.first()
    assert st.k == 3 and st.coverage_at_k == 0.0  # serving reports 0 where E19 gives NULL
    assert [r.region_id for r in table.orderBy("rank").collect()] == ["A", "B", "C"]


def test_region_stats_unseen_defaults(spark):
    train = spark.createDataFrame([("A", 2.0), ("A", 4.0), ("B", 7.0)], "region_id string, lag_0 double")
    stats = labels.region_train_stats(train)
    df = spark.createDataFrame([("A",), ("B",), ("Z",)], "region_id string")
    got = {r.region_id: r for r in labels.apply_region_stats(df, stats).collect()}
    assert got["B"].region_train_std == 0.0 and got["B"].region_seen_in_train == 1.0
    assert got["Z"].region_seen_in_train == 0.0
    assert got["Z"].region_train_mean == pytest.approx((3.0 + 7.0) / 2)
    assert got["Z"].region_train_count == pytest.approx(1.5)


def test_one_hot_vocabulary(spark, monkeypatch):
    train = spark.createDataFrame([(" a ",), (None,), ("b",)], "c string")
    table = prep.vocabulary(train, "c", lambda d, name: materialize(spark, d, name))
    vocab = prep.dense_names(table)
    assert vocab == ["__MISSING__", "a", "b"]
    test = spark.createDataFrame([("a",), ("zz",), (None,)], "c string")
    got = [tuple(r[1:]) for r in prep.one_hot(test, "c", vocab).collect()]
    assert got == [(0.0, 1.0, 0.0), (0.0, 0.0, 0.0), (1.0, 0.0, 0.0)]
    assert [r["index"] for r in prep.one_hot_sparse(test, "c", table).collect()] == [1, None, 0]
    monkeypatch.setattr(prep, "MAX_COLUMNS", 2)
    with pytest.raises(ValueError):
        prep.dense_names(table)
    assert prep.dense_names(prep.vocabulary(train.limit(0), "c", None)) == ["__MISSING__"]


def test_vocabulary_of_a_million(spark):
    """No bound on the categories: ranks of ranges equal the sorted order."""
    train = spark.range(0, 1_000_000, 1, 8).select(F.md5(F.col("id").cast("string").cast("binary")).alias("c"))
    vocab = prep.vocabulary(train, "c", lambda d, name: materialize(spark, d, name))
    want = np.sort(np.array([r.c for r in train.collect()]))
    got = vocab.toPandas().sort_values("index")
    assert (got["index"].to_numpy() == np.arange(1_000_000)).all() and (got["category"].to_numpy() == want).all()


def test_sequences_left_padded(spark):
    df = spark.createDataFrame([("r", f"t{i}", float(i)) for i in range(3)], "region_id string, time_id string, x double")
    got = prep.sequences(df, ["x"], 4).orderBy("time_id").collect()
    assert got[0].sequence == [[0.0], [0.0], [0.0], [0.0]]
    assert got[2].sequence == [[0.0], [0.0], [1.0], [2.0]]


def test_cube_edges(spark):
    rows = [(2019, 3, "THEFT", True), (2021, 3, "THEFT", False), (2021, 5, "ARSON", False)]
    df = spark.createDataFrame(rows, "Year int, Hour int, `Primary Type` string, Arrest boolean")
    y = cube.yoy(df).first()
    assert y.latest_year == 2021 and y.prev_count is None and y.yoy_delta is None  # 2020 missing
    rates = cube.arrest_rate_by_type(df, 5).collect()
    assert {r["Primary Type"] for r in rates} == {"THEFT"}  # ARSON has no arrest -> dropped
    hours = cube.dense_counts(spark, df, "Hour").collect()
    assert len(hours) == 24 and sum(r["count"] for r in hours) == 3


def test_outliers_population_std(spark):
    rows = [(i, 10) for i in range(10)] + [(10, 100)]
    df = spark.createDataFrame(rows, "x int, count int")
    got = cube.outliers(df, "x").collect()
    assert len(got) == 1 and got[0].x == 10 and got[0].is_outlier and got[0].is_peak


def test_split_excludes_straddling_window(spark):
    t = [dt.date(2024, 12, 16), dt.date(2024, 12, 23), dt.date(2024, 12, 30), dt.date(2025, 1, 6)]
    df = spark.createDataFrame([(d, d + dt.timedelta(days=7)) for d in t], "time_id date, next_time date")
    tr, te = labels.split_train_test(df, dt.date(2024, 12, 30), dt.date(2025, 1, 13))
    assert [r.time_id for r in tr.collect()] == [dt.date(2024, 12, 16)]
    assert [r.time_id for r in te.orderBy("time_id").collect()] == [dt.date(2024, 12, 30), dt.date(2025, 1, 6)]


def test_stratified_sample_quotas(spark):
    rows = [("R", f"2025-01-{d:02d}", 1.0 * i, 2.0, cls) for d in range(1, 29)
            for i, cls in enumerate(["Miss"] * 8 + ["Exact hit"] * 2)]
    df = spark.createDataFrame(rows, "region_id string, event_date string, latitude double, longitude double, "
                                     "coverage_class string")
    from riskbeacon.operators import spatial
    got = {r.coverage_class: r["count"] for r in spatial.stratified_sample(df, n=50).groupBy("coverage_class")
           .count().collect()}
    # 280 rows, n = 50: quotas floor(224 * 50 / 280) = 40 and floor(56 * 50 / 280) = 10
    assert got == {"Miss": 40, "Exact hit": 10}
