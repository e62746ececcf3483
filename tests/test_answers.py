"""Answers that small tables decide: ties, caps, labels, densified views, fallbacks."""

import datetime as dt
import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskbeacon.functions.sample import seeded_sample
from riskbeacon.operators import cube, harmonize, labels, metrics, models, serving, spatial, support, tables
from riskbeacon.sources import readers


def test_importance_ties_go_by_feature_name(spark):
    rows = [(7, s, "in", "persistence", f, 1.0 if f == "lag_0" else 0.0, "m") for s in (0, 1)
            for f in ("week", "lag_0", "cos", "ewma")]
    by_seed = spark.createDataFrame(rows, "window int, seed int, dataset string, model string, feature string, "
                                          "importance_norm double, method string").withColumn("importance_raw",
                                                                                              F.col("importance_norm"))
    got = support.summarize_importance(by_seed).orderBy("rank_in_model").collect()
    assert [r.feature for r in got] == ["lag_0", "cos", "ewma", "week"]
    assert all(r.importance_norm_std == 0.0 and r.seed_n == 2 for r in got)


def test_hit_summary_counts_the_sample(spark):
    rows = [("Exact hit", True, False)] * 100 + [("Neighbor hit", False, True)] * 150 + [("Miss", False, False)] * 30
    hits = spark.createDataFrame(rows, "coverage_class string, exact_hit boolean, neighbor_hit boolean")
    hits = (hits.withColumn("region_id", F.lit("r")).withColumn(
        "event_date", F.timestamp_seconds(F.monotonically_increasing_id()))
            .withColumn("latitude", F.lit(1.0)).withColumn("longitude", F.lit(1.0)))
    chosen = spark.createDataFrame([("m", 0)], "model string, seed int")
    for n in (53, 280, 1000):
        r = spatial.hit_summary(hits, 7, chosen, sample_n=n).first()
        assert r.n_events_total == 280
        assert r.n_events_sampled_for_plot == spatial.stratified_sample(hits, n).count()
        assert abs(r.exact_hit_rate - 100 / 280) < 1e-12 and abs(r.neighbor_aware_hit_rate - 250 / 280) < 1e-12
    assert spatial.hit_summary(hits, 7, chosen, sample_n=53).first().n_events_sampled_for_plot == 18 + 28 + 5


def test_area_labels(spark):
    df = spark.createDataFrame([("IL__CPD_DIST_007", "in_domain"), ("IL__CPD_DIST_000", "in_domain"),
                                ("TX__TX123", "out_domain"), ("plain", "out_domain")], "region_id string, dataset string")
    df = df.withColumn("time_id", F.lit("2025-01-06"))
    got = {r.region_id: r.area_label for r in serving.friendly_labels(df, 7).collect()}
    assert got == {"IL__CPD_DIST_007": "Chicago District 7 [IL__CPD_DIST_007]",
                   "IL__CPD_DIST_000": "Chicago District 0 [IL__CPD_DIST_000]",
                   "TX__TX123": "TX Agency TX123 [TX__TX123]", "plain": "plain"}


def test_compare_series_views(spark):
    df = spark.createDataFrame([("a", 2015, 1, 3), ("a", 2017, 2, 3), ("b", 2016, 12, 0), ("c", 2018, 5, 5)],
                               "`Primary Type` string, Year int, Month int, Hour int")
    for view, buckets in (("Monthly", 12), ("Hourly", 24), ("Yearly", 4)):
        got = cube.compare_series(spark, df, "Primary Type", ["a", "b"], view).collect()
        assert len(got) == 2 * buckets and sum(r["count"] for r in got) == 3
    with pytest.raises(ValueError):
        cube.compare_series(spark, df, "Primary Type", ["a", "b", "c"], "Monthly")


def test_rows_without_an_agency_have_no_state(spark):
    off = spark.createDataFrame([(1, "13A"), (2, "13A")], "incident_id int, offense_code string")
    inc = spark.createDataFrame([(1, 10, "2020-01-01"), (2, 99, "2020-01-02")],
                                "incident_id int, agency_id int, incident_date string")
    typ = spark.createDataFrame([("13A", "Aggravated Assault", "Assault Offenses")],
                                "offense_code string, offense_name string, offense_category_name string")
    ag = spark.createDataFrame([(10, "co", "X")], "agency_id int, state_abbr string, county_name string")
    rule = harmonize.RegionStrategy("county", "county_name", "agency_id", "")
    got = {r.region_id: r.source_state for r in harmonize.national_events(off, inc, typ, ag, rule).collect()}
    assert set(got.values()) == {"co", None}
    got = harmonize.national_events(off, inc, typ, ag.drop("state_abbr"), rule).collect()
    assert {r.source_state for r in got} == {"UNK"}


def test_region_rules(spark):
    def decide(values, names):
        schema = ", ".join(f"{n} string" for n in names)
        s = harmonize.decide_region_strategy(spark.createDataFrame([tuple(values)], schema))
        return s.strategy, s.primary_field, s.fallback_field
    assert decide(["1", "o"], ["agency_id", "ori"]) == ("agency", "agency_id", "ori")
    assert decide([None, "o"], ["agency_id", "ori"]) == ("agency", "ori", "agency_id")
    assert decide(["u"], ["pub_agency_unit"]) == ("agency", "pub_agency_unit", None)
    assert decide([None, "c"], ["agency_id", "county_name"]) == ("county", "county_name", "agency_id")
    assert decide([None, "IL"], ["agency_id", "state_abbr"]) == ("state_agency", "state_abbr", "agency_id")


def test_encoding_falls_back_file_by_file(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("name\ncafé\n".encode("utf-8"))
    (tmp_path / "b.csv").write_bytes("name\nolé\n".encode("latin-1"))
    got = sorted(r["name"] for r in readers.read_csv_flexible(spark, str(tmp_path)).collect())
    assert got == ["café", "olé"]


def test_unknown_sizes_and_models_are_errors(spark):
    with pytest.raises(ValueError):
        labels.window_of(dt.date(2020, 1, 1), 5)
    train = spark.createDataFrame([(0,)], "y int")
    from riskbeacon.config import FEATURE_NUMERIC
    for f in FEATURE_NUMERIC:
        train = train.withColumn(f, F.lit(0.0))
    with pytest.raises(ValueError):
        models.fit_grid(train, {}, "/nowhere", None, models=("no such model",))


def test_hull_holds_all_points():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 5, 40, 400):
        p = rng.integers(0, 12, (n, 2)).astype(float)
        h = spatial.hull(p[:, 0], p[:, 1])
        assert {tuple(v) for v in h} <= {tuple(v) for v in p} and tuple(h[0]) == min(map(tuple, p))
        if len(h) > 2:
            for a, b in zip(h, np.roll(h, -1, axis=0)):
                side = (b[0] - a[0]) * (p[:, 1] - a[1]) - (b[1] - a[1]) * (p[:, 0] - a[0])
                assert (side >= 0).all()
                on = p[side == 0]
                lo, hi = np.minimum(a, b), np.maximum(a, b)
                assert ((on >= lo) & (on <= hi)).all()  # edges run from vertex to vertex


def test_knn_against_all_distances(spark):
    rng = np.random.default_rng(1)
    p = rng.integers(0, 6, (40, 2))
    df = spark.createDataFrame([(f"r{i:02d}", float(x), float(y)) for i, (x, y) in enumerate(p)],
                               "region_id string, lon double, lat double")
    got = {(r.region_id, r.nn_rank): r.neighbor_id for r in spatial.knn_graph(spark, df, 3).collect()}
    for i in range(40):
        near = sorted((np.hypot(*(p[i] - p[j])), f"r{j:02d}") for j in range(40) if j != i)[:3]
        assert [got[f"r{i:02d}", k + 1] for k in range(3)] == [n for _, n in near]


def test_serving_raises_when_nothing_matches(spark):
    rows = [(7, "IL__CPD_DIST_007", "2000-06-05", 1, 4.0, "m", "in_domain", 0.9, 1, 0)]
    s = spark.createDataFrame(rows, "time_window_days int, region_id string, time_id string, y int, y_count double, "
                                    "model string, dataset string, y_score double, y_pred int, seed int")
    assert serving.single_prediction(s, 7, "in_domain", "m", "IL__CPD_DIST_007", "2000-06-05").count() == 1
    with pytest.raises(ValueError):
        serving.single_prediction(s, 7, "in_domain", "m", "IL__CPD_DIST_007", "2000-06-12")
    with pytest.raises(ValueError):
        serving.topk_for_time(s, 3, "in_domain", "m", "2000-06-05", 5)
    assert serving.topk_for_time(s, 7, "in_domain", "m", "2000-06-05", 5)[0].count() == 1


def test_unmapped_share_of_both_sources(spark):
    city = spark.createDataFrame([(" theft ",), ("BURGLARY",), ("GAMBLING",), (None,)], "kind string")
    offense = spark.createDataFrame([("23A",), ("220",), ("99Z",), ("120",), ("99Z",)], "offense_code string")
    types = spark.createDataFrame([("23A", "Pocket-picking", "Larceny/Theft Offenses"), ("99Z", "Other", "Other")],
                                  "offense_code string, offense_name string, offense_category_name string")
    got = {r["source"]: (r["unmapped_ratio"], r["n_rows"])
           for r in harmonize.unmapped_by_source(city, "kind", offense, types).collect()}
    assert got["city"] == (0.5, 4)
    assert got["national"][1] == 5 and abs(got["national"][0] - 0.4) < 1e-12  # 220 and 120 map by code alone


def test_wide_results_fill_missing_cells(spark):
    ml = spark.createDataFrame([("m", "in_domain", "overall", "auc", 0.5), ("m", "in_domain", "overall", "auc", 0.7),
                                ("m", "in_domain", "neighbor_overall", "f1", 0.9)],
                               "model string, domain string, slice string, metric string, value double")
    row = tables.results_wide(ml).collect()[0]
    assert row["in_domain_auc"] == "0.600 ± 0.141"
    assert row["in_domain_f1"] == "NA" and row["out_domain_auc"] == "NA"


def test_seeded_sample_has_n_rows_and_repeats(spark):
    df = spark.range(0, 5000, 1, 16).withColumn("v", F.col("id") % 7)
    for n in (1, 700, 5000, 9000):
        got = sorted(r.id for r in seeded_sample(df, n, 42, ["id"]).collect())
        want = sorted(range(5000), key=lambda i: hashlib.md5(f"42|{i}".encode()).hexdigest())[:n]
        assert got == sorted(want)
    same = df.select(F.lit(1).alias("v"))
    assert seeded_sample(same, 10).count() == 10
    assert seeded_sample(df.limit(0), 10).count() == 0


def test_group_labels_and_their_default(spark):
    thr = spark.createDataFrame([("A", 2), ("B", 5)], "crime_group string, threshold int")
    df = spark.createDataFrame([("A", 2.0), ("A", 1.0), ("B", 4.0), ("C", 4.0), ("C", 5.0), (None, 6.0), ("A", None)],
                               "crime_group string, y_count double")
    got = Counter((r.crime_group, r.y_count, r.y) for r in labels.add_label_by_group(df, thr).collect())
    assert got == Counter([("A", 2.0, 1), ("A", 1.0, 0), ("B", 4.0, 0), ("C", 4.0, 0), ("C", 5.0, 1), (None, 6.0, 1),
                           ("A", None, 0)])
    one = labels.add_label_by_group(df, thr.limit(0), default_threshold=4).filter("crime_group = 'C'").collect()
    assert [r.y for r in one] == [1, 1]


def test_coverage_and_completeness_report_what_is_missing(spark):
    pred = spark.createDataFrame([(0, "in_domain", "m")] * 3 + [(1, "in_domain", "m")] * 2 + [(0, "other", "m")],
                                 "seed int, dataset string, model string")
    expected = spark.createDataFrame([("in_domain", 3)], "dataset string, expected_rows long")
    got = {(r.seed, r.dataset): (r.n_rows, r.expected_rows) for r in models.prediction_coverage(pred, expected).collect()}
    assert got == {(1, "in_domain"): (2, 3), (0, "other"): (1, None)}
    ml = spark.createDataFrame([("m", 0, d, "overall", k) for d in ("in_domain", "out_domain")
                                for k in ("auc", "f1", "precision", "recall") if (d, k) != ("out_domain", "f1")],
                               "model string, seed int, domain string, slice string, metric string")
    missing = metrics.metrics_completeness(spark, ml, ["m"], (0,)).collect()
    assert [(r.model, r.seed, r.domain, r.metric) for r in missing] == [("m", 0, "out_domain", "f1")]
