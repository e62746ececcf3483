"""Hull candidates, the neighbour grid, and the model that the metrics choose."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskbeacon.operators import metrics, neighbors, spatial
from riskbeacon.plans.store import materialize


def keeper(spark):
    return lambda df, name: materialize(spark, df, f"test-{name}")


def cloud(rng, n):
    """A wide cluster, a very dense one, scattered places, repeated places and far outliers."""
    parts = [rng.normal(0, 1, (n // 3, 2)), rng.normal(50, 1e-4, (n // 3, 2)), rng.uniform(-1e3, 1e3, (n // 6, 2)),
             np.repeat(rng.uniform(0, 9, (5, 2)), n // 60, 0), [[1e6, 1e6], [-1e6, 3.0]]]
    return np.vstack(parts)


def regions(spark, xy, rng):
    ids = np.array([f"R{i:06d}" for i in rng.permutation(len(xy))])
    return ids, spark.createDataFrame(pd.DataFrame({"region_id": ids, "lon": xy[:, 0], "lat": xy[:, 1]}))


def test_nearest_against_all_distances(spark):
    rng = np.random.default_rng(1)
    line = np.column_stack((np.arange(30.0), np.zeros(30)))
    for xy in (cloud(rng, 600), np.vstack((rng.integers(0, 4, (50, 2)), 100 + line)), np.zeros((12, 2)), np.zeros((1, 2))):
        ids, df = regions(spark, xy, rng)
        got = {(r.region_id, r.nn_rank): (r.neighbor_id, pytest.approx(r.distance, rel=1e-12))
               for r in neighbors.nearest(spark, df, 3, keeper(spark)).collect()}
        want = {}
        for i in range(len(xy)):
            d = np.hypot(*(xy - xy[i]).T)
            near = [j for j in np.lexsort((ids, d)) if j != i][:3]
            want |= {(ids[i], k + 1): (ids[j], d[j]) for k, j in enumerate(near)}
        assert got == want
    assert neighbors.nearest(spark, df.limit(0), 3, keeper(spark)).count() == 0


def test_candidates_grow_with_the_regions(spark, monkeypatch):
    counted = []
    plain = neighbors._candidates
    monkeypatch.setattr(neighbors, "_candidates", lambda a, i: counted.append(plain(a, i)) or counted[-1])
    shares = []
    for n in (600, 4800):
        rng = np.random.default_rng(2)
        xy = cloud(rng, n)
        _, df = regions(spark, xy, rng)
        counted.clear()
        entries = df.selectExpr("lon", "lat", "region_id AS id")
        neighbors.site_candidates(entries.select("lon", "lat").distinct(), entries, 3, keeper(spark))
        shares.append(sum(c.count() for c in counted) / len(xy))
    assert shares[1] < 2.5 * shares[0] and shares[1] < 4800 / 8  # all pairs: 8 times as many


def test_most_points_stay_out_of_python(spark):
    rng = np.random.default_rng(3)
    rows = [("big", float(x), float(y)) for x, y in rng.normal(0, 1, (4000, 2))]
    rows += [("line", float(i), 2.0 * i) for i in range(10)] + [("dot", 1.0, 1.0)] * 5 + [("two", 0.0, 0.0), ("two", 1.0, 3.0)]
    df = spark.createDataFrame(rows, "region_id string, longitude double, latitude double")
    sent = {r.region_id: r["count"] for r in spatial.hull_candidates(df).groupBy("region_id").count().collect()}
    assert sent["big"] < 400 and sent["line"] == 10 and sent["dot"] == 5 and sent["two"] == 2
    got = spatial.convex_hulls(df).orderBy("region_id", "vertex").collect()
    for rid in ("big", "line", "dot", "two"):
        own = np.array([(x, y) for r, x, y in rows if r == rid])
        assert np.array_equal([(r.longitude, r.latitude) for r in got if r.region_id == rid], spatial.hull(*own.T))


def predictions(spark, best):
    """Three models; only ``best`` predicts the positives, and ranks them first."""
    rows = []
    for m in metrics.MODEL_ORDER:
        for seed in (2, 1):
            for t in ("2000-01-03", "2000-01-10"):
                for r in range(6):
                    y = int(r < 2)
                    hit = y if m == best else 1 - y
                    rows.append((f"R{r}", t, y, float(y), m, "in_domain", 0.9 * hit + 0.01 * r, hit, seed))
                    rows.append((f"R{r}", t, y, float(y), m, "out_domain", 0.5, 1 - hit, seed))
    return spark.createDataFrame(rows, "region_id string, time_id string, y int, y_count double, model string, "
                                       "dataset string, y_score double, y_pred int, seed int")


def test_hits_follow_the_best_model(spark):
    knn = spark.createDataFrame([(f"R{r}", f"R{(r + 5) % 6}", 1.0, 1) for r in range(6)],
                                "region_id string, neighbor_id string, distance double, nn_rank int")
    events = spark.createDataFrame([(f"R{r}", 1.0, 2.0, dt.datetime(2000, 1, 12)) for r in range(6)] + [(None, 1.0, 2.0, None)],
                                   "region_id string, latitude double, longitude double, event_date timestamp")
    for best in metrics.MODEL_ORDER:
        pred = predictions(spark, best)
        chosen = metrics.chosen_model(pred)
        assert [tuple(r) for r in chosen.collect()] == [(best, 1)]
        hits = spatial.event_hit_classes(events, pred, knn, 7, chosen, k=2)
        got = {r.region_id: r.coverage_class for r in hits.collect()}
        # the windows' best two are R0 and R1; R2's neighbor is R1
        assert got == {"R0": "Exact hit", "R1": "Exact hit", "R2": "Neighbor hit", "R3": "Miss", "R4": "Miss", "R5": "Miss"}
        one = spatial.hit_summary(hits, 7, chosen, 2).first()
        assert (one.model, one.seed, one.n_events_total) == (best, 1, 6) and one.exact_hit_rate == 2 / 6
        rates = {r.region_id: r for r in spatial.exact_neighbor_rates(pred, knn, chosen).collect()}
        assert rates["R0"].exact_hit_rate == 1.0 and rates["R2"].pred_positive_rate == 0.0
    nothing = metrics.chosen_model(predictions(spark, "ewma").limit(0))
    assert [tuple(r) for r in nothing.collect()] == [(metrics.MODEL_ORDER[0], 0)]


def test_sample_filters_before_the_exchange(spark):
    hits = spark.range(0, 20000, 1, 8).select(
        F.concat(F.lit("R"), F.col("id") % 9).alias("region_id"), F.timestamp_seconds(F.col("id")).alias("event_date"),
        (F.col("id") / 7).alias("latitude"), (F.col("id") / 3).alias("longitude"),
        F.when(F.col("id") % 100 < 90, "Miss").when(F.col("id") == 5099, "Exact hit").otherwise("Neighbor hit").alias("coverage_class"))
    got = spatial.stratified_sample(hits, n=500).select(hits.columns)
    counts = {r.coverage_class: r["count"] for r in got.groupBy("coverage_class").count().collect()}
    assert counts["Miss"] == 450 and counts["Exact hit"] == 1 and sum(counts.values()) == 500
    smallest = hits.filter("coverage_class = 'Miss'").orderBy(spatial.sample_key(42)).limit(450)
    assert got.filter("coverage_class = 'Miss'").exceptAll(smallest).count() == 0
    assert spatial.stratified_sample(hits, n=30000).count() == 20000
    assert spatial.stratified_sample(hits.limit(0)).count() == 0
