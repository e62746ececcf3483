"""Published runs: newest valid run, pruning, unfinished runs, seeds without rows; threshold maps; CSV trees."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskbeacon.operators import predict, runs, serving
from riskbeacon.sources import readers

COLS = ("time_window_days int, region_id string, time_id string, y int, y_count double, model string, dataset string, "
        "y_score double, y_pred int, seed int")


def pred(spark, score, windows=(7, 3), seeds=(0, 1)):
    return spark.createDataFrame(
        [(w, f"R{r}", "2000-06-05", r % 2, float(r), m, d, score + r / 100, 1, s) for w in windows for s in seeds
         for m in ("m", "n") for d in ("in_domain", "out_domain") for r in range(4)], COLS)


def day(n):
    return dt.datetime(2001, 1, n)


def test_newest_valid_run_is_served(spark, tmp_path):
    store = str(tmp_path / "store")
    runs.publish(pred(spark, 1.0), store, "a", day(1))
    runs.publish(pred(spark, 2.0), store, "b", day(3))
    runs.publish(pred(spark, 3.0, windows=(7,)), store, "c", day(4))  # a window is missing
    runs.write_rows(pred(spark, 4.0), store, "d")                     # never committed
    served = runs.serving(spark, store)
    assert {int(r.y_score) for r in served.select("y_score").collect()} == {2} and served.count() == 32
    assert runs.newest(spark, store).first().run == "b"
    assert {(r.time_window_days, r.seed, r.n_rows) for r in runs.partitions(spark, store).collect()} == {
        (w, s, 4) for w in (7, 3) for s in (0, 1)}
    runs.commit(spark, store, "d", day(5))
    assert {int(r.y_score) for r in runs.serving(spark, store).select("y_score").collect()} == {4}
    assert {r.seed for r in runs.serving(spark, store, seed=1).select("seed").collect()} == {1}


def test_look_ups_prune_partitions(spark, tmp_path):
    store = str(tmp_path / "store")
    for k in range(3):
        runs.publish(pred(spark, float(k)), store, f"r{k}", day(k + 1))
    s = runs.serving(spark, store)
    wanted = s.filter("time_window_days = 7 AND dataset = 'in_domain' AND model = 'm'")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = wanted._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = plan[plan.index("PartitionFilters"):]
    assert "dynamicpruning" in filters
    for c in ("time_window_days", "dataset", "model", "seed"):
        assert c in filters[:filters.index("PushedFilters")]
    table, _ = serving.topk_for_time(s, 7, "in_domain", "m", "2000-06-05", 2)
    assert [r.region_id for r in table.orderBy("rank").collect()] == ["R3", "R2"]


def test_missing_runs_and_seeds_raise(spark, tmp_path):
    store = str(tmp_path / "store")
    runs.publish(pred(spark, 1.0, windows=(7,)), store, "a", day(1))
    with pytest.raises(ValueError, match="no valid run"):
        runs.serving(spark, store)
    runs.publish(pred(spark, 1.0).filter("NOT (seed = 1 AND time_window_days = 3)"), store, "b", day(2))
    assert runs.serving(spark, store).count() == 32
    with pytest.raises(ValueError, match="seed 1 for the 3-day"):
        runs.serving(spark, store, seed=1)
    with pytest.raises(ValueError, match="missing required columns"):
        runs.publish(pred(spark, 1.0).drop("y_score"), store)


def test_thresholds_by_group(spark):
    xy = spark.createDataFrame([("R", "t", 1, 3.0, g, 3.0) for g in ("a", "b", "z", None)],
                               "region_id string, time_id string, y int, y_count double, crime_group string, lag_0 double")
    specs = [("baseline_persistence", 0, "lag_0")]

    def got(df, thr):
        return [r.y_pred for r in predict.predictions_long(df, "in_domain", thr, specs).collect()]
    assert got(xy, 3) == [1, 1, 1, 1]
    assert got(xy, {"a": 2, "b": 4}) == [1, 0, 0, 0]
    assert got(xy, {}) == [1, 1, 1, 1] and got(xy.drop("crime_group"), {"a": 2, "b": 4}) == [0, 0, 0, 0]
    assert {(s, c) for m, s, c in predict.scorer_specs() if m == "baseline_persistence"} == {(s, "lag_0") for s in (0, 1, 2)}


def test_each_file_has_its_encoding(spark, tmp_path):
    root = tmp_path / "t.csv"
    root.mkdir()
    (root / "a.csv").write_bytes("id,Straße\n1,caf\xe9\n2,Ã©\n".encode("utf-8"))
    (root / "b.csv").write_bytes("id,Straße\n3,caf\xe9\n4,plain\n".encode("latin-1"))
    (root / "c.csv").write_bytes("﻿id,Straße\n5,日本\n6,\n".encode("utf-8"))
    got = {}
    for f in ("a.csv", "b.csv", "c.csv"):
        df = readers.read_csv_flexible(spark, str(root / f))
        assert df.columns == ["id", "Straße"]
        got |= {r.id: r["Straße"] for r in df.collect()}
    assert got == {"1": "caf\xe9", "2": "Ã©", "3": "caf\xe9", "4": "plain", "5": "日本", "6": None}
    both = readers.read_csv_flexible(spark, [str(root / "a.csv"), str(root / "b.csv")], columns=["Straße"], keep_file="at")
    assert sorted(r["Straße"] for r in both.collect()) == sorted(["caf\xe9", "Ã©", "caf\xe9", "plain"])
    assert both.select(F.element_at(F.split("at", "/"), -1)).distinct().count() == 2


def test_tables_of_part_files(spark, tmp_path):
    for n in readers.NATIONAL_TABLES:
        spark.range(0, 20, 1, 3).selectExpr("id AS x").write.option("header", True).csv(f"{tmp_path}/raw/s1/{n}")
    spark.range(3).write.option("header", True).csv(f"{tmp_path}/raw/s2/{readers.NATIONAL_TABLES[0]}")
    found = readers.discover_inputs(spark, f"{tmp_path}/raw").collect()
    assert [(r.role, r.path.rsplit("/", 1)[1]) for r in found] == [("national_root", "s1")]
    t = {(r.name, r.parent.rsplit("/", 1)[1]): r.n_files for r in readers.list_tables(spark, f"{tmp_path}/raw").collect()}
    assert t["agencies.csv", "s1"] == 3 and len(t) == 5
    assert all(df.count() == 20 for df in readers.read_national(spark, [found[0].path]).values())
