"""Edge fixtures for the column expressions."""

import datetime as dt

from pyspark.sql import functions as F

from riskbeacon.functions.expr import clean_region_token, map_city_type, map_offense, region_state, time_bin


def _col(spark, values, dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {dtype}")


def test_region_token_order_matters(spark):
    vals = [None, "", " 12.0 ", "NAN", "nan", "unknown", "cook", "7.0.0"]
    got = [r[0] for r in _col(spark, vals).select(clean_region_token("v")).collect()]
    assert got == ["UNKNOWN", "UNKNOWN", "12", "UNKNOWN", "NAN", "UNKNOWN", "COOK", "7.0"]


def test_city_type_mapping(spark):
    vals = [" theft ", "INTIMIDATION", "Other Narcotic Violation", "MOTOR VEHICLE THEFT", "ARSON", None]
    got = [r[0] for r in _col(spark, vals).select(map_city_type("v")).collect()]
    assert got == ["theft_larceny", "assault_battery", "drug_narcotics", "motor_vehicle_theft", None, None]


def test_offense_rules_order(spark):
    rows = [(None, None, "220"), ("MOTOR VEHICLE THEFT", None, "999"), ("x", "Robbery", "1"),
            ("x", "Robbery X", "1"), ("x", "Larceny/Theft Offenses", "1"), ("Drug deal", None, "1"),
            ("Stolen bike", None, "240"), (None, None, None)]
    df = spark.createDataFrame(rows, "name string, cat string, code string")
    got = [r[0] for r in df.select(map_offense(F.col("name"), F.col("cat"), F.col("code"))).collect()]
    # the THEFT name rule fires before the (unreachable) MOTOR VEHICLE THEFT name rule
    assert got == ["burglary", "theft_larceny", "robbery", None, "theft_larceny", "drug_narcotics",
                   "motor_vehicle_theft", None]


def test_time_bins(spark):
    days = [dt.date(2014, 12, 30), dt.date(2014, 12, 31), dt.date(2015, 1, 1), dt.date(2015, 1, 4),
            dt.date(2015, 1, 5), None]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = df.select(time_bin(F.col("d"), 7).alias("w7"), time_bin(F.col("d"), 3).alias("w3")).collect()
    assert [r.w7 for r in got] == [dt.date(2014, 12, 29)] * 4 + [dt.date(2015, 1, 5), None]
    assert [r.w3 for r in got] == [dt.date(2014, 12, 29), dt.date(2014, 12, 29), dt.date(2015, 1, 1),
                                   dt.date(2015, 1, 4), dt.date(2015, 1, 4), None]


def test_region_state(spark):
    vals = ["il__cpd_dist_1", "NAN__x", "", None, "solo"]
    got = [r[0] for r in _col(spark, vals).select(region_state("v")).collect()]
    assert got == ["IL", "UNK", "UNK", "UNK", "SOLO"]


def test_exact_percentile_matches_builtin(spark):
    import random
    from riskbeacon.functions.quantile import exact_percentile
    rnd = random.Random(7)
    rows = [("a", float(rnd.randint(0, 50))) for _ in range(2001)] + [("b", rnd.random()) for _ in range(998)]
    rows += [("c", 5.0), ("d", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    for q in (0.5, 0.75, 0.1):
        got = {r.g: r.p for r in exact_percentile(df, "x", q, ["g"], "p", buckets=16).collect()}
        exp = {r.g: r.p for r in df.groupBy("g").agg(F.percentile("x", q).alias("p")).collect() if r.p is not None}
        assert set(got) == set(exp)
        for k in exp:
            assert abs(got[k] - exp[k]) < 1e-12, (q, k)


def test_ranged_quantiles_and_prefix_sums_equal_plain_ones(spark):
    import random
    from riskbeacon.functions.quantile import exact_percentile
    from riskbeacon.operators import metrics
    rnd = random.Random(3)
    df = spark.createDataFrame([("a", float(rnd.randint(0, 40))) for _ in range(1500)], "g string, x double")
    a = exact_percentile(df, "x", 0.3, ["g"], "p", buckets=8).first().p
    b = df.agg(F.percentile("x", 0.3).alias("p")).first().p
    assert abs(a - b) < 1e-12
    p = spark.createDataFrame([("s", rnd.randint(0, 1), rnd.randint(0, 1), float(rnd.randint(0, 30)))
                               for _ in range(800)], "g string, y int, y_pred int, y_score double")
    rows = p.collect()
    pos, neg = ([x.y_score for x in rows if x.y == y] for y in (1, 0))
    below = sum((a > b) + (a == b) / 2 for a in pos for b in neg)
    got = metrics.classification_metrics(p, ["g"]).first()
    assert abs(got.auc - below / (len(pos) * len(neg))) < 1e-12
