"""Sources (A1-A3, A6, A9, A10) on files written by the tests."""

import os

from pyspark.sql import functions as F

from riskbeacon.operators import harmonize
from riskbeacon.plans import pipeline
from riskbeacon.sources import readers, standin

from conftest import SF_SMALL


def test_resolve_column_last_duplicate_wins():
    assert readers.resolve_column(["Primary Type", "primary_type"], ["primary type"]) == "primary_type"
    assert readers.resolve_column(["DATE", "x"], ["incident_date", "date"]) == "DATE"
    assert readers.resolve_column(["x"], ["date"]) is None


def test_csv_encoding_fallback(spark, tmp_path):
    text = "id,Description\n1,caf\xe9 robbery\n2,plain\n"
    utf = tmp_path / "utf8.csv"
    lat = tmp_path / "latin1.csv"
    utf.write_bytes(text.encode("utf-8"))
    lat.write_bytes(text.encode("latin-1"))
    for p in (utf, lat):
        got = [r.Description for r in readers.read_csv_flexible(spark, str(p)).orderBy("id").collect()]
        assert got == ["caf\xe9 robbery", "plain"]


def test_discovery_and_partitioned_roundtrip(spark, tmp_path):
    root = tmp_path / "raw"
    (root / "city").mkdir(parents=True)
    (root / "nat" / "a").mkdir(parents=True)
    (root / "nat" / "b").mkdir(parents=True)
    for name in ["crime_train_2015_2024.csv", "crime_test_2025.csv"]:
        (root / "city" / name).write_text("Date\n2025-01-01\n")
    for n in readers.NATIONAL_TABLES:
        (root / "nat" / "a" / n).write_text("x\n1\n")
    (root / "nat" / "b" / readers.NATIONAL_TABLES[0]).write_text("x\n1\n")
    got = {(r.role, os.path.basename(r.path)) for r in readers.discover_inputs(spark, str(root)).collect()}
    assert got == {("city_train", "crime_train_2015_2024.csv"), ("city_test", "crime_test_2025.csv"),
                   ("national_root", "a")}

    preds = pipeline.window_run(spark, SF_SMALL, 7).predictions.withColumn("time_window_days", F.lit(7))
    out = str(tmp_path / "preds")
    readers.write_table(preds, out, ["time_window_days", "dataset", "model", "seed"])
    back = readers.read_table(spark, out).filter("dataset = 'in_domain' AND model = 'ewma' AND seed = 0")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    assert back.count() == preds.filter("dataset = 'in_domain' AND model = 'ewma' AND seed = 0").count()


def test_thresholds_json_and_newest_run(spark, tmp_path):
    thr = spark.createDataFrame([(7, 10), (3, 4)], "time_window_days int, threshold int")
    path = str(tmp_path / "thr")
    readers.write_thresholds(spark, thr, path)
    assert sorted(tuple(r) for r in readers.read_thresholds(spark, path).collect()) == [(3, 4), (7, 10)]
    runs = spark.createDataFrame([("r1", 7, 1), ("r1", 3, 1), ("r2", 7, 5), ("r3", 7, 3), ("r3", 3, 3)],
                                 "run_id string, time_window_days int, modified_ts long")
    assert readers.newest_valid_run(runs).first().run_id == "r3"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_events_join_types_by_number_and_suppliers_undealt(spark):
    """Codes that are whole numbers aren't joined as text, and the events aren't
    dealt by supplier or agency where Spark knows the small table's size."""
    inside = _plan(pipeline.in_domain_events(spark, SF_SMALL).select("event_date", "region_id", "crime_group"))
    assert "cast(l_partkey" not in inside and "offense_code" in inside
    outside = _plan(standin.out_domain_events(spark, SF_SMALL))
    assert "hashpartitioning(l_suppkey" not in outside


def test_codes_meet_as_numbers_or_as_text(spark):
    """The same events whatever type the codes have; rows without a type, an incident or a code, and repeated incidents."""
    rows = [(1, 120), (1, 5), (2, 220), (2, 77), (3, 5), (4, 5), (5, None)]
    incidents = [(1, 10, "2020-01-01"), (2, 99, "2020-01-02"), (2, 10, "2020-01-03"), (3, None, None), (5, 10, "2020-01-04")]
    types = [(5, "Theft", "x"), (5, "Arson", "x"), (120, "b", "c"), (None, "Theft", "x")]
    inc = spark.createDataFrame(incidents, "incident_id int, agency_id int, incident_date string")
    ag = spark.createDataFrame([(10, "co", "X")], "agency_id int, state_abbr string, county_name string")
    rule = harmonize.RegionStrategy("county", "county_name", "agency_id", "")
    found = []
    for a, b in (("bigint", "bigint"), ("int", "bigint"), ("string", "string"), ("bigint", "string")):
        off = spark.createDataFrame(rows, "incident_id int, code int").selectExpr("incident_id", f"CAST(code AS {a}) offense_code")
        typ = spark.createDataFrame(types, "code int, offense_name string, offense_category_name string").selectExpr(
            f"CAST(code AS {b}) offense_code", "offense_name", "offense_category_name")
        got = harmonize.national_events(off, inc, typ, ag, rule, drop_invalid=False)
        assert dict(got.dtypes)["offense_code"] == "string"
        found.append(sorted(map(str, got.collect())))
    assert len(found[0]) == 9 and all(f == found[0] for f in found)
    kept = harmonize.national_events(off, inc, typ, ag, rule).select("region_id", "crime_group", "offense_code").collect()
    assert sorted(map(tuple, kept)) == [("CO__X", "burglary", "220"), ("CO__X", "robbery", "120"), ("UNKNOWN__99", "burglary", "220")]


def test_places_of_suppliers(spark, tmp_path):
    """Suppliers without a nation, nations without a region, and events without a supplier or a type."""
    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    put("region", [(0, "Asia")], "r_regionkey int, r_name string")
    put("nation", [(0, "n0", 0), (1, "n1", 9)], "n_nationkey int, n_name string, n_regionkey int")
    put("supplier", [(1, 0), (2, 1), (3, None), (4, 7), (4, 0)], "s_suppkey long, s_nationkey int")
    put("part", [(1, "LARGE"), (2, "odd")], "p_partkey long, p_type string")
    put("lineitem", [(1, s, "2020-01-01") for s in (1, 2, 3, 4, 5, None)] + [(2, 1, "2020-01-01"), (3, 1, "2020-01-01"), (1, 1, None)],
        "l_partkey long, l_suppkey long, l_shipdate string")
    got = [r.region_id for r in standin.out_domain_events(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(["ASIA__N0", "UNKNOWN__N1", "UNKNOWN__UNKNOWN", "UNKNOWN__UNKNOWN", "ASIA__N0"])
