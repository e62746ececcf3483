"""Driver contract: entry(), queries(), oracle_sql(); a fast oracle subset."""

import importlib.util
import os

import pytest

from conftest import ROOT, SF_SMALL


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs(spark):
    mod = _entry_module()
    df = mod.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"domain", "seed", "model", "k", "coverage"}


def test_catalog_consistency():
    mod = _entry_module()
    q, o = mod.queries(), mod.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 100
    assert not any(k.startswith("opN_") for k in q)


FAST = ["op_c3_panel_7d", "op_c16_supervised_7d", "op_c18_threshold_7d", "op_d5_predictions_7d",
        "op_e4_overall_by_seed", "op_e19_topk_coverage", "op_e9_region_buckets", "op_g3_kpis", "op_g9_pivot_year_hour",
        "op_b3_offense_mapping_table", "op_e25_knn_graph", "op_c28_sequences"]


@pytest.mark.parametrize("name", FAST)
def test_oracle_subset(spark, name):
    from oracle_check import compare, duck
    from riskbeacon.plans.catalog import load_all
    res = compare(spark, duck(SF_SMALL), load_all()[name], SF_SMALL)
    assert res["status"] == "OK", res
