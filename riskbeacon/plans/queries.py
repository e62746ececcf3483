"""Registered queries, one per inventory operator, each with its
DuckDB oracle. Spark builders read the stand-in tables under ``sf_dir``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskbeacon.config import CRIME_GROUPS, FEATURE_NUMERIC
from riskbeacon.functions.expr import side_by_side
from riskbeacon.operators import labels, panel
from riskbeacon.operators.features import build_supervised
from riskbeacon.plans import pipeline
from riskbeacon.plans import sql as S
from riskbeacon.plans.catalog import register
from riskbeacon.plans.store import materialize, table_root
from riskbeacon.sources import standin

GRP = [f"count_grp_{g}" for g in CRIME_GROUPS]


# ======================================================== C: panel =========
@register("op_c3_panel_7d", S.with_ctes([("ev_in", S.events_in())] + S.panel_ctes("ev_in", 7),
                                        "SELECT * FROM panel"), doubles=GRP, bench=True)
def q_panel_7d(spark, sf_dir):
    return pipeline.panel_for(spark, sf_dir, 7, "in")[0]


@register("op_c2_panel_3d_short", S.with_ctes([("ev", S.events_short())] + S.panel_ctes("ev", 3),
                                              "SELECT * FROM panel"), doubles=GRP)
def q_panel_3d_short(spark, sf_dir):
    p, _ = panel.build_panel(panel.day_counts(standin.short_events(spark, sf_dir)), 3, persist=False)
    return p


@register("op_c2_panel_3d_out", S.with_ctes([("ev", S.events_out())] + S.panel_ctes("ev", 3),
                                            "SELECT * FROM panel"), doubles=GRP)
def q_panel_3d_out(spark, sf_dir):
    return pipeline.panel_for(spark, sf_dir, 3, "out")[0]


_SUP_COLS = (["region_id", "time_id", "next_time"] + [c for c in FEATURE_NUMERIC if not c.startswith("region_")]
             + ["neighbor_lag_0", "y_count"])
_SUP_SQL_COLS = ", ".join(dict.fromkeys(_SUP_COLS))


@register("op_c16_supervised_7d",
          S.with_ctes([("ev_in", S.events_in())] + S.panel_ctes("ev_in", 7) + S.supervised_ctes("panel", 7),
                      f"SELECT {_SUP_SQL_COLS} FROM sup"),
          doubles=[c for c in dict.fromkeys(_SUP_COLS) if c not in ("region_id", "time_id", "next_time")],
          bench=True)
def q_supervised_7d(spark, sf_dir):
    return pipeline.supervised_for(spark, sf_dir, 7, "in").select(*dict.fromkeys(_SUP_COLS))


@register("op_c16_supervised_3d_short",
          S.with_ctes([("ev", S.events_short())] + S.panel_ctes("ev", 3) + S.supervised_ctes("panel", 3),
                      f"SELECT {_SUP_SQL_COLS} FROM sup"),
          doubles=[c for c in dict.fromkeys(_SUP_COLS) if c not in ("region_id", "time_id", "next_time")])
def q_supervised_3d_short(spark, sf_dir):
    p, b = panel.build_panel(panel.day_counts(standin.short_events(spark, sf_dir)), 3, persist=False)
    return build_supervised(p, 3, b.n_windows).select(*dict.fromkeys(_SUP_COLS))


# ======================================================== C: labels ========
def _thr_sql(w: int) -> str:
    return S.with_ctes(S.split_ctes(w), f"""SELECT {w} AS time_window_days, (SELECT threshold FROM thr) AS threshold,
       (SELECT t0 FROM tb) AS test_start, (SELECT t1 FROM tb) AS test_end,
       (SELECT count(*) FROM train_x) AS n_train, (SELECT count(*) FROM test_x) AS n_test,
       (SELECT count(*) FROM out_x) AS n_out""")


def _thr_spark(spark, sf_dir, w):
    r = pipeline.window_run(spark, sf_dir, w)
    counts = side_by_side(r.train.agg(F.count(F.lit(1)).alias("n_train")),
                          r.test.agg(F.count(F.lit(1)).alias("n_test")),
                          r.out.agg(F.count(F.lit(1)).alias("n_out")))
    return counts.select(F.lit(w).alias("time_window_days"), F.lit(r.threshold).alias("threshold"),
                         F.lit(r.test_start).alias("test_start"), F.lit(r.test_end).alias("test_end"),
                         "n_train", "n_test", "n_out")


@register("op_c18_threshold_7d", _thr_sql(7))
def q_thr7(spark, sf_dir):
    return _thr_spark(spark, sf_dir, 7)


@register("op_c18_threshold_3d", _thr_sql(3))
def q_thr3(spark, sf_dir):
    return _thr_spark(spark, sf_dir, 3)


@register("op_c19_threshold_by_group",
          S.with_ctes(S.split_ctes(7) + [("tg", "SELECT region_state AS crime_group, y_count FROM train")],
                      """SELECT crime_group, CAST(greatest(1, ceil(quantile_cont(y_count, 0.75))) AS INTEGER) AS threshold
FROM tg GROUP BY crime_group"""))
def q_thr_group(spark, sf_dir):
    # Group thresholds keyed by any grouping column; here the state of the region.
    tr = pipeline.window_run(spark, sf_dir, 7).train.withColumnRenamed("region_state", "crime_group")
    return labels.threshold_frame(tr, group_col="crime_group")


@register("op_c20_labels_by_group",
          S.with_ctes(S.split_ctes(7) + [
              ("tg", "SELECT region_state AS g, CAST(greatest(1, ceil(quantile_cont(y_count, 0.75))) AS INTEGER) AS threshold "
                     "FROM train GROUP BY 1")],
              """SELECT x.region_id, x.time_id, x.region_state AS crime_group, x.y_count,
       CAST(x.y_count >= coalesce(t.threshold, greatest(1, (SELECT max(threshold) FROM tg))) AS INTEGER) AS y
FROM test x LEFT JOIN tg t ON x.region_state = t.g"""), doubles=["y_count"])
def q_label_group(spark, sf_dir):
    r = pipeline.window_run(spark, sf_dir, 7)
    train, test = (d.withColumnRenamed("region_state", "crime_group") for d in (r.train, r.test))
    thresholds = labels.threshold_frame(train, group_col="crime_group")
    return labels.add_label_by_group(test, thresholds).select("region_id", "time_id", "crime_group", "y_count", "y")


@register("op_c21_region_train_stats",
          S.with_ctes(S.split_ctes(7), "SELECT * FROM rstats"),
          doubles=["region_train_mean", "region_train_std", "region_train_count"])
def q_region_stats(spark, sf_dir):
    return labels.region_train_stats(pipeline.window_run(spark, sf_dir, 7).train)


_XY_COLS = ["region_id", "time_id"] + FEATURE_NUMERIC + ["y", "y_count"]


def _xy_sql(src: str) -> str:
    cols = ", ".join(["region_id", "strftime(time_id, '%Y-%m-%d') AS time_id"]
                     + [f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURE_NUMERIC]
                     + ["CAST(y AS INTEGER) AS y", "CAST(y_count AS DOUBLE) AS y_count"])
    return S.with_ctes(S.split_ctes(7), f"SELECT {cols} FROM {src}")


@register("op_c23_xy_in_train", _xy_sql("train_x"), doubles=FEATURE_NUMERIC + ["y_count"])
def q_xy_train(spark, sf_dir):
    return pipeline.window_run(spark, sf_dir, 7).xy("in_train")


@register("op_c23_xy_in_test", _xy_sql("test_x"), doubles=FEATURE_NUMERIC + ["y_count"])
def q_xy_test(spark, sf_dir):
    return pipeline.window_run(spark, sf_dir, 7).xy("in_domain")


@register("op_c22_xy_out_domain", _xy_sql("out_x"), doubles=FEATURE_NUMERIC + ["y_count"], bench=True)
def q_xy_out(spark, sf_dir):
    return pipeline.window_run(spark, sf_dir, 7).xy("out_domain")


# ======================================================== D: predictions ===
@register("op_d5_predictions_7d", S.with_ctes(S.predictions_ctes(7), "SELECT * FROM preds"),
          doubles=["y_count", "y_score"], bench=True)
def q_preds7(spark, sf_dir):
    return pipeline.window_run(spark, sf_dir, 7).predictions


@register("op_d5_predictions_3d", S.with_ctes(S.predictions_ctes(3), "SELECT * FROM preds"),
          doubles=["y_count", "y_score"])
def q_preds3(spark, sf_dir):
    return pipeline.window_run(spark, sf_dir, 3).predictions


# ======================================================== E: metrics =======
from riskbeacon.operators import metrics as M  # noqa: E402
from riskbeacon.operators import topk as TK  # noqa: E402

_MET = ["n_rows", "positive_rate", "precision", "recall", "f1", "auc"]


def _pred_sql(final: str, w: int = 7, extra: list | None = None) -> str:
    return S.with_ctes(S.predictions_ctes(w) + (extra or []), final)


def _mlong_sql(final: str, w: int = 7) -> str:
    return S.with_ctes(S.predictions_ctes(w) + S.metrics_long_ctes(w), final)


def _keep(spark):
    """Writes an intermediate table to the shared folder and reads it back."""
    return lambda df, name: materialize(spark, df, name.strip("_"))


def _preds(spark, sf_dir, w: int = 7):
    return pipeline.window_run(spark, sf_dir, w).predictions


def _preds_grouped(spark, sf_dir, w: int = 7):
    # Out-of-domain slicing column: the region's state plays the group role.
    return _preds(spark, sf_dir, w).withColumn("crime_group", M.simple_state())


def _mlong(spark, sf_dir, w: int = 7):
    return M.metrics_long(_preds_grouped(spark, sf_dir, w), w)


@register("op_e3_summary_by_dataset_model",
          _pred_sql("SELECT dataset, model, n_rows, positive_rate, precision, recall, f1, auc AS auc_roc FROM e3_m",
                    extra=S.metrics_ctes("preds", ["dataset", "model"], "e3_")),
          doubles=["positive_rate", "precision", "recall", "f1", "auc_roc"])
def q_e3(spark, sf_dir):
    return M.summary_by_dataset_model(_preds(spark, sf_dir))


@register("op_e4_overall_by_seed",
          _pred_sql("SELECT seed, dataset AS domain, model, auc, f1, recall, precision, n_rows FROM e4_m",
                    extra=S.metrics_ctes("preds", ["seed", "dataset", "model"], "e4_")),
          doubles=["auc", "f1", "recall", "precision"], bench=True)
def q_e4(spark, sf_dir):
    return M.overall_by_seed(_preds(spark, sf_dir))


def _temporal_sql(period: str) -> str:
    b = S.month_bucket("time_id") if period == "M" else \
        "CAST(year(CAST(time_id AS DATE)) AS VARCHAR) || 'Q' || CAST(quarter(CAST(time_id AS DATE)) AS VARCHAR)"
    return _pred_sql("SELECT dataset, model, period, n_rows, precision, recall, f1, auc AS auc_roc FROM e5_m",
                     extra=[("e5src", f"SELECT *, {b} AS period FROM preds")]
                     + S.metrics_ctes("e5src", ["dataset", "model", "period"], "e5_"))


@register("op_e5_temporal_monthly", _temporal_sql("M"), doubles=["precision", "recall", "f1", "auc_roc"])
def q_e5m(spark, sf_dir):
    return M.temporal_metrics(_preds(spark, sf_dir), "M")


@register("op_e5_temporal_quarterly", _temporal_sql("Q"), doubles=["precision", "recall", "f1", "auc_roc"])
def q_e5q(spark, sf_dir):
    return M.temporal_metrics(_preds(spark, sf_dir), "Q")


@register("op_e6_temporal_f1_by_seed",
          _mlong_sql("SELECT seed, dataset AS domain, model, date_bucket, 'f1' AS metric, f1 AS value FROM tm_m"),
          doubles=["value"])
def q_e6(spark, sf_dir):
    return M.temporal_f1_by_seed(_preds(spark, sf_dir), "M")


@register("op_e7_neighbor_metrics_by_seed",
          _mlong_sql("SELECT seed, domain, model, metric AS neighbor_metric, value FROM mlong "
                     "WHERE slice = 'neighbor_overall'"), doubles=["value"])
def q_e7(spark, sf_dir):
    return M.neighbor_metrics_by_seed(_preds(spark, sf_dir))


@register("op_e8_group_metrics_by_seed",
          _mlong_sql("SELECT seed, domain, model, crime_group, metric, value FROM mlong WHERE slice = 'crime_group'"),
          doubles=["value"])
def q_e8(spark, sf_dir):
    return M.group_metrics_by_seed(_preds_grouped(spark, sf_dir))


_BUCKET_SQL = [
    ("bbase", "SELECT DISTINCT region_id, time_id, y, y_count FROM preds WHERE dataset = 'out_domain'"),
    ("bwork", "SELECT region_id, avg(y_count) AS workload FROM bbase GROUP BY region_id"),
    ("brank", """SELECT region_id, workload, row_number() OVER (ORDER BY workload, region_id) AS rk,
       count(*) OVER () AS rr FROM bwork"""),
    ("bmap", """SELECT region_id, workload, 'Q' || CAST(CASE WHEN least(4, rr) <= 1 THEN 1
       ELSE greatest(1, CAST(ceil(least(4, rr) * (rk - 1) / CAST(rr - 1 AS DOUBLE)) AS INTEGER)) END AS VARCHAR)
       AS region_bucket FROM brank"""),
    ("bsrc", "SELECT p.*, b.region_bucket FROM preds p JOIN bmap b ON p.region_id = b.region_id "
             "WHERE p.dataset = 'out_domain'"),
]


@register("op_e9_region_buckets", _pred_sql("SELECT region_id, workload, region_bucket FROM bmap", extra=_BUCKET_SQL),
          doubles=["workload"])
def q_e9a(spark, sf_dir):
    return M.region_buckets(_preds(spark, sf_dir), _keep(spark))


@register("op_e9_region_bucket_metrics",
          _pred_sql("SELECT seed, model, region_bucket, auc, f1, n_rows FROM e9_m",
                    extra=_BUCKET_SQL + S.metrics_ctes("bsrc", ["seed", "model", "region_bucket"], "e9_")),
          doubles=["auc", "f1"])
def q_e9b(spark, sf_dir):
    return M.region_bucket_metrics_by_seed(_preds(spark, sf_dir), _keep(spark))


@register("op_e10_metrics_long", _mlong_sql("SELECT * FROM mlong"), doubles=["value"], bench=True)
def q_e10(spark, sf_dir):
    return _mlong(spark, sf_dir)


_E11_GAP = "model = 'ewma' AND seed = 2 AND (metric = 'f1' OR domain = 'out_domain')"


@register("op_e11_metrics_completeness", _mlong_sql(
    f"""SELECT e.model, e.seed, e.domain, e.metric FROM
  (SELECT * FROM (VALUES ('baseline_persistence'), ('rolling_mean'), ('ewma')) m(model),
                 (VALUES (0), (1), (2)) s(seed), (VALUES ('in_domain'), ('out_domain')) d(domain),
                 (VALUES ('auc'), ('f1'), ('recall'), ('precision')) k(metric)) e
WHERE NOT EXISTS (SELECT 1 FROM mlong l WHERE l.slice = 'overall' AND l.model = e.model AND l.seed = e.seed
                  AND l.domain = e.domain AND l.metric = e.metric AND NOT ({_E11_GAP.replace("model", "l.model").replace("seed", "l.seed")
                  .replace("metric", "l.metric").replace("domain =", "l.domain =")}))"""))
def q_e11(spark, sf_dir):
    """Of a metrics table with a gap, the rows that are missing."""
    return M.metrics_completeness(spark, _mlong(spark, sf_dir).filter(f"NOT ({_E11_GAP})"))


@register("op_e12_seed_mean_overall",
          _mlong_sql("SELECT dataset, model, avg(precision) AS precision, avg(recall) AS recall, avg(f1) AS f1, "
                     "avg(auc) AS auc_roc FROM ov_m GROUP BY dataset, model"),
          doubles=["precision", "recall", "f1", "auc_roc"])
def q_e12(spark, sf_dir):
    return M.seed_mean_overall(_preds(spark, sf_dir))


@register("op_e13_seed_mean_monthly_f1",
          _mlong_sql("SELECT dataset, model, date_bucket AS period, avg(f1) AS f1 FROM tm_m GROUP BY 1, 2, 3"),
          doubles=["f1"])
def q_e13(spark, sf_dir):
    return M.seed_mean_monthly_f1(_preds(spark, sf_dir))


_OV_SQL = "(SELECT dataset, model, avg(f1) AS f1, avg(auc) AS auc_roc FROM ov_m GROUP BY dataset, model)"


@register("op_e14_delta_auc", _mlong_sql(
    f"""SELECT a.model, a.auc_roc AS auc_in_domain, b.auc_roc AS auc_out_domain, a.auc_roc - b.auc_roc AS delta_auc
FROM {_OV_SQL} a JOIN {_OV_SQL} b ON a.model = b.model AND a.dataset = 'in_domain' AND b.dataset = 'out_domain'"""),
          doubles=["auc_in_domain", "auc_out_domain", "delta_auc"])
def q_e14(spark, sf_dir):
    return M.delta_auc(M.seed_mean_overall(_preds(spark, sf_dir)))


@register("op_e15_generalization_gap", _mlong_sql(
    f"""SELECT a.model, a.auc_roc - b.auc_roc AS delta_auc, a.f1 - b.f1 AS delta_f1
FROM {_OV_SQL} a JOIN {_OV_SQL} b ON a.model = b.model AND a.dataset = 'in_domain' AND b.dataset = 'out_domain'"""),
          doubles=["delta_auc", "delta_f1"])
def q_e15(spark, sf_dir):
    return M.generalization_gap(M.seed_mean_overall(_preds(spark, sf_dir)))


def _mlong_both_sql(final: str) -> str:
    parts = [f"(WITH {_mlong_sql('SELECT * FROM mlong', w)[5:]})" for w in (7, 3)]
    return f"WITH mboth AS ({parts[0]} UNION ALL {parts[1]})\n{final}"


def _mlong_both(spark, sf_dir):
    pipeline.window_runs(spark, sf_dir, (7, 3))
    return _mlong(spark, sf_dir, 7).unionByName(_mlong(spark, sf_dir, 3))


_GAP_SQL = """(SELECT time_window_days, model, seed, metric,
        max(CASE WHEN domain = 'in_domain' THEN value END) - max(CASE WHEN domain = 'out_domain' THEN value END) AS delta
 FROM mboth WHERE slice = 'overall' GROUP BY 1, 2, 3, 4)"""


@register("op_e16_window_gap_by_seed", _mlong_both_sql(f"SELECT * FROM {_GAP_SQL} g"), doubles=["delta"])
def q_e16a(spark, sf_dir):
    return M.window_gap_by_seed(_mlong_both(spark, sf_dir))


@register("op_e16_window_gap_summary", _mlong_both_sql(
    f"SELECT time_window_days, model, metric, avg(delta) AS mean, coalesce(stddev_samp(delta), 0.0) AS std "
    f"FROM {_GAP_SQL} g GROUP BY 1, 2, 3"), doubles=["mean", "std"])
def q_e16b(spark, sf_dir):
    return M.window_gap_summary(_mlong_both(spark, sf_dir))


@register("op_e17_window_overall_summary", _mlong_both_sql(
    "SELECT time_window_days, domain, model, metric, avg(value) AS mean, coalesce(stddev_samp(value), 0.0) AS std "
    "FROM mboth WHERE slice = 'overall' AND metric IN ('auc', 'f1') GROUP BY 1, 2, 3, 4"), doubles=["mean", "std"])
def q_e17(spark, sf_dir):
    return M.window_overall_summary(_mlong_both(spark, sf_dir))


# ======================================================== E: Top-K =========
_TOPK_AGG = [
    ("hagg", "SELECT dataset, model, time_id, region_id, max(y_score) AS score, max(y) AS y_true FROM preds "
             "GROUP BY 1, 2, 3, 4"),
    ("hnr", "SELECT dataset, model, count(DISTINCT region_id) AS n_regions FROM hagg GROUP BY 1, 2"),
    ("hrk", """SELECT h.*, n.n_regions, row_number() OVER (PARTITION BY h.dataset, h.model, h.time_id
       ORDER BY h.score DESC NULLS LAST, h.region_id) AS rk FROM hagg h JOIN hnr n USING (dataset, model)"""),
    ("hk", """SELECT dataset, model, least(kreq, n_regions) AS k, time_id, avg(y_true) AS hit
FROM hrk, (VALUES (1), (3), (5)) kk(kreq) WHERE n_regions > 1 AND rk <= least(kreq, n_regions)
GROUP BY dataset, model, kreq, least(kreq, n_regions), time_id"""),
]


@register("op_e18_topk_hit_rate", _pred_sql(
    "SELECT dataset, model, k, count(*) AS weekly_count, avg(hit) AS topk_hit_rate FROM hk "
    "GROUP BY dataset, model, k", extra=_TOPK_AGG), doubles=["topk_hit_rate"])
def q_e18(spark, sf_dir):
    return TK.topk_hit_rate(_preds(spark, sf_dir))


_COV_SQL = [
    ("cagg", "SELECT dataset, seed, model, time_id, region_id, max(y_score) AS risk_score, "
             "sum(y_count) AS true_incidents FROM preds GROUP BY 1, 2, 3, 4, 5"),
    ("cnr", "SELECT dataset, count(DISTINCT region_id) AS n_regions FROM cagg GROUP BY 1"),
    ("cks", """SELECT n.dataset, kk.k FROM cnr n, (VALUES (5), (10), (20), (50), (100)) kk(k) WHERE kk.k <= n.n_regions
UNION ALL SELECT dataset, greatest(1, n_regions) FROM cnr n
WHERE NOT EXISTS (SELECT 1 FROM (VALUES (5), (10), (20), (50), (100)) kk(k) WHERE kk.k <= n.n_regions)"""),
    ("crk", """SELECT *, row_number() OVER (PARTITION BY dataset, seed, model, time_id
       ORDER BY risk_score DESC NULLS LAST, region_id) AS rk FROM cagg"""),
    ("cwin", """SELECT c.dataset, c.seed, c.model, c.time_id, k.k,
       CASE WHEN sum(c.true_incidents) > 0 THEN sum(CASE WHEN c.rk <= k.k THEN c.true_incidents ELSE 0 END)
            / sum(c.true_incidents) END AS coverage
FROM crk c JOIN cks k ON c.dataset = k.dataset GROUP BY 1, 2, 3, 4, 5"""),
    ("cseed", "SELECT dataset AS domain, seed, model, k, avg(coverage) AS coverage FROM cwin GROUP BY 1, 2, 3, 4"),
]


@register("op_e19_topk_coverage", _pred_sql("SELECT * FROM cseed", extra=_COV_SQL), doubles=["coverage"], bench=True)
def q_e19(spark, sf_dir):
    return TK.topk_coverage_by_seed(_preds(spark, sf_dir))


@register("op_e20_topk_coverage_seed_mean", _pred_sql(
    "SELECT domain AS dataset, model, k, avg(coverage) AS topk_hit_rate FROM cseed GROUP BY 1, 2, 3",
    extra=_COV_SQL), doubles=["topk_hit_rate"])
def q_e20(spark, sf_dir):
    return TK.topk_coverage_seed_mean(TK.topk_coverage_by_seed(_preds(spark, sf_dir)))


_SEL_SQL = [
    ("ssub", "SELECT * FROM preds WHERE dataset = 'in_domain'"),
    ("snw", "SELECT seed, model, time_id, count(DISTINCT region_id) AS n FROM ssub GROUP BY 1, 2, 3"),
    ("srk", """SELECT s.*, greatest(1, least(5, n.n)) AS kk, row_number() OVER (PARTITION BY s.seed, s.model, s.time_id
       ORDER BY s.y_score DESC NULLS LAST, s.region_id) AS rk
FROM ssub s JOIN snw n USING (seed, model, time_id)"""),
    ("swin", "SELECT seed, model, count(DISTINCT time_id) AS nw FROM ssub GROUP BY 1, 2"),
    ("ssel", """SELECT r.seed, r.model, r.region_id,
       CAST(sum(CASE WHEN rk <= kk THEN 1 ELSE 0 END) AS DOUBLE) / greatest(max(w.nw), 1) AS topk_selection_rate
FROM srk r JOIN swin w USING (seed, model) GROUP BY 1, 2, 3"""),
]


@register("op_e21_topk_selection_frequency", _pred_sql("SELECT * FROM ssel", extra=_SEL_SQL),
          doubles=["topk_selection_rate"])
def q_e21(spark, sf_dir):
    return TK.topk_selection_frequency(_preds(spark, sf_dir))


@register("op_e22_best_model", _mlong_sql(
    """SELECT model, mean_f1 FROM (
  SELECT model, avg(value) AS mean_f1,
         CASE model WHEN 'baseline_persistence' THEN 1 WHEN 'rolling_mean' THEN 2 ELSE 3 END AS o
  FROM mlong WHERE slice = 'overall' AND domain = 'in_domain' AND metric = 'f1' GROUP BY model
) t ORDER BY mean_f1 DESC, o LIMIT 1"""), doubles=["mean_f1"])
def q_e22(spark, sf_dir):
    return M.best_model(_mlong(spark, sf_dir))


# ======================================================== G: cube ==========
from riskbeacon.operators import cube as G  # noqa: E402

# Dashboard parameters of the registered views (sidebar defaults / examples).
G_FILTER = dict(year_range=(1996, 1999), districts=[1, 2, 3, 5, 8], crime_types=["1-URGENT", "2-HIGH", "3-MEDIUM"],
                arrest_filter="Arrested Only")
G_TOP_N = 15


def _city(spark, sf_dir):
    return standin.city_clean(spark, sf_dir)


def _g_sql(final: str, extra=None) -> str:
    return S.with_ctes([("city", S.city())] + (extra or []), final)


_G1_WHERE = ('"Year" BETWEEN 1996 AND 1999 AND "District" IN (1, 2, 3, 5, 8) '
             "AND \"Primary Type\" IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AND \"Arrest\" = TRUE")


@register("op_g1_filters", _g_sql(f"SELECT * FROM city WHERE {_G1_WHERE}"), doubles=["Latitude", "Longitude"])
def q_g1(spark, sf_dir):
    return G.apply_filters(_city(spark, sf_dir), **G_FILTER)


@register("op_g2_filter_domains", _g_sql(
    """SELECT 'year_min' AS kind, CAST(min("Year") AS VARCHAR) AS value FROM city
UNION ALL SELECT 'year_max', CAST(max("Year") AS VARCHAR) FROM city
UNION ALL SELECT DISTINCT 'district', CAST("District" AS VARCHAR) FROM city WHERE "District" IS NOT NULL
UNION ALL SELECT DISTINCT 'type', "Primary Type" FROM city WHERE "Primary Type" IS NOT NULL"""))
def q_g2(spark, sf_dir):
    return G.filter_domains(_city(spark, sf_dir))


@register("op_g3_kpis", _g_sql(
    """SELECT count(*) AS total, count(DISTINCT "Primary Type") AS n_types,
       avg(CAST("Arrest" AS DOUBLE)) * 100 AS arrest_rate_pct, count(DISTINCT "District") AS n_districts,
       CAST(max("Year") AS INTEGER) AS latest_year,
       (SELECT t FROM (SELECT "Primary Type" AS t, count(*) AS n FROM city GROUP BY 1) ORDER BY n DESC, t LIMIT 1)
         AS top_type,
       (SELECT h FROM (SELECT CAST("Hour" AS INTEGER) AS h, count(*) AS n FROM city GROUP BY 1) ORDER BY n DESC, h LIMIT 1)
         AS peak_hour
FROM city"""), doubles=["arrest_rate_pct"], bench=True)
def q_g3(spark, sf_dir):
    return G.kpis(_city(spark, sf_dir))


@register("op_g4_yoy", _g_sql(
    """SELECT y.yr AS latest_year, y.n AS latest_count, p.n AS prev_count,
       CASE WHEN p.n IS NOT NULL AND p.n <> 0 THEN y.n - p.n END AS yoy_delta,
       CASE WHEN p.n IS NOT NULL AND p.n <> 0 THEN (y.n - p.n) * 100.0 / p.n END AS yoy_delta_pct
FROM (SELECT CAST("Year" AS INTEGER) AS yr, count(*) AS n FROM city GROUP BY 1) y
LEFT JOIN (SELECT CAST("Year" AS INTEGER) AS yr, count(*) AS n FROM city GROUP BY 1) p ON p.yr = y.yr - 1
WHERE y.yr = (SELECT max(CAST("Year" AS INTEGER)) FROM city)"""), doubles=["yoy_delta_pct"])
def q_g4(spark, sf_dir):
    return G.yoy(_city(spark, sf_dir))


@register("op_g5_counts_by_year", _g_sql('SELECT "Year", count(*) AS count FROM city GROUP BY 1'))
def q_g5(spark, sf_dir):
    return G.counts_by(_city(spark, sf_dir), "Year")


def _dense_sql(col: str, values) -> str:
    if col == "DayOfWeek":
        axis = ", ".join(f"({i}, '{v}')" for i, v in enumerate(values))
        cast = f'"{col}"'
    else:
        axis = ", ".join(f"({i}, {v})" for i, v in enumerate(values))
        cast = f'CAST("{col}" AS INTEGER)'
    return _g_sql(f"""SELECT a.ord, a.v AS "{col}", CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM (VALUES {axis}) a(ord, v) LEFT JOIN (SELECT {cast} AS v, count(*) AS n FROM city GROUP BY 1) c ON a.v = c.v""")


@register("op_g6_counts_by_month", _dense_sql("Month", G.MONTH_ORDER))
def q_g6(spark, sf_dir):
    return G.dense_counts(spark, _city(spark, sf_dir), "Month")


@register("op_g7_counts_by_hour", _dense_sql("Hour", G.HOUR_ORDER))
def q_g7(spark, sf_dir):
    return G.dense_counts(spark, _city(spark, sf_dir), "Hour")


@register("op_g8_counts_by_dayofweek", _dense_sql("DayOfWeek", G.DAY_ORDER))
def q_g8(spark, sf_dir):
    return G.dense_counts(spark, _city(spark, sf_dir), "DayOfWeek")


def _pivot_sql(row: str, col: str, values, dense_days: bool = False) -> str:
    cells = ", ".join(f'count(*) FILTER (WHERE CAST("{col}" AS INTEGER) = {v}) AS "{v}"' for v in values)
    base = f'SELECT "{row}", {cells} FROM city GROUP BY 1'
    if not dense_days:
        return _g_sql(base)
    axis = ", ".join(f"({i}, '{v}')" for i, v in enumerate(G.DAY_ORDER))
    fill = ", ".join(f'coalesce(p."{v}", 0) AS "{v}"' for v in values)
    return _g_sql(f"""SELECT a.d AS "{row}", a.ord, {fill}
FROM (VALUES {axis}) a(ord, d) LEFT JOIN ({base}) p ON a.d = p."{row}\"""")


@register("op_g9_pivot_year_hour", _pivot_sql("Year", "Hour", G.HOUR_ORDER), bench=True)
def q_g9(spark, sf_dir):
    return G.pivot_counts(spark, _city(spark, sf_dir), "Year", "Hour")


@register("op_g10_pivot_year_month", _pivot_sql("Year", "Month", G.MONTH_ORDER))
def q_g10(spark, sf_dir):
    return G.pivot_counts(spark, _city(spark, sf_dir), "Year", "Month")


@register("op_g11_pivot_day_hour", _pivot_sql("DayOfWeek", "Hour", G.HOUR_ORDER, dense_days=True))
def q_g11(spark, sf_dir):
    return G.pivot_counts(spark, _city(spark, sf_dir), "DayOfWeek", "Hour")


@register("op_g12_compare_types_monthly", _g_sql(
    """SELECT g.value, g.bucket, CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM (SELECT * FROM (VALUES ('1-URGENT'), ('5-LOW')) v(value), (SELECT CAST(unnest(range(1, 13)) AS INTEGER) AS bucket) b) g
LEFT JOIN (SELECT "Primary Type" AS value, CAST("Month" AS INTEGER) AS bucket, count(*) AS n FROM city
           WHERE "Primary Type" IN ('1-URGENT', '5-LOW') GROUP BY 1, 2) c
ON g.value = c.value AND g.bucket = c.bucket"""))
def q_g12(spark, sf_dir):
    return G.compare_series(spark, _city(spark, sf_dir), G.C_TYPE, ["1-URGENT", "5-LOW"], "Monthly")


def _g12_sql(buckets: str, col: str) -> str:
    return _g_sql(f"""SELECT g.value, g.bucket, CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM (SELECT * FROM (VALUES ('1-URGENT'), ('5-LOW')) v(value), ({buckets}) b) g
LEFT JOIN (SELECT "Primary Type" AS value, CAST("{col}" AS INTEGER) AS bucket, count(*) AS n FROM city GROUP BY 1, 2) c
ON g.value = c.value AND g.bucket = c.bucket""")


@register("op_g12_compare_types_hourly", _g12_sql("SELECT CAST(unnest(range(0, 24)) AS INTEGER) AS bucket", "Hour"))
def q_g12h(spark, sf_dir):
    return G.compare_series(spark, _city(spark, sf_dir), G.C_TYPE, ["1-URGENT", "5-LOW"], "Hourly")


@register("op_g12_compare_types_yearly", _g12_sql(
    'SELECT DISTINCT CAST("Year" AS INTEGER) AS bucket FROM city WHERE "Year" IS NOT NULL', "Year"))
def q_g12y(spark, sf_dir):
    return G.compare_series(spark, _city(spark, sf_dir), G.C_TYPE, ["1-URGENT", "5-LOW"], "Yearly")


@register("op_g13_outliers_daily", _g_sql(
    """SELECT "Date", count, z, is_outlier, is_peak FROM (
  SELECT *, (abs_z IS NOT NULL AND row_number() OVER (ORDER BY abs_z DESC NULLS LAST, "Date") <= 3) AS is_outlier,
         row_number() OVER (ORDER BY count DESC, "Date") = 1 AS is_peak
  FROM (SELECT *, CASE WHEN abs(z) >= 2.0 THEN abs(z) END AS abs_z FROM (
    SELECT "Date", count, CASE WHEN count(*) OVER () >= 3 AND stddev_pop(count) OVER () > 0
           THEN (count - avg(count) OVER ()) / stddev_pop(count) OVER () END AS z
    FROM (SELECT "Date", count(*) AS count FROM city GROUP BY 1) s) t) u
) v WHERE is_outlier OR is_peak"""), doubles=["z"])
def q_g13(spark, sf_dir):
    daily = G.counts_by(_city(spark, sf_dir), "Date")
    return G.outliers(daily, "Date")


@register("op_g14_counts_by_district", _g_sql('SELECT "District", count(*) AS count FROM city GROUP BY 1'))
def q_g14(spark, sf_dir):
    return G.counts_by(_city(spark, sf_dir), G.C_DIST)


@register("op_g15_community_first_n_by_id", _g_sql(
    f'SELECT "Community Area", count(*) AS count FROM city GROUP BY 1 ORDER BY 1 LIMIT {G_TOP_N}'))
def q_g15a(spark, sf_dir):
    return G.top_n(_city(spark, sf_dir), G.C_AREA, G_TOP_N, order_by="id")


@register("op_g15_community_top_n", _g_sql(
    f'SELECT "Community Area", count(*) AS count FROM city GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {G_TOP_N}'))
def q_g15b(spark, sf_dir):
    return G.top_n(_city(spark, sf_dir), G.C_AREA, G_TOP_N)


@register("op_g16_top_locations", _g_sql(
    f'SELECT "Location Description", count(*) AS count FROM city GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {G_TOP_N}'))
def q_g16(spark, sf_dir):
    return G.top_n(_city(spark, sf_dir), G.C_LOC, G_TOP_N)


_G17_COLS = ["ID", "Primary Type", "District", "Latitude", "Longitude"]


@register("op_g17_map_sample", S.with_ctes([("craw", S.city_raw()), ("samp", """SELECT "ID", "Primary Type", "District",
       "Latitude", "Longitude" FROM craw ORDER BY md5('42|' || CAST("ID" AS VARCHAR)) LIMIT 1000""")],
    """SELECT s.*, avg("Latitude") OVER () AS center_lat, avg("Longitude") OVER () AS center_lon,
       CASE WHEN "District" IS NOT NULL THEN CAST((dense_rank() OVER (ORDER BY "District" NULLS FIRST) - 1) % 20 AS INTEGER) END
       AS palette_idx FROM samp s"""), doubles=["Latitude", "Longitude", "center_lat", "center_lon"])
def q_g17(spark, sf_dir):
    return G.map_sample(standin.city_raw(spark, sf_dir).select(*_G17_COLS), n=1000, keys=["ID"])


@register("op_g18_heat_grid", _g_sql(
    """SELECT CAST(floor("Latitude" / 0.01) AS BIGINT) AS lat_cell, CAST(floor("Longitude" / 0.01) AS BIGINT) AS lon_cell,
       count(*) AS count FROM city WHERE "Latitude" IS NOT NULL AND "Longitude" IS NOT NULL GROUP BY 1, 2"""))
def q_g18(spark, sf_dir):
    return G.heat_grid(_city(spark, sf_dir))


@register("op_g19_arrests_by_year", _g_sql(
    'SELECT CAST("Year" AS INTEGER) AS "Year", count(*) AS crimes, count(*) FILTER (WHERE "Arrest") AS arrests '
    'FROM city GROUP BY 1'))
def q_g19(spark, sf_dir):
    return G.arrests_by_year(_city(spark, sf_dir))


@register("op_g20_largest_gap_year", _g_sql(
    """SELECT (SELECT yr FROM a ORDER BY gap DESC, yr LIMIT 1) AS gap_year,
       (SELECT gap FROM a ORDER BY gap DESC, yr LIMIT 1) AS gap, CAST((SELECT sum(arrests) FROM a) AS BIGINT) AS total_arrests""",
    extra=[("a", 'SELECT CAST("Year" AS INTEGER) AS yr, count(*) - count(*) FILTER (WHERE "Arrest") AS gap, '
                 'count(*) FILTER (WHERE "Arrest") AS arrests FROM city GROUP BY 1')]))
def q_g20(spark, sf_dir):
    return G.largest_gap_year(_city(spark, sf_dir))


@register("op_g21_arrest_rate_by_type", _g_sql(
    f"""SELECT "Primary Type", crimes, arrests, arrest_rate, rank, side FROM (
  SELECT *, CAST(row_number() OVER (ORDER BY arrest_rate DESC, "Primary Type") AS INTEGER) AS rank, 'top' AS side FROM r
  UNION ALL
  SELECT *, CAST(row_number() OVER (ORDER BY arrest_rate ASC, "Primary Type") AS INTEGER) AS rank, 'bottom' AS side FROM r
) x WHERE rank <= {G_TOP_N}""",
    extra=[("r", 'SELECT "Primary Type", count(*) AS crimes, count(*) FILTER (WHERE "Arrest") AS arrests, '
                 'CAST(count(*) FILTER (WHERE "Arrest") AS DOUBLE) / count(*) AS arrest_rate FROM city GROUP BY 1 '
                 'HAVING count(*) FILTER (WHERE "Arrest") > 0')]), doubles=["arrest_rate"])
def q_g21(spark, sf_dir):
    return G.arrest_rate_by_type(_city(spark, sf_dir), G_TOP_N)


@register("op_g22_arrest_share_by_hour", _g_sql(
    """SELECT h.h AS "Hour", coalesce(1.0 - a.t, 0.0) AS arrest_false, coalesce(a.t, 0.0) AS arrest_true
FROM (SELECT CAST(unnest(range(0, 24)) AS INTEGER) AS h) h
LEFT JOIN (SELECT CAST("Hour" AS INTEGER) AS h, avg(CAST("Arrest" AS DOUBLE)) AS t FROM city GROUP BY 1) a ON h.h = a.h"""),
          doubles=["arrest_false", "arrest_true"])
def q_g22(spark, sf_dir):
    return G.arrest_share(spark, _city(spark, sf_dir), "Hour")


@register("op_g23_arrest_share_by_district", _g_sql(
    'SELECT CAST("District" AS INTEGER) AS "District", 1.0 - avg(CAST("Arrest" AS DOUBLE)) AS arrest_false, '
    'avg(CAST("Arrest" AS DOUBLE)) AS arrest_true FROM city GROUP BY 1'), doubles=["arrest_false", "arrest_true"])
def q_g23(spark, sf_dir):
    return G.arrest_share(spark, _city(spark, sf_dir), G.C_DIST)


_TOP6 = '(SELECT "Primary Type" FROM city GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 6)'


@register("op_g24_type_hour_top6", _g_sql(
    'SELECT "Primary Type", ' + ", ".join(f'count(*) FILTER (WHERE CAST("Hour" AS INTEGER) = {h}) AS "{h}"'
                                          for h in G.HOUR_ORDER)
    + f' FROM city WHERE "Primary Type" IN {_TOP6} GROUP BY 1'))
def q_g24(spark, sf_dir):
    return G.type_hour_crosstab(_city(spark, sf_dir), 6)


@register("op_g25_type_district_composition", _g_sql(
    f"""SELECT "Primary Type", "District", n AS count, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY "District") AS share
FROM (SELECT "Primary Type", "District", count(*) AS n FROM city
      WHERE "Primary Type" IN (SELECT "Primary Type" FROM city GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT {G_TOP_N})
        AND "District" IN (SELECT "District" FROM city GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT {G_TOP_N})
      GROUP BY 1, 2) m"""), doubles=["share"])
def q_g25(spark, sf_dir):
    return G.type_district_composition(_city(spark, sf_dir), G_TOP_N)


# ======================================================== F: serving =======
from riskbeacon.operators import runs as RUNS  # noqa: E402
from riskbeacon.operators import serving as SV  # noqa: E402
from riskbeacon.operators import support as H  # noqa: E402

F_PARAMS = dict(window_days=7, dataset="in_domain", model="baseline_persistence", region_id="AMERICA__NATION_1",
                time_id="2000-06-05", k=5, seed=0)


def _serving(spark, sf_dir):
    return RUNS.serving(spark, pipeline.serving_store(spark, sf_dir), F_PARAMS["seed"])


def _serving_sql(final: str, extra=None) -> str:
    parts = [f"(WITH {S.with_ctes(S.predictions_ctes(w), f'SELECT *, {w} AS time_window_days FROM preds')[5:]})"
             for w in (7, 3)]
    ctes = [("pboth", f"{parts[0]} UNION ALL {parts[1]}"),
            ("serv", f"""SELECT CAST(time_window_days AS INTEGER) AS time_window_days, region_id, time_id, y, y_count,
       model, dataset, y_score, y_pred, CAST(seed AS INTEGER) AS seed FROM pboth WHERE seed = {F_PARAMS['seed']}""")]
    return S.with_ctes(ctes + (extra or []), final)


_FW = (f"time_window_days = {F_PARAMS['window_days']} AND dataset = '{F_PARAMS['dataset']}' "
       f"AND model = '{F_PARAMS['model']}'")


@register("op_f1_available_choices", _serving_sql(
    f"""SELECT DISTINCT 'dataset' AS level, dataset AS value FROM serv WHERE time_window_days = 7
UNION ALL SELECT DISTINCT 'model', model FROM serv WHERE time_window_days = 7 AND dataset = 'in_domain'
UNION ALL SELECT DISTINCT 'region', region_id FROM serv WHERE {_FW}
UNION ALL SELECT DISTINCT 'time', time_id FROM serv WHERE {_FW}"""))
def q_f1(spark, sf_dir):
    p = F_PARAMS
    return SV.available(_serving(spark, sf_dir), p["window_days"], p["dataset"], p["model"])


@register("op_f2_single_prediction", _serving_sql(
    f"SELECT * FROM serv WHERE {_FW} AND region_id = '{F_PARAMS['region_id']}' AND time_id = '{F_PARAMS['time_id']}'"),
          doubles=["y_count", "y_score"])
def q_f2(spark, sf_dir):
    p = F_PARAMS
    return SV.single_prediction(_serving(spark, sf_dir), p["window_days"], p["dataset"], p["model"], p["region_id"],
                                p["time_id"])


@register("op_f3_area_trend", _serving_sql(
    f"SELECT time_id, y_score, y_pred, y_count, y FROM serv WHERE {_FW} AND region_id = '{F_PARAMS['region_id']}'"),
          doubles=["y_score", "y_count"])
def q_f3(spark, sf_dir):
    p = F_PARAMS
    return SV.area_trend(_serving(spark, sf_dir), p["window_days"], p["dataset"], p["model"], p["region_id"])


_F4_SQL = [("f4", f"""SELECT *, row_number() OVER (ORDER BY y_score DESC, region_id) AS rank,
       count(*) OVER () AS n, sum(y_count) OVER () AS total
FROM serv WHERE {_FW} AND time_id = '{F_PARAMS['time_id']}'"""),
           ("f4top", f"SELECT * FROM f4 WHERE rank <= greatest(1, least({F_PARAMS['k']}, n))")]


def _f4(spark, sf_dir):
    p = F_PARAMS
    return SV.topk_for_time(_serving(spark, sf_dir), p["window_days"], p["dataset"], p["model"], p["time_id"], p["k"])


@register("op_f4_topk_table", _serving_sql(
    "SELECT CAST(rank AS INTEGER) AS rank, region_id, y_score, y_pred, y_count, y FROM f4top", _F4_SQL),
          doubles=["y_score", "y_count"], bench=True)
def q_f4a(spark, sf_dir):
    return _f4(spark, sf_dir)[0]


@register("op_f4_topk_stats", _serving_sql(
    """SELECT CAST(greatest(1, least(5, max(n))) AS DOUBLE) AS k, CAST(max(n) AS DOUBLE) AS n_regions,
       CASE WHEN max(total) > 0 THEN sum(y_count) / max(total) ELSE 0.0 END AS coverage_at_k,
       coalesce(avg(CAST(y = 1 AS DOUBLE)), 0.0) AS topk_hit_rate, CAST(max(total) AS DOUBLE) AS total_incidents,
       CAST(sum(y_count) AS DOUBLE) AS topk_incidents FROM f4top""", _F4_SQL),
          doubles=["k", "n_regions", "coverage_at_k", "topk_hit_rate", "total_incidents", "topk_incidents"])
def q_f4b(spark, sf_dir):
    return _f4(spark, sf_dir)[1]


@register("op_f5_selected_rank", _serving_sql(
    f"""SELECT '{F_PARAMS['region_id']}' AS region_id, CAST(min(rank) AS INTEGER) AS rank, min(rank) IS NOT NULL AS in_topk
FROM f4top WHERE region_id = '{F_PARAMS['region_id']}'""", _F4_SQL))
def q_f5(spark, sf_dir):
    return SV.selected_rank(_f4(spark, sf_dir)[0], F_PARAMS["region_id"])


@register("op_f6_friendly_labels", _serving_sql(
    f"""SELECT *, CASE WHEN dataset = 'in_domain' AND contains(region_id, 'CPD_DIST_') THEN 'Chicago District ' ||
                 CASE WHEN ltrim(split_part(region_id, 'CPD_DIST_', -1), '0') = '' THEN '0'
                      ELSE ltrim(split_part(region_id, 'CPD_DIST_', -1), '0') END || ' [' || region_id || ']'
            WHEN contains(region_id, '__') THEN split_part(region_id, '__', 1) || ' Agency ' ||
                 substr(region_id, strpos(region_id, '__') + 2) || ' [' || region_id || ']'
            ELSE region_id END AS area_label,
       time_id || ' to ' || strftime(CAST(time_id AS DATE) + INTERVAL 6 DAY, '%Y-%m-%d') || ' [' || time_id || ']'
         AS window_label
FROM serv WHERE {_FW}"""), doubles=["y_count", "y_score"])
def q_f6(spark, sf_dir):
    p = F_PARAMS
    s = _serving(spark, sf_dir).filter((F.col("time_window_days") == p["window_days"])
                                       & (F.col("dataset") == p["dataset"]) & (F.col("model") == p["model"]))
    return SV.friendly_labels(s, p["window_days"])


# ======================================================== H: support =======
def _test_sql(w: int) -> str:
    return f"(WITH {S.with_ctes(S.split_ctes(w), 'SELECT * FROM test_x')[5:]})"


def _pct(col: str) -> str:
    return (f"(rank() OVER (ORDER BY {col}) + (count(*) OVER (PARTITION BY {col}) - 1) / 2.0) / count(*) OVER ()")


_H1_SQL = f"""WITH t7 AS {_test_sql(7)}, t3 AS {_test_sql(3)},
m7 AS (SELECT strftime(time_id, '%Y-%m') AS month, CAST(sum(y_count) AS DOUBLE) AS incidents_7d,
              avg(CAST(y AS DOUBLE)) AS posrate_7d FROM t7 GROUP BY 1),
m3 AS (SELECT strftime(time_id, '%Y-%m') AS month, CAST(sum(y_count) AS DOUBLE) AS incidents_3d,
              avg(CAST(y AS DOUBLE)) AS posrate_3d FROM t3 GROUP BY 1),
m AS (SELECT * FROM m7 JOIN m3 USING (month)),
r AS (SELECT *, ({_pct('incidents_7d')} + {_pct('incidents_3d')}) / 2 AS incident_rank_score,
              ({_pct('posrate_7d')} + {_pct('posrate_3d')}) / 2 AS pos_rank_score FROM m)
SELECT month, incidents_7d, incidents_3d, posrate_7d, posrate_3d, incident_rank_score, pos_rank_score,
       0.7 * incident_rank_score + 0.3 * pos_rank_score AS risk_score,
       CASE WHEN 0.7 * incident_rank_score + 0.3 * pos_rank_score >= 0.8 THEN 'Peak (surge staffing)'
            WHEN 0.7 * incident_rank_score + 0.3 * pos_rank_score >= 0.5 THEN 'High (reinforced patrol)'
            WHEN 0.7 * incident_rank_score + 0.3 * pos_rank_score >= 0.4 THEN 'Moderate (baseline+)'
            ELSE 'Low (baseline)' END AS staffing_tier
FROM r"""


@register("op_h1_staffing_priority", _H1_SQL,
          doubles=["incidents_7d", "incidents_3d", "posrate_7d", "posrate_3d", "incident_rank_score",
                   "pos_rank_score", "risk_score"], bench=True)
def q_h1(spark, sf_dir):
    r7, r3 = pipeline.window_runs(spark, sf_dir, (7, 3))
    return H.staffing_priority(r7.test, r3.test)


def _best_sel(spark, sf_dir, w):
    sel = TK.topk_selection_frequency(_preds(spark, sf_dir, w))
    best = M.best_model(_mlong(spark, sf_dir, w)).select("model")
    return sel.join(F.broadcast(best), "model", "left_semi")


def _h2_win_sql(w: int) -> str:
    body = S.with_ctes(S.predictions_ctes(w) + S.metrics_long_ctes(w) + _SEL_SQL, """SELECT s.region_id,
       avg(s.topk_selection_rate) AS sel FROM ssel s WHERE s.model = (
  SELECT model FROM (SELECT model, avg(value) AS mf,
         CASE model WHEN 'baseline_persistence' THEN 1 WHEN 'rolling_mean' THEN 2 ELSE 3 END AS o
         FROM mlong WHERE slice = 'overall' AND domain = 'in_domain' AND metric = 'f1' GROUP BY model)
  ORDER BY mf DESC, o LIMIT 1) GROUP BY s.region_id""")
    return f"(WITH {body[5:]})"


_H2_SQL = f"""WITH t7 AS {_test_sql(7)}, t3 AS {_test_sql(3)}, s7 AS {_h2_win_sql(7)}, s3 AS {_h2_win_sql(3)},
a7 AS (SELECT region_id, avg(y_count) AS avg_y_count_7d, avg(CAST(y AS DOUBLE)) AS pos_rate_7d FROM t7 GROUP BY 1),
a3 AS (SELECT region_id, avg(y_count) AS avg_y_count_3d, avg(CAST(y AS DOUBLE)) AS pos_rate_3d FROM t3 GROUP BY 1)
SELECT a7.region_id, avg_y_count_7d, pos_rate_7d, s7.sel AS topk_sel_rate_7d, avg_y_count_3d, pos_rate_3d,
       s3.sel AS topk_sel_rate_3d,
       CASE WHEN pos_rate_7d >= 0.5 THEN 'Tier-1 (persistent hotspot)' WHEN pos_rate_7d >= 0.3 THEN 'Tier-2 (elevated)'
            ELSE 'Tier-3 (monitor)' END AS policy_tier
FROM a7 LEFT JOIN s7 ON a7.region_id = s7.region_id LEFT JOIN a3 ON a7.region_id = a3.region_id
LEFT JOIN s3 ON a7.region_id = s3.region_id"""


@register("op_h2_district_priority", _H2_SQL,
          doubles=["avg_y_count_7d", "pos_rate_7d", "topk_sel_rate_7d", "avg_y_count_3d", "pos_rate_3d",
                   "topk_sel_rate_3d"])
def q_h2(spark, sf_dir):
    r7, r3 = pipeline.window_runs(spark, sf_dir, (7, 3))
    return H.district_priority(r7.test, r3.test, _best_sel(spark, sf_dir, 7), _best_sel(spark, sf_dir, 3))


# ======================================================== E: spatial =======
from riskbeacon.operators import spatial as SP  # noqa: E402

E_GEO = dict(window_days=7, k=5)


def _knn(spark, sf_dir):
    return pipeline.region_graph(spark, sf_dir)


def _chosen(spark, sf_dir):
    """E22's model and the smallest seed."""
    return M.chosen_model(_preds(spark, sf_dir, E_GEO["window_days"]))


def _hits(spark, sf_dir):
    p = E_GEO
    return SP.event_hit_classes(standin.geo_events(spark, sf_dir), _preds(spark, sf_dir, p["window_days"]),
                                _knn(spark, sf_dir), p["window_days"], _chosen(spark, sf_dir), p["k"])


_CHOSEN_SQL = S.metrics_ctes("preds", ["seed", "dataset", "model"], "bm_") + [
    ("chosen", f"""SELECT model, (SELECT min(seed) FROM preds) AS seed
FROM (SELECT model, avg(f1) AS mean_f1, list_position({list(M.MODEL_ORDER)}, model) AS o
      FROM bm_m WHERE dataset = 'in_domain' GROUP BY model) ORDER BY mean_f1 DESC, o LIMIT 1"""),
]
_HIT_SQL = S.knn_ctes() + _CHOSEN_SQL + [
    ("ge", S.geo_events()),
    ("tsub", """SELECT *, count(DISTINCT region_id) OVER (PARTITION BY time_id) AS n,
       row_number() OVER (PARTITION BY time_id ORDER BY y_score DESC, region_id) AS r
FROM preds JOIN chosen USING (model, seed) WHERE dataset = 'in_domain'"""),
    ("topk", f"SELECT CAST(time_id AS DATE) AS pred_time_id, region_id FROM tsub "
             f"WHERE r <= greatest(1, least({E_GEO['k']}, n))"),
    ("nbset", "SELECT DISTINCT t.pred_time_id, k.region_id FROM topk t JOIN knn k ON k.neighbor_id = t.region_id"),
    ("hits", f"""SELECT e.region_id, e.event_date, e.latitude, e.longitude, {S.time_bin('e.event_date', 7)} AS event_time_id,
       CAST({S.time_bin('e.event_date', 7)} - INTERVAL 7 DAY AS DATE) AS pred_time_id
FROM ge e WHERE e.event_date IS NOT NULL AND e.region_id IS NOT NULL AND e.latitude IS NOT NULL
  AND e.longitude IS NOT NULL"""),
    ("hcls", """SELECT h.*, (t.region_id IS NOT NULL) AS exact_hit,
       (t.region_id IS NULL AND nb.region_id IS NOT NULL) AS neighbor_hit,
       CASE WHEN t.region_id IS NOT NULL THEN 'Exact hit' WHEN nb.region_id IS NOT NULL THEN 'Neighbor hit'
            ELSE 'Miss' END AS coverage_class
FROM hits h LEFT JOIN topk t ON h.pred_time_id = t.pred_time_id AND h.region_id = t.region_id
LEFT JOIN nbset nb ON h.pred_time_id = nb.pred_time_id AND h.region_id = nb.region_id"""),
]


@register("op_e23_region_centroids", S.with_ctes(S.knn_ctes(), "SELECT * FROM cent"), doubles=["lon", "lat"])
def q_e23(spark, sf_dir):
    return SP.centroids(standin.geo_points(spark, sf_dir))


_E24_SQL = S.with_ctes([("lr", S.label_regions()), ("gp", S.geo_points()), (
    "p", """SELECT DISTINCT region_id, longitude AS x, latitude AS y FROM gp
WHERE region_id IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL"""), (
    "e", """SELECT a.region_id, a.x, a.y FROM p a JOIN p b ON a.region_id = b.region_id AND (a.x <> b.x OR a.y <> b.y)
WHERE NOT EXISTS (SELECT 1 FROM p c WHERE c.region_id = a.region_id AND (
  (b.x - a.x) * (c.y - a.y) - (b.y - a.y) * (c.x - a.x) < 0
  OR ((b.x - a.x) * (c.y - a.y) - (b.y - a.y) * (c.x - a.x) = 0
      AND (a.x - c.x) * (b.x - c.x) + (a.y - c.y) * (b.y - c.y) > 0)))"""), (
    "v", """SELECT DISTINCT * FROM e UNION ALL
SELECT region_id, x, y FROM p WHERE region_id IN (SELECT region_id FROM p GROUP BY 1 HAVING count(*) = 1)"""), (
    "m", """SELECT *, atan2(y - avg(y) OVER r, x - avg(x) OVER r) AS angle,
       row_number() OVER (PARTITION BY region_id ORDER BY x, y) = 1 AS lowest FROM v
WINDOW r AS (PARTITION BY region_id)""")],
    """SELECT m.region_id, CAST(row_number() OVER (PARTITION BY m.region_id ORDER BY
       m.angle - s.angle + CASE WHEN m.angle < s.angle THEN 2 * pi() ELSE 0 END) - 1 AS INTEGER) AS vertex,
       m.x AS longitude, m.y AS latitude
FROM m JOIN m s ON s.region_id = m.region_id AND s.lowest""")


@register("op_e24_convex_hulls", _E24_SQL, doubles=["longitude", "latitude"])
def q_e24(spark, sf_dir):
    return SP.convex_hulls(standin.geo_points(spark, sf_dir))


@register("op_e25_knn_graph", S.with_ctes(S.knn_ctes(), "SELECT * FROM knn"), doubles=["distance"])
def q_e25(spark, sf_dir):
    return _knn(spark, sf_dir)


@register("op_e26_event_hit_classes", _pred_sql("SELECT * FROM hcls", extra=_HIT_SQL),
          doubles=["latitude", "longitude"], bench=True)
def q_e26(spark, sf_dir):
    return _hits(spark, sf_dir)


@register("op_e27_hit_summary", _pred_sql(
    f"""SELECT 7 AS time_window_days, (SELECT model FROM chosen) AS model,
       CAST((SELECT seed FROM chosen) AS INTEGER) AS seed, {E_GEO['k']} AS topk_k, count(*) AS n_events_total,
       (SELECT CAST(CASE WHEN sum(c) <= 50000 THEN sum(c) ELSE least(50000, sum(greatest(1, floor(c * 50000.0 / t)))) END AS BIGINT)
        FROM (SELECT count(*) AS c, sum(count(*)) OVER () AS t FROM hcls GROUP BY coverage_class) k) AS n_events_sampled_for_plot,
       avg(CAST(exact_hit AS DOUBLE)) AS exact_hit_rate,
       avg(CAST(exact_hit OR neighbor_hit AS DOUBLE)) AS neighbor_aware_hit_rate FROM hcls""", extra=_HIT_SQL),
          doubles=["exact_hit_rate", "neighbor_aware_hit_rate"])
def q_e27(spark, sf_dir):
    p = E_GEO
    return SP.hit_summary(_hits(spark, sf_dir), p["window_days"], _chosen(spark, sf_dir), p["k"])


_E28_SQL = """SELECT * EXCLUDE (h, c, t, r) FROM (
  SELECT *, row_number() OVER (PARTITION BY coverage_class ORDER BY h) AS r FROM (
    SELECT *, count(*) OVER (PARTITION BY coverage_class) AS c, count(*) OVER () AS t, md5(concat_ws('|', '42', region_id,
      strftime(event_date, '%Y-%m-%d %H:%M:%S'), CAST(CAST(floor(latitude * 1000000.0::DOUBLE) AS BIGINT) AS VARCHAR),
      CAST(CAST(floor(longitude * 1000000.0::DOUBLE) AS BIGINT) AS VARCHAR))) AS h FROM hcls))
WHERE r <= CASE WHEN t <= 1000 THEN c ELSE greatest(1, floor(c * 1000.0::DOUBLE / t)) END ORDER BY h LIMIT 1000"""


@register("op_e28_stratified_hit_sample", _pred_sql(_E28_SQL, extra=_HIT_SQL), doubles=["latitude", "longitude"])
def q_e28(spark, sf_dir):
    return SP.stratified_sample(_hits(spark, sf_dir), n=1000)


@register("op_e29_exact_neighbor_rates", _pred_sql(
    """SELECT p.region_id,
       avg(CAST(p.y_pred = 1 AND p.y = 1 AS DOUBLE)) AS exact_hit_rate,
       avg(CAST(p.y_pred = 1 AND NOT (p.y = 1) AND nb.region_id IS NOT NULL AS DOUBLE)) AS neighbor_only_hit_rate,
       avg(CAST(p.y_pred = 1 AS DOUBLE)) AS pred_positive_rate
FROM (SELECT * FROM preds WHERE dataset = 'in_domain' AND model = (SELECT model FROM chosen)) p
LEFT JOIN (SELECT DISTINCT q.seed, q.time_id, k.region_id FROM preds q JOIN knn k ON k.neighbor_id = q.region_id
           WHERE q.dataset = 'in_domain' AND q.model = (SELECT model FROM chosen) AND q.y = 1) nb
  ON p.seed = nb.seed AND p.time_id = nb.time_id AND p.region_id = nb.region_id
GROUP BY p.region_id""", extra=S.knn_ctes() + _CHOSEN_SQL),
          doubles=["exact_hit_rate", "neighbor_only_hit_rate", "pred_positive_rate"])
def q_e29(spark, sf_dir):
    return SP.exact_neighbor_rates(_preds(spark, sf_dir), _knn(spark, sf_dir), _chosen(spark, sf_dir))


# ======================================================== E: tables ========
from riskbeacon.operators import tables as TB  # noqa: E402


def _dist_inputs(spark, sf_dir):
    r = pipeline.window_run(spark, sf_dir, 7)
    ev_in = pipeline.in_domain_events(spark, sf_dir)
    split = F.lit(standin.STANDIN_SPLIT_DATE).cast("timestamp")
    events = {"in_train": ev_in.filter(F.col("event_date") < split),
              "in_domain": ev_in.filter(F.col("event_date") >= split),
              "out_domain": standin.out_domain_events(spark, sf_dir)}
    xys = {"in_train": r.train, "in_domain": r.test, "out_domain": r.out}
    return events, xys


def _dist_sql(with_pos: bool) -> str:
    axis = ", ".join(f"({i}, '{g}')" for i, g in enumerate(CRIME_GROUPS))
    evs = {"in_train": f"SELECT * FROM ev_in WHERE event_date < TIMESTAMP '{standin.STANDIN_SPLIT_DATE}'",
           "in_domain": f"SELECT * FROM ev_in WHERE event_date >= TIMESTAMP '{standin.STANDIN_SPLIT_DATE}'",
           "out_domain": "SELECT * FROM ev_out"}
    xy = {"in_train": "train_x", "in_domain": "test_x", "out_domain": "out_x"}
    parts = []
    for name, src in evs.items():
        if with_pos:
            parts.append(f"""SELECT '{name}' AS dataset, a.ord, a.crime_group, CAST(coalesce(c.n, 0) AS BIGINT) AS incidents_n,
       coalesce(c.n, 0) / greatest((SELECT count(*) FROM ({src}) z), 1) AS incidents_pct,
       coalesce((SELECT avg(CAST(y AS DOUBLE)) FROM {xy[name]}), 0.0) AS positive_rate
FROM (VALUES {axis}) a(ord, crime_group) LEFT JOIN (SELECT crime_group, count(*) AS n FROM ({src}) s GROUP BY 1) c
  ON a.crime_group = c.crime_group""")
        else:
            parts.append(f"""SELECT '{name}' AS dataset, a.ord, a.crime_group, CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM (VALUES {axis}) a(ord, crime_group) LEFT JOIN (SELECT crime_group, count(*) AS n FROM ({src}) s GROUP BY 1) c
  ON a.crime_group = c.crime_group""")
    return S.with_ctes(S.split_ctes(7), "\nUNION ALL\n".join(parts))


@register("op_e30_distribution_table", _dist_sql(True), doubles=["incidents_pct", "positive_rate"])
def q_e30(spark, sf_dir):
    ev, xys = _dist_inputs(spark, sf_dir)
    return TB.distribution_table(spark, ev, xys)


_T2_SQL = ("SELECT model, domain, metric, avg(value) AS mean, coalesce(stddev_samp(value), 0.0) AS std "
           "FROM mlong WHERE slice = 'overall' GROUP BY 1, 2, 3")


@register("op_e31_results_numeric", _mlong_sql(_T2_SQL), doubles=["mean", "std"])
def q_e31a(spark, sf_dir):
    return TB.results_numeric(_mlong(spark, sf_dir))


@register("op_e31_results_formatted", _mlong_sql(
    f"SELECT model, domain || '_' || metric AS \"column\", printf('%.3f ± %.3f', mean, std) AS cell FROM ({_T2_SQL}) t"))
def q_e31b(spark, sf_dir):
    return TB.results_formatted(_mlong(spark, sf_dir))


def _wide_cells() -> str:
    return ", ".join(f"coalesce(max(cell) FILTER (WHERE col = '{d}_{m}'), 'NA') AS {d}_{m}"
                     for d in TB.RESULT_DOMAINS for m in TB.RESULT_METRICS)


@register("op_e31_results_wide", _mlong_sql(
    f"""SELECT model, {_wide_cells()} FROM (SELECT model, domain || '_' || metric AS col,
       printf('%.3f ± %.3f', mean, std) AS cell FROM ({_T2_SQL}) t) w GROUP BY model"""))
def q_e31c(spark, sf_dir):
    return TB.results_wide(_mlong(spark, sf_dir))


@register("op_e32_processed_group_counts", _dist_sql(False))
def q_e32(spark, sf_dir):
    ev, _ = _dist_inputs(spark, sf_dir)
    return TB.processed_group_counts(spark, ev)


def _e33_sql(metric: str) -> str:
    cells = ", ".join(f"avg({metric}) FILTER (WHERE region_bucket = 'Q{i}') AS Q{i}" for i in range(1, 5))
    return _pred_sql(f"SELECT model, {cells} FROM e9_m GROUP BY model",
                     extra=_BUCKET_SQL + S.metrics_ctes("bsrc", ["seed", "model", "region_bucket"], "e9_"))


@register("op_e33_model_bucket_auc", _e33_sql("auc"), doubles=["Q1", "Q2", "Q3", "Q4"])
def q_e33a(spark, sf_dir):
    return TB.model_bucket_matrix(M.region_bucket_metrics_by_seed(_preds(spark, sf_dir), _keep(spark)), "auc")


@register("op_e33_model_bucket_f1", _e33_sql("f1"), doubles=["Q1", "Q2", "Q3", "Q4"])
def q_e33b(spark, sf_dir):
    return TB.model_bucket_matrix(M.region_bucket_metrics_by_seed(_preds(spark, sf_dir), _keep(spark)), "f1")


@register("op_e34_coverage_curve", _pred_sql(
    "SELECT domain, model, k, avg(coverage) AS mean, coalesce(stddev_samp(coverage), 0.0) AS std "
    "FROM cseed GROUP BY 1, 2, 3", extra=_COV_SQL), doubles=["mean", "std"])
def q_e34a(spark, sf_dir):
    return TB.mean_std(TK.topk_coverage_by_seed(_preds(spark, sf_dir)), ["domain", "model", "k"], "coverage")


@register("op_e34_neighbor_vs_exact_f1", _mlong_sql(
    "SELECT domain, model, slice, avg(value) AS mean, coalesce(stddev_samp(value), 0.0) AS std FROM mlong "
    "WHERE metric = 'f1' AND slice IN ('overall', 'neighbor_overall') GROUP BY 1, 2, 3"), doubles=["mean", "std"])
def q_e34b(spark, sf_dir):
    ml = _mlong(spark, sf_dir).filter((F.col("metric") == "f1") & F.col("slice").isin("overall", "neighbor_overall"))
    return TB.mean_std(ml, ["domain", "model", "slice"], "value")


@register("op_e34_overall_bars", _mlong_sql(
    "SELECT domain, model, metric, avg(value) AS mean, coalesce(stddev_samp(value), 0.0) AS std FROM mlong "
    "WHERE slice = 'overall' AND metric IN ('auc', 'f1', 'precision', 'recall') GROUP BY 1, 2, 3"),
          doubles=["mean", "std"])
def q_e34c(spark, sf_dir):
    ml = _mlong(spark, sf_dir).filter((F.col("slice") == "overall") & F.col("metric").isin(*TB.RESULT_METRICS))
    return TB.mean_std(ml, ["domain", "model", "metric"], "value")


@register("op_e34_monthly_f1", _mlong_sql(
    "SELECT dataset AS domain, model, date_bucket, avg(f1) AS mean, coalesce(stddev_samp(f1), 0.0) AS std "
    "FROM tm_m GROUP BY 1, 2, 3"), doubles=["mean", "std"])
def q_e34d(spark, sf_dir):
    return TB.mean_std(M.temporal_f1_by_seed(_preds(spark, sf_dir), "M"), ["domain", "model", "date_bucket"], "value")


def _e35_spark(spark, sf_dir):
    pipeline.window_runs(spark, sf_dir, (7, 3))
    thr = _thr_spark(spark, sf_dir, 7).unionByName(_thr_spark(spark, sf_dir, 3))
    ml = _mlong_both(spark, sf_dir)
    return TB.window_report(thr, M.window_overall_summary(ml), M.window_gap_summary(ml))


_E35_SQL = _mlong_both_sql(f"""SELECT 'threshold' AS section, 7 AS time_window, '' AS model, '' AS domain,
       'threshold' AS metric, CAST(threshold AS DOUBLE) AS value FROM ({_thr_sql(7)}) a
UNION ALL SELECT 'threshold', 3, '', '', 'threshold', CAST(threshold AS DOUBLE) FROM ({_thr_sql(3)}) b
UNION ALL SELECT 'overall', time_window_days, model, domain, metric, avg(value) FROM mboth
  WHERE slice = 'overall' AND metric IN ('auc', 'f1') GROUP BY 2, 3, 4, 5
UNION ALL SELECT 'gap', time_window_days, model, 'in-out', metric, avg(delta) FROM {_GAP_SQL} g GROUP BY 2, 3, 5""")


@register("op_e35_window_report", _E35_SQL, doubles=["value"])
def q_e35(spark, sf_dir):
    return _e35_spark(spark, sf_dir)


# ======================================================== C: prep ==========
from riskbeacon.operators import prep as PR  # noqa: E402


def _xy_frames(spark, sf_dir):
    r = pipeline.window_run(spark, sf_dir, 7)
    return {"Xy_in_train": r.xy("in_train"), "Xy_in_domain": r.xy("in_domain"), "Xy_out_domain": r.xy("out_domain")}


@register("op_c24_schema_consistency", S.with_ctes(S.split_ctes(7), """SELECT d.dataset, d.n_rows, c.n_columns, c.consistent
FROM (SELECT 'Xy_in_train' AS dataset, count(*) AS n_rows FROM train_x UNION ALL
      SELECT 'Xy_in_domain', count(*) FROM test_x UNION ALL SELECT 'Xy_out_domain', count(*) FROM out_x) d,
     (SELECT CAST(31 AS BIGINT) AS n_columns, TRUE AS consistent) c"""))
def q_c24(spark, sf_dir):
    frames = _xy_frames(spark, sf_dir)
    sch = labels.schema_consistency(spark, frames)
    per = sch.groupBy("dataset").agg(F.count(F.lit(1)).alias("n_columns"), F.bool_and("matches_base").alias("consistent"))
    counts = None
    for name, f in frames.items():
        c = f.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("dataset", F.lit(name))
        counts = c if counts is None else counts.unionByName(c)
    return counts.join(F.broadcast(per), "dataset").select("dataset", "n_rows", "n_columns", "consistent")


def _fit_sql() -> str:
    long = "\nUNION ALL\n".join(f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM train_x"
                                for f in FEATURE_NUMERIC)
    return S.split_ctes(7) + [
        ("flong", long),
        ("fmed", "SELECT feature, median(value) AS median FROM flong GROUP BY 1"),
        ("ffit", """SELECT m.feature, coalesce(m.median, 0.0) AS median, avg(coalesce(l.value, m.median, 0.0)) AS mean,
       CASE WHEN stddev_pop(coalesce(l.value, m.median, 0.0)) IS NULL OR stddev_pop(coalesce(l.value, m.median, 0.0)) = 0
            THEN 1.0 ELSE stddev_pop(coalesce(l.value, m.median, 0.0)) END AS std
FROM flong l JOIN fmed m ON l.feature = m.feature GROUP BY m.feature, m.median"""),
    ]


@register("op_c26_preprocess_fit", S.with_ctes(_fit_sql(), "SELECT * FROM ffit"), doubles=["median", "mean", "std"], bench=True)
def q_c26a(spark, sf_dir):
    return PR.fit_numeric(pipeline.window_run(spark, sf_dir, 7).train)


def _tr_sql() -> str:
    cols = ", ".join(f"(coalesce(CAST({f} AS DOUBLE), (SELECT median FROM ffit WHERE feature = '{f}')) "
                     f"- (SELECT mean FROM ffit WHERE feature = '{f}')) / (SELECT std FROM ffit WHERE feature = '{f}') "
                     f"AS {f}" for f in FEATURE_NUMERIC)
    return S.with_ctes(_fit_sql(), f"SELECT region_id, time_id, {cols}, y, y_count FROM test_x")


@register("op_c26_preprocess_transform", _tr_sql(), doubles=FEATURE_NUMERIC + ["y_count"])
def q_c26b(spark, sf_dir):
    r = pipeline.window_run(spark, sf_dir, 7)
    return PR.transform_numeric(r.test, PR.numeric_params(r.train))


@register("op_c27_one_hot_state", S.with_ctes(S.split_ctes(7), """SELECT t.region_id, t.time_id, v.category,
       CAST(trim(coalesce(t.region_state, '__MISSING__')) = v.category AS DOUBLE) AS value
FROM test_x t, (SELECT DISTINCT trim(coalesce(region_state, '__MISSING__')) AS category FROM train_x) v"""),
          doubles=["value"])
def q_c27(spark, sf_dir):
    r = pipeline.window_run(spark, sf_dir, 7)
    vocab = PR.dense_names(PR.vocabulary(r.train, "region_state", _keep(spark)))
    oh = PR.one_hot(r.test.select("region_id", "time_id", "region_state"), "region_state", vocab)
    cols = [f"region_state__{v}" for v in vocab]
    return (oh.select("region_id", "time_id", *[F.col(f"`{c}`").alias(c.split("__", 1)[1]) for c in cols])
            .unpivot(["region_id", "time_id"], vocab, "category", "value"))


@register("op_c27_one_hot_sparse", """WITH v AS (
  SELECT *, row_number() OVER (ORDER BY category) - 1 AS "index"
  FROM (SELECT DISTINCT trim(coalesce(c_name, '__MISSING__')) AS category FROM customer WHERE c_custkey % 10 <> 3))
SELECT c_custkey, v."index" FROM customer LEFT JOIN v ON trim(coalesce(c_name, '__MISSING__')) = v.category""")
def q_c27_sparse(spark, sf_dir):
    """A wide column: customer names, known from the customers whose key doesn't end in 3; the others are unseen."""
    c = standin.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    vocab = PR.vocabulary(c.filter(F.col("c_custkey") % 10 != 3), "c_name", _keep(spark))
    return PR.one_hot_sparse(c, "c_name", vocab).select("c_custkey", "index")


def _seq_sql(step: int, length: int = 8) -> str:
    back = length - 1 - step
    cells = FEATURE_NUMERIC if not back else [
        f"coalesce(CAST(lag({f}, {back}) OVER w AS DOUBLE), 0.0) AS {f}" for f in FEATURE_NUMERIC]
    return (f"SELECT region_id, time_id, {step} AS step, {', '.join(cells)} FROM test_x "
            "WINDOW w AS (PARTITION BY region_id ORDER BY time_id)")


@register("op_c28_sequences", S.with_ctes(S.split_ctes(7), "\nUNION ALL\n".join(_seq_sql(s) for s in range(8))),
          doubles=FEATURE_NUMERIC)
def q_c28(spark, sf_dir):
    seq = PR.sequences(pipeline.window_run(spark, sf_dir, 7).test, FEATURE_NUMERIC)
    return (seq.select("region_id", "time_id", F.posexplode("sequence").alias("step", "v"))
            .select("region_id", "time_id", F.col("step").cast("int").alias("step"),
                    *[F.col("v")[i].alias(f) for i, f in enumerate(FEATURE_NUMERIC)]))


# ======================================================== B: harmonize =====
from riskbeacon.functions.expr import CITY_TYPE_GROUPS, clean_region_token  # noqa: E402
from riskbeacon.operators import eda as EDA  # noqa: E402
from riskbeacon.operators import harmonize as HZ  # noqa: E402
from riskbeacon.sources import readers as RD  # noqa: E402


@register("op_b1_region_tokens", (f"""SELECT 'nation' AS source, n_name AS raw, {S.tok('n_name')} AS token
FROM nation UNION ALL SELECT 'region', r_name, {S.tok('r_name')} FROM region
UNION ALL SELECT DISTINCT 'segment', lower(c_mktsegment), {S.tok('lower(c_mktsegment)')} FROM customer
UNION ALL SELECT 'agency_float', CAST(c_custkey AS VARCHAR) || '.0', {S.tok("CAST(c_custkey AS VARCHAR) || '.0'")}
FROM customer"""))
def q_b1(spark, sf_dir):
    n = standin.table(spark, sf_dir, "nation").select(F.lit("nation").alias("source"), F.col("n_name").alias("raw"))
    r = standin.table(spark, sf_dir, "region").select(F.lit("region").alias("source"), F.col("r_name").alias("raw"))
    cu = standin.table(spark, sf_dir, "customer")
    s = cu.select(F.lit("segment").alias("source"), F.lower("c_mktsegment").alias("raw")).distinct()
    a = cu.select(F.lit("agency_float").alias("source"), F.concat(F.col("c_custkey").cast("string"), F.lit(".0")).alias("raw"))
    return n.unionByName(r).unionByName(s).unionByName(a).withColumn("token", clean_region_token("raw"))


@register("op_b2_city_mapping_table", S.with_ctes([("city", S.city())], """SELECT DISTINCT "Primary Type" AS city_raw_type,
       CAST(NULL AS VARCHAR) AS crime_group FROM city WHERE "Primary Type" IS NOT NULL"""))
def q_b2(spark, sf_dir):
    return HZ.city_mapping_table(standin.city_clean(spark, sf_dir), "Primary Type")


_MIXED_SQL = ("cmix", f"""SELECT * REPLACE (
  list_extract({standin.MIXED_TYPES_SQL}, CAST("ID" % {len(standin.MIXED_TYPES)} + 1 AS INTEGER)) AS "Primary Type",
  CASE WHEN "ID" % 89 = 0 THEN NULL WHEN "ID" % 97 = 0 THEN '13/45/2001 99:00:00 PM' ELSE "Date" END AS "Date",
  CASE WHEN "ID" % 101 = 0 THEN NULL WHEN "ID" % 103 = 0 THEN 'nan' ELSE CAST("District" AS VARCHAR) || '.0' END AS "District")
FROM craw""")
_MIXED_EVENTS_SQL = S.with_ctes([("craw", S.city_raw()), _MIXED_SQL, ("cev", f"""SELECT
       CAST(try_strptime("Date", '%m/%d/%Y %I:%M:%S %p') AS TIMESTAMP) AS event_date,
       'IL__CPD_DIST_' || {S.tok('"District"')} AS region_id,
       {S.case_map('upper(trim("Primary Type"))', CITY_TYPE_GROUPS)} AS crime_group, "Primary Type" AS raw_type FROM cmix""")],
    "{}")


def _mixed_events(spark, sf_dir, drop_invalid):
    agency = HZ.RegionStrategy("agency", "agency_id", None, "")
    return HZ.city_events(standin.city_mixed(spark, sf_dir), "Date", "Primary Type", "District", agency,
                          date_format=EDA.EXPORT_TS_FORMAT, drop_invalid=drop_invalid)


@register("op_b2_city_types", S.with_ctes([("craw", S.city_raw()), _MIXED_SQL], f"""SELECT DISTINCT "Primary Type" AS city_raw_type,
       {S.case_map('upper(trim("Primary Type"))', CITY_TYPE_GROUPS)} AS crime_group FROM cmix WHERE "Primary Type" IS NOT NULL"""))
def q_b2_types(spark, sf_dir):
    """All fixed types, odd spellings of them and unmapped ones."""
    return HZ.city_mapping_table(standin.city_mixed(spark, sf_dir), "Primary Type")


@register("op_b7_city_events", _MIXED_EVENTS_SQL.format(
    "SELECT * FROM cev WHERE event_date IS NOT NULL AND crime_group IS NOT NULL AND region_id IS NOT NULL"))
def q_b7_events(spark, sf_dir):
    """Rows with bad or missing dates and unmapped types are dropped."""
    return _mixed_events(spark, sf_dir, True)


@register("op_b10_city_load_quality", _MIXED_EVENTS_SQL.format("""SELECT count(*) AS n_rows,
       avg(CAST(event_date IS NULL AS DOUBLE)) AS invalid_date_rate, avg(CAST(crime_group IS NULL AS DOUBLE)) AS unmapped_rate,
       count(DISTINCT region_id) AS n_regions FROM cev"""), doubles=["invalid_date_rate", "unmapped_rate"])
def q_b10_city(spark, sf_dir):
    return HZ.load_quality(_mixed_events(spark, sf_dir, False))


@register("op_b5_region_strategies", """SELECT * FROM (VALUES
  ('all', CASE WHEN (SELECT bool_or(c_custkey IS NOT NULL) FROM customer) THEN 'agency' ELSE 'county' END, 'agency_id', 'ori'),
  ('no ids', CASE WHEN (SELECT bool_or(c_phone IS NOT NULL) FROM cust) THEN 'agency' ELSE 'county' END, 'ori', 'agency_id'),
  ('names', CASE WHEN (SELECT bool_or(n_name IS NOT NULL) FROM nation) THEN 'county' END, 'county_name', 'agency_id'),
  ('states', 'state_agency', 'state_abbr', 'agency_id')) t(case_name, strategy, primary_field, fallback_field)"""
          .replace("c_phone IS NOT NULL) FROM cust", "c_name IS NOT NULL) FROM customer"))
def q_b5_cases(spark, sf_dir):
    """Each branch: descriptors held by all agencies, by ORI alone, county names alone, none."""
    full = standin.nat_agencies(spark, sf_dir)
    none = F.lit(None).cast("string")
    bare = full.withColumn("agency_id", none)
    cases = {"all": full, "no ids": bare.withColumn("ori", F.coalesce(full["state_name"], F.lit("x"))), "names": bare,
             "states": bare.withColumn("county_name", none)}
    return reduce(DataFrame.unionByName, [
        HZ.strategy_frame(spark, HZ.decide_region_strategy(df)).select(
            F.lit(name).alias("case_name"), "strategy", "primary_field", "fallback_field") for name, df in cases.items()])


_B3_CASE = """CASE WHEN contains(upper(coalesce(cat, 'NAN')), 'LARCENY/THEFT') THEN 'theft_larceny'
  WHEN contains(upper(coalesce(cat, 'NAN')), 'ASSAULT OFFENSES') THEN 'assault_battery'
  WHEN contains(upper(coalesce(cat, 'NAN')), 'BURGLARY/BREAKING & ENTERING') OR upper(coalesce(code, 'NAN')) = '220' THEN 'burglary'
  WHEN upper(coalesce(cat, 'NAN')) = 'ROBBERY' OR upper(coalesce(code, 'NAN')) = '120' THEN 'robbery'
  WHEN contains(upper(coalesce(cat, 'NAN')), 'MOTOR VEHICLE THEFT') OR upper(coalesce(code, 'NAN')) = '240' THEN 'motor_vehicle_theft'
  WHEN contains(upper(coalesce(cat, 'NAN')), 'DRUG/NARCOTIC OFFENSES') THEN 'drug_narcotics'
  WHEN contains(upper(coalesce(nm, 'NAN')), 'ASSAULT') THEN 'assault_battery'
  WHEN contains(upper(coalesce(nm, 'NAN')), 'LARCENY') OR contains(upper(coalesce(nm, 'NAN')), 'THEFT') THEN 'theft_larceny'
  WHEN contains(upper(coalesce(nm, 'NAN')), 'BURGLARY') THEN 'burglary'
  WHEN contains(upper(coalesce(nm, 'NAN')), 'ROBBERY') THEN 'robbery'
  WHEN contains(upper(coalesce(nm, 'NAN')), 'MOTOR VEHICLE THEFT') THEN 'motor_vehicle_theft'
  WHEN contains(upper(coalesce(nm, 'NAN')), 'DRUG') OR contains(upper(coalesce(nm, 'NAN')), 'NARCOTIC') THEN 'drug_narcotics'
  ELSE NULL END"""


@register("op_b3_offense_mapping_table", f"""SELECT nm AS national_raw_offense, code AS offense_code,
       cat AS offense_category_name, {_B3_CASE} AS crime_group
FROM (SELECT DISTINCT p_type AS nm, CAST(p_partkey AS VARCHAR) AS code, p_brand AS cat FROM part) t""")
def q_b3(spark, sf_dir):
    return HZ.national_mapping_table(standin.nat_offense_type(spark, sf_dir))


@register("op_b5_region_strategy", """SELECT CASE WHEN bool_or(c_custkey IS NOT NULL) THEN 'agency' ELSE 'county' END
       AS strategy, 'agency_id' AS primary_field, 'ori' AS fallback_field FROM customer""")
def q_b5(spark, sf_dir):
    st = HZ.decide_region_strategy(standin.nat_agencies(spark, sf_dir))
    return HZ.strategy_frame(spark, st).select("strategy", "primary_field", "fallback_field")


@register("op_b6_region_ids", f"""SELECT c.c_custkey AS agency_id,
       {S.tok('r.r_name')} || '__' || {S.tok('c.c_custkey')} AS region_agency,
       CASE WHEN {S.tok('n.n_name')} <> 'UNKNOWN' THEN {S.tok('r.r_name')} || '__' || {S.tok('n.n_name')}
            ELSE {S.tok('r.r_name')} || '__' || {S.tok('c.c_custkey')} END AS region_county,
       {S.tok('r.r_name')} || '__' || {S.tok('c.c_custkey')} AS region_state_agency
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")
def q_b6(spark, sf_dir):
    ag = standin.nat_agencies(spark, sf_dir)
    agency = HZ.RegionStrategy("agency", "agency_id", None, "")
    state_agency = HZ.RegionStrategy("state_agency", "state_abbr", "agency_id", "")
    return ag.select("agency_id", HZ.national_region_id(ag, agency).alias("region_agency"),
                     HZ.national_region_id(ag, pipeline.COUNTY_STRATEGY).alias("region_county"),
                     HZ.national_region_id(ag, state_agency).alias("region_state_agency"))


@register("op_b7_city_events_raw", S.with_ctes([("craw", S.city_raw())], """SELECT
       CAST(strptime("Date", '%m/%d/%Y %I:%M:%S %p') AS TIMESTAMP) AS event_date,
       'IL__CPD_DIST_' || """ + S.tok('"District"') + """ AS region_id, CAST(NULL AS VARCHAR) AS crime_group,
       "Primary Type" AS raw_type FROM craw"""))
def q_b7(spark, sf_dir):
    raw = standin.city_raw(spark, sf_dir)
    agency = HZ.RegionStrategy("agency", "agency_id", None, "")
    return HZ.city_events(raw, "Date", "Primary Type", "District", agency, date_format=EDA.EXPORT_TS_FORMAT,
                          drop_invalid=False)


_B9_MORE = ", CAST(l.l_partkey AS VARCHAR) AS offense_code, r.r_name AS source_state"


@register("op_b9_national_events", S.with_ctes([("ev", S.events_in(_B9_MORE))], "SELECT * FROM ev"), bench=True)
def q_b9(spark, sf_dir):
    return pipeline.in_domain_events(spark, sf_dir)


@register("op_b10_load_quality", S.with_ctes([("ev", S.events_in())], """SELECT count(*) AS n_rows,
       0.0 AS invalid_date_rate, 0.0 AS unmapped_rate, count(DISTINCT region_id) AS n_regions FROM ev"""),
          doubles=["invalid_date_rate", "unmapped_rate"])
def q_b10(spark, sf_dir):
    raw = HZ.national_events(
        standin.nat_offense(spark, sf_dir), standin.nat_incident(spark, sf_dir), standin.nat_offense_type(spark, sf_dir),
        standin.nat_agencies(spark, sf_dir), pipeline.COUNTY_STRATEGY,
        group_expr=standin.standin_group(F.col("offense_name")), drop_invalid=False)
    return HZ.load_quality(raw)


@register("op_b11_unmapped_ratio", f"""SELECT avg(CAST(({S.case_map('event_type', standin.STANDIN_EVENT_GROUPS)}) IS NULL
       AS DOUBLE)) AS unmapped_ratio, count(*) AS n_rows FROM events""", doubles=["unmapped_ratio"])
def q_b11(spark, sf_dir):
    ev = standin.table(spark, sf_dir, "events").select(
        standin.map_pairs(F.col("event_type"), standin.STANDIN_EVENT_GROUPS).alias("crime_group"))
    return HZ.unmapped_ratio(ev)


@register("op_b11_unmapped_by_source", S.with_ctes([("city", S.city())], f"""SELECT 'city' AS source,
       avg(CAST(({S.case_map('upper(trim("Primary Type"))', CITY_TYPE_GROUPS)}) IS NULL AS DOUBLE)) AS unmapped_ratio, count(*) AS n_rows FROM city
UNION ALL SELECT 'national', avg(CAST(({_B3_CASE}) IS NULL AS DOUBLE)), count(*)
FROM (SELECT p.p_type AS nm, CAST(l.l_partkey AS VARCHAR) AS code, p.p_brand AS cat
      FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey) t"""), doubles=["unmapped_ratio"])
def q_b11b(spark, sf_dir):
    return HZ.unmapped_by_source(standin.city_clean(spark, sf_dir), "Primary Type",
                                 standin.nat_offense(spark, sf_dir), standin.nat_offense_type(spark, sf_dir))


_EDA_YEARS = (1996, 2001)


@register("op_b12_eda_clean", S.with_ctes([("craw", S.city_raw())], S.eda_clean(*_EDA_YEARS)),
          doubles=["Latitude", "Longitude"])
def q_b12(spark, sf_dir):
    return EDA.clean_export(standin.city_raw(spark, sf_dir), _EDA_YEARS)


@register("op_b13_time_features", S.with_ctes([("craw", S.city_raw()), ("cl", S.eda_clean(*_EDA_YEARS))],
                                              """SELECT "Date", "Time", CAST(month("Date") AS TINYINT) AS "Month",
       dayname("Date") AS "DayOfWeek", CAST(hour(strptime("Time", '%H:%M:%S')) AS TINYINT) AS "Hour" FROM cl"""))
def q_b13(spark, sf_dir):
    return EDA.time_features(EDA.clean_export(standin.city_raw(spark, sf_dir), _EDA_YEARS)).select(
        "Date", "Time", "Month", "DayOfWeek", "Hour")


@register("op_b14_year_split_summary", S.with_ctes([("craw", S.city_raw()), ("cl", S.eda_clean(*_EDA_YEARS))],
                                                   """SELECT CASE WHEN "Year" = 2001 THEN 'test' ELSE 'train' END AS split,
       count(*) AS n_rows, min("Date") AS min_date, max("Date") AS max_date FROM cl WHERE "Year" <= 2001 GROUP BY 1"""))
def q_b14(spark, sf_dir):
    return EDA.split_summary(EDA.year_split(EDA.clean_export(standin.city_raw(spark, sf_dir), _EDA_YEARS), 2001))


@register("op_b14_year_split_rows", S.with_ctes([("craw", S.city_raw()), ("cl", S.eda_clean(*_EDA_YEARS))],
                                                """SELECT CASE WHEN "Year" = 2001 THEN 'test' ELSE 'train' END AS split, *
FROM cl WHERE "Year" <= 2001"""), doubles=["Latitude", "Longitude"])
def q_b14_rows(spark, sf_dir):
    """The rows of both sets, written apart and read back."""
    import uuid
    parts = EDA.year_split(EDA.clean_export(standin.city_raw(spark, sf_dir), _EDA_YEARS), 2001)
    root = f"{table_root(spark)}/year-split-{uuid.uuid4().hex[:8]}"
    out = []
    for name in ("train", "test"):
        RD.write_table(parts.filter(F.col("split") == name).drop("split"), f"{root}/{name}")
        out.append(RD.read_table(spark, f"{root}/{name}").withColumn("split", F.lit(name)))
    return out[0].unionByName(out[1])


# ======================================================== A: sources =======
_A4_NUMERIC = ["o_orderkey", "o_custkey", "o_totalprice"]
_A4_ALL = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
_A4_STATS = {"count": "count({c})", "mean": "avg({c})", "stddev": "stddev_samp({c})", "min": "min({c})", "max": "max({c})"}


@register("op_a4_profile_orders", "\nUNION ALL ".join(
    [f"SELECT '{c}' AS \"column\", '{k}' AS stat, CAST({e.format(c=c)} AS DOUBLE) AS value FROM orders"
     for c in _A4_NUMERIC for k, e in _A4_STATS.items()]
    + [f"SELECT '{c}', 'nulls', CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) FROM orders" for c in _A4_ALL]),
    doubles=["value"])
def q_a4(spark, sf_dir):
    return RD.profile(standin.table(spark, sf_dir, "orders"))


def _national_tree(spark, sf_dir) -> str:
    """The national stand-in tables as a tree of CSV tables: two roots with
    half of the incidents each, one folder without agencies, two city exports."""
    import uuid
    root = f"{table_root(spark)}/raw-{uuid.uuid4().hex[:8]}"
    tables = {"NIBRS_incident.csv": standin.nat_incident(spark, sf_dir),
              "NIBRS_OFFENSE.csv": standin.nat_offense(spark, sf_dir),
              "NIBRS_OFFENSE_TYPE.csv": standin.nat_offense_type(spark, sf_dir),
              "agencies.csv": standin.nat_agencies(spark, sf_dir)}
    for half in (0, 1):
        for name, df in tables.items():
            if "incident_id" in df.columns:
                df = df.filter(F.col("incident_id") % 2 == half)
            elif half:  # codes and agencies stand in the first root; here are none besides the header
                df = df.limit(0)
            RD.write_table(df, f"{root}/state{half}/{name}", fmt="csv")
    RD.write_table(tables["NIBRS_incident.csv"], f"{root}/partial/NIBRS_incident.csv", fmt="csv")
    raw = standin.city_raw(spark, sf_dir).select("Case Number", "Date", "Primary Type", "District")
    last = F.col("Date").contains("/2001 ")
    RD.write_table(raw.filter(~last), f"{root}/city/Crime_Train_2015_2024.csv", fmt="csv")
    RD.write_table(raw.filter(last), f"{root}/city/Crime_Test_2025.csv", fmt="csv")
    return root


@register("op_a1_csv_tree_events", S.with_ctes([("ev", S.events_in(_B9_MORE))], "SELECT * FROM ev"))
def q_a1(spark, sf_dir):
    """A3 finds the national roots of a CSV tree, A1 reads them, B8/B9 make events of them."""
    found = RD.discover_inputs(spark, _national_tree(spark, sf_dir))
    roots = [r.path for r in found.filter("role = 'national_root'").orderBy("path").collect()]
    raw = RD.read_national(spark, roots)
    return HZ.national_events(raw["NIBRS_OFFENSE.csv"], raw["NIBRS_incident.csv"], raw["NIBRS_OFFENSE_TYPE.csv"],
                              raw["agencies.csv"], pipeline.COUNTY_STRATEGY,
                              group_expr=standin.standin_group(F.col("offense_name")))


@register("op_a5_missing_audit", S.with_ctes([("craw", S.city_raw())],
                                             """SELECT 'Location' AS "column", count(*) AS n_missing FROM craw"""))
def q_a5(spark, sf_dir):
    return RD.missing_audit(standin.city_raw(spark, sf_dir))


@register("op_a7_union_train_test", S.with_ctes([("city", S.city())], """SELECT CASE WHEN "Year" <= 2000 THEN 'train'
       ELSE 'test' END AS dataset, count(*) AS n_rows, count(DISTINCT "Primary Type") AS n_types FROM city GROUP BY 1"""))
def q_a7(spark, sf_dir):
    c = standin.city_clean(spark, sf_dir)
    u = RD.union_datasets({"train": c.filter(F.col("Year") <= 2000), "test": c.filter(F.col("Year") > 2000)})
    return u.groupBy("dataset").agg(F.count(F.lit(1)).alias("n_rows"),
                                    F.count_distinct(F.col("`Primary Type`")).alias("n_types"))


@register("op_a11_export_sample", S.with_ctes([("craw", S.city_raw())],
    """SELECT * FROM craw ORDER BY md5('42|' || "Case Number") LIMIT 1000"""), doubles=["Latitude", "Longitude"])
def q_a11(spark, sf_dir):
    raw = standin.city_raw(spark, sf_dir).drop("X Coordinate", "Y Coordinate", "Updated On", "Location")
    return RD.export_sample(raw, n=1000, keys=["Case Number"])


@register("op_a12_geo_points", S.with_ctes([("city", S.city())], f"""SELECT 'IL__CPD_DIST_' || {S.tok('"District"')}
       AS region_id, "Latitude" AS latitude, "Longitude" AS longitude FROM city
WHERE "District" IS NOT NULL AND "Latitude" IS NOT NULL AND "Longitude" IS NOT NULL"""),
          doubles=["latitude", "longitude"])
def q_a12(spark, sf_dir):
    c = standin.city_clean(spark, sf_dir)
    return RD.city_geo([c.filter(F.col("Year") <= 2000), c.filter(F.col("Year") > 2000)])


@register("op_a13_geo_events", S.with_ctes([("city", S.city())], f"""SELECT 'IL__CPD_DIST_' || {S.tok('"District"')}
       AS region_id, "Latitude" AS latitude, "Longitude" AS longitude, CAST("Date" AS TIMESTAMP) AS event_date
FROM city WHERE "Year" > 2000 AND "Date" IS NOT NULL"""), doubles=["latitude", "longitude"])
def q_a13(spark, sf_dir):
    c = standin.city_clean(spark, sf_dir)
    return RD.city_geo([c.filter(F.col("Year") > 2000)], with_date="Date")


# ======================================================== D: models ========
from riskbeacon.operators import models as ML  # noqa: E402
from riskbeacon.plans import ml as MLP  # noqa: E402


@register("op_d2_logistic_predictions", bench=True)
def q_d2(spark, sf_dir):
    return MLP.fit_one(spark, sf_dir, 7, 0, ML.MODEL_LR)


@register("op_d3_forest_predictions", bench=True)
def q_d3(spark, sf_dir):
    return MLP.fit_one(spark, sf_dir, 7, 0, ML.MODEL_RF)


@register("op_d4_sequence_predictions")
def q_d4(spark, sf_dir):
    return MLP.fit_one(spark, sf_dir, 7, 0, ML.MODEL_SEQ)


def _fitted(spark, sf_dir, w: int = 7):
    """Persistence and the fitted models, all seeds: the table of ``_preds`` with fitted models."""
    return MLP.grid(spark, sf_dir, w).predictions


@register("op_d5_fitted_predictions")
def q_d5_fitted(spark, sf_dir):
    return MLP.both_windows(spark, sf_dir)


def _fitted_rows_sql(w: int) -> str:
    """What a prediction table of fitted models must hold besides the scores
    themselves, and persistence whole."""
    models = ", ".join(f"('{m}')" for m in ML.FITTED_ORDER)
    rows = "\nUNION ALL ".join(f"SELECT region_id, strftime(time_id, '%Y-%m-%d') AS time_id, y, y_count, lag_0, "
                               f"'{d}' AS dataset FROM {t}" for d, t in (("in_domain", "test_x"), ("out_domain", "out_x")))
    body = S.with_ctes(S.split_ctes(w), f"""SELECT {w} AS time_window_days, x.region_id, x.time_id, x.y, x.y_count, m.model,
       x.dataset, s.seed, m.model = 'baseline_persistence' OR NULL AS rule, TRUE AS in_range,
       CASE WHEN m.model = 'baseline_persistence' THEN CAST(x.lag_0 AS DOUBLE) END AS rule_score,
       CASE WHEN m.model = 'baseline_persistence' THEN CAST(x.lag_0 >= (SELECT threshold FROM thr) AS INTEGER) END AS rule_pred,
       TRUE AS pred_fits
FROM ({rows}) x, (VALUES {models}) m(model), (VALUES (0), (1), (2)) s(seed)""")
    return f"SELECT * EXCLUDE (rule) FROM (WITH {body[5:]}) w{w}"


@register("op_d5_fitted_contract", f"{_fitted_rows_sql(7)}\nUNION ALL {_fitted_rows_sql(3)}", doubles=["y_count", "rule_score"])
def q_d5_contract(spark, sf_dir):
    """Keys, labels and counts of all models, seeds and windows; scores
    are probabilities, predictions follow them; persistence whole (D1)."""
    p = MLP.both_windows(spark, sf_dir)
    rule = F.col("model") == "baseline_persistence"
    score, yp = F.col("y_score"), F.col("y_pred")
    return p.select("time_window_days", "region_id", "time_id", "y", "y_count", "model", "dataset", "seed",
                    F.coalesce(rule | score.between(0.0, 1.0), F.lit(False)).alias("in_range"),
                    F.when(rule, score).alias("rule_score"), F.when(rule, yp).alias("rule_pred"),
                    F.coalesce(rule | (yp == (score >= 0.5).cast("int")), F.lit(False)).alias("pred_fits"))


_D6_GAP = "model = 'ewma' AND seed = 1 AND region_id < 'B'"


@register("op_d6_prediction_coverage", _pred_sql(f"""SELECT p.seed, p.dataset, p.model, p.n_rows, e.expected_rows
FROM (SELECT seed, dataset, model, count(*) AS n_rows FROM preds WHERE NOT ({_D6_GAP}) GROUP BY 1, 2, 3) p
LEFT JOIN (SELECT dataset, count(*) AS expected_rows FROM preds WHERE model = 'rolling_mean' AND seed = 0 GROUP BY 1) e
  ON e.dataset = p.dataset WHERE e.expected_rows IS DISTINCT FROM p.n_rows"""))
def q_d6(spark, sf_dir):
    """Of a table in which one model lacks some regions for one seed, the groups that cover too little."""
    r = pipeline.window_run(spark, sf_dir, 7)
    exp = (r.test.agg(F.count(F.lit(1)).alias("expected_rows")).withColumn("dataset", F.lit("in_domain"))
           .unionByName(r.out.agg(F.count(F.lit(1)).alias("expected_rows")).withColumn("dataset", F.lit("out_domain"))))
    return ML.prediction_coverage(r.predictions.filter(f"NOT ({_D6_GAP})"), exp)


@register("op_d6_fitted_coverage", "\nUNION ALL ".join(
    f"""SELECT * FROM (WITH {S.with_ctes(S.split_ctes(w), f"""SELECT {w} AS time_window_days, d.dataset, m.model, s.seed, d.n_rows
FROM (SELECT 'in_domain' AS dataset, count(*) AS n_rows FROM test_x UNION ALL SELECT 'out_domain', count(*) FROM out_x) d,
     (VALUES {", ".join(f"('{m}')" for m in ML.FITTED_ORDER)}) m(model), (VALUES (0), (1), (2)) s(seed)""")[5:]}) w{w}"""
    for w in (7, 3)))
def q_d6_fitted(spark, sf_dir):
    return MLP.both_windows(spark, sf_dir).groupBy("time_window_days", "dataset", "model", "seed").agg(
        F.count(F.lit(1)).alias("n_rows"))


@register("op_d8_logistic_importance")
def q_d8(spark, sf_dir):
    return MLP.importance_both_windows(spark, sf_dir).filter(F.col("model") == ML.MODEL_LR)


@register("op_d9_forest_split_counts")
def q_d9(spark, sf_dir):
    return MLP.importance_both_windows(spark, sf_dir).filter(F.col("model") == ML.MODEL_RF)


_FEATURES_SQL = f"(SELECT unnest({list(FEATURE_NUMERIC)}) AS feature)"
_WINDOWS_SQL = "(VALUES ('7d'), ('3d')) w(\"window\")"


@register("op_d10_persistence_importance", f"""SELECT w."window", s.seed, 'in_domain' AS dataset, 'baseline_persistence' AS model,
       f.feature, 'rule_based' AS method, CAST(f.feature = 'lag_0' AS DOUBLE) AS importance_raw,
       CAST(f.feature = 'lag_0' AS DOUBLE) AS importance_norm
FROM {_FEATURES_SQL} f, {_WINDOWS_SQL}, (VALUES (0), (1), (2)) s(seed)""")
def q_d10(spark, sf_dir):
    return MLP.importance_both_windows(spark, sf_dir).filter(F.col("model") == "baseline_persistence")


@register("op_d11_importance_sums", f"""SELECT w."window", s.seed, m.model, (SELECT count(*) FROM {_FEATURES_SQL} f) AS n_features,
       1.0::DOUBLE AS total, TRUE AS in_range
FROM {_WINDOWS_SQL}, (VALUES (0), (1), (2)) s(seed),
     (VALUES ('baseline_persistence'), ('logistic_regression'), ('random_forest')) m(model)""", doubles=["total"])
def q_d11(spark, sf_dir):
    """Normalized importances of every window, seed and model: one row a feature, shares that sum to one."""
    return MLP.importance_both_windows(spark, sf_dir).groupBy("window", "seed", "model").agg(
        F.count_distinct("feature").alias("n_features"), F.sum("importance_norm").alias("total"),
        F.bool_and(F.col("importance_norm").between(0.0, 1.0)).alias("in_range"))


@register("op_d12_importance_summary")
def q_d12(spark, sf_dir):
    return H.summarize_importance(MLP.importance_both_windows(spark, sf_dir))


@register("op_d12_tied_ranks", f"""SELECT w."window", f.feature, CAST(f.feature = 'lag_0' AS DOUBLE) AS importance_norm_mean,
       0.0::DOUBLE AS importance_norm_std, 3 AS seed_n,
       CAST(row_number() OVER (PARTITION BY w."window" ORDER BY f.feature <> 'lag_0', f.feature) AS INTEGER) AS rank_in_model
FROM {_FEATURES_SQL} f, {_WINDOWS_SQL}""", doubles=["importance_norm_mean", "importance_norm_std"])
def q_d12_tied(spark, sf_dir):
    """Ranks where all features but one tie: by name."""
    return q_d12(spark, sf_dir).filter(F.col("model") == "baseline_persistence").select(
        "window", "feature", "importance_norm_mean", "importance_norm_std", "seed_n", "rank_in_model")


@register("op_h3_top10_features")
def q_h3(spark, sf_dir):
    return H.top_features(q_d12(spark, sf_dir), 10)


@register("op_h3_top10_ranks", f"""SELECT w."window", m.model, 10 AS n, 55 AS rank_sum
FROM {_WINDOWS_SQL}, (VALUES ('baseline_persistence'), ('logistic_regression'), ('random_forest')) m(model)""")
def q_h3_ranks(spark, sf_dir):
    """Each window and model lists ranks 1 to 10 once, in falling importance."""
    top = q_h3(spark, sf_dir)
    falls = F.col("importance_norm_mean") <= F.lag("importance_norm_mean", 1, 2.0).over(
        Window.partitionBy("window", "model").orderBy("rank_in_model"))
    return top.withColumn("falls", falls).filter("falls").groupBy("window", "model").agg(
        F.count(F.lit(1)).alias("n"), F.sum("rank_in_model").alias("rank_sum"))


@register("op_d13_fit_log")
def q_d13(spark, sf_dir):
    return reduce(DataFrame.unionByName, [g.log.withColumn("time_window_days", F.lit(w))
                                          for w, g in MLP.grids(spark, sf_dir).items()])


@register("op_d13_fit_log_rows", "\nUNION ALL ".join(
    f"""SELECT * FROM (WITH {S.with_ctes(S.split_ctes(w), f"""SELECT {w} AS time_window_days, m.model, s.seed, count(*) AS n_rows,
       {len(FEATURE_NUMERIC)} AS n_features
FROM train_x, (VALUES ('logistic_regression'), ('random_forest'), ('sequence_mlp')) m(model), (VALUES (0), (1), (2)) s(seed)
GROUP BY m.model, s.seed""")[5:]}) w{w}""" for w in (7, 3)))
def q_d13_rows(spark, sf_dir):
    return q_d13(spark, sf_dir).select("time_window_days", "model", "seed", "n_rows", "n_features")


@register("op_d14_persist_models", "\nUNION ALL ".join(
    f"""SELECT * FROM (WITH {S.with_ctes(S.split_ctes(w), f"""SELECT {w} AS time_window_days, m.model, s.seed,
       (SELECT count(*) FROM test_x) + (SELECT count(*) FROM out_x) AS n_rows, 0 AS n_differ
FROM (VALUES {", ".join(f"('{m}')" for m in ML.FITTED_ORDER)}) m(model), (VALUES (0), (1), (2)) s(seed)""")[5:]}) w{w}"""
    for w in (7, 3)))
def q_d14(spark, sf_dir):
    """Models and preprocessor loaded once more from disk score every row as the stored table has it."""
    keys = ["region_id", "time_id", "dataset", "model", "seed"]

    def differing(w: int, g) -> DataFrame:
        again = MLP.reload_and_score(spark, sf_dir, w, g.root).select(*keys, F.col("y_score").alias("again"))
        both = g.predictions.join(again, keys, "full")
        return both.groupBy("model", "seed").agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(~F.coalesce(F.abs(F.col("y_score") - F.col("again")) < 1e-12, F.lit(False))).alias("n_differ")) \
            .withColumn("time_window_days", F.lit(w))
    grids = MLP.grids(spark, sf_dir)
    return reduce(DataFrame.unionByName, pipeline.in_parallel(*[lambda w=w, g=g: differing(w, g) for w, g in grids.items()]))


# ============================================ E, F, H over the fitted models =
@register("op_e3_fitted_summary")
def q_e3_fitted(spark, sf_dir):
    return M.summary_by_dataset_model(_fitted(spark, sf_dir))


@register("op_e4_fitted_by_seed")
def q_e4_fitted(spark, sf_dir):
    return M.overall_by_seed(_fitted(spark, sf_dir))


def _fitted_mlong(spark, sf_dir, w: int = 7):
    return M.metrics_long(_fitted(spark, sf_dir, w).withColumn("crime_group", M.simple_state()), w)


@register("op_e10_fitted_metrics_long")
def q_e10_fitted(spark, sf_dir):
    MLP.grids(spark, sf_dir)  # both windows, fitted side by side
    return _fitted_mlong(spark, sf_dir, 7).unionByName(_fitted_mlong(spark, sf_dir, 3))


@register("op_e11_fitted_completeness", """SELECT m.model, 0 AS seed, 'in_domain' AS domain, k.metric
FROM (VALUES ('lstm')) m(model), (VALUES ('auc'), ('f1'), ('recall'), ('precision')) k(metric)""")
def q_e11_fitted(spark, sf_dir):
    """Missing rows when a model is asked for that wasn't fitted: only that one's."""
    return M.metrics_completeness(spark, _fitted_mlong(spark, sf_dir), [*ML.FITTED_ORDER, "lstm"], (0, 1, 2)).filter(
        "seed = 0 AND domain = 'in_domain' OR model <> 'lstm'")


@register("op_e16_fitted_window_gap")
def q_e16_fitted(spark, sf_dir):
    return M.window_gap_summary(q_e10_fitted(spark, sf_dir))


@register("op_e17_fitted_window_summary")
def q_e17_fitted(spark, sf_dir):
    return M.window_overall_summary(q_e10_fitted(spark, sf_dir))


@register("op_e19_fitted_topk_coverage")
def q_e19_fitted(spark, sf_dir):
    return TK.topk_coverage_by_seed(_fitted(spark, sf_dir))


@register("op_e22_fitted_best_model")
def q_e22_fitted(spark, sf_dir):
    return M.best_model(_fitted_mlong(spark, sf_dir), models=ML.FITTED_ORDER)


def _fitted_chosen(spark, sf_dir):
    return M.chosen_model(_fitted(spark, sf_dir), models=ML.FITTED_ORDER)


def _fitted_hits(spark, sf_dir):
    return SP.event_hit_classes(standin.geo_events(spark, sf_dir), _fitted(spark, sf_dir), _knn(spark, sf_dir),
                                E_GEO["window_days"], _fitted_chosen(spark, sf_dir), E_GEO["k"])


@register("op_e27_fitted_hit_summary")
def q_e27_fitted(spark, sf_dir):
    return SP.hit_summary(_fitted_hits(spark, sf_dir), E_GEO["window_days"], _fitted_chosen(spark, sf_dir), E_GEO["k"])


@register("op_e29_fitted_neighbor_rates")
def q_e29_fitted(spark, sf_dir):
    return SP.exact_neighbor_rates(_fitted(spark, sf_dir), _knn(spark, sf_dir), _fitted_chosen(spark, sf_dir))


@register("op_e31_fitted_results")
def q_e31_fitted(spark, sf_dir):
    return TB.results_formatted(_fitted_mlong(spark, sf_dir))


def _fitted_serving(spark, sf_dir):
    return RUNS.serving(spark, MLP.serving_store(spark, sf_dir), F_PARAMS["seed"])


_FITTED_CHOICES = S.with_ctes(S.split_ctes(7), f"""SELECT 'dataset' AS level, unnest(['in_domain', 'out_domain']) AS value
UNION ALL SELECT 'model', unnest({ML.FITTED_ORDER})
UNION ALL SELECT DISTINCT 'region', region_id FROM test_x
UNION ALL SELECT DISTINCT 'time', strftime(time_id, '%Y-%m-%d') FROM test_x""")


@register("op_f1_fitted_choices", _FITTED_CHOICES)
def q_f1_fitted(spark, sf_dir):
    return SV.available(_fitted_serving(spark, sf_dir), F_PARAMS["window_days"], F_PARAMS["dataset"], ML.MODEL_RF)


@register("op_f4_fitted_topk_table")
def q_f4_fitted(spark, sf_dir):
    p = F_PARAMS
    return SV.topk_for_time(_fitted_serving(spark, sf_dir), p["window_days"], p["dataset"], ML.MODEL_RF, p["time_id"], p["k"])[0]


@register("op_h2_fitted_district_priority")
def q_h2_fitted(spark, sf_dir):
    def selected(w):
        sel = TK.topk_selection_frequency(_fitted(spark, sf_dir, w))
        best = M.chosen_model(_fitted(spark, sf_dir, w), models=ML.FITTED_ORDER).select("model")
        return sel.join(F.broadcast(best), "model", "left_semi")  # a single row
    MLP.grids(spark, sf_dir)  # both windows, fitted side by side
    r7, r3 = pipeline.window_runs(spark, sf_dir, (7, 3))
    return H.district_priority(r7.test, r3.test, selected(7), selected(3))


# ======================================================== A: sinks/serving =


@register("op_a2_header_harmonization", S.with_ctes([("craw", S.city_raw())],
                                                    """SELECT CAST(strptime("Date", '%m/%d/%Y %I:%M:%S %p') AS TIMESTAMP) AS event_date,
       "Primary Type" AS raw_type, CAST("District" AS VARCHAR) AS region_token FROM craw"""))
def q_a2(spark, sf_dir):
    raw = standin.city_raw(spark, sf_dir)
    h = RD.harmonize_headers(raw, {"event_date": RD.DATE_COLUMN_CANDIDATES, "raw_type": RD.CRIME_TYPE_COLUMN_CANDIDATES,
                                   "region_token": RD.CITY_REGION_CANDIDATE_PRIORITY})
    return h.select(F.try_to_timestamp("event_date", F.lit(EDA.EXPORT_TS_FORMAT)).alias("event_date"), "raw_type",
                    F.col("region_token").cast("string").alias("region_token"))


@register("op_a3_list_inputs", """
SELECT 'national_root' AS role, 'state0' AS folder, 'NIBRS_incident.csv' AS name,
       count(*) FILTER (WHERE o_orderkey % 2 = 0) AS n_rows FROM orders
UNION ALL SELECT 'national_root', 'state1', 'NIBRS_incident.csv', count(*) FILTER (WHERE o_orderkey % 2 = 1) FROM orders
UNION ALL SELECT 'national_root', 'state0', 'NIBRS_OFFENSE.csv', count(*) FILTER (WHERE l_orderkey % 2 = 0) FROM lineitem
UNION ALL SELECT 'national_root', 'state1', 'NIBRS_OFFENSE.csv', count(*) FILTER (WHERE l_orderkey % 2 = 1) FROM lineitem
UNION ALL SELECT 'national_root', 'state0', 'NIBRS_OFFENSE_TYPE.csv', count(*) FROM part
UNION ALL SELECT 'national_root', 'state1', 'NIBRS_OFFENSE_TYPE.csv', 0
UNION ALL SELECT 'national_root', 'state0', 'agencies.csv', count(*) FROM customer
UNION ALL SELECT 'national_root', 'state1', 'agencies.csv', 0
UNION ALL SELECT 'city_train', 'city', 'Crime_Train_2015_2024.csv', count(*) FILTER (WHERE year(o_orderdate) <> 2001) FROM orders
UNION ALL SELECT 'city_test', 'city', 'Crime_Test_2025.csv', count(*) FILTER (WHERE year(o_orderdate) = 2001) FROM orders""")
def q_a3(spark, sf_dir):
    """Rows of each table that discovery finds in a CSV tree, counted by the files they are in."""
    root = _national_tree(spark, sf_dir)
    found = RD.discover_inputs(spark, root)
    tables = RD.list_tables(spark, root)
    path = F.when(F.col("role") == "national_root", F.col("parent")).otherwise(F.col("path"))
    wanted = (tables.withColumn("role", F.lit("national_root")).filter(F.col("name").isin(RD.NATIONAL_TABLES))
              .unionByName(tables.withColumn("role", F.lit("city_train")))
              .unionByName(tables.withColumn("role", F.lit("city_test"))))
    wanted = wanted.withColumn("at", path).join(found.withColumnRenamed("path", "at"), ["role", "at"]).select(
        "role", "path", F.element_at(F.split("parent", "/"), -1).alias("folder"), "name")
    paths = [r.path for r in wanted.select("path").collect()]  # one for each input table
    counts = [RD.read_csv_flexible(spark, p, keep_file="file").groupBy(
        F.regexp_replace("file", "/[^/]*$", "").alias("path")).agg(F.count(F.lit(1)).alias("n")) for p in paths]
    rows = reduce(DataFrame.unionByName, counts)
    return wanted.join(rows, "path", "left").select("role", "folder", "name", F.coalesce("n", F.lit(0)).alias("n_rows"))


_A6_COLS = ["region_id", "time_id", "y", "y_count", "model", "dataset", "y_score", "y_pred", "seed"]


@register("op_a6_partitioned_roundtrip", _pred_sql("SELECT 'parquet' AS format, * FROM preds UNION ALL "
                                                   "SELECT 'csv', * FROM preds"), doubles=["y_count", "y_score"])
def q_a6(spark, sf_dir):
    """The whole prediction table, written partitioned as Parquet and as CSV and read back."""
    import uuid
    root = f"{table_root(spark)}/predictions-partitioned-{uuid.uuid4().hex[:8]}"
    pred = _preds(spark, sf_dir)
    types = dict(pred.dtypes)
    out = []
    for fmt in ("parquet", "csv"):
        RD.write_table(pred, f"{root}/{fmt}", ["dataset", "model", "seed"], fmt)
        back = RD.read_table(spark, f"{root}/{fmt}", fmt)
        out.append(back.select(F.lit(fmt).alias("format"), *[F.col(c).cast(types[c]).alias(c) for c in _A6_COLS]))
    return out[0].unionByName(out[1])


_PARTS_SQL = f"""SELECT CAST(time_window_days AS INTEGER) AS time_window_days, dataset, model,
       CAST(seed AS INTEGER) AS seed, count(*) AS n_rows FROM pboth GROUP BY 1, 2, 3, 4"""


@register("op_a6_publish_serving", _serving_sql(_PARTS_SQL), bench=True)
def q_a6_publish(spark, sf_dir):
    """Publish a run of all predictions; its partitions and their rows by the commit table."""
    store = pipeline.serving_store(spark, sf_dir, renew=True)
    return RUNS.partitions(spark, store).select(*RUNS.KEYS, "n_rows")


@register("op_a10_newest_run", _serving_sql(f"SELECT 'second' AS run, * FROM ({_PARTS_SQL}) p"))
def q_a10(spark, sf_dir):
    """Of four runs (complete, complete and newer, one window only, unfinished) the second is served."""
    import datetime as dt
    import uuid
    store = f"{table_root(spark)}/runs-{uuid.uuid4().hex[:8]}"
    pred = pipeline.predictions_both_windows(spark, sf_dir)
    for day, run, rows in ((1, "first", pred), (2, "second", pred), (3, "third", pred.filter("time_window_days = 7"))):
        RUNS.publish(rows, store, run, dt.datetime(2001, 1, day))
    RUNS.write_rows(pred, store, "fourth")
    served = RUNS.table(spark, store).join(F.broadcast(RUNS.newest(spark, store)), "run")
    return served.groupBy("run", *RUNS.KEYS).agg(F.count(F.lit(1)).alias("n_rows"))


@register("op_a8_serving_frame", _serving_sql("SELECT * FROM serv"), doubles=["y_count", "y_score"])
def q_a8(spark, sf_dir):
    return _serving(spark, sf_dir)


@register("op_a9_thresholds_json", f"""SELECT 7 AS time_window_days, threshold FROM ({_thr_sql(7)}) a
UNION ALL SELECT 3, threshold FROM ({_thr_sql(3)}) b""")
def q_a9(spark, sf_dir):
    import uuid
    r7, r3 = pipeline.window_runs(spark, sf_dir, (7, 3))
    thr = spark.createDataFrame([(7, r7.threshold), (3, r3.threshold)], "time_window_days int, threshold int")
    path = f"{table_root(spark)}/thresholds-{uuid.uuid4().hex[:8]}"
    RD.write_thresholds(spark, thr, path)
    return RD.read_thresholds(spark, path)
