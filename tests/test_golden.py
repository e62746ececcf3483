"""Golden chains: published stage outputs reproduced from their inputs.

The values are fixed values of the published run (staffing table: the first
five columns are the input, the rest the expected output)."""

import pytest

from riskbeacon.config import DATASET_IN as IN
from riskbeacon.config import DATASET_OUT as OUT
from riskbeacon.operators import metrics, support, tables, topk

# --- fixed values: published monthly staffing rows --------------------------
STAFFING = [
    ("2025-06", 17103.0, 14602.0, 0.35, 0.32916666666666666, 0.9583333333333333, 0.9583333333333333, 0.9583333333333333, "Peak (surge staffing)"),
    ("2025-07", 13621.0, 16147.0, 0.34375, 0.3333333333333333, 0.875, 0.9583333333333333, 0.8999999999999999, "Peak (surge staffing)"),
    ("2025-09", 16069.0, 13885.0, 0.3, 0.2833333333333333, 0.8333333333333333, 0.8125, 0.8270833333333333, "Peak (surge staffing)"),
    ("2025-08", 12932.0, 13904.0, 0.2708333333333333, 0.2833333333333333, 0.75, 0.7291666666666666, 0.7437499999999999, "High (reinforced patrol)"),
    ("2025-05", 12914.0, 13614.0, 0.28125, 0.24583333333333332, 0.625, 0.6666666666666667, 0.6375, "High (reinforced patrol)"),
    ("2025-03", 14791.0, 12604.0, 0.125, 0.16666666666666666, 0.625, 0.4166666666666667, 0.5625, "High (reinforced patrol)"),
    ("2025-10", 12487.0, 13555.0, 0.16666666666666666, 0.25416666666666665, 0.5416666666666667, 0.5833333333333333, 0.5541666666666667, "High (reinforced patrol)"),
    ("2025-04", 12386.0, 13103.0, 0.23958333333333334, 0.2, 0.45833333333333337, 0.5416666666666667, 0.4833333333333334, "Moderate (baseline+)"),
    ("2025-01", 11156.0, 11944.0, 0.10416666666666667, 0.10833333333333334, 0.29166666666666663, 0.29166666666666663, 0.29166666666666663, "Low (baseline)"),
    ("2025-11", 11063.0, 12031.0, 0.07291666666666667, 0.12083333333333333, 0.29166666666666663, 0.29166666666666663, 0.29166666666666663, "Low (baseline)"),
    ("2025-02", 10908.0, 11578.0, 0.052083333333333336, 0.07916666666666666, 0.16666666666666666, 0.16666666666666666, 0.16666666666666666, "Low (baseline)"),
    ("2025-12", 9158.0, 10676.0, 0.041666666666666664, 0.0625, 0.08333333333333333, 0.08333333333333333, 0.08333333333333333, "Low (baseline)"),
]


def test_staffing_chain(spark):
    m = spark.createDataFrame([r[:5] for r in STAFFING],
                              "month string, incidents_7d double, incidents_3d double, posrate_7d double, "
                              "posrate_3d double")
    got = {r.month: r for r in support.staffing_scores(m).collect()}
    for month, *_, inc, pos, risk, tier in STAFFING:
        g = got[month]
        assert g.incident_rank_score == pytest.approx(inc, abs=1e-12)
        assert g.pos_rank_score == pytest.approx(pos, abs=1e-12)
        assert g.risk_score == pytest.approx(risk, abs=1e-12)
        assert g.staffing_tier == tier


# --- fixed values: published metrics of the 7-day window, by seed -------------
# (seed, domain, model, AUC, F1, recall, precision)
BY_SEED = [
    (0, IN, "baseline_persistence", 0.9369264744301483, 0.6938775510204082, 0.6967213114754098, 0.6910569105691057),
    (0, IN, "logistic_regression", 0.9542036770948992, 0.7449664429530202, 0.9098360655737705, 0.6306818181818182),
    (0, IN, "lstm", 0.9268663052707203, 0.6841186736474695, 0.8032786885245902, 0.5957446808510638),
    (0, IN, "random_forest", 0.9514115668473646, 0.7529880478087648, 0.7745901639344263, 0.7325581395348837),
    (0, OUT, "baseline_persistence", 0.9982853363943279, 0.9420209828823854, 0.9509476031215162, 0.9332603938730853),
    (0, OUT, "logistic_regression", 0.92624648829149, 0.641566265060241, 0.47491638795986624, 0.988399071925754),
    (0, OUT, "lstm", 0.9855922190817485, 0.45829823083403537, 0.3032329988851728, 0.9379310344827586),
    (0, OUT, "random_forest", 0.9969075414779636, 0.9527027027027029, 0.9431438127090301, 0.962457337883959),
    (1, IN, "baseline_persistence", 0.9369264744301483, 0.6938775510204082, 0.6967213114754098, 0.6910569105691057),
    (1, IN, "logistic_regression", 0.9545914701848346, 0.7607573149741825, 0.9057377049180327, 0.655786350148368),
    (1, IN, "lstm", 0.917091878388087, 0.6761565836298933, 0.7786885245901639, 0.5974842767295597),
    (1, IN, "random_forest", 0.9521708248971329, 0.7622789783889979, 0.7950819672131147, 0.7320754716981132),
    (1, OUT, "baseline_persistence", 0.9982853363943279, 0.9420209828823854, 0.9509476031215162, 0.9332603938730853),
    (1, OUT, "logistic_regression", 0.848996357541982, 0.49202350965575137, 0.326644370122631, 0.9965986394557823),
    (1, OUT, "lstm", 0.8993919078136109, 0.31719532554257096, 0.5295429208472687, 0.22640610104861772),
    (1, OUT, "random_forest", 0.996687858014776, 0.9506726457399104, 0.9453734671125975, 0.9560315670800451),
    (2, IN, "baseline_persistence", 0.9369264744301483, 0.6938775510204082, 0.6967213114754098, 0.6910569105691057),
    (2, IN, "logistic_regression", 0.9542730716478349, 0.7620689655172413, 0.9057377049180327, 0.6577380952380952),
    (2, IN, "lstm", 0.9367652341453856, 0.7191413237924865, 0.8237704918032787, 0.638095238095238),
    (2, IN, "random_forest", 0.9528361961988113, 0.767716535433071, 0.7991803278688525, 0.7386363636363636),
    (2, OUT, "baseline_persistence", 0.9982853363943279, 0.9420209828823854, 0.9509476031215162, 0.9332603938730853),
    (2, OUT, "logistic_regression", 0.9020952034920463, 0.55, 0.3801560758082497, 0.9941690962099126),
    (2, OUT, "lstm", 0.8828260574413226, 0.2770346860122421, 0.6811594202898551, 0.1738759248719408),
    (2, OUT, "random_forest", 0.9968791560471969, 0.9490196078431373, 0.9442586399108138, 0.9538288288288288),
]
# (dataset, model, precision, recall, F1, AUC): means over the seeds
OVERALL = [
    (IN, "baseline_persistence", 0.6910569105691057, 0.6967213114754097, 0.6938775510204082, 0.9369264744301483),
    (IN, "logistic_regression", 0.6480687545227605, 0.907103825136612, 0.7559309078148146, 0.9543560729758562),
    (IN, "lstm", 0.6104413985586206, 0.8019125683060109, 0.6931388603566164, 0.926907805934731),
    (IN, "random_forest", 0.7344233249564535, 0.7896174863387978, 0.7609945205436112, 0.9521395293144362),
    (OUT, "baseline_persistence", 0.9332603938730853, 0.9509476031215162, 0.9420209828823854, 0.9982853363943279),
    (OUT, "logistic_regression", 0.993055602530483, 0.39390561129691565, 0.5611965915719974, 0.8924460164418395),
    (OUT, "lstm", 0.44607102013443906, 0.5046451133407656, 0.35084274746294947, 0.922603394778894),
    (OUT, "random_forest", 0.957439244597611, 0.9442586399108138, 0.9507983187619168, 0.9968248518466455),
]
# model: AUC in the domain less AUC out of it
DELTA_AUC = {
    "logistic_regression": 0.06191005653401671,
    "lstm": 0.004304411155837018,
    "random_forest": -0.04468532253220925,
    "baseline_persistence": -0.06135886196417961,
}
# model: AUC, F1, recall and precision in the domain, then out of it
CELLS = {
    "baseline_persistence": ["0.937 ± 0.000", "0.694 ± 0.000", "0.697 ± 0.000", "0.691 ± 0.000",
        "0.998 ± 0.000", "0.942 ± 0.000", "0.951 ± 0.000", "0.933 ± 0.000"],
    "logistic_regression": ["0.954 ± 0.000", "0.756 ± 0.010", "0.907 ± 0.002", "0.648 ± 0.015",
        "0.892 ± 0.040", "0.561 ± 0.075", "0.394 ± 0.075", "0.993 ± 0.004"],
    "random_forest": ["0.952 ± 0.001", "0.761 ± 0.007", "0.790 ± 0.013", "0.734 ± 0.004",
        "0.997 ± 0.000", "0.951 ± 0.002", "0.944 ± 0.001", "0.957 ± 0.004"],
    "lstm": ["0.927 ± 0.010", "0.693 ± 0.023", "0.802 ± 0.023", "0.610 ± 0.024",
        "0.923 ± 0.055", "0.351 ± 0.095", "0.505 ± 0.190", "0.446 ± 0.427"],
}
# (model, seed, metric, in-domain less out-of-domain)
GAPS = [
    ("logistic_regression", 0, "auc", 0.02795718880340914),
    ("logistic_regression", 0, "f1", 0.10340017789277922),
    ("logistic_regression", 1, "auc", 0.1055951126428526),
    ("logistic_regression", 1, "f1", 0.2687338053184312),
    ("logistic_regression", 2, "auc", 0.0521778681557884),
    ("logistic_regression", 2, "f1", 0.2120689655172413),
    ("lstm", 0, "auc", -0.058725913811027985),
    ("lstm", 0, "f1", 0.22582044281343416),
    ("lstm", 1, "auc", 0.017699970574476143),
    ("lstm", 1, "f1", 0.3589612580873224),
    ("lstm", 2, "auc", 0.05393917670406301),
    ("lstm", 2, "f1", 0.4421066377802444),
    ("random_forest", 0, "auc", -0.045495974630598957),
    ("random_forest", 0, "f1", -0.19971465489393803),
    ("random_forest", 1, "auc", -0.04451703311764321),
    ("random_forest", 1, "f1", -0.18839366735091245),
    ("random_forest", 2, "auc", -0.04404295984838558),
    ("random_forest", 2, "f1", -0.18130307241006627),
]
# (domain, seed, model, k, coverage), and its mean over the seeds
COVERAGE = [
    (IN, 0, "random_forest", 5, 0.301236932015651),
    (IN, 0, "random_forest", 10, 0.573666331448517),
    (IN, 0, "random_forest", 20, 0.9238198285438544),
    (IN, 1, "random_forest", 5, 0.3025420129146363),
    (IN, 1, "random_forest", 10, 0.5733225165775275),
    (IN, 1, "random_forest", 20, 0.9216683647788528),
    (IN, 2, "random_forest", 5, 0.30036032379591354),
    (IN, 2, "random_forest", 10, 0.574102951194283),
    (IN, 2, "random_forest", 20, 0.9212226370085369),
]
COVERAGE_MEAN = {5: 0.3013797562420669, 10: 0.5736972664067759, 20: 0.922236943443748}


@pytest.fixture()
def by_seed(spark):
    return spark.createDataFrame(BY_SEED, "seed int, domain string, model string, auc double, f1 double, recall double, "
                                          "precision double")


@pytest.fixture()
def mlong(by_seed):
    """The tidy table's overall rows, from the metrics by seed."""
    return by_seed.unpivot(["seed", "domain", "model"], ["auc", "f1", "recall", "precision"], "metric", "value").selectExpr(
        "7 AS time_window_days", "domain", "model", "seed", "metric", "value", "'overall' AS slice")


def test_seed_mean_chain(by_seed):
    got = {(r.dataset, r.model): r for r in metrics.mean_over_seeds(by_seed).collect()}
    assert len(got) == len(OVERALL)
    for dataset, model, *want in OVERALL:
        r = got[dataset, model]
        assert [r.precision, r.recall, r.f1, r.auc_roc] == pytest.approx(want, abs=1e-12)


def test_delta_auc_chain(spark):
    overall = spark.createDataFrame(OVERALL, "dataset string, model string, precision double, recall double, f1 double, "
                                             "auc_roc double")
    got = {r.model: r.delta_auc for r in metrics.delta_auc(overall).collect()}
    assert got == pytest.approx(DELTA_AUC, abs=1e-12)
    gaps = {r.model: r.delta_auc for r in metrics.generalization_gap(overall).collect()}
    assert gaps == pytest.approx(DELTA_AUC, abs=1e-12)


def test_results_chain(mlong):
    columns = [f"{d}_{m}" for d in (IN, OUT) for m in ("auc", "f1", "recall", "precision")]
    got = {r["model"]: [r[c] for c in columns] for r in tables.results_wide(mlong).collect()}
    assert got == CELLS
    numeric = {(r.domain, r.model, r.metric): r["mean"] for r in tables.results_numeric(mlong).collect()}
    means = {(r.domain, r.model, r.metric): r["mean"] for r in metrics.window_overall_summary(mlong).collect()}
    for dataset, model, precision, recall, f1, auc in OVERALL:
        own = {"precision": precision, "recall": recall, "f1": f1, "auc": auc}
        assert {k: numeric[dataset, model, k] for k in own} == pytest.approx(own, abs=1e-12)
        assert [means[dataset, model, k] for k in ("f1", "auc")] == pytest.approx([f1, auc], abs=1e-12)


def test_window_gap_chain(mlong):
    got = {(r.model, r.seed, r.metric): r.delta for r in metrics.window_gap_by_seed(mlong).collect()}
    for model, seed, metric, delta in GAPS:
        assert got[model, seed, metric] == pytest.approx(delta, abs=1e-12)


def test_topk_coverage_chain(spark):
    rows = spark.createDataFrame(COVERAGE, "domain string, seed int, model string, k int, coverage double")
    got = {r.k: r.topk_hit_rate for r in topk.topk_coverage_seed_mean(rows).collect()}
    assert got == pytest.approx(COVERAGE_MEAN, abs=1e-12)
