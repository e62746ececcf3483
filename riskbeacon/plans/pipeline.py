"""End-to-end window runs over the stand-in tables.

``window_run(spark, sf_dir, w)`` composes: canonical events (B) -> dense
panel (C1-C5) -> supervised features (C6-C16) -> split / threshold / labels /
region stats (C17-C22) -> Xy contract (C23) -> long predictions (D5) for the
in-domain test set and the out-of-domain set.

Only the panel-sized intermediates are persisted (regions x windows rows).
The driver receives four scalars per window: first/last panel window (grid),
first/last test window (split) and the integer threshold.
"""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskbeacon.config import DATASET_IN, DATASET_OUT, DATASET_TRAIN
from riskbeacon.operators import harmonize, labels, panel, predict, runs, spatial
from riskbeacon.operators.features import build_supervised
from riskbeacon.plans.store import materialize, table_root
from riskbeacon.sources import standin

COUNTY_STRATEGY = harmonize.RegionStrategy("county", "county_name", "agency_id",
                                           "stand-in: state = region name, county = nation name")


@dataclass
class WindowRun:
    window_days: int
    bounds_in: panel.TimeBounds
    bounds_out: panel.TimeBounds
    test_start: dt.date
    test_end: dt.date
    threshold: int
    panel_in: DataFrame
    panel_out: DataFrame
    supervised_in: DataFrame
    train: DataFrame      # labelled + region stats
    test: DataFrame
    out: DataFrame
    score: Callable[[], DataFrame]
    _scored: list[DataFrame] = field(default_factory=list)
    _lock: threading.Lock = field(default_factory=threading.Lock)

    @property
    def predictions(self) -> DataFrame:
        """The long prediction table, written when it is first asked for:
        features, labels and fits don't need it."""
        with self._lock:
            if not self._scored:
                self._scored.append(self.score())
            return self._scored[0]

    def xy(self, dataset: str) -> DataFrame:
        src = {DATASET_TRAIN: self.train, DATASET_IN: self.test, DATASET_OUT: self.out}[dataset]
        return labels.enforce_xy(src, name=dataset)


def in_domain_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return harmonize.national_events(
        standin.nat_offense(spark, sf_dir), standin.nat_incident(spark, sf_dir),
        standin.nat_offense_type(spark, sf_dir), standin.nat_agencies(spark, sf_dir),
        COUNTY_STRATEGY, group_expr=standin.standin_group(F.col("offense_name")))


def test_events(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_date") >= F.lit(standin.STANDIN_SPLIT_DATE).cast("timestamp"))


_CACHE: dict = {}
_LOCKS: dict = {}
_GUARD = threading.Lock()


def session_key(spark) -> tuple:
    """Identity of the running Spark application (a stopped and recreated
    session never sees the previous session's frames)."""
    sc = spark.sparkContext
    return (sc.applicationId, sc.startTime)


def _key(spark, *parts):
    return session_key(spark) + parts


def _lock(key) -> threading.Lock:
    with _GUARD:
        return _LOCKS.setdefault(key, threading.Lock())


def in_parallel(*thunks):
    """Run independent driver-side job submissions concurrently: Spark
    schedules jobs from several threads side by side, so small stages of
    independent branches (in/out domain, 7d/3d window) share the cores."""
    if len(thunks) == 1:
        return [thunks[0]()]
    with ThreadPoolExecutor(max_workers=len(thunks)) as pool:
        futures = [pool.submit(t) for t in thunks]
        return [f.result() for f in futures]


def panel_for(spark: SparkSession, sf_dir: str, window_days: int, domain: str):
    key = _key(spark, "panel", sf_dir, window_days, domain)
    with _lock(key):
        return _panel_for(spark, sf_dir, window_days, domain, key)


def _panel_for(spark, sf_dir, window_days, domain, key):
    if key not in _CACHE:
        def keep(df, _n=f"counts-{domain}-{window_days}d"):
            return materialize(spark, df, _n)
        _CACHE[key] = panel.build_panel(days_for(spark, sf_dir, domain), window_days, store=keep)
    return _CACHE[key]


def days_for(spark: SparkSession, sf_dir: str, domain: str) -> DataFrame:
    """Counts by day of a domain, written once: both windows are summed from them."""
    key = _key(spark, "days", sf_dir, domain)
    with _lock(key):
        if key not in _CACHE:
            days = (panel.day_counts(in_domain_events(spark, sf_dir), standin.STANDIN_SPLIT_DATE) if domain == "in"
                    else panel.day_counts(standin.out_domain_events(spark, sf_dir)))
            _CACHE[key] = materialize(spark, days, f"days-{domain}")
        return _CACHE[key]


def supervised_both(spark: SparkSession, sf_dir: str, window_days: int) -> DataFrame:
    """Features of the in- and out-of-domain panels from ONE plan: the two
    panels are tagged and unioned, and every window is partitioned by the
    tag, so both are featurized by the same exchanges and sorts."""
    key = _key(spark, "sup", sf_dir, window_days)
    with _lock(key):
        return _supervised_both(spark, sf_dir, window_days, key)


def _supervised_both(spark, sf_dir, window_days, key):
    if key not in _CACHE:
        (p_in, b_in), (p_out, b_out) = in_parallel(lambda: panel_for(spark, sf_dir, window_days, "in"),
                                                   lambda: panel_for(spark, sf_dir, window_days, "out"))
        both = p_in.withColumn("domain", F.lit("in")).unionByName(p_out.withColumn("domain", F.lit("out")))
        n = max(b_in.n_windows, b_out.n_windows)
        _CACHE[key] = materialize(spark, build_supervised(both, window_days, n, keys=("domain",)),
                                  f"features-{window_days}d")
    return _CACHE[key]


def supervised_for(spark: SparkSession, sf_dir: str, window_days: int, domain: str) -> DataFrame:
    return supervised_both(spark, sf_dir, window_days).filter(F.col("domain") == domain).drop("domain")


def window_run(spark: SparkSession, sf_dir: str, window_days: int = 7) -> WindowRun:
    key = _key(spark, "run", sf_dir, window_days)
    with _lock(key):
        return _window_run(spark, sf_dir, window_days, key)


def window_runs(spark: SparkSession, sf_dir: str, windows=(7, 3)) -> list[WindowRun]:
    """Both window runs, built concurrently."""
    return in_parallel(*[(lambda w=w: window_run(spark, sf_dir, w)) for w in windows])


def _window_run(spark, sf_dir, window_days, key) -> WindowRun:
    if key in _CACHE:
        return _CACHE[key]
    supervised_both(spark, sf_dir, window_days)  # builds both panels concurrently
    p_in, b_in = panel_for(spark, sf_dir, window_days, "in")
    p_out, b_out = panel_for(spark, sf_dir, window_days, "out")
    sup_in = supervised_for(spark, sf_dir, window_days, "in")
    sup_out = supervised_for(spark, sf_dir, window_days, "out")
    t0, t1 = labels.window_of(b_in.first_marked, window_days), labels.window_of(b_in.last_event, window_days)
    train, test = labels.split_train_test(sup_in, t0, t1)
    thr = labels.compute_threshold(train)
    train_l = labels.add_label(train, thr)
    stats = labels.region_train_stats(train_l)
    dflt = labels.region_stat_defaults(stats)
    train_x = labels.apply_region_stats(train_l, stats, dflt)
    test_x = labels.apply_region_stats(labels.add_label(test, thr), stats, dflt)
    out_x = labels.apply_region_stats(labels.add_label(sup_out, thr), stats, dflt)
    # The long prediction table feeds every metric; it is written once
    # (rows x models x seeds, panel-sized) instead of being re-derived.
    def score() -> DataFrame:
        return materialize(spark, predict.predictions_long(test_x, DATASET_IN, thr).unionByName(
            predict.predictions_long(out_x, DATASET_OUT, thr)), f"predictions-{window_days}d")
    run = WindowRun(window_days, b_in, b_out, t0, t1, thr, p_in, p_out, sup_in, train_x, test_x, out_x, score)
    _CACHE[key] = run
    return run


def predictions_both_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction table of both windows, tagged with time_window_days."""
    runs_ = window_runs(spark, sf_dir, (7, 3))
    frames = in_parallel(*[lambda r=r: r.predictions.withColumn("time_window_days", F.lit(r.window_days)) for r in runs_])
    return frames[0].unionByName(frames[1])


def region_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """kNN graph of the regions' centroids (E23, E25), written once."""
    key = _key(spark, "graph", sf_dir)
    with _lock(key):
        if key not in _CACHE:
            def keep(df, name):
                return materialize(spark, df, f"graph-{name}")
            cents = spatial.centroids(standin.geo_points(spark, sf_dir))
            _CACHE[key] = keep(spatial.knn_graph(spark, cents, keep=keep), "edges")
        return _CACHE[key]


_STORES: dict = {}


def serving_store(spark: SparkSession, sf_dir: str, renew: bool = False) -> str:
    """Folder of the published runs of both windows' predictions. The first
    call of a session publishes one, ``renew`` a further one. Published runs
    are kept when memoized frames are dropped: look-ups read what was stored."""
    key = _key(spark, "store", sf_dir)
    with _lock(key):
        if key not in _STORES or renew:
            store = _STORES.get(key) or f"{table_root(spark)}/serving-{uuid.uuid4().hex[:12]}"
            runs.publish(predictions_both_windows(spark, sf_dir), store)
            _STORES[key] = store
        return _STORES[key]


def clear_cache() -> None:
    """Drop the session's memoized panels/runs and their persisted data."""
    for v in list(_CACHE.values()):
        frames = v if isinstance(v, tuple) else (v,)
        for f in frames:
            if isinstance(f, DataFrame):
                f.unpersist()
            elif isinstance(f, WindowRun):
                for g in (f.panel_in, f.panel_out, f.supervised_in):
                    g.unpersist()
    _CACHE.clear()
