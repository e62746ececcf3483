"""Spatial hit analysis.

* centroids: exact per-region medians - one aggregation over all points.
* convex hull: points strictly inside the polygon of a region's extreme
  points are dropped by a JVM expression; every partition reduces the rest to
  one hull per region (mapInPandas), merged in salted groups, then per region.
* kNN graph: a grid of several levels (``neighbors``), two equi-joins on cells.
* hit classes: equi-joins of events with the Top-K set of the window that
  predicted them and with the Top-K set expanded over the kNN graph.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskbeacon.config import DATASET_IN, KNN_K
from riskbeacon.functions.expr import side_by_side, time_bin
from riskbeacon.functions.quantile import exact_percentile
from riskbeacon.operators import neighbors


# ------------------------------------------------------------------ E23 ----
def centroids(points: DataFrame) -> DataFrame:
    """Exact median longitude / latitude per region over ALL points, by
    selection (``exact_percentile``) so a region holding most points is never
    merged in one task."""
    p = points.dropna(subset=["region_id", "latitude", "longitude"])
    lon = exact_percentile(p, "longitude", 0.5, ["region_id"], "lon")
    lat = exact_percentile(p, "latitude", 0.5, ["region_id"], "lat")
    return lon.join(lat, "region_id")


# ------------------------------------------------------------------ E24 ----
def _outside(xy: np.ndarray, a: int, b: int, rows: np.ndarray) -> list[int]:
    """Hull vertices strictly to the left of a -> b, in the order from a to b:
    the farthest point splits the rest in two, until nothing is left outside."""
    done, todo = [], [(a, b, rows)]
    while todo:
        a, b, rows = todo.pop()
        if rows is None:
            done.append(a)
            continue
        d = xy[b] - xy[a]
        rel = xy[rows] - xy[a]
        left = d[0] * rel[:, 1] - d[1] * rel[:, 0]
        rows, rel, left = rows[left > 0], rel[left > 0], left[left > 0]
        if not len(rows):
            continue
        far = int(rows[np.lexsort((rel @ d, -left))[0]])
        todo += [(far, b, rows), (far, far, None), (a, far, rows)]  # taken from the end
    return done


def hull(xs: np.ndarray, ys: np.ndarray) -> np.ndarray:
    """Vertices of the convex hull, counter-clockwise from the lowest-left
    point; points on an edge are left out."""
    xy = np.unique(np.column_stack((xs, ys)).astype(float), axis=0)
    if len(xy) <= 2:
        return xy
    rows, last = np.arange(len(xy)), len(xy) - 1
    top, bottom = _outside(xy, 0, last, rows), _outside(xy, last, 0, rows)
    return xy[[0, *bottom[::-1], last, *top[::-1]]]


_HULL_SCHEMA = "region_id string, salt int, longitude double, latitude double"
_HULL_COLS = ["region_id", "salt", "longitude", "latitude"]
HULL_SALTS = 32  # groups in which a region's partial hulls are merged first


def _partial_hulls(batches):
    """One hull per region and partition, grown batch by batch."""
    kept: dict[str, np.ndarray] = {}
    for pdf in batches:
        for rid, g in pdf.groupby("region_id"):
            own = g[["longitude", "latitude"]].to_numpy(float)
            old = kept.get(rid)
            own = own if old is None else np.vstack((old, own))
            kept[rid] = hull(own[:, 0], own[:, 1])
    salt = TaskContext.get().partitionId() % HULL_SALTS
    for rid, own in kept.items():
        yield pd.DataFrame({"region_id": rid, "salt": np.int32(salt), "longitude": own[:, 0], "latitude": own[:, 1]})


def _merged_hull(pdf: pd.DataFrame) -> pd.DataFrame:
    own = hull(pdf["longitude"].to_numpy(), pdf["latitude"].to_numpy())
    return pd.DataFrame({"region_id": pdf["region_id"].iloc[0], "salt": pdf["salt"].iloc[0], "longitude": own[:, 0],
                         "latitude": own[:, 1]})[_HULL_COLS]


def _final_hull(pdf: pd.DataFrame) -> pd.DataFrame:
    own = hull(pdf["longitude"].to_numpy(), pdf["latitude"].to_numpy())
    return pd.DataFrame({"region_id": pdf["region_id"].iloc[0], "vertex": np.arange(len(own), dtype=np.int32),
                         "longitude": own[:, 0], "latitude": own[:, 1]})


DIRECTIONS = 16  # in which the extreme points of a region are looked for
ROUNDING = 1e-12  # of the terms of a cross product


def inner_polygons(points: DataFrame) -> DataFrame:
    """(region_id, polygon): the extreme points of a region in ``DIRECTIONS``
    directions, counter-clockwise; corners of its hull, from partial aggregates."""
    def far(i: int):
        angle = 2 * np.pi * i / DIRECTIONS
        reach = F.col("longitude") * float(np.cos(angle)) + F.col("latitude") * float(np.sin(angle))
        return F.max_by(F.struct(F.col("longitude").alias("x"), F.col("latitude").alias("y")), reach)
    return points.groupBy("region_id").agg(F.array(*[far(i) for i in range(DIRECTIONS)]).alias("polygon"))


def hull_candidates(points: DataFrame) -> DataFrame:
    """The points that may be corners: those not strictly inside their
    region's inner polygon. The test is a JVM expression; what is inside by
    less than rounding stays, and so does every point of a polygon without area."""
    x, y = F.col("longitude"), F.col("latitude")

    def left(a, b):
        one, two = (b["x"] - a["x"]) * (y - a["y"]), (b["y"] - a["y"]) * (x - a["x"])
        return (a == b) | (one - two > (F.abs(one) + F.abs(two)) * ROUNDING)
    edges = F.arrays_zip(F.col("polygon").alias("a"),
                         F.concat(F.slice("polygon", 2, DIRECTIONS - 1), F.slice("polygon", 1, 1)).alias("b"))
    inside = (F.size(F.array_distinct("polygon")) > 2) & F.forall(edges, lambda e: left(e["a"], e["b"]))
    return points.join(inner_polygons(points), "region_id").filter(~inside).select("region_id", "longitude", "latitude")


def convex_hulls(points: DataFrame) -> DataFrame:
    """Hull vertices per region (counter-clockwise from the lowest-left point).

    Only candidates leave the JVM: a hull per partition of them, merged in
    salted groups, then once per region.
    """
    p = points.dropna(subset=["region_id", "latitude", "longitude"]).select("region_id", "longitude", "latitude")
    partial = hull_candidates(p).mapInPandas(_partial_hulls, _HULL_SCHEMA)
    merged = partial.groupBy("region_id", "salt").applyInPandas(_merged_hull, _HULL_SCHEMA)
    return merged.groupBy("region_id").applyInPandas(
        _final_hull, "region_id string, vertex int, longitude double, latitude double")


# ------------------------------------------------------------------ E25 ----
def knn_graph(spark: SparkSession, cents: DataFrame, k: int = KNN_K, keep=lambda df, name: df) -> DataFrame:
    """(region_id, neighbor_id, distance, nn_rank): k nearest other centroids,
    ties by neighbor id, through a grid (``neighbors``)."""
    return neighbors.nearest(spark, cents, k, keep)


# ------------------------------------------------------------------ E26 ----
EXACT, NEIGHBOR, MISS = "Exact hit", "Neighbor hit", "Miss"


def topk_sets(pred: DataFrame, chosen: DataFrame, k: int = 5, dataset: str = DATASET_IN) -> DataFrame:
    """(pred_time_id, region_id): the Top-K regions of every window by the one
    (model, seed) that ``chosen`` holds."""
    sub = pred.filter(F.col("dataset") == dataset).join(F.broadcast(chosen), ["model", "seed"])  # a single row
    window = Window.partitionBy("time_id")
    r = (sub.withColumn("__r", F.row_number().over(window.orderBy(F.col("y_score").desc(), F.col("region_id"))))
         .withColumn("__first", F.col("region_id") != F.lag("region_id", 1, "").over(window.orderBy("region_id")))
         .withColumn("__n", F.sum(F.col("__first").cast("int")).over(window)))
    return (r.filter(F.col("__r") <= F.greatest(F.lit(1), F.least(F.lit(int(k)), F.col("__n"))))
            .select(F.to_date("time_id").alias("pred_time_id"), "region_id"))


def hit_table(top: DataFrame, knn: DataFrame) -> DataFrame:
    """(pred_time_id, region_id, near): 2 for Top-K regions of a window, 1 for
    other regions with a kNN neighbor among them (at most k edges a region)."""
    edges = knn.select(F.col("neighbor_id").alias("region_id"), F.col("region_id").alias("of"))
    around = top.join(edges, "region_id").select("pred_time_id", F.col("of").alias("region_id"), F.lit(1).alias("near"))
    return (top.withColumn("near", F.lit(2)).unionByName(around)
            .groupBy("pred_time_id", "region_id").agg(F.max("near").alias("near")))


def event_hit_classes(events: DataFrame, pred: DataFrame, knn: DataFrame, window_days: int, chosen: DataFrame,
                      k: int = 5) -> DataFrame:
    """Each event's window minus one window is the window that predicted it.
    Exact hit: the event's region is in that window's Top-K; neighbor hit:
    otherwise some kNN neighbor of it is; else miss. One join on (window, region)."""
    classes = hit_table(topk_sets(pred, chosen, k), knn)
    ev = (events.dropna(subset=["event_date", "region_id", "latitude", "longitude"])
          .withColumn("event_time_id", time_bin(F.col("event_date"), window_days))
          .withColumn("pred_time_id", F.date_sub(F.col("event_time_id"), int(window_days))))
    out = ev.join(classes, ["pred_time_id", "region_id"], "left").withColumn("near", F.coalesce("near", F.lit(0)))
    return out.select("region_id", "event_date", "latitude", "longitude", "event_time_id", "pred_time_id",
                      (F.col("near") == 2).alias("exact_hit"), (F.col("near") == 1).alias("neighbor_hit"),
                      F.when(F.col("near") == 2, F.lit(EXACT)).when(F.col("near") == 1, F.lit(NEIGHBOR))
                      .otherwise(F.lit(MISS)).alias("coverage_class"))


# ------------------------------------------------------------------ E27 ----
def class_quota(count, total, n: int):
    """Rows of a class in a sample of n rows of ``total``: its share, at least one; all if there are no more than n."""
    return F.when(total <= n, count).otherwise(
        F.greatest(F.lit(1), F.floor(count * F.lit(float(n)) / total))).cast("long")


def hit_summary(hits: DataFrame, window_days: int, chosen: DataFrame, k: int = 5, sample_n: int = 50000) -> DataFrame:
    """One row: the chosen model and seed, events, events of the sample (E28) and hit rates."""
    per = hits.groupBy("coverage_class").agg(
        F.count(F.lit(1)).alias("c"), F.sum(F.col("exact_hit").cast("long")).alias("e"),
        F.sum((F.col("exact_hit") | F.col("neighbor_hit")).cast("long")).alias("a"))
    n = F.sum("c").over(Window.partitionBy(F.lit(1)))  # three classes
    per = per.withColumn("n", n).withColumn("q", class_quota(F.col("c"), F.col("n"), sample_n))
    out = per.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("n_events_total"),
        F.coalesce(F.least(F.sum("q"), F.max(F.when(F.col("n") > sample_n, sample_n).otherwise(F.col("n")))), F.lit(0))
        .cast("long").alias("n_events_sampled_for_plot"),
        (F.sum("e") / F.sum("c")).alias("exact_hit_rate"),
        (F.sum("a") / F.sum("c")).alias("neighbor_aware_hit_rate"))
    return side_by_side(out, chosen.select("model", F.col("seed").cast("int").alias("seed"))).select(
        F.lit(int(window_days)).alias("time_window_days"), "model", "seed", F.lit(int(k)).alias("topk_k"),
        *out.columns)


# ------------------------------------------------------------------ E28 ----
_PREFIX = 4  # hex digits of a hash bucket: at most 65,536 buckets a class


def sample_key(seed: int):
    """md5 of the seed, region, time and place (in millionths of a degree) of an event."""
    place = [F.floor(F.col(c) * 1000000.0).cast("string") for c in ("latitude", "longitude")]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), "region_id", F.date_format("event_date", "yyyy-MM-dd HH:mm:ss"),
                             *place).cast("binary"))


def stratified_sample(hits: DataFrame, n: int = 50000, seed: int = 42) -> DataFrame:
    """Per class the ``class_quota`` rows with the smallest ``sample_key``, and
    of these the n smallest overall; all rows when there are no more than n.

    Counts by the key's leading digits give each class the last bucket that
    its quota reaches. Rows beyond it are dropped where they are read, before
    any exchange, so only about n rows are ever ordered.
    """
    keyed = hits.withColumn("__h", sample_key(seed))
    bucket = F.substring("__h", 1, _PREFIX)
    counts = keyed.groupBy("coverage_class", bucket.alias("__b")).agg(F.count(F.lit(1)).alias("__c"))
    of_class = Window.partitionBy("coverage_class")
    total = F.sum("__c").over(Window.partitionBy(F.lit(1)))  # 65,536 rows of three classes at most
    counts = (counts.withColumn("__q", class_quota(F.sum("__c").over(of_class), total, n))
              .withColumn("__before", F.sum("__c").over(of_class.orderBy("__b")) - F.col("__c")))
    cut = (counts.filter(F.col("__before") < F.col("__q")).groupBy("coverage_class")
           .agg(F.max("__b").alias("__last"), F.max("__q").alias("__q")))
    kept = keyed.join(F.broadcast(cut), "coverage_class").filter(bucket <= F.col("__last"))  # one row a class
    ranked = kept.withColumn("__r", F.row_number().over(of_class.orderBy("__h"))).filter(F.col("__r") <= F.col("__q"))
    return ranked.orderBy("__h").limit(int(n)).drop("__r", "__q", "__h", "__last")


# ------------------------------------------------------------------ E29 ----
def exact_neighbor_rates(pred: DataFrame, knn: DataFrame, chosen: DataFrame, dataset: str = DATASET_IN) -> DataFrame:
    """Per region over all (seed, window) rows of the chosen model: exact-hit rate
    (predicted positive and positive), neighbor-only rate (predicted
    positive, not positive, some kNN neighbor positive), predicted-positive rate."""
    sub = pred.filter(F.col("dataset") == dataset).join(F.broadcast(chosen.select("model")), "model")  # a single row
    pos = sub.filter(F.col("y") == 1).select("seed", "time_id", F.col("region_id").alias("neighbor_id"))
    nb_pos = (knn.select("region_id", "neighbor_id").join(pos, "neighbor_id")
              .select("seed", "time_id", "region_id").distinct().withColumn("__nbpos", F.lit(True)))
    j = sub.join(nb_pos, ["seed", "time_id", "region_id"], "left")
    pp = F.col("y_pred") == 1
    ex = pp & (F.col("y") == 1)
    nbh = pp & ~ex & F.coalesce(F.col("__nbpos"), F.lit(False))
    return j.groupBy("region_id").agg(
        F.avg(ex.cast("double")).alias("exact_hit_rate"),
        F.avg(nbh.cast("double")).alias("neighbor_only_hit_rate"),
        F.avg(pp.cast("double")).alias("pred_positive_rate"))
