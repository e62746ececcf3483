"""Exact k nearest neighbours through a grid of several levels.

Level l cuts the bounding square into cells of side / 2^l. Places with equal
coordinates are one site. A site is looked up on the finest level whose 3 x 3
cells around it hold enough entries, so dense parts use small cells and far
outliers large ones: a cell is read by few sites however many entries it has
(sites that need a level lie sparse on the next finer one), and the number of
candidates grows in proportion to the regions.

1. the 3 x 3 cells around a site give its k + 1 best entries so far;
2. the (k + 1)-th of them lies within 3 * sqrt(2) cell sides, which proves
   that nothing outside that circle can be nearer: only cells of rings 2 to 5
   that the circle touches are still joined, for the sites that have any.

Both steps are equi-joins on (level, x, y). At most k + 1 regions of a site
are entries: of regions in one place only the smallest ids can be among the
nearest. Every region then takes the k best of its site but itself.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CELL_ENTRIES = 64    # a level is added while a cell of the finest has more entries than this and k ask for
DEEPER = 4           # levels added at a time
FINEST = 44          # cells of side / 2^44 are near the resolution of coordinates
RINGS = 5            # rings that a circle of 3 * sqrt(2) sides can touch
SLACK = 1e-9         # of a cell side or distance, against rounding


def _cell(at: Column, low: float, side: Column) -> Column:
    return F.floor((at - F.lit(low)) / side).cast("long")


class Grid:
    """Bounding square and levels that fit the entries."""

    def __init__(self, entries: DataFrame, k: int):
        box = entries.agg(F.min("lon").alias("x0"), F.max("lon").alias("x1"), F.min("lat").alias("y0"),
                          F.max("lat").alias("y1"), F.count(F.lit(1)).alias("n")).first()
        self.n, self.x0, self.y0 = box.n, box.x0, box.y0
        self.side = max(box.x1 - box.x0, box.y1 - box.y0) or 1.0 if box.n else 1.0
        # about two entries in a cell if they were spread evenly
        self.finest = min(FINEST, max(0, math.ceil(math.log2(math.sqrt(max(box.n, 2) / 2)))))
        while self.finest < FINEST:
            fullest = entries.groupBy(*self.cell(F.lit(self.finest))).count().agg(F.max("count")).first()[0] or 0
            if fullest <= CELL_ENTRIES * (k + 1):
                break
            self.finest = min(FINEST, self.finest + DEEPER)

    def width(self, level: Column) -> Column:
        return F.lit(self.side) / F.pow(F.lit(2.0), level)

    def cell(self, level: Column) -> list[Column]:
        w = self.width(level)
        return [_cell(F.col("lon"), self.x0, w).alias("cx"), _cell(F.col("lat"), self.y0, w).alias("cy")]

    def on_levels(self, df: DataFrame) -> DataFrame:
        every = df.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(self.finest))))
        return every.select("*", *self.cell(F.col("level")))


def _around(reach: int) -> Column:
    """Array of (dx, dy) of all cells up to ``reach`` rings away."""
    step = F.sequence(F.lit(-reach), F.lit(reach))
    return F.flatten(F.transform(step, lambda x: F.transform(step, lambda y: F.struct(x.alias("dx"), y.alias("dy")))))


def _levels(grid: Grid, sites: DataFrame, entries: DataFrame, k: int) -> DataFrame:
    """Sites with the finest level on which the 3 x 3 cells around them hold
    k + 1 entries, or level 0, whose 3 x 3 cells hold everything."""
    counts = grid.on_levels(entries).groupBy("level", "cx", "cy").agg(F.count(F.lit(1)).alias("n"))
    near = (counts.withColumn("d", F.explode(_around(1)))
            .groupBy("level", (F.col("cx") + F.col("d.dx")).alias("cx"), (F.col("cy") + F.col("d.dy")).alias("cy"))
            .agg(F.sum("n").alias("n")).filter(F.col("n") > k))
    best = (grid.on_levels(sites).join(near, ["level", "cx", "cy"]).groupBy("lon", "lat")
            .agg(F.max("level").alias("found")))
    out = sites.join(best, ["lon", "lat"], "left").withColumn("level", F.coalesce("found", F.lit(0))).drop("found")
    return out.select("*", *grid.cell(F.col("level")))


def _candidates(asked: DataFrame, index: DataFrame) -> DataFrame:
    """(lon, lat, id, distance): the entries of the cells (level, x, y) asked for."""
    return (asked.join(index, ["level", "cx", "cy"])
            .select("lon", "lat", "id", F.hypot(F.col("lon") - F.col("ex"), F.col("lat") - F.col("ey")).alias("distance")))


def _best(candidates: DataFrame, n: int) -> DataFrame:
    w = Window.partitionBy("lon", "lat").orderBy("distance", "id")
    return candidates.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= n)


def site_candidates(sites: DataFrame, entries: DataFrame, k: int, keep=lambda df, name: df) -> tuple[DataFrame, DataFrame]:
    """Candidates of the 3 x 3 cells and of the outer rings (see the module).

    ``keep`` may write an intermediate table.
    """
    grid = Grid(entries, k)
    placed = keep(_levels(grid, sites, entries, k), "sites")
    index = grid.on_levels(entries).select("level", "cx", "cy", "id", F.col("lon").alias("ex"), F.col("lat").alias("ey"))
    index = index.join(placed.select("level").distinct(), "level", "left_semi")
    block = placed.withColumn("d", F.explode(_around(1))).select(
        "lon", "lat", "level", (F.col("cx") + F.col("d.dx")).alias("cx"), (F.col("cy") + F.col("d.dy")).alias("cy"))
    first = keep(_best(_candidates(block, index), k + 1).drop("place"), "first")

    # the circle of the (k + 1)-th best so far; fewer found means that all entries were seen
    reach = first.groupBy("lon", "lat").agg(F.max("distance").alias("reach"), F.count(F.lit(1)).alias("n"))
    width = grid.width(F.col("level"))
    cell = {a: F.col(c) + F.col(f"d.d{a}") for a, c in (("x", "cx"), ("y", "cy"))}
    low = {"x": F.lit(grid.x0) + cell["x"] * width, "y": F.lit(grid.y0) + cell["y"] * width}
    gap = {a: F.greatest(low[a] - F.col(at), F.col(at) - low[a] - width, F.lit(0.0))
           for a, at in (("x", "lon"), ("y", "lat"))}
    outer = F.filter(_around(RINGS), lambda d: F.greatest(F.abs(d["dx"]), F.abs(d["dy"])) > 1)
    rings = (placed.join(reach.filter(F.col("n") > k), ["lon", "lat"]).withColumn("d", F.explode(outer))
             .filter(F.hypot(gap["x"], gap["y"]) <= F.col("reach") * (1 + SLACK) + width * SLACK)
             .select("lon", "lat", "level", cell["x"].alias("cx"), cell["y"].alias("cy")))
    return first, _candidates(rings, index)


def nearest(spark: SparkSession, cents: DataFrame, k: int, keep=lambda df, name: df) -> DataFrame:
    """(region_id, neighbor_id, distance, nn_rank): the k nearest other regions
    by Euclidean distance in degrees, ties by neighbor id.

    Regions need finite coordinates and one row each.
    """
    own = cents.select("region_id", F.col("lon").cast("double").alias("lon"), F.col("lat").cast("double").alias("lat"))
    # -0.0 and 0.0 are one place
    own = keep(own.select("region_id", (F.col("lon") + 0.0).alias("lon"), (F.col("lat") + 0.0).alias("lat")), "regions")
    entries = _best(own.select("lon", "lat", F.lit(0.0).alias("distance"), F.col("region_id").alias("id")), k + 1).select(
        "lon", "lat", "id")
    sites = entries.select("lon", "lat").distinct()
    first, more = site_candidates(sites, entries, k, keep)
    of_site = _best(first.unionByName(more), k + 1)
    w = Window.partitionBy("region_id").orderBy("place")
    return (own.join(of_site, ["lon", "lat"]).filter(F.col("region_id") != F.col("id"))
            .withColumn("nn_rank", F.row_number().over(w).cast("int")).filter(F.col("nn_rank") <= k)
            .select("region_id", F.col("id").alias("neighbor_id"), "distance", "nn_rank"))
