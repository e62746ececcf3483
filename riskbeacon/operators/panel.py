"""Dense (region x time-window) panel of incident counts.

Scale notes: the event table is reduced by one partial+final hash aggregation
on (region_id, day); the windows are summed from the days, and everything after
that runs on the panel, whose size is regions x windows and does not grow with
the number of events. The time
grid is generated per region with ``explode(sequence(..))`` from two driver
scalars (the global first and last window), so no cross join is planned.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskbeacon.config import ANCHOR_DATE, CRIME_GROUPS
from riskbeacon.functions.expr import GROUP_COUNT_COLS, group_count_col, time_bin


@dataclass(frozen=True)
class TimeBounds:
    first: dt.date | None
    last: dt.date | None
    window_days: int
    first_marked: dt.datetime | None = None   # first event at/after the split date
    last_event: dt.datetime | None = None

    @property
    def n_windows(self) -> int:
        if self.first is None:
            return 0
        return (self.last - self.first).days // self.window_days + 1


def with_time_id(events: DataFrame, window_days: int, anchor: str = ANCHOR_DATE,
                 date_col: str = "event_date") -> DataFrame:
    """Attach the window start date."""
    return events.withColumn("time_id", time_bin(F.col(date_col), window_days, anchor))


def day_counts(events: DataFrame, mark_from: str | None = None) -> DataFrame:
    """C3 + C5 by day: total and per-group counts per (region, day), from which
    windows of any length are summed. One look at the events serves them all.

    Spark plans a partial aggregation before the shuffle, so at most one row
    per (region, day) and map task crosses the network - hot regions do
    not concentrate raw events in one task.
    """
    ev = events.select("event_date", "region_id", "crime_group").withColumn("day", F.to_date("event_date"))
    ev = ev.filter(F.col("region_id").isNotNull() & F.col("day").isNotNull())
    aggs = [F.count(F.lit(1)).alias("count")]
    aggs += [F.count_if(F.col("crime_group") == g).cast("double").alias(group_count_col(g))
             for g in CRIME_GROUPS]
    if mark_from is not None:
        # First event at/after a split date and last event per cell, so the
        # test-window bounds come from this same pass (no second event scan).
        start = F.lit(mark_from).cast("timestamp")
        aggs += [F.min(F.when(F.col("event_date") >= start, F.col("event_date"))).alias("first_from"),
                 F.max("event_date").alias("last_date")]
    return ev.groupBy("region_id", "day").agg(*aggs)


def window_counts(days: DataFrame, window_days: int, anchor: str = ANCHOR_DATE) -> DataFrame:
    """C3 + C5: ``day_counts`` summed per (region, window)."""
    aggs = [F.sum(c).alias(c) for c in ("count", *GROUP_COUNT_COLS)]
    if "first_from" in days.columns:
        aggs += [F.min("first_from").alias("first_from"), F.max("last_date").alias("last_date")]
    return with_time_id(days, window_days, anchor, "day").groupBy("region_id", "time_id").agg(*aggs)


def time_bounds(counts: DataFrame, window_days: int) -> TimeBounds:
    with_marks = "first_from" in counts.columns
    aggs = [F.min("time_id").alias("a"), F.max("time_id").alias("b")]
    if with_marks:
        aggs += [F.min("first_from").alias("f"), F.max("last_date").alias("l")]
    row = counts.agg(*aggs).first()
    if not with_marks:
        return TimeBounds(row["a"], row["b"], int(window_days))
    return TimeBounds(row["a"], row["b"], int(window_days), row["f"], row["l"])


def densify(counts: DataFrame, bounds: TimeBounds) -> DataFrame:
    """C4: every region x every window between the GLOBAL first and last
    window; missing cells are 0 (regions first seen late get leading zeros)."""
    if bounds.first is None:
        return counts.limit(0)
    step = F.expr(f"INTERVAL {bounds.window_days} DAYS")
    counts = counts.select("region_id", "time_id", "count", *GROUP_COUNT_COLS)
    grid = (counts.select("region_id").distinct()
            .select("region_id",
                    F.explode(F.sequence(F.lit(bounds.first), F.lit(bounds.last), step)).alias("time_id")))
    panel = grid.join(counts, ["region_id", "time_id"], "left")
    fills = {"count": 0, **{c: 0.0 for c in GROUP_COUNT_COLS}}
    return panel.fillna(fills).select("region_id", "time_id", F.col("count").cast("long").alias("count"),
                                      *GROUP_COUNT_COLS)


def build_panel(days: DataFrame, window_days: int, anchor: str = ANCHOR_DATE,
                persist: bool = True, store=None) -> tuple[DataFrame, TimeBounds]:
    """``day_counts`` -> dense panel (region_id, time_id, count, count_grp_*).

    The aggregated counts feed both the bounds scalar and the panel; they are
    regions x windows in size. ``store(df)`` (if given) materializes them in
    the shared folder, else they are persisted.
    """
    counts = window_counts(days, window_days, anchor)
    if store is not None:
        counts = store(counts)
    elif persist:
        counts = counts.persist(StorageLevel.MEMORY_AND_DISK)
    bounds = time_bounds(counts, window_days)
    return densify(counts, bounds), bounds
