"""Connected components by alternating large and small stars.

Every step is a sum over neighbours and a join, written to the shared
folder; a hub with many neighbours is pre-aggregated before the shuffle and
its join side can be split by AQE. Links never meet in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskbeacon.llm.common import Scratch


class Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _only_stars(edges: DataFrame) -> bool:
    """No node has both a smaller neighbour and another one (edges are distinct)."""
    node = _both_ways(edges).groupBy("a").agg(F.min("b").alias("low"), F.count(F.lit(1)).alias("n"))
    return node.filter("low < a AND n > 1").agg(F.count(F.lit(1))).first()[0] == 0


def _large_star(edges: DataFrame) -> DataFrame:
    both = _both_ways(edges)
    low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    return (both.join(low, F.col("a") == F.col("u")).filter("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b"))


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
    moved = edges.join(low, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).filter("a <> b")


def components(scratch: Scratch, edges: DataFrame, name: str) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of a link (a, b).

    Nodes without links don't appear. The order of a and b and repeated
    links don't matter.
    """
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    step = 0
    now = scratch.write(now, f"{name}-0")
    while not _only_stars(now):
        step += 1
        now = scratch.write(_small_star(_large_star(now).distinct()).distinct(), f"{name}-{step}")
        scratch.drop(f"{name}-{step - 1}")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of the rows with equal keys, from batches sorted by the keys.

    Holds the rows of one key (callers bound them) and one batch.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(b.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(b.num_rows, bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(new).tolist(), b.num_rows]
        for x, y in zip(cuts, cuts[1:]):
            key = tuple(c[x] for c in cols)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(x, y - x))
            last = key
    if held:
        yield pa.Table.from_batches(held)
