"""Near-duplicate vectors by a pivot-permutation index.

Reference points (pivots) are a bounded sample of the vectors; every vector
is described by its nearest pivots in order of closeness: ``NEAREST``, or as
many as pairs modelled at the threshold need (``lists_needed``). The inverted
list of a pivot holds the vectors that have it among them. The pivots that
two vectors of a list share are counted; those that share at least ``SHARED``
are candidates, in the list of the first pivot that both share, and every
candidate is then verified by its cosine. Long lists are split into blocks
that meet pairwise. Equal
vectors are one class, so that copies are never expanded into pairs, and a
block returns counts per class and a spanning forest, not pairs.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskbeacon.llm.common import Scratch, arrow_settings, tidy
from riskbeacon.llm.components import Forest, components, runs

NEAREST = 8        # pivots that describe a vector, at least
FOUND = 0.98       # share of the modelled pairs that must share enough pivots
MODELLED = 512     # vectors to model a pair for
AROUND = (32, 256, 2 * 4096)  # neighbours whose mean a modelled pair turns about
SHARED = 2         # pivots that candidates share at least
MOST_PIVOTS = 4096
BLOCK = 2048       # classes of a block


def unit_vectors(embeddings: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, digest, unit): unit vectors as doubles in binary; digest of the
    direction's bytes. Both are null where the vector is null, empty, zero or
    holds a null or a value that isn't finite."""
    rows = embeddings.select(embeddings[id_col].alias("vec_id"), embeddings[vec_col].cast("array<double>").alias("v"))

    def make(batches):
        for b in batches:
            digest, unit = [], []
            for v in b.column(1).to_pylist():
                x = np.array([np.nan if e is None else e for e in v], np.float64) if v else np.zeros(0)
                if len(x) and np.isfinite(x).all() and x.any():
                    x = x / np.abs(x).max()  # no overflow in the norm
                    x = x / np.linalg.norm(x) + 0.0
                    digest.append(hashlib.md5(x.tobytes(), usedforsecurity=False).digest())
                    unit.append(x.tobytes())
                else:
                    digest.append(None)
                    unit.append(None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(digest, pa.binary()), pa.array(unit, pa.binary())],
                                             names=["vec_id", "digest", "unit"])

    return rows.mapInArrow(tidy(make), f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, digest binary, unit binary")


def _matrix(col: pa.ChunkedArray | pa.Array) -> np.ndarray:
    parts = col.to_pylist()
    return np.frombuffer(b"".join(parts), np.float64).reshape(len(parts), -1)


def pivot_codes(unit: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """The nearest pivots of each row, closest first, ties to the smaller number."""
    sim = np.round(unit @ pivots.T, 12)
    return np.argsort(-sim, axis=1, kind="stable")[:, :nearest]


def spread(sample: np.ndarray, threshold: float, most: int) -> np.ndarray:
    """The first ``most`` vectors that aren't near one taken before: a dense
    cluster gives one pivot, so that its vectors agree on their pivots."""
    taken: list[int] = []
    for i in range(len(sample)):
        if not taken or (sample[taken] @ sample[i]).max() < threshold:
            taken.append(i)
            if len(taken) == most:
                break
    return sample[taken]


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def partners(x: np.ndarray, about: np.ndarray, toward: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """For each vector one at cosine ``threshold`` to it and as far from
    ``about`` as it, turned toward ``toward``; and whether there is one."""
    r = x - about
    size = np.linalg.norm(r, axis=1, keepdims=True)
    e = _unit(r)
    w = toward - about
    w = _unit(w - (w * e).sum(axis=1, keepdims=True) * e)
    low, high = np.zeros(len(x)), np.full(len(x), np.pi)

    def turned(angle: np.ndarray) -> np.ndarray:
        return _unit(about + size * (np.cos(angle)[:, None] * e + np.sin(angle)[:, None] * w))

    for _ in range(50):
        mid = (low + high) / 2
        near = (x * turned(mid)).sum(axis=1) >= threshold
        low, high = np.where(near, mid, low), np.where(near, high, mid)
    y = turned(low)
    return y, np.abs((x * y).sum(axis=1) - threshold) < 1e-6


def lists_needed(sample: np.ndarray, pivots: np.ndarray, threshold: float, least: int, shared: int) -> int:
    """How many nearest pivots (``least`` or more) describe a vector, so that
    ``FOUND`` of the pairs modelled at exactly the threshold share ``shared``.
    Pairs are modelled within dense groups of several sizes: there closeness
    to the pivots changes most, and the more so the more pivots there are."""
    rng = np.random.default_rng(0)
    x = sample[rng.permutation(len(sample))[:MODELLED]]
    order = np.argsort(-np.round(x @ sample.T, 12), axis=1, kind="stable")[:, 1:]
    take = min(least, len(pivots))
    if not order.shape[1] or shared > len(pivots):
        return take

    def ranks(v: np.ndarray) -> np.ndarray:
        return np.argsort(pivot_codes(v, pivots, len(pivots)), axis=1, kind="stable")

    own = ranks(x)
    for n in sorted({min(n, order.shape[1]) for n in AROUND}):
        about = np.stack([sample[o[:n]].mean(axis=0) for o in order])
        toward = sample[order[np.arange(len(x)), rng.integers(0, n, len(x))]]
        y, there = partners(x, about, toward, threshold)
        if there.any():
            # the length of the lists' start that holds ``shared`` common pivots
            start = 1 + np.sort(np.maximum(own[there], ranks(y[there])), axis=1)[:, shared - 1]
            take = max(take, int(np.sort(start)[math.ceil(FOUND * len(start)) - 1]))
    return take


def _described(pivots: np.ndarray, nearest: int):
    def make(batches):
        for b in batches:
            codes = pivot_codes(_matrix(b.column(1)), pivots, nearest)
            flat = pa.array(codes.astype(np.int32).ravel())
            off = pa.array(np.arange(len(codes) + 1, dtype=np.int32) * codes.shape[1])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), b.column(3),
                                              pa.ListArray.from_arrays(off, flat)],
                                             names=["digest", "unit", "id", "copies", "pivots"])
    return make


def candidates(codes: np.ndarray, pivot: int, shared: int, i_rows: np.ndarray, j_rows: np.ndarray) -> np.ndarray:
    """Matrix of the pairs of rows that share at least ``shared`` pivots and
    have ``pivot`` as the first one (of the smallest number) that they share."""
    known, at = np.unique(codes, return_inverse=True)  # few: the pivots around this one
    held = np.zeros((len(codes), len(known)), np.float32)
    held[np.arange(len(codes))[:, None], at.reshape(codes.shape)] = 1
    before = np.searchsorted(known, pivot)
    out = held[i_rows] @ held[j_rows].T >= shared
    if before:
        out &= held[i_rows, :before] @ held[j_rows, :before].T == 0
    return out


def _list_links(threshold: float, shared: int):
    """Counts of linked vectors and a spanning forest, for two blocks of a pivot's list."""
    def make(batches):
        for t in runs(batches, ["pivot", "low", "high"]):
            t = t.combine_chunks()
            pivot, same = t["pivot"][0].as_py(), t["low"][0].as_py() == t["high"][0].as_py()
            x, ids, copies = _matrix(t["unit"]), t["id"].to_numpy(), t["copies"].to_numpy()
            flat = t["pivots"].combine_chunks().flatten().to_numpy()
            codes = flat.reshape(len(ids), -1)
            side = t["block"].to_numpy()
            i_rows = np.flatnonzero(side == t["low"][0].as_py())
            j_rows = np.arange(len(ids)) if same else np.flatnonzero(side != t["low"][0].as_py())
            count = np.zeros(len(ids), np.int64)
            f, a, b = Forest(len(ids)), [], []
            for part in np.array_split(i_rows, -(-len(i_rows) // 256)):
                pairs = candidates(codes, pivot, shared, part, j_rows)
                if same:
                    pairs &= part[:, None] < j_rows[None, :]
                some_i, some_j = np.flatnonzero(pairs.any(axis=1)), np.flatnonzero(pairs.any(axis=0))
                if not len(some_i):
                    continue
                part, others = part[some_i], j_rows[some_j]
                near = (x[part] @ x[others].T >= threshold) & pairs[np.ix_(some_i, some_j)]
                p, q = np.nonzero(near)
                count[part] += near @ copies[others]
                count[others] += copies[part] @ near
                for i, j in zip(part[p].tolist(), others[q].tolist()):
                    if f.join(i, j):
                        a.append(ids[i])
                        b.append(ids[j])
            some = np.flatnonzero(count)
            n = len(some) + len(a)
            if n:
                yield pa.RecordBatch.from_arrays(
                    [t["digest"].combine_chunks().take(pa.array(np.concatenate((some, np.zeros(len(a), np.int64))))),
                     pa.array(np.concatenate((count[some], np.zeros(len(a), np.int64)))),
                     pa.array([None] * len(some) + a, pa.int64()), pa.array([None] * len(some) + b, pa.int64())],
                    names=["digest", "n", "a", "b"])
    return make


def near_vectors(embeddings: DataFrame, threshold: float = 0.9, nearest: int = NEAREST, shared: int = SHARED,
                 most_pivots: int = MOST_PIVOTS) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row.

    Pairs found link at cosine >= threshold in double precision; none below
    it links. Vectors that are null, empty, zero or hold null or non-finite
    components link with nothing, nor do rows without an id. Vectors of
    different lengths are never compared. Rows with equal ids count as
    vectors of their own and as one node of the components.
    """
    spark = embeddings.sparkSession
    arrow_settings(spark)
    scratch = Scratch(spark, "pivots")
    base = scratch.write(unit_vectors(embeddings), "vectors")
    classes = scratch.write(
        base.filter("digest IS NOT NULL AND vec_id IS NOT NULL").groupBy("digest")
        .agg(F.min(F.col("vec_id").cast("long")).alias("id"), F.count(F.lit(1)).alias("copies"),
             F.any_value("unit").alias("unit")), "classes")
    links = []
    # vectors of one length are one collection; lengths are few
    lengths = [r["d"] for r in classes.select(F.length("unit").alias("d")).distinct().collect()]
    for d in sorted(lengths):
        own = classes.filter(F.length("unit") == d)
        n = own.count()
        wanted = min(most_pivots, max(16, 2 * math.isqrt(n)))
        # a bounded sample, at most twice ``most_pivots`` vectors, by the digest's hash
        sample = own.select("unit").orderBy(F.xxhash64("digest"), "digest").limit(2 * wanted).collect()
        sample = np.stack([np.frombuffer(r["unit"], np.float64) for r in sample])
        pivots = spread(sample, threshold, wanted)
        take = lists_needed(sample, pivots, threshold, nearest, shared)
        need = min(shared, take)
        described = scratch.write(own.select("digest", "unit", "id", "copies").mapInArrow(
            tidy(_described(pivots, take)), "digest binary, unit binary, id long, copies long, pivots array<int>"), f"described-{d}")
        lists = described.withColumn("pivot", F.explode("pivots"))
        blocks = (described.select(F.explode("pivots").alias("p")).groupBy("p").agg(F.count(F.lit(1)).alias("c"))
                  .select("p", F.ceil(F.col("c") / BLOCK).cast("int").alias("blocks")))
        # a row per pivot: at most ``most_pivots``
        split = lists.join(F.broadcast(blocks), F.col("pivot") == F.col("p")).withColumn(
            "block", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int"))
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        split = split.withColumn("other", other).select(
            "pivot", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block",
            "digest", "unit", "id", "copies", "pivots")
        found = (split.repartition("pivot", "low", "high").sortWithinPartitions("pivot", "low", "high")
                 .mapInArrow(tidy(_list_links(threshold, need)), "digest binary, n long, a long, b long"))
        links.append(scratch.write(found, f"links-{d}"))
    out = base.withColumn("id", F.col("vec_id").cast("long"))
    if not links:
        return out.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"),
                          F.lit(True).alias("kept"))
    found = links[0]
    for more in links[1:]:
        found = found.unionByName(more)
    comp = components(scratch, found.filter("a IS NOT NULL").select("a", "b"), "linked")
    counts = found.filter("a IS NULL").groupBy("digest").agg(F.sum("n").alias("others"))
    per_class = (classes.select("digest", "id", "copies").join(counts, "digest", "left")
                 .join(comp.withColumnRenamed("node", "id"), "id", "left")
                 .select("digest", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("class_links"),
                         F.coalesce("component", "id").alias("class_component")))
    found = out.join(per_class, "digest", "left").select(
        "vec_id", "id", F.when(F.col("vec_id").isNull(), 0).otherwise(F.coalesce("class_links", F.lit(0)))
        .cast("long").alias("n_links"),
        F.when(F.col("vec_id").isNotNull(), F.coalesce("class_component", "id")).alias("component_id"))
    return found.select("vec_id", "n_links", "component_id",
                        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
