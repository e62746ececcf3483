"""Exact top-k inner products by distributed histogram selection.

Queries and candidates are dealt into blocks; each pair of blocks is scored
as a matrix product, in every round anew. A round counts, for each query,
the scores by bins over the query's present interval; the sums over all
blocks say which bin holds the k-th best score, and the next round refines
that bin until it is one integer wide. With the k-th value known, one last
scoring keeps what lies above it and breaks ties at it by the smaller id.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskbeacon.llm.common import Scratch, arrow_settings, tidy

BINS = 1024
QUERY_BLOCK = 1024      # queries of a block
CANDIDATE_BLOCK = 4096  # candidates of a block
BLOCK_BYTES = 16 << 20  # of vectors in a block, about
EXACT = 2.0 ** 53       # doubles hold all integers below
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


def integer_vectors(embeddings: DataFrame, scale: int = 256, id_col: str = "vec_id",
                    vec_col: str = "embedding") -> DataFrame:
    """(vec_id, vec): floor(scale * x) of each component as doubles in binary;
    rows without an id or with null or non-finite components are left out."""
    rows = embeddings.select(embeddings[id_col].cast("long").alias("vec_id"),
                             embeddings[vec_col].cast("array<double>").alias("v")).filter("vec_id IS NOT NULL")

    def make(batches):
        for b in batches:
            out, norm = [], []
            for v in b.column(1).to_pylist():
                x = None if v is None else np.array([np.nan if e is None else e for e in v], np.float64)
                x = None if x is None else np.floor(scale * x) + 0.0
                good = x is not None and np.isfinite(x).all()
                out.append(x.tobytes() if good else None)
                norm.append(float(np.hypot.reduce(x, initial=0.0)) if good else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary()), pa.array(norm, pa.float64())],
                                             names=["vec_id", "vec", "norm"])

    return rows.mapInArrow(tidy(make), "vec_id long, vec binary, norm double").filter("vec IS NOT NULL")


def _matrix(vec: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(vec), np.float64).reshape(len(vec), len(vec.iloc[0]) // 8)


def _scores(q: pd.DataFrame, c: pd.DataFrame) -> np.ndarray:
    """Integer inner products of all rows of q and c, int64; values beyond it
    are held at its ends. Exact: as doubles while every sum stays below 2**53."""
    x, y = _matrix(q["vec"]), _matrix(c["vec"])
    top = (np.abs(x).max(initial=0.0) * np.abs(y).max(initial=0.0)) * x.shape[1]
    if top < EXACT:
        return np.rint(x @ y.T).astype(np.int64)
    xi = [[int(e) for e in r] for r in x]
    yi = [[int(e) for e in r] for r in y]
    return np.array([[min(_HIGH, max(_LOW, sum(a * b for a, b in zip(r, s)))) for s in yi] for r in xi],
                    dtype=np.int64).reshape(len(x), len(y))


def _count_bins(k: int, bins: int):
    """Counts by bin for each query, from the top bin down to the one in which
    this block alone has k scores: lower bins can't hold the k-th best."""
    def make(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        ids, bin_, n = [], [], []
        if len(q) and len(c):
            s = _scores(q, c)
            cid = c["vec_id"].to_numpy()
            for i, (qid, lo, hi) in enumerate(zip(q["vec_id"], q["lo"], q["hi"])):
                own = s[i][cid != qid]
                width = -(-(int(hi) - int(lo) + 1) // bins)
                above = int((own > hi).sum())
                own = own[(own >= lo) & (own <= hi)]
                at = (own.astype(np.uint64) - np.uint64(int(lo) % (1 << 64))) // np.uint64(width)
                b, count = np.unique(at.astype(np.int64), return_counts=True)
                have = above + np.cumsum(count[::-1])
                keep = int(np.searchsorted(have, k)) + 1
                b, count = b[::-1][:keep], count[::-1][:keep]
                ids += [qid] * (len(b) + 1)
                bin_ += [bins, *b.tolist()]
                n += [above, *count.tolist()]
        return pd.DataFrame({"query_id": pd.Series(ids, dtype="int64"), "bin": pd.Series(bin_, dtype="int64"),
                             "n": pd.Series(n, dtype="int64")})
    return make


def _take(k: int):
    """The block's own best: scores above the k-th value, and at it the k smallest ids."""
    def make(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(c):
            s = _scores(q, c)
            cid = c["vec_id"].to_numpy()
            for i, (qid, kth) in enumerate(zip(q["vec_id"], q["lo"])):
                above = (s[i] > kth) & (cid != qid)
                tie = np.sort(cid[(s[i] == kth) & (cid != qid)])[:k]
                ids = np.concatenate((cid[above], tie))
                out.append(pd.DataFrame({"query_id": np.int64(qid), "vec_id": ids, "score": np.concatenate(
                    (s[i][above], np.full(len(tie), kth, np.int64)))}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": pd.Series(dtype="int64"),
                                                        "vec_id": pd.Series(dtype="int64"),
                                                        "score": pd.Series(dtype="int64")})
    return make


def top_inner_products(embeddings: DataFrame, k: int = 5, every: int = 50, scale: int = 256,
                       bins: int = BINS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best scores of every query, all if fewer.

    Queries are the rows whose id is divisible by ``every``; candidates are
    all rows with another id. Vectors that are null or hold null or
    non-finite components take no part, nor do rows without an id; vectors
    of different lengths aren't scored with each other. Repeated rows are
    candidates each; a repeated query id is one query per distinct vector,
    merged in one ranking.
    """
    spark = embeddings.sparkSession
    arrow_settings(spark)
    scratch = Scratch(spark, "topk")
    vectors = scratch.write(integer_vectors(embeddings, scale).withColumn("dim", F.length("vec")), "vectors")
    queries = vectors.filter(F.col("vec_id") % every == 0).select("dim", "vec_id", "vec").distinct()
    is_query = F.col("vec_id") % every == 0
    size = vectors.agg(F.sum("dim").alias("c"), F.sum(F.when(is_query, F.col("dim"))).alias("q"),
                       F.count(F.lit(1)).alias("nc"), F.count_if(is_query).alias("nq"), F.max("norm").alias("norm")).first()
    n_chunks = max(1, -(-size["nc"] // CANDIDATE_BLOCK), -(-(size["c"] or 0) // BLOCK_BYTES))
    n_blocks = max(1, -(-size["nq"] // QUERY_BLOCK), -(-(size["q"] or 0) // BLOCK_BYTES))
    chunk = F.pmod(F.xxhash64("vec_id", "vec"), F.lit(n_chunks)).cast("int")
    block = F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int")
    right = vectors.select("dim", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("block"),
                           chunk.alias("chunk"), "vec_id", "vec")
    # no score lies beyond the product of the longest query and candidate
    most = min(_HIGH, math.ceil((size["norm"] or 0.0) ** 2 * (1 + 1e-9)) + 1)
    state = queries.select("dim", block.alias("block"), "vec_id", "vec", F.lit(-most).cast("long").alias("lo"),
                           F.lit(most).cast("long").alias("hi"))
    state = scratch.write(state, "state-0")

    def against(fn, schema):
        left = state.select("dim", "block", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))).alias("chunk"),
                            "vec_id", "vec", "lo", "hi")
        return left.groupBy("dim", "block", "chunk").cogroup(right.groupBy("dim", "block", "chunk")).applyInPandas(
            fn, schema)

    width, step = 2 * most + 1, 0
    while width > 1:
        counts = against(_count_bins(k, bins), "query_id long, bin long, n long").groupBy("query_id", "bin").agg(
            F.sum("n").alias("n"))
        down = Window.partitionBy("query_id").orderBy(F.desc("bin"))
        # the highest bin down to which there are k scores; the lowest bin, if there are fewer
        pick = (counts.withColumn("have", F.sum("n").over(down)).filter((F.col("bin") < bins))
                .groupBy("query_id").agg(F.max(F.when(F.col("have") >= k, F.col("bin"))).alias("hit"),
                                         F.min("bin").alias("least")))
        w = F.ceil((F.col("hi").cast("decimal(38,0)") - F.col("lo") + 1) / bins).cast("decimal(38,0)")
        at = F.coalesce("hit", "least")
        moved = state.join(pick, state["vec_id"] == pick["query_id"], "left").select(
            "dim", "block", "vec_id", "vec",
            F.when(at.isNull(), F.col("lo")).otherwise(F.col("lo") + at * w).cast("long").alias("lo"),
            F.when(at.isNull(), F.col("lo")).otherwise(
                F.least(F.col("hi").cast("decimal(38,0)"), F.col("lo") + (at + 1) * w - 1)).cast("long").alias("hi"))
        step += 1
        state = scratch.write(moved, f"state-{step}")
        width = -(-width // bins)
    best = against(_take(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
