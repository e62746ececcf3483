"""Quality: regularised quadratic discriminant analysis over document statistics.

A text is described by transformed statistics of its characters, words and
lines. Class means and covariances come from sums over all labelled rows;
covariances are shrunk towards the pooled one and a diagonal. A score is the
logistic of the difference of the classes' log-densities, by Mahalanobis
distances through Cholesky factors that are computed once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskbeacon.llm.common import (Scratch, arrow_settings, held_out, segment_sums, slices_by_bytes, string_buffers,
                                   text_column, tidy)
from riskbeacon.llm.labels import fit_labels

TO_POOLED = 0.5      # shrinkage of a class covariance to the pooled one
TO_DIAGONAL = 0.1    # and of that to its diagonal
FLOOR = 0.02         # added to the variances of standardised statistics
TEMPER = 4.0         # log-density differences are divided by it
_ASCII = np.arange(256)
_KINDS = {
    "upper": (_ASCII >= 65) & (_ASCII <= 90),
    "lower": ((_ASCII >= 97) & (_ASCII <= 122)),
    "digit": (_ASCII >= 48) & (_ASCII <= 57),
    "blank": np.isin(_ASCII, [9, 11, 12, 13, 32]),
    "line": _ASCII == 10,
    "stop": np.isin(_ASCII, [44, 46]),
    "shout": np.isin(_ASCII, [33, 63]),
    "bar": _ASCII == 124,
    "mark": np.isin(_ASCII, [*range(35, 44), 45, 47, 58, 59, 60, 61, 62, 64, *range(91, 97), 123, 125, 126]),
    "wide": _ASCII >= 128,
}
FEATURES = ["size", "words", "word_length", "upper", "digit", "stop", "shout", "bar", "mark", "wide", "lines",
            "repeated_lines", "repeated_words"]


def statistics(texts: pa.Array) -> np.ndarray:
    """Transformed statistics, a row per text; an empty text has zeros."""
    raw, off = string_buffers(texts)
    n = np.diff(off).astype(np.float64)
    count = {k: segment_sums(m[raw], off).astype(np.float64) for k, m in _KINDS.items()}
    white = (_KINDS["blank"] | _KINDS["line"])[raw]
    begins = ~white
    begins[1:] &= white[:-1]
    begins[off[:-1][n > 0]] = ~white[off[:-1][n > 0]]
    words = segment_sums(begins, off).astype(np.float64)
    solid = np.maximum(n - count["blank"] - count["line"], 1)

    def distinct(lists: pa.ListArray) -> np.ndarray:
        code = lists.flatten().dictionary_encode().indices.to_numpy().astype(np.int64)
        lo = lists.offsets.to_numpy().astype(np.int64)
        doc = np.repeat(np.arange(len(lists)), np.diff(lo))
        pairs = np.unique(doc * (np.int64(code.max(initial=0)) + 1) + code)
        return np.bincount(pairs // (np.int64(code.max(initial=0)) + 1), minlength=len(lists)).astype(np.float64)

    lines = pc.split_pattern(texts, "\n")
    n_lines = count["line"] + 1
    part = lambda k: np.sqrt(count[k] / solid)
    cols = [np.log1p(n), np.log1p(words), np.log1p(solid / np.maximum(words, 1)), part("upper"), part("digit"),
            part("stop"), part("shout"), part("bar"), part("mark"), part("wide"), np.log1p(words / n_lines),
            np.sqrt(np.maximum(1 - distinct(lines) / n_lines, 0)),
            np.sqrt(np.maximum(1 - distinct(pc.ascii_split_whitespace(texts)) / np.maximum(words, 1), 0))]
    out = np.stack(cols, axis=1)
    out[n == 0] = 0
    return out


@dataclass
class Discriminant:
    """Standardisation, and for each class mean, Cholesky factor and log-constant."""
    centre: np.ndarray
    scale: np.ndarray
    mean: np.ndarray
    factor: np.ndarray
    constant: np.ndarray

    @staticmethod
    def of(n: np.ndarray, s: np.ndarray, ss: np.ndarray) -> "Discriminant":
        """From the classes' counts, sums (2, d) and sums of products (2, d, d)."""
        total = n.sum()
        centre = s.sum(axis=0) / total
        scale = np.sqrt(np.maximum(np.diag(ss.sum(axis=0)) / total - centre ** 2, 1e-12))
        mean = (s / n[:, None] - centre) / scale
        cov = np.empty_like(ss)
        for c in (0, 1):
            m = s[c] / n[c]
            cov[c] = (ss[c] / n[c] - np.outer(m, m)) / np.outer(scale, scale)
        pooled = (n[:, None, None] * cov).sum(axis=0) / total
        factor, constant = [], []
        for c in (0, 1):
            v = (1 - TO_POOLED) * cov[c] + TO_POOLED * pooled
            v = (1 - TO_DIAGONAL) * v + TO_DIAGONAL * np.diag(np.diag(v)) + FLOOR * np.eye(len(v))
            low = np.linalg.cholesky(v)
            factor.append(np.linalg.inv(low))  # applied to many rows
            constant.append(np.log(n[c] / total) - np.log(np.diag(low)).sum())
        return Discriminant(centre, scale, mean, np.stack(factor), np.array(constant))

    def score(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.centre) / self.scale
        log = [self.constant[c] - 0.5 * (((z - self.mean[c]) @ self.factor[c].T) ** 2).sum(axis=1) for c in (0, 1)]
        return 1 / (1 + np.exp(-np.clip((log[1] - log[0]) / TEMPER, -40, 40)))


@dataclass
class Constant:
    """Where the labels hold one class, or none."""
    value: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.value)


def statistics_table(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the statistics of every whole text."""
    arrow_settings(docs.sparkSession)
    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batches):
        for b in batches:
            x = statistics_of(text_column(b))
            off = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(off, pa.array(x.ravel()))],
                                             names=["doc_id", "x"])

    return rows.mapInArrow(tidy(run), schema)


def statistics_of(texts: pa.Array) -> np.ndarray:
    got = [statistics(texts.slice(a, b - a)) for a, b in slices_by_bytes(texts, 4 << 20)]
    return np.concatenate(got) if got else np.zeros((0, len(FEATURES)))


def fit(table: DataFrame, labels: DataFrame) -> Discriminant | Constant:
    """From all labelled rows of (doc_id, x): sums are formed per task and
    added by Spark; what reaches the driver has a fixed size."""
    d = len(FEATURES)
    rows = table.select(F.col("doc_id").cast("long").alias("id"), "x").join(labels, "id").select("y", "x")

    def sums(batches):
        got = np.zeros((2, 1 + d + d * d))
        for b in batches:
            y = b.column(0).to_numpy()
            x = b.column(1).flatten().to_numpy().reshape(-1, d)
            for c in (0, 1):
                z = x[y == c]
                got[c] += np.concatenate(([len(z)], z.sum(axis=0), (z.T @ z).ravel()))
        c, k = np.divmod(np.arange(got.size), got.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), pa.array(k, pa.int32()), pa.array(got.ravel())],
                                         names=["c", "k", "v"])

    total = np.zeros((2, 1 + d + d * d))
    for r in rows.mapInArrow(tidy(sums), "c int, k int, v double").groupBy("c", "k").agg(F.sum("v").alias("v")).collect():
        total[r["c"], r["k"]] = r["v"]
    n = total[:, 0]
    if (n == 0).any():
        return Constant(1.0 if n[0] == 0 else 0.0)
    return Discriminant.of(n, total[:, 1:1 + d], total[:, 1 + d:].reshape(2, d, d))


def quality_scores(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, held_out, score), one row per row; a null text scores as an
    empty one. Without labels of both classes the score is constant."""
    table = Scratch(spark, "quality").write(statistics_table(docs), "statistics")
    model = fit(table, fit_labels(spark, sf_dir, "quality"))
    shared = spark.sparkContext.broadcast(model)  # fixed size
    schema = T.StructType([table.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def run(batches):
        for b in batches:
            x = b.column(1).flatten().to_numpy().reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(shared.value.score(x))], names=["doc_id", "score"])

    return table.mapInArrow(tidy(run), schema).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score")


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, that score at least ``least``."""
    table = Scratch(spark, "quality").write(statistics_table(docs), "statistics")
    shared = spark.sparkContext.broadcast(fit(table, fit_labels(spark, sf_dir, "quality")))

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(shared.value.score(statistics_of(text_column(b))) >= least))

    return docs.mapInArrow(tidy(run), docs.schema)
