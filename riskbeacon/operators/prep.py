"""Model-input preparation.

* numeric preprocessing: exact median imputation, then mean and POPULATION
  std (0 -> 1) fitted on train by wide aggregates over all features; the
  fitted values (one row per feature) become literals of the transform.
* one-hot: NULL -> __MISSING__, trimmed, sorted train vocabulary as a ranked
  table; a row keeps the index of its category (sparse), or gets one column
  for each category (dense). Unseen values map to all zeros.
* sequences: the last L feature vectors of the region (bounded frame
  ``rowsBetween(-(L-1), 0)``), left-padded with zero vectors.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskbeacon.config import FEATURE_NUMERIC, SEQUENCE_LENGTH
from riskbeacon.functions.order import ranked
from riskbeacon.functions.quantile import exact_medians

MISSING = "__MISSING__"


# ------------------------------------------------------------------ C26 ----
def numeric_params(train: DataFrame, features=FEATURE_NUMERIC) -> dict[str, tuple[float, float, float]]:
    """feature -> (median, mean, std) on train, missing values filled with the
    median first (0 for a feature without values).

    Filling adds n_missing times the median to the moments of the values that
    are there, so mean and deviation need no second look at the rows.
    """
    found = exact_medians(train, features)
    out = {}
    for f in features:
        n, mean, var, median = (found[f][k] for k in ("n", "mean", "var", "median"))
        if not n:
            out[f] = (0.0, 0.0, 1.0)
            continue
        filled = n / found[f]["rows"]
        all_mean = mean + (median - mean) * (1 - filled)
        std = math.sqrt(max(0.0, var * filled + (median - mean) ** 2 * filled * (1 - filled)))
        out[f] = (median, all_mean, std if std > 0 else 1.0)  # a deviation that is 0 or NaN counts as 1
    return out


def fit_numeric(train: DataFrame, features=FEATURE_NUMERIC) -> DataFrame:
    """(feature, median, mean, std): ``numeric_params`` as a table, one row for each feature."""
    rows = [(f, *map(float, v)) for f, v in numeric_params(train, features).items()]
    return train.sparkSession.createDataFrame(rows, "feature string, median double, mean double, std double")


def transform_numeric(df: DataFrame, params: dict, features=FEATURE_NUMERIC, keep=("region_id", "time_id")) -> DataFrame:
    cols = [F.col(k) for k in keep if k in df.columns]
    for f in features:
        med, mean, std = params[f]
        v = F.coalesce(F.col(f).cast("double"), F.lit(med))
        cols.append(((v - F.lit(mean)) / F.lit(std)).alias(f))
    return df.select(*cols, *[c for c in ("y", "y_count") if c in df.columns])


# ------------------------------------------------------------------ C27 ----
def category(c: str):
    return F.trim(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(MISSING)))


def vocabulary(train: DataFrame, col: str, keep) -> DataFrame:
    """(category, index): the distinct categories of train numbered from 0 in
    sorted order, by ranges of categories (``ranked``); of any number. An
    empty train gives the missing category alone. ``keep`` writes the table."""
    found = train.select(category(col).alias("category")).distinct()
    if found.isEmpty():
        return train.sparkSession.createDataFrame([(MISSING, 0)], "category string, index long")
    return ranked(found, ["category"], "rank", keep).select("category", (F.col("rank") - 1).alias("index"))


def one_hot_sparse(df: DataFrame, col: str, vocab: DataFrame, out: str = "index") -> DataFrame:
    """``df`` with the place of the row's 1 among the categories; NULL for a
    category that train doesn't know, whose row is all zeros."""
    return (df.withColumn("__category", category(col))
            .join(vocab.select(F.col("category").alias("__category"), F.col("index").alias(out)), "__category", "left")
            .drop("__category"))


MAX_COLUMNS = 10_000  # columns of a dense block


def dense_names(vocab: DataFrame) -> list[str]:
    """Categories in order, for a dense block. Each becomes a column, so more
    than ``MAX_COLUMNS`` raise here; ``one_hot_sparse`` takes any number."""
    got = vocab.orderBy("index").limit(MAX_COLUMNS + 1).collect()
    if len(got) > MAX_COLUMNS:
        raise ValueError(f"more than {MAX_COLUMNS} categories for dense columns; use one_hot_sparse")
    return [r["category"] for r in got]


def one_hot(df: DataFrame, col: str, names: list[str]) -> DataFrame:
    """Dense form: one 0/1 column ``<col>__<category>`` for each name."""
    v = category(col)
    return df.select("*", *[(v == F.lit(x)).cast("double").alias(f"{col}__{x}") for x in names])


# ------------------------------------------------------------------ C28 ----
def sequences(df: DataFrame, features: list[str], length: int = SEQUENCE_LENGTH,
              keys=("region_id",)) -> DataFrame:
    """One sequence per row: the vectors of the last ``length`` rows of its
    region (itself included), left zero-padded to ``length``."""
    if length <= 1:
        raise ValueError("sequence length must be > 1")
    w = Window.partitionBy(*keys).orderBy("time_id").rowsBetween(-(length - 1), 0)
    vec = F.array(*[F.col(f).cast("double") for f in features])
    zeros = F.array(*[F.lit(0.0) for _ in features])
    hist = F.collect_list(vec).over(w)
    pad = F.array_repeat(zeros, F.lit(length) - F.size(hist))
    return df.withColumn("sequence", F.concat(pad, hist))
