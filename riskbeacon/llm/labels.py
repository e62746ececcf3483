"""Labelled rows to fit on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskbeacon.llm.common import held_out


def fit_labels(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    """(id, y) of the rows of ``labels`` that may be fitted on: label 0 or 1,
    crc32 of the id as text modulo 3 other than 1. Rows that contradict each
    other for an id count as the larger label."""
    t = spark.read.parquet(f"{sf_dir}/labels.parquet")
    t = t.select(t["doc_id"].cast("long").alias("id"), t[label].cast("int").alias("y"))
    return t.filter(F.col("y").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id"))).groupBy("id").agg(
        F.max("y").alias("y"))


def fit_sample(docs: DataFrame, labels: DataFrame, most: int, longest: int) -> DataFrame:
    """(id, text, lang, y, in_class): at most ``most`` rows of each label, in the
    order of a hash of their ids, whose text has at most ``longest``
    characters; ``in_class`` is how many labelled rows the label has."""
    parts = []
    for y in (0, 1):
        own = labels.filter(F.col("y") == y)
        parts.append(own.orderBy(F.xxhash64("id"), "id").limit(most))
    ids = parts[0].unionByName(parts[1])
    lang = docs["lang"] if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(docs["doc_id"].cast("long").alias("id"), docs["text"].alias("text"), lang.alias("lang"))
    # at most 2 * most ids
    return rows.filter(F.length("text") <= longest).join(F.broadcast(ids), "id")
