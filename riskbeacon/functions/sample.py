"""Seeded samples of exactly n rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_PREFIX = 4  # hex digits of a bucket: at most 65,536 buckets


def seeded_sample(df: DataFrame, n: int, seed: int = 42, keys: Sequence[str] | None = None) -> DataFrame:
    """The n rows with the smallest md5 of seed and keys (all columns by
    default); all rows if there are fewer.

    Counts by the hash's leading digits give the last bucket that the sample
    needs; only rows up to it are ordered, so the final merge sees n rows and
    one bucket, not n rows of every task. Rows with equal keys share a hash
    and are taken in any order.
    """
    names = list(keys) if keys is not None else df.columns
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(f"`{k}`").cast("string") for k in names]).cast("binary"))
    hashed = df.withColumn("__h", h)
    bucket = F.substring("__h", 1, _PREFIX)
    counts = hashed.groupBy(bucket.alias("__b")).agg(F.count(F.lit(1)).alias("__c"))
    before = F.sum("__c").over(Window.orderBy("__b")) - F.col("__c")  # at most 65,536 rows
    last = counts.withColumn("__before", before).filter(F.col("__before") < n).agg(F.max("__b").alias("__last"))
    kept = hashed.join(F.broadcast(last), bucket <= F.col("__last"))  # one row
    return kept.orderBy("__h").limit(int(n)).drop("__h", "__last")
