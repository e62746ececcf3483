"""Exact quantiles without ordering a whole group in one task.

``exact_percentile``: one column by group. The rows are first reduced to (group, value) -> count, so that repeated
values cost one row however many rows hold them. The exact answer is then
found by selection over the distinct values:

1. approximate quantiles of the distinct values cut each group into
   ``buckets`` ranges (they only balance the work);
2. a sum of counts per (group, range) and a running sum over that small
   table give the ranges that hold the two order statistics needed for
   linear interpolation (rank floor/ceil of q * (n - 1));
3. only the values of those ranges are ordered, and the two values are
   interpolated exactly as ``percentile`` does.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_percentile(df: DataFrame, value: str, q: float, keys: list[str], out: str,
                     buckets: int = 64, accuracy: int = 2000) -> DataFrame:
    """(keys..., out): the exact linear-interpolated q-quantile of ``value``
    per group (NULL values ignored; groups without values are absent)."""
    v = df.select(*keys, F.col(value).cast("double").alias("__v")).filter(F.col("__v").isNotNull())
    hist = v.groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__c"))
    probs = [i / buckets for i in range(1, buckets)]
    cuts = hist.groupBy(*keys).agg(F.percentile_approx("__v", probs, accuracy).alias("__cuts"),
                                   F.sum("__c").alias("__n"))
    binned = hist.join(cuts, keys).withColumn(
        "__b", F.size(F.filter("__cuts", lambda c: c < F.col("__v")))).drop("__cuts")
    per_b = binned.groupBy(*keys, "__b", "__n").agg(F.sum("__c").alias("__bc"))
    run = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    pos = F.lit(float(q)) * (F.col("__n") - 1)
    per_b = (per_b.withColumn("__start", F.coalesce(F.sum("__bc").over(run), F.lit(0)))
             .withColumn("__k1", F.floor(pos).cast("long")).withColumn("__k2", F.ceil(pos).cast("long"))
             .withColumn("__frac", pos - F.floor(pos)))

    def within(k: str, low, count):
        return (F.col(k) >= low) & (F.col(k) < low + count)

    wanted = per_b.filter(within("__k1", F.col("__start"), F.col("__bc")) | within("__k2", F.col("__start"), F.col("__bc")))
    wanted = wanted.select(*keys, "__b", "__start", "__k1", "__k2", "__frac")
    upto = Window.partitionBy(*keys, "__b").orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    at = (binned.drop("__n").join(wanted, [*keys, "__b"])
          .withColumn("__low", F.col("__start") + F.coalesce(F.sum("__c").over(upto), F.lit(0))))
    picked = at.groupBy(*keys).agg(
        F.max(F.when(within("__k1", F.col("__low"), F.col("__c")), F.col("__v"))).alias("__v1"),
        F.max(F.when(within("__k2", F.col("__low"), F.col("__c")), F.col("__v"))).alias("__v2"),
        F.max("__frac").alias("__f"))
    return picked.select(*keys, (F.col("__v1") + (F.col("__v2") - F.col("__v1")) * F.col("__f")).alias(out))


GUESS_ACCURACY = 10000  # of the sketch a guess comes from; it bounds the sketch's memory, not the result


def exact_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, dict]:
    """Per column: rows, n, mean and var (population) of the non-null values,
    and their exact median (None without values).

    All columns share every scan: one wide aggregate gives the moments and a
    guess near each median, the next counts the values below and up to each
    guess and takes its neighbours. That proves the one or two middle values,
    or says between which values they lie: then a guess from those values is
    counted in the same way. A guess is right to about a 10,000th of the
    values it was made from, so a few rounds settle any number of rows. One
    row of aggregates reaches the driver, no value is moved or sorted.
    """
    x = {c: F.col(f"`{c}`").cast("double") for c in columns}
    got = df.agg(F.count(F.lit(1)).alias("rows"), *[e.alias(f"{k}_{i}") for i, c in enumerate(columns) for k, e in (
        ("n", F.count(x[c])), ("mean", F.avg(x[c])), ("var", F.var_pop(x[c])),
        ("guess", F.percentile_approx(x[c], F.lit(0.5), F.lit(GUESS_ACCURACY))))]).first()
    out, open_ = {}, {}
    for i, c in enumerate(columns):
        out[c] = {"rows": got["rows"], "n": got[f"n_{i}"], "mean": got[f"mean_{i}"], "var": got[f"var_{i}"], "median": None}
        if got[f"n_{i}"]:
            # the middle ranks lie above ``low`` (ranks before ``start``) and below ``high`` (ranks up to ``end``)
            open_[c] = {"guess": got[f"guess_{i}"], "low": None, "start": 0, "high": None, "end": got[f"n_{i}"]}
    while open_:
        names = list(open_)
        row = df.agg(*[e.alias(f"{k}_{i}") for i, c in enumerate(names) for k, e in (
            ("below", F.count_if(x[c] < F.lit(open_[c]["guess"]))), ("upto", F.count_if(x[c] <= F.lit(open_[c]["guess"]))),
            ("prev", F.max(F.when(x[c] < F.lit(open_[c]["guess"]), x[c]))),
            ("next", F.min(F.when(x[c] > F.lit(open_[c]["guess"]), x[c]))))]).first()
        for i, c in enumerate(names):
            at, below, upto = open_[c], row[f"below_{i}"], row[f"upto_{i}"]
            known = {below - 1: row[f"prev_{i}"], upto: row[f"next_{i}"]}
            middle = [math.floor((out[c]["n"] - 1) / 2), math.ceil((out[c]["n"] - 1) / 2)]
            values = [at["guess"] if below <= r < upto else known.get(r) for r in middle]
            if None not in values:
                out[c]["median"] = values[0] + (values[1] - values[0]) * 0.5 if values[0] != values[1] else values[0]
                del open_[c]
            elif middle[0] >= upto:
                at.update(low=at["guess"], start=upto)
            else:
                at.update(high=at["guess"], end=below)
        if open_:
            names, guesses = list(open_), []
            for i, c in enumerate(names):
                at = open_[c]
                inside = F.lit(True)
                inside = inside if at["low"] is None else inside & (x[c] > F.lit(at["low"]))
                inside = inside if at["high"] is None else inside & (x[c] < F.lit(at["high"]))
                share = (math.floor((out[c]["n"] - 1) / 2) - at["start"] + 0.5) / (at["end"] - at["start"])
                guesses.append(F.percentile_approx(F.when(inside, x[c]), F.lit(share), F.lit(GUESS_ACCURACY)).alias(f"g_{i}"))
            row = df.agg(*guesses).first()
            for i, c in enumerate(names):
                open_[c]["guess"] = row[f"g_{i}"]
    return out
