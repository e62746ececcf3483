"""Mixing sources to target weights.

Words are summed per source; each source's share of all words gives its
target, no more than ``most`` times what it has (the excess goes to the
others by weight until none is above: a water level found by rounds of sums
over the source table). A document is emitted floor(rate) times plus once
more where a hash of its id and the seed falls below the rate's fraction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskbeacon.llm.common import WORD_RE, Scratch

WEIGHTS = (5.0, 2.0, 1.0)  # of the sources in code-point order, repeating
MOST = 3.0
SEED = "mix-1"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def ranked(scratch: Scratch, df: DataFrame, key: str) -> DataFrame:
    """Adds ``rank`` (from 0) in ascending order of ``key``, null last, without
    ordering the whole table in one task: ranges, then a sum over the ranges."""
    order = F.col(key).asc_nulls_last()
    t = scratch.write(df.repartitionByRange(order).withColumn("_part", F.spark_partition_id()), "ranged")
    parts = t.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    run = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", F.coalesce(F.sum("_n").over(run), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(order)) - 1
    return (t.withColumn("_own", own).join(F.broadcast(parts), "_part")  # a row per range
            .withColumn("rank", F.col("_own") + F.col("_before")).drop("_part", "_own", "_before"))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, source_size, target, rate) from rows (source, size).

    target = min(most * source_size, level * weight), where the level makes
    the targets sum to all words. A source without words has target 0 and
    rate 1 (its documents are emitted once and add no words).
    """
    scratch = Scratch(sizes.sparkSession, "mixing")
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    table = scratch.write(ranked(scratch, per, "source")
                          .withColumn("weight", F.element_at(cycle, (F.col("rank") % len(weights)).cast("int") + 1)),
                          "sources")
    cap = F.col("source_size") * F.lit(float(most))
    total = table.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("s")).first()["s"]
    level, n_capped = 0.0, -1
    while True:  # the level only rises and sources only become capped
        capped = (F.col("weight") * F.lit(level) > cap) | (F.col("source_size") == 0)
        got = table.agg(F.sum(F.when(capped, cap).otherwise(0.0)).alias("c"),
                        F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))).alias("w"),
                        F.count_if(capped).alias("n")).first()
        if got["n"] == n_capped or not got["w"]:
            break
        n_capped, level = got["n"], (total - got["c"]) / got["w"]
    target = F.least(cap, F.col("weight") * F.lit(level))
    return scratch.write(table.select("source", "source_size", target.alias("target"))
                         .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
                                     .otherwise(1.0)), "targets")


def copies(doc_id: Column, rate: Column, seed: str = SEED) -> Column:
    """floor(rate), and one more where the id's hash is below the fraction."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(f":{seed}")).cast("binary"))
    u = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(16 ** 13))
    return (F.floor(rate) + F.when(u < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def mix_plan(docs: DataFrame, weights: tuple = WEIGHTS, most: float = MOST, seed: str = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies), one row per document.

    Null text: size 0. Null source: a source of its own, last in order. Rows
    with equal ids draw alike. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "mixplan")
    sized = scratch.write(docs.select(docs["doc_id"], docs["source"], words(docs["text"]).alias("size")), "sizes")
    t = source_targets(sized.select("source", "size"), weights, most)
    # the target table is read from its file, so that Spark knows its size:
    # broadcast below the session's threshold, else a join that AQE splits
    return (sized.join(t.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
            .withColumn("copies", copies(F.col("doc_id"), F.col("rate"), seed))
            .select("doc_id", "size", "source_size", "target",
                    (F.col("size") * F.col("copies")).alias("taken"), "copies"))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, most: float = MOST, seed: str = SEED) -> DataFrame:
    """The mixed corpus: every row of ``docs``, all its columns, as many times as it is taken."""
    t = source_targets(docs.select(docs["source"], words(docs["text"]).alias("size")), weights, most)
    t = t.select(F.col("source").alias("s"), "rate")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    taken = rows.join(t, F.col("row.source").eqNullSafe(F.col("s"))).select(
        "row", copies(F.col("row.doc_id"), F.col("rate"), seed).alias("n"))
    return (taken.filter("n > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("i"))
            .select("row.*"))
