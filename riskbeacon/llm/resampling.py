"""Draws documents that look like a target text set (importance resampling).

Words are hashed into buckets. A bucket's gain is the scaled log ratio of its
smoothed share in the target and in the documents; all gains fit in one array
of ``buckets`` integers, and a document's weight is the sum of the array's
entries at its features' buckets. Weight plus seeded Gumbel noise is the
score; the highest scores are a draw without replacement in proportion to
exp(weight / 1000).

The draw never sorts the corpus: scores are written once, then the cut-off
score is found by bisection over exact counts of the written rows, then in
the same way the cut-off id among rows with that score and the cut-off row
number among equal ids. Only drawn rows are range-partitioned for ranks.

Cases: a null text has no words (no features, weight 0). A null doc_id is
hashed as the text "null" and comes after all other ids on ties. Repeated
rows are scored each by itself; rows equal in score and id are drawn and
ranked by their number of features, then in the order of the written table.
An empty ``documents`` gives no rows, an empty target gives every bucket the
count 0. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskbeacon.llm.common import Scratch

BUCKETS = 10000
SCALE = 1000      # gains and noise are whole thousandths
HALVINGS = 3      # bisection steps that one counting job answers
PLAIN_WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def plain_words(text: Column) -> Column:
    """Words of a text with A-Z lower-cased: runs of digits, letters and anything beyond ASCII."""
    return F.coalesce(F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(PLAIN_WORD), F.lit(0)),
                      F.array().cast("array<string>"))


def features(words: Column, longest: int) -> Column:
    """All runs of 1 to ``longest`` consecutive words, joined by one blank."""
    def runs(n: int) -> Column:
        starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - n + 1))
        return F.coalesce(F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " ")),
                          F.array().cast("array<string>"))
    return F.concat(words, *[runs(n) for n in range(2, longest + 1)])


def bucket(feature: Column, buckets: int) -> Column:
    return (F.crc32(feature.cast("binary")) % buckets).cast("int")


def bucket_gains(documents: DataFrame, target: DataFrame, buckets: int, longest: int) -> list[int]:
    """Gain of each bucket, from counts over all rows; ``buckets`` numbers reach the driver."""
    def of(df: DataFrame, name: str) -> DataFrame:
        feature = df.select(F.explode(features(plain_words(df["text"].cast("string")), longest)).alias("f"))
        return feature.select(bucket(F.col("f"), buckets).alias("bucket"), F.lit(name).alias("side"))
    counts = (of(documents, "s").unionByName(of(target, "t")).groupBy("bucket")
              .agg(F.count_if(F.col("side") == "s").alias("s"), F.count_if(F.col("side") == "t").alias("t")))
    s, t = [0] * buckets, [0] * buckets
    for r in counts.collect():
        s[r.bucket], t[r.bucket] = r.s, r.t
    all_s, all_t = float(sum(s) + buckets), float(sum(t) + buckets)
    return [math.floor(SCALE * math.log((t[b] + 1.0) * all_s / ((s[b] + 1.0) * all_t))) for b in range(buckets)]


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths from the first 8 hex digits of sha256("<seed>:<doc_id>")."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-float(SCALE) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def score_documents(documents: DataFrame, gains: list[int], seed: int, longest: int) -> DataFrame:
    """(row, doc_id, n_words, n_features, weight, score) of every document."""
    # constant-folded to one array literal, so no row carries the array
    table = F.split(F.lit(",".join(map(str, gains))), ",").cast("array<long>")
    rows = documents.select(documents["doc_id"].alias("doc_id"),
                            plain_words(documents["text"].cast("string")).alias("words"))
    rows = rows.select("doc_id", F.size("words").cast("long").alias("n_words"),
                       features(F.col("words"), longest).alias("features"))
    weight = F.aggregate("features", F.lit(0).cast("long"),
                         lambda sum_, f: sum_ + F.element_at(table, bucket(f, len(gains)) + 1))
    return rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "n_words",
                       F.size("features").cast("long").alias("n_features"), weight.alias("weight")).withColumn(
        "score", F.col("weight") + noise(F.col("doc_id"), seed))


def cut_key(rows: DataFrame, key: str, take: int) -> tuple[int, int]:
    """The smallest value v of a long column with at least ``take`` rows at or
    below it, and the number of rows below it.

    Every job counts the rows at or below the cuts of the next ``HALVINGS``
    halvings of the interval; no row leaves its task. 0 < take <= rows.
    """
    ends = rows.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    lo, hi = ends.lo, ends.hi
    while lo < hi:
        parts = 1 << HALVINGS
        cuts = sorted({lo + (hi - lo) * i // parts for i in range(1, parts)})
        counts = rows.agg(*[F.count_if(F.col(key) <= F.lit(c)).alias(f"n{i}") for i, c in enumerate(cuts)]).first()
        enough = [c for i, c in enumerate(cuts) if counts[i] >= take]
        short = [c for i, c in enumerate(cuts) if counts[i] < take]
        lo, hi = max(short, default=lo - 1) + 1, min(enough, default=hi)
    return lo, rows.filter(F.col(key) < F.lit(lo)).count()


ORDER = ["down", "no_id", "id", "n_features", "row"]  # ascending; higher scores come first


def _keyed(scored: DataFrame) -> DataFrame:
    return scored.select("*", (-F.col("score")).alias("down"), F.col("doc_id").isNull().cast("long").alias("no_id"),
                         F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"))


def draw(keyed: DataFrame, take: int) -> Column:
    """Condition that holds for the first ``take`` rows in ORDER (0 < take <= rows)."""
    at, cuts = keyed, []
    for key in ORDER:
        cut, below = cut_key(at, key, take)
        cuts.append((key, cut))
        take -= below
        at = at.filter(F.col(key) == F.lit(cut))
        if at.count() == take:  # all rows that tie so far belong to the draw
            break
    inside = F.lit(True)
    for key, cut in reversed(cuts):
        inside = (F.col(key) < F.lit(cut)) | ((F.col(key) == F.lit(cut)) & inside)
    return inside


def ranked(scratch: Scratch, drawn: DataFrame) -> DataFrame:
    """Rank 1, 2, 3... in ORDER: range partitions sorted in place, numbered by
    what the partitions before hold. The driver sees one count a partition."""
    spark: SparkSession = drawn.sparkSession
    placed = scratch.write(drawn.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
                           .withColumn("at", F.monotonically_increasing_id()), "drawn")
    part = F.shiftright("at", 33).cast("int")
    sizes = placed.groupBy(part.alias("part")).count().collect()
    starts, total = [], 0
    for r in sorted(sizes, key=lambda r: r.part):
        starts.append((r.part, total))
        total += r["count"]
    start = F.broadcast(spark.createDataFrame(starts, "part int, start long"))
    return placed.withColumn("part", part).join(start, "part").withColumn(
        "rank", F.col("start") + F.col("at").bitwiseAND((1 << 33) - 1) + 1)


def resample(documents: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, seed: int = 2024,
             buckets: int = BUCKETS, longest: int = 1) -> DataFrame:
    """(doc_id, n_features, weight, score, rank): the ``percent`` of documents
    with at least ``min_words`` words that score highest have a rank, ties to
    the smaller doc_id; all others have null. See the module for odd cases."""
    scratch = Scratch(documents.sparkSession, "resampling")
    gains = bucket_gains(documents, target, buckets, longest)
    keyed = _keyed(scratch.write(score_documents(documents, gains, seed, longest), "scored"))
    long_enough = keyed.filter(F.col("n_words") >= min_words)
    take = percent * long_enough.count() // 100
    out = ["doc_id", "n_features", "weight", "score", "rank"]
    no_rank = F.lit(None).cast("long")
    if not take:
        return keyed.withColumn("rank", no_rank).select(*out)
    chosen = (F.col("n_words") >= min_words) & draw(long_enough, take)
    return ranked(scratch, keyed.filter(chosen)).select(*out).unionByName(
        keyed.filter(~chosen).withColumn("rank", no_rank).select(*out))
