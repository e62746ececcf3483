"""Order without a single-task sort: value ranges fixed in advance, and exact ranks by range counts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEPS = 4096          # ranges between a power of two and the next
_TOP = 1 << 40        # beyond all ranges of finite numbers


def value_range(x: Column) -> Column:
    """Range of a double as a long that never falls when the value rises.

    Exponent and leading binary digits of the value, as a radix sort would
    take them, so no statistics of the data are needed. Equal values share a
    range; infinities stand at the ends and NaN above all, as Spark orders them.
    """
    size = F.abs(x)
    exponent = F.floor(F.log2(size))
    # a power of two missed by rounding moves both terms by the same amount
    digits = exponent * STEPS + F.floor(size / F.pow(F.lit(2.0), exponent) * STEPS) + 1200 * STEPS
    digits = F.when(size == float("inf"), F.lit(_TOP - 1)).otherwise(digits.cast("long"))
    return (F.when(F.isnan(x), F.lit(_TOP)).when(x == 0, F.lit(0)).when(x > 0, digits).otherwise(-digits))


def ranked(df: DataFrame, order: Sequence[str], out: str, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """``df`` with ``out``: 1, 2, 3... in ascending order of the columns.

    Rows are dealt to ranges of the order, sorted inside them and written
    (``keep``); the rows of the ranges before give each range its start. The
    driver sees one count a range, no task holds more than a range. Rows equal
    in all columns of the order get successive ranks in any order.
    """
    at, part = f"__at_{out}", f"__part_{out}"
    placed = keep(df.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)
                  .withColumn(at, F.monotonically_increasing_id()), out)
    starts, total = [], 0
    for r in sorted(placed.groupBy(F.shiftright(at, 33).cast("int").alias("p")).count().collect(), key=lambda r: r.p):
        starts.append((r.p, total))
        total += r["count"]
    start = df.sparkSession.createDataFrame(starts, f"{part} int, __start long")
    return (placed.withColumn(part, F.shiftright(at, 33).cast("int")).join(F.broadcast(start), part)  # a row a range
            .withColumn(out, F.col("__start") + F.col(at).bitwiseAND((1 << 33) - 1) + 1).drop(at, part, "__start"))
