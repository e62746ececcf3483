"""Groups spelling variants: words of a corpus that are one edit apart.

The vocabulary is joined with itself by asymmetric q-chunks. Of a pair, the
word that isn't longer (n code points) is cut into two disjoint chunks; the
other word, of n or n + 1 code points, offers its positional grams of the
same lengths. One inserted, deleted or replaced code point touches one chunk
only, so the other chunk stands in both words, shifted by one at most: an
edit behind a chunk leaves it in its place, an edit before it moves it by the
difference of the two lengths. Grams at any other place can't meet a chunk
and aren't offered.

A chunk such as a common prefix may be shared by very many words. What is
left of the two words beside the shared chunk is again one edit apart, so
the same rule cuts it into two chunks, one of which is shared too: a join key
is (n, a chunk, a chunk of the rest with the places of both). That splits
every group by rule, for all sizes alike, and loses no pair. Candidates are
verified by edit distance.

Joins are by sorted shuffles only. Spark sizes a table by its compressed files
and takes an explode to add no rows: it would send the keys of a vocabulary
under its broadcast threshold, many times that size, through the driver.

Cases: a null text has no words. A null doc_id is hashed as the text "null".
Repeated rows count as often as they occur. A word near to no other has
n_near 0, null form and itself as root. Among near words of equal count the
smallest in code-point order is the form. Empty tables give no rows; extra
columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskbeacon.llm.common import Scratch
from riskbeacon.llm.resampling import LOWER, UPPER

LETTERS = "[A-Za-z\\u00C0-\\u00FF]+"
SLIP = 97          # a run whose hash this divides loses one code point
SHORTEST = 5       # code points of a word
LEAST = 3          # occurrences of a word
RATIO = 2          # a form is at least so many times as frequent


def vocabulary(documents: DataFrame) -> DataFrame:
    """(word, n): the words of at least ``SHORTEST`` code points and ``LEAST``
    occurrences. Counts are summed in each task before the shuffle."""
    runs = documents.select(
        F.coalesce(documents["doc_id"].cast("string"), F.lit("null")).alias("id"),
        F.explode(F.regexp_extract_all(documents["text"].cast("string"), F.lit(LETTERS), F.lit(0))).alias("run"))
    runs = runs.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    word = F.when(F.col("h") % SLIP == 0, F.concat(F.col("run").substr(F.lit(1), at),
                                                  F.col("run").substr(at + 2, F.length("run")))).otherwise(F.col("run"))
    return (runs.withColumn("h", h).select(word.alias("word")).filter(F.length("word") >= SHORTEST)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST))


def _join(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """A join that never broadcasts a side, whatever size Spark takes it to have."""
    return left.join(right.hint("merge"), on, how)


def _spans(n: Column) -> list[tuple[Column, Column]]:
    """(from, to) of the part that each key of a word of n code points leaves
    out: the two chunks of the word, each cut in two again."""
    half = F.floor(n / 2).cast("int")
    low, high = F.floor(half / 2).cast("int"), F.floor((half + n) / 2).cast("int")
    zero = F.lit(0)
    return [(zero, low), (low, half), (half, high), (high, n)]


def _keys(words: DataFrame, longer: int) -> DataFrame:
    """Keys of words of n + longer code points against chunks of words of n:
    what stands before and behind the part left out, the latter shifted by ``longer``."""
    size = F.length("word")
    n = (size - longer).cast("int")
    keys = [F.struct(F.lit(i).alias("part"),
                     F.col("word").substr(F.lit(1), a).alias("before"),
                     F.col("word").substr(b + 1 + longer, size).alias("behind"))
            for i, (a, b) in enumerate(_spans(n))]
    return words.select("word", "n", n.alias("size"), F.explode(F.array(*keys)).alias("key")).select(
        "word", "n", "size", "key.part", "key.before", "key.behind")


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, other, other_n): all ordered pairs of different words one edit apart, each once."""
    chunks = _keys(words, 0)
    on = ["size", "part", "before", "behind"]

    def joined(grams: DataFrame) -> DataFrame:
        other = grams.withColumnsRenamed({"word": "other", "n": "other_n"})
        pairs = _join(chunks, other, on).filter(F.col("word") != F.col("other"))
        return pairs.filter(F.levenshtein("word", "other", 1) == 1).select("word", "n", "other", "other_n")
    # of equal lengths: the replaced code point lies in one part, so a pair meets once in each order
    same = joined(_keys(words, 0))
    # an inserted code point may be counted to two parts where letters repeat
    more = joined(_keys(words, 1)).distinct()
    back = more.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"),
                       F.col("n").alias("other_n"))
    return same.unionByName(more).unionByName(back)


def roots(scratch: Scratch, forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: each round lets a word skip as far as
    its present target has come. Counts at least double at each step, so a
    chain has at most 63 steps and 6 rounds settle it."""
    now = scratch.write(forms.select("word", F.col("form").alias("root")), "roots-0")
    step = 0
    while True:
        step += 1
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        now = scratch.write(_join(now, ahead, "root", "left").select(
            "word", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved")), f"roots-{step}")
        if now.filter("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def spelling_variants(documents: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row for each word of the vocabulary."""
    scratch = Scratch(documents.sparkSession, "spelling")
    words = scratch.write(vocabulary(documents), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("down"), F.col("other").alias("other")))
    near = near_pairs(words).groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    is_form = -F.col("best.down") >= RATIO * F.col("n")
    found = scratch.write(near.select("word", "n_near", F.when(is_form, F.col("best.other")).alias("form"),
                                      F.when(is_form, -F.col("best.down")).alias("form_n")), "near")
    rooted = roots(scratch, found.filter("form IS NOT NULL"))
    return (_join(_join(words, found, "word", "left"), rooted, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"))
