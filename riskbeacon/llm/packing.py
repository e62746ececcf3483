"""Packing token pieces into windows by minimum bin slack.

Each document's ids are cut into full windows and one rest. Rests are packed
by their lengths alone: a histogram of at most ``window`` lengths is all the
packer sees, whatever the corpus holds. For each window it seeds the longest
remaining length, and a bitset dynamic program over the remaining multiset
finds the sum closest to what is left; the counts are read back from the
stored bitsets, and the pattern is repeated as often as the counts allow.
Pieces then find their place by their rank among the pieces of equal length.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskbeacon.llm.common import Scratch, arrow_settings, text_column, tidy
from riskbeacon.llm.tokens import encoder

WINDOW = 4096


def closest_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths, within ``counts``, whose sum comes closest to
    ``room`` from below: bitset subset sums with counts in binary chunks, and
    backtracking through the bitsets before each chunk."""
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted((x for x in counts if counts[x] > 0 and x <= room), reverse=True):
        left, chunk = min(counts[length], room // length), 1
        while left > 0:
            take = min(chunk, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left, chunk = left - take, chunk * 2
        if reach >> room & 1:
            break
    best, used = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> best & 1:
            used[length] = used.get(length, 0) + take
            best -= length * take
    return used


def patterns(histogram: dict[int, int], window: int) -> list[tuple[dict[int, int], int]]:
    """(lengths of a window with their counts, how many windows are alike)."""
    counts = {k: v for k, v in histogram.items() if v > 0}
    out = []
    while counts:
        seed = max(counts)
        counts[seed] -= 1
        used = closest_fill(counts, window - seed)
        counts[seed] += 1
        used[seed] = used.get(seed, 0) + 1
        times = min(counts[k] // m for k, m in used.items())
        out.append((used, times))
        for k, m in used.items():
            counts[k] -= m * times
            if not counts[k]:
                del counts[k]
    return out


def cut_pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = 2, with_ids: bool = False,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, part, k[, ids]): full windows and the rest of each row.

    ``k`` numbers the pieces of a task that have equal length, ``part`` is
    the task. A null text is empty: one piece that holds the end id.
    """
    arrow_settings(docs.sparkSession)
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    fields = [rows.schema["doc_id"]] + [T.StructField(c, T.LongType()) for c in
                                        ("start", "length", "ids_crc32", "doc_tokens", "part", "k")]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType())))
    schema = T.StructType(fields)

    def cut(batches):
        enc = encoder(tokenizer)
        part = TaskContext.get().partitionId()
        seen = np.zeros(window + 1, np.int64)
        for b in batches:
            keys = b.column(0)
            for first, counts, ids in enc.encode(text_column(b)):
                lens = counts + 1
                ends = np.cumsum(lens)
                if not len(lens):
                    continue
                out = np.full(int(ends[-1]), end_id, np.uint32)
                inner = np.ones(len(out), bool)
                inner[ends - 1] = False
                out[inner] = ids
                n = -(-lens // window)                      # pieces of each document
                doc = np.repeat(np.arange(len(lens)), n)
                nth = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                start = nth * window
                size = np.minimum(lens[doc] - start, window)
                at = (ends - lens)[doc] + start
                raw = memoryview(out).cast("B")
                crc = [zlib.crc32(raw[4 * a:4 * (a + s)]) for a, s in zip(at.tolist(), size.tolist())]
                order = np.argsort(size, kind="stable")     # ranks among equal lengths
                ss = size[order]
                heads = np.flatnonzero(np.concatenate(([True], ss[1:] != ss[:-1])))
                k = np.empty(len(size), np.int64)
                runs = np.diff(np.append(heads, len(ss)))
                k[order] = np.arange(len(ss)) - np.repeat(heads, runs) + np.repeat(seen[ss[heads]], runs)
                seen[ss[heads]] += runs
                cols = [keys.slice(first, len(lens)).take(pa.array(doc)), start, size, np.array(crc, np.int64),
                        lens[doc], np.full(len(doc), part), k]
                cols = [c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in cols]
                if with_ids:  # pieces lie one after another, as the documents do
                    poff = np.concatenate(([0], np.cumsum(size)))
                    cols.append(pa.ListArray.from_arrays(pa.array(poff, pa.int32()), pa.array(out, pa.int64())))
                yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return rows.mapInArrow(tidy(cut), schema)


def _segments(pats: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (length, first rank, pieces a window, first window, offset in the window),
    ordered by length and first rank; at most a row per pattern and length."""
    rank: dict[int, int] = {}
    rows, base = [], 0
    for used, times in pats:
        offset = 0
        for length in sorted(used, reverse=True):
            rows.append((length, rank.get(length, 0), used[length], base, offset))
            rank[length] = rank.get(length, 0) + used[length] * times
            offset += length * used[length]
        base += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]), one row per piece.

    Every id of every row lies in one piece; sequences hold at most
    ``window`` ids, without gaps from offset 0. Repeated rows are packed as
    often as they appear; an empty table gives no pieces.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    pieces = scratch.write(cut_pieces(docs, tokenizer, window, end_id, with_ids), "pieces")
    per = scratch.write(pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "lengths")
    # at most ``window`` rows, whatever the corpus holds
    histogram = {r["length"]: r["n"] for r in per.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    full = histogram.pop(window, 0)
    seg = _segments(([({window: 1}, full)] if full else []) + patterns(histogram, window))
    table = docs.sparkSession.sparkContext.broadcast(seg)  # bounded by patterns x lengths
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = pieces.join(base, ["length", "part"]).withColumn("r", F.col("base") + F.col("k"))
    keep = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + (["ids"] if with_ids else [])
    placed = placed.select(*keep, "r")
    names = keep[:5] + ["sequence_id", "offset"] + keep[5:]
    types = {f.name: f for f in placed.schema}
    schema = T.StructType([types.get(n, T.StructField(n, T.LongType())) for n in names])

    def place(batches):
        s = table.value
        for b in batches:
            col = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            length, r = col["length"].to_numpy(), col["r"].to_numpy()
            # the last segment of this length that starts at or before the rank
            span = np.int64(1) << 48
            at = np.searchsorted(s[:, 0] * span + s[:, 1], length * span + r, side="right") - 1
            d = r - s[at, 1]
            col["sequence_id"] = pa.array(s[at, 3] + d // s[at, 2], pa.int64())
            col["offset"] = pa.array(s[at, 4] + d % s[at, 2] * length, pa.int64())
            yield pa.RecordBatch.from_arrays([col[n] for n in names], names=names)

    return placed.mapInArrow(tidy(place), schema)
