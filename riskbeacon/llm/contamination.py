"""Finds benchmark passages in documents through an FM-index of each shard.

Every batch of documents becomes one or more shards of at most ``SHARD``
words, each with a word list and an index (``fmindex``) of its own, written
as one row to the shared folder: built once, read for every block of phrases
and after lost executors. Phrases are the windows of ``WINDOW`` consecutive
words of an item (all words of a shorter one). They go to the tasks in blocks
of at most about ``BLOCK_BYTES`` bytes, one search over the written indexes
for each block, so their number isn't bounded. A document longer than a shard
is cut into pieces that overlap by ``WINDOW`` - 1 words; what its pieces and
the blocks find is merged.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.

Cases: null and empty texts have no words, and nothing is found in them or
through them. Every row is a document of its own, also with a repeated or
null doc_id. Items with the same item_id count as one, a null item_id as an
item named "null". Repeated windows are one phrase. Empty tables give no rows
or no hits; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskbeacon.llm.common import Scratch, arrow_settings, string_buffers, text_column, tidy
from riskbeacon.llm.fmindex import Index, Parts, build
from riskbeacon.llm.resampling import plain_words

WINDOW = 10
SHARD = 1 << 19           # words of a shard, about
BLOCK_BYTES = 16 << 20    # of phrases searched at a time, about

INDEX = ("docs array<struct<row: long, doc_id: long, n_words: long>>, "
         "pieces array<struct<row: long, at: long, first: long>>, words array<binary>, "
         "counts binary, bits binary, marks binary, samples binary")

# the byte a word keeps, 0 for bytes between words
_KEEP = np.zeros(256, np.uint8)
_KEEP[0x30:0x3A] = np.arange(0x30, 0x3A)
_KEEP[0x41:0x5B] = np.arange(0x61, 0x7B)
_KEEP[0x61:0x7B] = np.arange(0x61, 0x7B)
_KEEP[0x80:] = np.arange(0x80, 0x100)


def word_numbers(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(word list, number of each word in it, words before each text and in all)."""
    raw, off = string_buffers(texts)
    low = _KEEP[raw]
    inside = low > 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = off[:-1][off[:-1] < len(raw)]
    begins[edges] |= inside[edges]
    at = np.flatnonzero(begins)
    kept = np.cumsum(inside, dtype=np.int64)
    ends = np.append(kept[at] - 1, kept[-1] if len(kept) else 0)
    words = pa.Array.from_buffers(pa.large_binary(), len(at),
                                  [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(low[inside])])
    coded = words.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.searchsorted(at, off)


def _cut(starts: np.ndarray, shard: int, window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Shards as lists of (text, first word, end) with about ``shard`` words at most."""
    held, size = [], 0
    for i, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist())):
        for lo in range(0, max(b - a, 1), shard):
            hi = min(lo + shard + window - 1, b - a)
            if held and size + hi - lo > shard:
                yield held
                held, size = [], 0
            held.append((i, lo, hi))
            size += hi - lo
            if hi == b - a:
                break
    if held:
        yield held


def _lists(kind: pa.DataType, rows: list[tuple]) -> pa.Array:
    """One list of structs holding ``rows``."""
    names = [f.name for f in kind]
    return pa.array([[dict(zip(names, r)) for r in rows]], pa.list_(kind))


DOC = pa.struct([("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64())])
PIECE = pa.struct([("row", pa.int64()), ("at", pa.int64()), ("first", pa.int64())])


def _index_batch(batch: pa.RecordBatch, shard: int, window: int) -> Iterator[pa.RecordBatch]:
    rows, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
    vocabulary, numbers, starts = word_numbers(text_column(batch))
    for cut in _cut(starts, shard, window):
        used = np.zeros(len(vocabulary) + 1, bool)
        for i, lo, hi in cut:
            used[numbers[starts[i] + lo:starts[i] + hi]] = True
        number = np.cumsum(used)  # 1 and up
        symbols, pieces, at = [], [], 0
        for i, lo, hi in cut:
            if hi > lo:
                pieces.append((rows[i], at + 1, lo))
                symbols += [np.zeros(1, np.int64), number[numbers[starts[i] + lo:starts[i] + hi]]]
                at += hi - lo + 1
        symbols.append(np.zeros(1, np.int64))
        parts = build(np.concatenate(symbols))
        own = vocabulary.take(pa.array(np.flatnonzero(used[:-1]))).cast(pa.binary())
        docs = [(rows[i], ids[i], int(starts[i + 1] - starts[i])) for i, lo, _ in cut if lo == 0]
        yield pa.RecordBatch.from_arrays(
            [_lists(DOC, docs), _lists(PIECE, pieces), pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own)]
            + [pa.array([np.ascontiguousarray(x).tobytes()], pa.binary())
               for x in (parts.counts, parts.bits, parts.marks, parts.samples)],
            names=["docs", "pieces", "words", "counts", "bits", "marks", "samples"])


def index_shards(documents: DataFrame, window: int = WINDOW, shard: int = SHARD) -> DataFrame:
    """One row for each shard: its documents, pieces, word list and index. Write it before use:
    the rows are numbered as they come."""
    rows = documents.select(F.monotonically_increasing_id().alias("row"),
                            documents["doc_id"].cast("long").alias("doc_id"),
                            documents["text"].cast("string").alias("text"))

    def make(batches):
        for batch in batches:
            if batch.num_rows:
                yield from _index_batch(batch, shard, window)

    arrow_settings(documents.sparkSession)
    return rows.mapInArrow(tidy(make), INDEX)


def phrases(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct (phrase, item): windows of an item's words joined by blanks."""
    items = benchmark.select(F.coalesce(benchmark["item_id"].cast("string"), F.lit("null")).alias("item"),
                             plain_words(benchmark["text"].cast("string")).alias("words"))
    starts = F.when(F.size("words") > 0, F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1))))
    runs = F.transform(starts, lambda i: F.array_join(F.slice("words", i, window), " "))
    return items.select(F.explode(runs).alias("phrase"), "item").distinct()


def _block(found: pa.Table, window: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(word list, phrases as word numbers with -1 in front of shorter ones, phrase ids)."""
    words = pc.split_pattern(found.column("phrase").combine_chunks().cast(pa.large_string()), " ")
    coded = words.flatten().dictionary_encode()
    size = pc.list_value_length(words).to_numpy(zero_copy_only=False)
    end = np.cumsum(size)
    matrix = np.full((len(size), window), -1, np.int32)
    at = np.arange(int(size.sum()))
    row = np.repeat(np.arange(len(size)), size)
    matrix[row, window - (end[row] - at)] = coded.indices.to_numpy(zero_copy_only=False)
    return coded.dictionary.cast(pa.large_binary()), matrix, found.column("id").to_numpy()


def _find(batch: pa.RecordBatch, i: int, block: tuple) -> Iterator[tuple[int, list, list]]:
    """(row, hit spans in words, phrase ids) of the pieces of one shard in which a phrase occurs."""
    cell = {n: batch.column(batch.schema.get_field_index(n))[i] for n in batch.schema.names}
    pieces = cell["pieces"].as_py()
    if not pieces:
        return
    listed, matrix, ids = block
    own = cell["words"].values
    # where each word of the phrases stands in the shard's list, -1 if nowhere
    place = pc.index_in(listed.cast(own.type), value_set=own).fill_null(-1).to_numpy(zero_copy_only=False)
    present = ((matrix < 0) | (place[matrix] >= 0)).all(axis=1)
    matrix, ids = matrix[present], ids[present]
    if not len(ids):
        return
    counts = np.frombuffer(cell["counts"].as_py(), "<u4")
    size = int(counts.sum())
    bits = np.frombuffer(cell["bits"].as_py(), "<u8").reshape(-1, size // 64 + 1)
    index = Index(Parts(counts, bits, np.frombuffer(cell["marks"].as_py(), "<u8"),
                        np.frombuffer(cell["samples"].as_py(), "<u4")))
    lo, hi = index.search(np.where(matrix < 0, -1, place[matrix] + 1))
    found = np.flatnonzero(hi > lo)
    if not len(found):
        return
    many = (hi - lo)[found]
    which = np.repeat(found, many)
    rows = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many) + lo[which]
    at = index.locate(rows)
    length = (matrix >= 0).sum(axis=1)[which]
    depth = np.cumsum(np.bincount(at, minlength=size + 1) - np.bincount(at + length, minlength=size + 1))
    edge = np.diff(np.concatenate([[0], (depth > 0).astype(np.int8)]))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    piece_at = np.array([p["at"] for p in pieces])
    of_span = np.searchsorted(piece_at, begin, side="right") - 1
    pair = np.unique((np.searchsorted(piece_at, at, side="right") - 1) * len(ids) + which)
    for p in np.unique(of_span).tolist():
        move = pieces[p]["first"] - pieces[p]["at"]
        mine = slice(*np.searchsorted(of_span, [p, p + 1]).tolist())
        own_pairs = slice(*np.searchsorted(pair, [p * len(ids), (p + 1) * len(ids)]).tolist())
        yield (pieces[p]["row"], list(zip((begin[mine] + move).tolist(), (end[mine] + move).tolist())),
               ids[pair[own_pairs] % len(ids)].tolist())


SPAN = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
FOUND = "row long, spans array<struct<start: long, stop: long>>, phrases array<long>"


def _spans(starts: np.ndarray, stops: np.ndarray, sizes: np.ndarray) -> pa.Array:
    flat = pa.StructArray.from_arrays([pa.array(starts, pa.int64()), pa.array(stops, pa.int64())], fields=list(SPAN))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), flat)


def search_shards(index: DataFrame, block: tuple) -> DataFrame:
    """(row, spans, phrases) of each piece that holds phrases of the block."""
    spark = index.sparkSession
    shared = spark.sparkContext.broadcast(block)

    def make(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                got = list(_find(batch, i, shared.value))
                if got:
                    flat = np.array([s for _, spans, _ in got for s in spans], np.int64).reshape(-1, 2)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r for r, _, _ in got], pa.int64()),
                         _spans(flat[:, 0], flat[:, 1], np.array([len(s) for _, s, _ in got])),
                         pa.array([p for _, _, p in got], pa.list_(pa.int64()))], names=["row", "spans", "phrases"])

    arrow_settings(spark)
    return index.select("pieces", "words", "counts", "bits", "marks", "samples").mapInArrow(tidy(make), FOUND)


def _merge(batch: pa.RecordBatch) -> pa.Array:
    """Lists of spans, sorted, with touching and overlapping ones merged."""
    lists = batch.column(batch.schema.get_field_index("spans"))
    row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    flat = lists.flatten()
    start, stop = (flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
    order = np.lexsort((start, row))
    row, start, stop = row[order], start[order], stop[order]
    wide = int(stop.max(initial=0)) + 1
    reach = np.maximum.accumulate(stop + row * wide) - row * wide if len(row) else stop
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] > reach[:-1])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(row)) - 1
    return _spans(start[begin], reach[end], np.bincount(row[begin], minlength=len(lists)))


def _blocks(listed: DataFrame, window: int) -> Iterator[tuple]:
    """Blocks of phrases of about BLOCK_BYTES at most, dealt by hash."""
    total = listed.agg(F.sum(F.octet_length("phrase"))).first()[0] or 0
    n = -(-total // BLOCK_BYTES)
    for k in range(n):
        yield _block(listed.filter(F.pmod(F.xxhash64("phrase"), F.lit(n)) == k).select("id", "phrase").toArrow(), window)


def removal_spans(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard: int = SHARD) -> DataFrame:
    """One row for each document: doc_id, n_words, spans (word positions
    [start, stop) inside occurrences of phrases, merged) and items (ids of the
    items with occurring phrases, as sorted strings)."""
    scratch = Scratch(documents.sparkSession, "contamination")
    index = scratch.write(index_shards(documents, window, shard), "index")
    pairs = scratch.write(phrases(benchmark, window), "pairs")
    listed = scratch.write(pairs.select("phrase").distinct().withColumn("id", F.monotonically_increasing_id()), "phrases")
    docs = index.select(F.explode("docs").alias("d")).select("d.*")
    found = None
    for k, block in enumerate(_blocks(listed, window)):
        part = scratch.write(search_shards(index, block), f"found-{k}")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return docs.select("doc_id", "n_words", F.array().cast("array<struct<start: long, stop: long>>").alias("spans"),
                           F.array().cast("array<string>").alias("items"))
    # pieces of a document and blocks of phrases
    hits = found.groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"),
                                    F.array_sort(F.array_distinct(F.flatten(F.collect_list("phrases")))).alias("phrases"))

    def merge(batches):
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column(0), _merge(b), b.column(2)], names=["row", "spans", "phrases"])

    hits = hits.mapInArrow(merge, FOUND).withColumn("key", F.sha2(F.array_join(
        F.col("phrases").cast("array<string>"), ","), 256))
    hits = scratch.write(hits, "hits")
    # many documents hold the same phrases: items are looked up once for each set
    sets = hits.groupBy("key").agg(F.first("phrases").alias("phrases")).select("key", F.explode("phrases").alias("id"))
    of_phrase = pairs.join(listed, "phrase").select("id", "item")
    items = sets.join(of_phrase, "id").groupBy("key").agg(F.array_sort(F.collect_set("item")).alias("items"))
    hits = hits.drop("phrases").join(items, "key")
    none = {"spans": F.array().cast("array<struct<start: long, stop: long>>"), "items": F.array().cast("array<string>")}
    return docs.join(hits, "row", "left").select("doc_id", "n_words", *[F.coalesce(c, e).alias(c) for c, e in none.items()])


def contaminated(spans: DataFrame) -> DataFrame:
    """Counts and digests of ``removal_spans``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return spans.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (hit > 0).alias("contaminated"))
