"""Token-id files: Simple-8b blocks in ascending document order.

Documents are dealt by ranges of doc_id and sorted within each range; every
task encodes its documents with the tokenizer, appends the end id and writes
blocks of whole documents. A block is one row of a Parquet table (the commit
protocol keeps files of lost or repeated tasks out): the packed 64-bit
words, the escapes, an index with the ids before every 1,024th word, and the
ids and lengths of its documents. ``decode_blocks`` reads blocks back with
vectorised decoding; offsets over all files come from one row per range.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskbeacon.llm import simple8b
from riskbeacon.llm.common import Scratch, arrow_settings, text_column, tidy
from riskbeacon.llm.tokens import encoder

# larger batches than elsewhere: fewer distinct pieces are looked up again
BATCH_ROWS, BATCH_BYTES, REMEMBERED = 4000, 12 << 20, 800_000
BLOCK_IDS = 1 << 18  # a block ends with the document that reaches so many ids


def _block_schema(id_type: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("part", T.LongType()), T.StructField("block", T.LongType()),
        T.StructField("first_in_part", T.LongType()), T.StructField("n_ids", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(id_type)), T.StructField("doc_lens", T.ArrayType(T.LongType())),
        T.StructField("words", T.BinaryType()), T.StructField("escapes", T.BinaryType()),
        T.StructField("word_index", T.BinaryType())])


def encode_blocks(docs: DataFrame, tokenizer: str, end_id: int = 0, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Blocks of the documents' ids, in ascending id order within each range.

    Null ids come first; repeated ids stay next to each other, ordered by
    their text's hash. A null text is empty: only the end id.
    """
    arrow_settings(docs.sparkSession, BATCH_ROWS, BATCH_BYTES)
    rows = (docs.select(docs[id_col].alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
            .repartitionByRange("id").sortWithinPartitions("id", F.xxhash64("text")))
    schema = _block_schema(rows.schema["id"].dataType)
    arrow = pa.schema([("part", pa.int64()), ("block", pa.int64()), ("first_in_part", pa.int64()),
                       ("n_ids", pa.int64())])

    def write(batches):
        enc = encoder(tokenizer, REMEMBERED)
        part = TaskContext.get().partitionId()
        block, before = 0, 0

        def pack(doc_ids, lens, ids):
            nonlocal block, before
            words, escapes = simple8b.encode(ids)
            row = [pa.array([x], t) for x, t in zip((part, block, before, len(ids)), arrow.types)]
            row.append(pa.ListArray.from_arrays(pa.array([0, len(lens)], pa.int32()), doc_ids))
            row.append(pa.ListArray.from_arrays(pa.array([0, len(lens)], pa.int32()), pa.array(lens, pa.int64())))
            row += [pa.array([x.tobytes()], pa.binary())
                    for x in (words, escapes, simple8b.index(words).astype(np.int64))]
            block, before = block + 1, before + len(ids)
            return pa.RecordBatch.from_arrays(row, names=schema.names)

        for b in batches:
            keys = b.column(0)
            for first, counts, ids in enc.encode(text_column(b)):
                lens = counts + 1
                ends = np.cumsum(lens)
                out = np.full(int(ends[-1]) if len(ends) else 0, end_id, np.uint32)
                inner = np.ones(len(out), bool)
                inner[ends - 1] = False
                out[inner] = ids
                a = 0
                while a < len(lens):
                    base = int(ends[a - 1]) if a else 0
                    z = min(len(lens), int(np.searchsorted(ends, base + BLOCK_IDS)) + 1)
                    yield pack(keys.slice(first + a, z - a), lens[a:z], out[base:int(ends[z - 1])])
                    a = z

    return rows.mapInArrow(tidy(write), schema)


def with_starts(blocks: DataFrame) -> DataFrame:
    """Adds ``first``: the ids of all documents before the block.

    The offsets are summed over one row per range (as many as tasks wrote),
    put in order by the ranges' smallest id.
    """
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"),
                                       F.min(F.struct(F.element_at("doc_ids", 1).alias("id"), "part")).alias("lo"))
    run = Window.orderBy("lo").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(run), F.lit(0)).alias("before"))
    # one row per written range: bounded by the number of tasks
    return (blocks.join(F.broadcast(parts), "part")
            .withColumn("first", F.col("before") + F.col("first_in_part")).drop("before"))


def decode_blocks(blocks: DataFrame, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document, from the blocks."""
    id_type = blocks.schema["doc_ids"].dataType.elementType
    fields = [T.StructField("doc_id", id_type), T.StructField("start", T.LongType()),
              T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType())))
    schema = T.StructType(fields)

    def read(batches):
        for b in batches:
            col = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            for r in range(b.num_rows):
                words = np.frombuffer(col["words"][r].as_py(), np.uint64)
                escapes = np.frombuffer(col["escapes"][r].as_py(), np.uint64)
                ids = simple8b.decode(words, escapes).astype(np.uint32)
                lens = np.asarray(col["doc_lens"][r].values.to_numpy(), np.int64)
                off = np.concatenate(([0], np.cumsum(lens)))
                raw = memoryview(np.ascontiguousarray(ids)).cast("B")
                crc = [zlib.crc32(raw[4 * off[k]:4 * off[k + 1]]) for k in range(len(lens))]
                out = [col["doc_ids"][r].values, pa.array(off[:-1] + col["first"][r].as_py(), pa.int64()),
                       pa.array(lens, pa.int64()), pa.array(crc, pa.int64())]
                if with_ids:
                    out.append(pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids, pa.int64())))
                yield pa.RecordBatch.from_arrays(out, names=schema.names)

    cols = ["doc_ids", "doc_lens", "words", "escapes", "first"]
    return with_starts(blocks).select(*cols).mapInArrow(tidy(read), schema)


def token_files(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write the block files to the shared folder and return them as a table."""
    scratch = Scratch(docs.sparkSession, "tokenbin")
    return scratch.write(encode_blocks(docs, tokenizer, end_id), "blocks")
