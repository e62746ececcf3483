"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskbeacon.session import ensure_checkpoint_dir

# Rows of one Arrow batch; texts may be long, so batches are kept small and
# are cut again by bytes inside the tasks (``slices_by_bytes``).
ARROW_ROWS = 2000
ARROW_BYTES = 4 << 20
# A word is a run of anything but blank, tab, line feed, vertical tab, form
# feed and carriage return.
WORD_RE = "[^\\x20\\x09-\\x0D]+"


def arrow_settings(spark: SparkSession, rows: int = ARROW_ROWS, size: int = ARROW_BYTES) -> None:
    """Bound the batches that Arrow functions get, by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    try:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))
    except Exception:  # setting unknown to this Spark version
        pass


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tidy(fn: Callable) -> Callable:
    """An Arrow function that gives its freed memory back when a task ends:
    Python workers stay for later tasks and would else keep it."""
    def run(batches):
        yield from fn(batches)
        give_back()
    return run


def give_back() -> None:
    """Return freed memory of this process to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class Scratch:
    """Tables of one run, written to the shared checkpoint folder.

    A written table cuts the lineage and survives lost executors. ``drop``
    removes tables that later steps no longer read.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark)}/riskbeacon-llm/{name}-{uuid.uuid4().hex[:12]}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3, is 1: never used to fit."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def string_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array without nulls, offsets from 0."""
    texts = texts.cast(pa.large_string())
    off = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=len(texts) + 1 + texts.offset)[texts.offset:]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def text_column(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    col = batch.column(batch.schema.get_field_index(name))
    return col.cast(pa.string()).fill_null("")


def slices_by_bytes(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes each; a longer text stands alone."""
    _, off = string_buffers(texts)
    at, n = 0, len(texts)
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + most, side="right")) - 1)
        yield at, min(to, n)
        at = min(to, n)


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive offsets (empty segments: 0)."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]
