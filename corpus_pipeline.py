"""A training corpus from ``documents``: filter, deduplicate, mix, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next stage's docs. All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskbeacon.llm import minhash, mixing, packing, quality, toxicity
from riskbeacon.llm.common import Scratch, read_documents
from riskbeacon.llm.queries import tokenizer


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches their language's threshold go. A null or empty text is
    scored as an empty one, repeated rows alike; without labels of both kinds nothing goes."""
    return toxicity.drop_toxic(docs, toxicity.fit(spark, docs, sf_dir))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 go. Null and empty texts are scored as empty ones, repeated
    rows alike; an empty table stays empty."""
    return quality.drop_low_quality(spark, docs, sf_dir)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id; of rows with
    equal ids one. Texts without words and rows without an id stay."""
    return minhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: once for each whole part of its source's rate and
    perhaps once more. A null source is a source; a rate below one may drop a document."""
    return mixing.mix(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 4096 tokens. A null text is an empty
    document: the end token alone."""
    return packing.pack(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what is between two stages is a table in the shared folder."""
    scratch = Scratch(spark, "pipeline")
    docs = read_documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.write(docs, name)
    return docs


# The classifiers and the packer can't be expressed in SQL; the stages are
# tested against brute force and held-out labels.
ORACLE_SQL = None
