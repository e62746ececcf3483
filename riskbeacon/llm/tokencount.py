"""Token counts: Arrow functions that return lengths only.

Each text is cut at boundaries at which the tokenizer always cuts; the
distinct pieces of a slice (slices and library calls are balanced by bytes,
not rows) are encoded in batches and only their lengths are taken and
remembered, so no list of ids leaves the library call. Texts in which those cuts aren't known
to be safe are split at single blanks between letters or digits only when
they are long.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from riskbeacon.llm.common import arrow_settings, text_column, tidy
from riskbeacon.llm.tokens import encoder


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit), one row per input row.

    A null text counts as empty: 0 bytes, 0 tokens. Repeated rows and null
    ids keep a row each; other columns are ignored; an empty table gives none.
    """
    arrow_settings(docs.sparkSession)
    rows = docs.select(docs[id_col], docs[text_col])
    schema = T.StructType([rows.schema[0], T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])

    def count(batches):
        enc = encoder(tokenizer, ids=False)
        for b in batches:
            texts = text_column(b, text_col)
            n = enc.count(texts)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pc.binary_length(texts).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(n > limit)],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(tidy(count), schema)
