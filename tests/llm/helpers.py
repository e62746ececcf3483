"""Small tables with the awkward cases that every operator must take."""

import re
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}
# extra columns whose names the operators use inside
EXTRA = "size long, target double, copies long, rate double, id long, row string, score double, part long, grp long"
DOCS = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"


def rows(spark, texts, first=0):
    """Documents with the extra columns; (text) or (text, lang, source)."""
    data = []
    for i, t in enumerate(texts):
        text, lang, source = t if isinstance(t, tuple) else (t, "en", f"s{i % 3}")
        data.append((first + i, text, lang, source, None, 1, 2.0, 3, 4.0, 5, "r", 6.0, 7, 8))
    return spark.createDataFrame(data, DOCS)


def awkward(spark):
    """Nulls everywhere, empty and very long texts, repeated rows, odd white space, special strings."""
    long_text = " ".join(f"word{i % 997} and" for i in range(30000))
    texts = [("plain text, with words. and more", "en", "a"), (None, None, None), ("", "en", ""), ("   \t\n ", "de", "a"),
             (long_text, "en", "b"), ("same words here again and again", "fr", "b"),
             ("same words here again and again", "fr", "b"), ("x" * 50000, "es", None),
             ("a  b\n\n  c <|endoftext|> d\x01e", "en", "c"), ("naïve É 日本語　テキスト  x", None, "é")]
    df = rows(spark, texts)
    twice = df.filter("doc_id = 5")
    no_id = df.filter("doc_id = 0").selectExpr("CAST(NULL AS LONG) AS doc_id", *df.columns[1:])
    return df.unionByName(twice).unionByName(no_id)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def library_ids(name, texts):
    tk = Tokenizer.from_file(public_tokenizers.path(name))
    return [e.ids for e in tk.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingle_set(text, size=5):
    w = words(text)
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1)) if len(w) >= size else frozenset(
        [tuple(w)] if w else [])


def smallest_reachable(ids, pairs):
    up = {i: i for i in ids}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}
