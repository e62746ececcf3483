"""op4, op6, op7: ids, lengths and places against the library."""

import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

sys.path.insert(0, str(Path(__file__).parent))
from helpers import awkward, crc, empty, library_ids, rows  # noqa: E402
from riskbeacon.llm import packing, simple8b, tokenbin, tokencount  # noqa: E402
from riskbeacon.llm.queries import tokenizer  # noqa: E402

BYTE, WORDS = "byte_bpe_50k.json", "word_bpe_49k.json"


@pytest.mark.parametrize("name", [BYTE, WORDS])
def test_counts_are_the_librarys(spark, name):
    df = awkward(spark)
    got = tokencount.token_counts(df, tokenizer(name)).collect()
    texts = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    want = [(i, len((t or "").encode()), len(ids), len(ids) > 1024)
            for (i, t), ids in zip(texts, library_ids(name, [t for _, t in texts]))]
    assert Counter(tuple(r) for r in got) == Counter(want)
    assert tokencount.token_counts(empty(spark), tokenizer(name)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab C1.,'’\n\t  é中!?<|>\x01", max_size=40), min_size=1, max_size=5))
def test_pieces_join_to_the_texts_ids(texts):
    import pyarrow as pa
    from riskbeacon.llm.tokens import encoder
    for name in (BYTE, WORDS):
        got = []
        for _, n, ids in encoder(tokenizer(name)).encode(pa.array(texts, pa.string())):
            ends = np.cumsum(n)
            got += [ids[e - k:e].tolist() for e, k in zip(ends, n)]
        assert got == library_ids(name, texts)
        counted = encoder(tokenizer(name), ids=False)
        assert counted.count(pa.array(texts, pa.string())).tolist() == [len(g) for g in got] and not len(counted.flat)


def test_words_are_cut_before_marks():
    """A word with marks behind it is the piece of the plain word; ids stay the library's."""
    import pyarrow as pa
    from riskbeacon.llm.tokens import PieceEncoder
    marks = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
    texts = [f"word{m * k}{t}" for m in marks for k in (1, 3) for t in ("", "s", "'s", m + "x", " 1", "’")]
    texts += [f"{w}{m}{m}re{m}" for w in ("É", "choiç", "ñ1", "x²", "a×", "don't", "日本") for m in marks]
    enc = PieceEncoder(tokenizer(BYTE))
    n, ids = zip(*[(n, ids) for _, n, ids in enc.encode(pa.array(texts))])
    ends = np.cumsum(n[0])
    assert [ids[0][e - k:e].tolist() for e, k in zip(ends, n[0])] == library_ids(BYTE, texts)
    assert enc._pieces(pa.array(["word### choiç!! x"])).to_pylist() == [["word", "###", " choiç", "!!", " x"]]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60000), st.integers(0, 2**64 - 1)), max_size=700))
def test_simple8b_round_trip(ids):
    a = np.array(ids, dtype=np.uint64)
    words, escapes = simple8b.encode(a)
    assert (simple8b.decode(words, escapes) == a).all()
    idx = simple8b.index(words)
    lo, hi = len(a) // 3, 2 * len(a) // 3
    assert (simple8b.decode_range(words, escapes, idx, lo, hi) == a[lo:hi]).all()


def test_simple8b_packs():
    assert len(simple8b.encode(np.full(3000, 50000))[0]) <= 1024  # three to a word
    assert len(simple8b.encode(np.zeros(256, int))[0]) < 4


def test_token_files_read_back(spark):
    df = awkward(spark)
    got = tokenbin.decode_blocks(tokenbin.token_files(df, tokenizer(BYTE)), with_ids=True).collect()
    texts = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    want = {(i, t): ids + [0] for (i, t), ids in zip(texts, library_ids(BYTE, [t for _, t in texts]))}
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter(
        (i, len(want[i, t]), crc(want[i, t])) for i, t in texts)
    assert all(crc(r.ids) == r.ids_crc32 for r in got)
    got.sort(key=lambda r: r.start)
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    assert [-1 if r.doc_id is None else r.doc_id for r in got] == sorted(-1 if i is None else i for i, _ in texts)
    assert tokenbin.decode_blocks(tokenbin.token_files(empty(spark), tokenizer(BYTE))).count() == 0


def check_packing(got, total, window):
    assert sum(r.length for r in got) == total
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append(r)
    for pieces in by.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    return {k: sum(r.length for r in v) for k, v in by.items()}


def test_pack(spark):
    df = awkward(spark)
    got = packing.pack(df, tokenizer(WORDS), with_ids=True).collect()
    texts = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    ids = {(i, t): x + [2] for (i, t), x in zip(texts, library_ids(WORDS, [t for _, t in texts]))}
    check_packing(got, sum(len(ids[k]) for k in texts), 4096)
    assert all(crc(r.ids) == r.ids_crc32 and len(r.ids) == r.length for r in got)
    by_doc = {}
    for r in got:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    for i, t in texts:
        if i == 4:  # the long text, in several pieces
            pieces = sorted(by_doc[i, len(ids[i, t])], key=lambda r: r.start)
            assert sum((r.ids for r in pieces), []) == ids[i, t] and len(pieces) > 5
    assert packing.pack(empty(spark), tokenizer(WORDS)).count() == 0


def test_pack_leaves_little_padding(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = packing.pack(df, tokenizer(WORDS)).collect()
    sums = check_packing(got, sum(r.length for r in got), 4096)
    assert sum(4096 - v for v in sums.values()) < 0.1 * sum(sums.values())


def test_closest_fill_against_all_multisets():
    rng = np.random.default_rng(5)
    for _ in range(60):
        counts = {int(k): int(c) for k, c in zip(rng.integers(1, 30, 4), rng.integers(1, 4, 4))}
        room = int(rng.integers(1, 80))
        sums = {0}
        for k, c in counts.items():
            sums = {s + k * m for s in sums for m in range(c + 1)}
        used = packing.closest_fill(counts, room)
        assert all(m <= counts[k] for k, m in used.items())
        assert sum(k * m for k, m in used.items()) == max(s for s in sums if s <= room)


def test_hot_lengths_keep_every_piece(spark):
    df = rows(spark, ["same five words in all"] * 3000 + ["other text"])
    got = packing.pack(df.repartition(7), tokenizer(WORDS), window=64).collect()
    n = len(library_ids(WORDS, ["same five words in all"])[0]) + 1
    check_packing(got, 3000 * n + len(library_ids(WORDS, ["other text"])[0]) + 1, 64)
    assert len(got) == 3001
