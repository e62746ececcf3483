"""op11, op12, op13: decontamination, resampling and spelling variants against brute force."""

import hashlib
import math
import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parents[1])]
from helpers import LOWER, awkward, empty, rows  # noqa: E402
from riskbeacon.llm import contamination, fmindex, resampling, spelling  # noqa: E402
from riskbeacon.llm.common import Scratch  # noqa: E402

PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, row string, id long, phrase string, words int"


def plain(text):
    return PLAIN.findall((text or "").translate(LOWER))


def bench(spark, texts, first=0):
    return spark.createDataFrame([(first + i if t != "no id" else None, t, "r", 1, "p", 2) for i, t in enumerate(texts)], ITEMS)


# ---- op11 ----

def brute_hits(docs, items, window=10):
    wanted = {}
    for item, text in items:
        w = plain(text)
        for k in range(max(len(w) - window, 0) + 1 if w else 0):
            wanted.setdefault(tuple(w[k:k + window]), set()).add("null" if item is None else str(item))
    out = []
    for doc_id, text in docs:
        w, hit, found = plain(text), set(), set()
        for size in {len(p) for p in wanted}:
            for k in range(len(w) - size + 1):
                p = tuple(w[k:k + size])
                if p in wanted:
                    hit |= set(range(k, k + size))
                    found |= wanted[p]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, bool(hit)))
    return out


def check_hits(documents, benchmark, **kw):
    got = contamination.contaminated(contamination.removal_spans(documents, benchmark, **kw))
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    want = brute_hits([tuple(r) for r in documents.select("doc_id", "text").collect()],
                      [tuple(r) for r in benchmark.select("item_id", "text").collect()], kw.get("window", 10))
    key = lambda t: (t[0] is None, t)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    return got


def passages(seed=5):
    rng = np.random.default_rng(seed)
    word = lambda n: " ".join(f"w{v}" for v in rng.integers(0, 40, n))
    items = [word(n) for n in (25, 10, 9, 3, 1, 40)] + ["", None, "no id", "Ünï-Cödé 日本 x9"]
    texts = []
    for k in range(25):
        item = plain(items[int(rng.integers(0, 6))])
        a = int(rng.integers(0, len(item)))
        part = item[a:a + int(rng.integers(1, 15))]
        texts.append(f"{word(int(rng.integers(0, 60)))}, {' - '.join(part).upper()}. {word(int(rng.integers(0, 60)))}")
    texts += [items[0], items[0], items[0] + "\n" + items[0], "a ünï cödé! 日本: x9 b", "no id", items[5] * 3]
    return texts, items


def test_suffixes_and_search():
    rng = np.random.default_rng(0)
    for _ in range(10):
        pieces = [rng.integers(1, 6, rng.integers(1, 60)) for _ in range(20)]
        s = np.array([0] + [x for p in pieces + pieces[:1] * 6 for x in [*p.tolist(), 0]], np.int64)
        apart = np.cumsum(s == 0)
        # separators are distinct and below all words
        keys = [tuple((0, apart[j]) if s[j] == 0 else (1, s[j]) for j in range(i, len(s))) for i in range(len(s))]
        assert fmindex.sort_suffixes(s).tolist() == sorted(range(len(s)), key=keys.__getitem__)
        index = fmindex.Index(fmindex.build(s))
        asked = np.full((80, 4), -1)
        for r in asked:
            k = rng.integers(1, 5)
            r[4 - k:] = rng.integers(1, s.max() + 1, k)
        for r, lo, hi in zip(asked, *index.search(asked)):
            w = r[r >= 0]
            assert sorted(index.locate(np.arange(lo, hi)).tolist()) == [
                i for i in range(len(s) - len(w) + 1) if (s[i:i + len(w)] == w).all()]


def test_words_of_bytes():
    texts = ["A b-C9", "", "日本 x\x00y\x7fz", "  ", "É!é", "end"]
    listed, numbers, starts = contamination.word_numbers(pa.array(texts))
    words = [listed[i].as_py().decode() for i in numbers.tolist()]
    assert [words[a:b] for a, b in zip(starts[:-1], starts[1:])] == [plain(t) for t in texts]


def test_contamination(spark):
    texts, items = passages()
    got = check_hits(rows(spark, texts), bench(spark, items))
    assert got.filter("contaminated").count() > 10


def test_contamination_in_pieces_and_blocks(spark, monkeypatch):
    """Shards of 30 words and phrases in blocks of some 200 bytes give the same."""
    monkeypatch.setattr(contamination, "BLOCK_BYTES", 200)
    texts, items = passages(6)
    check_hits(rows(spark, [" ".join(texts)] + texts), bench(spark, items), shard=30)
    check_hits(rows(spark, texts), bench(spark, items), window=4, shard=11)


def test_contamination_awkward(spark):
    df = awkward(spark)
    b = bench(spark, ["here again and again", None, "", "word5 and word6 and word7 and word8 and word9 and word10 and"])
    check_hits(df, b)
    check_hits(df, b.limit(0))
    assert contamination.removal_spans(empty(spark), b).count() == 0


def test_spans_are_words_to_remove(spark):
    df = rows(spark, ["one two three four five six", "two three two three", "none"])
    got = {r.doc_id: ([(s.start, s.stop) for s in r.spans], r["items"]) for r in contamination.removal_spans(
        df, bench(spark, ["two three", "three four five", "five"], first=9)).collect()}
    assert got == {0: ([(1, 5)], ["10", "11", "9"]), 1: ([(0, 4)], ["9"]), 2: ([], [])}


# ---- op12 ----

def brute_draw(docs, target, percent=10, min_words=20, buckets=10000, longest=1):
    def feats(text):
        w = plain(text)
        return [" ".join(w[i:i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    def at(f):
        return zlib.crc32(f.encode()) % buckets
    s = Counter(at(f) for _, t in docs for f in feats(t))
    t = Counter(at(f) for x in target for f in feats(x))
    all_s, all_t = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (all_s + float(buckets)) / ((s[b] + 1) * (all_t + float(buckets)))))
    out = []
    for doc_id, text in docs:
        f = feats(text)
        h = int(hashlib.sha256(f"2024:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(at(x)) for x in f)
        out.append([doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))),
                    None, len(plain(text))])
    enough = sorted((r for r in out if r[5] >= min_words),
                    key=lambda r: (-r[3], r[0] is None, 0 if r[0] is None else r[0], r[1]))
    for k, r in enumerate(enough[:percent * len(enough) // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in out]


def check_draw(documents, benchmark, **kw):
    got = resampling.resample(documents, benchmark, **kw)
    assert got.dtypes == [("doc_id", "bigint"), ("n_features", "bigint"), ("weight", "bigint"), ("score", "bigint"),
                          ("rank", "bigint")]
    want = brute_draw([tuple(r) for r in documents.select("doc_id", "text").collect()],
                      [r.text for r in benchmark.collect()], **kw)
    key = lambda t: tuple((x is None, x or 0) for x in t)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


def mixed_texts(n, seed=2):
    rng = np.random.default_rng(seed)
    return [" ".join(f"v{v}" for v in rng.zipf(1.4, int(rng.integers(0, 60))) % 300) for _ in range(n)]


def test_resample(spark):
    df, b = rows(spark, mixed_texts(150)), bench(spark, mixed_texts(10, seed=9))
    check_draw(df, b)
    check_draw(df, b, percent=100, min_words=0)
    check_draw(df, b, percent=30, min_words=5, buckets=50, longest=2)


def test_resample_ties(spark):
    """Equal rows tie in score and id, and the cut goes through them."""
    same = rows(spark, ["a b c d"]).unionByName(rows(spark, ["a b c d"])).unionByName(rows(spark, ["a b c d"]))
    no_id = same.selectExpr("CAST(NULL AS LONG) AS doc_id", *same.columns[1:])
    df = same.unionByName(no_id).unionByName(rows(spark, ["x y", "z"], first=7))
    for percent in (0, 25, 50, 70, 100):
        check_draw(df, bench(spark, ["a b"]), percent=percent, min_words=1)


def test_resample_awkward(spark):
    df = awkward(spark)
    check_draw(df, bench(spark, ["same words", None, ""]), percent=60, min_words=1)
    check_draw(df, bench(spark, ["x"]).limit(0), percent=50, min_words=2)
    assert resampling.resample(empty(spark), bench(spark, ["x"])).count() == 0


def test_cut_key(spark):
    df = spark.createDataFrame([(v,) for v in [-(1 << 62), -5, -5, -5, 0, 3, 3, 1 << 62]], "k long")
    got = [resampling.cut_key(df, "k", n) for n in range(1, 9)]
    assert got == [(-(1 << 62), 0), (-5, 1), (-5, 1), (-5, 1), (0, 4), (3, 5), (3, 5), (1 << 62, 7)]


# ---- op13 ----

def brute_variants(docs):
    count = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    n = {w: c for w, c in count.items() if len(w) >= 5 and c >= 3}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))
    form, count_near = {}, {}
    for w in n:
        others = [x for x in n if near(w, x)]
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
        count_near[w] = len(others)
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], count_near[w], n.get(form[w])))
    return out


def check_variants(df):
    got = [tuple(r) for r in spelling.spelling_variants(df).collect()]
    want = brute_variants([tuple(r) for r in df.select("doc_id", "text").collect()])
    assert len(got) == len(want) and set(got) == want
    return want


def test_spelling_variants(spark):
    rng = np.random.default_rng(4)
    base = ["".join(rng.choice(list("abcé"), int(rng.integers(4, 12)))) for _ in range(60)]
    words = list(base)
    for w in base * 3:
        i = int(rng.integers(0, len(w)))
        words.append([w[:i] + w[i + 1:], w[:i] + "à" + w[i:], w[:i] + "B" + w[i + 1:], w + w[-1]][int(rng.integers(0, 4))])
    texts = [" ".join(rng.choice(words, 80, p=(p := 1 / np.arange(1, len(words) + 1)) / p.sum())) for _ in range(120)]
    want = check_variants(rows(spark, texts))
    assert sum(f is not None for _, f, *_ in want) > 40 and any(f != r for _, f, r, *_ in want if f)


def test_every_single_edit_is_found(spark):
    """Each deletion, replacement and insertion at each place, at odd and even lengths, with repeated letters."""
    words = set()
    for w in ("abcde", "aabbaa", "abcdefg", "zzzzzzzz", "éabcdefgh"):
        words |= {w} | {w[:i] + w[i + 1:] for i in range(len(w))} | {w[:i] + "q" + w[i:] for i in range(len(w) + 1)}
        words |= {w[:i] + "q" + w[i + 1:] for i in range(len(w))}
    check_variants(rows(spark, [" ".join(sorted(words)), " ".join(sorted(words)), " ".join(sorted(words)), "abcde zzzzzzzz"]))


def test_long_chain_of_forms(spark):
    words = ["aaaaaaaa"[:8 - k] + "b" * k for k in range(8)]
    text = " ".join(" ".join([w] * (3 << k)) for k, w in enumerate(words))
    check_variants(rows(spark, [text]))
    forms = spark.createDataFrame([(f"w{k}", f"w{k + 1}") for k in range(40)], "word string, form string")
    got = spelling.roots(Scratch(spark, "test"), forms).collect()
    assert {(r.word, r.root) for r in got} == {(f"w{k}", "w40") for k in range(40)}


def test_spelling_awkward(spark):
    check_variants(awkward(spark))
    assert spelling.spelling_variants(empty(spark)).count() == 0


def test_spelling_joins_broadcast_nothing(spark, monkeypatch):
    """A vocabulary far under the broadcast threshold: its exploded keys, forms and roots still don't pass the driver."""
    plans, write = [], Scratch.write

    def seen(df):
        got = df.collect()  # runs this frame's own plan, so that joins changed while running show
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return got

    def watched(self, df, name):
        seen(df)
        return write(self, df, name)
    monkeypatch.setattr(Scratch, "write", watched)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") not in ("-1", "-1b")
    text = "abcde abcde abcde abcdef abcdef abcdef abcdef abcdef abcdef"
    got = {(r.word, r.root, r.n) for r in seen(spelling.spelling_variants(rows(spark, [text])))}
    assert got == {("abcde", "abcdef", 3), ("abcdef", "abcdef", 6)}
    assert sum("SortMergeJoin" in p for p in plans) >= 3 and not any("Broadcast" in p for p in plans)


@pytest.mark.parametrize("name", ["op11_contamination", "op12_resample", "op13_spelling_variants"])
def test_queries_against_sql(spark, name):
    from oracle_check import canon, duck

    from riskbeacon.llm.queries import ORACLE_SQL, QUERIES
    sf = "/root/testdata/sf0.001"
    df = QUERIES[name](spark, sf)
    cur = duck(sf).execute(ORACLE_SQL[name])
    want = canon([c[0] for c in cur.description], cur.fetchall())
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == want
