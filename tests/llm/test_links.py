"""op2, op5, op9: links, components and searches against brute force."""

import math
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from helpers import awkward, empty, rows, shingle_set, smallest_reachable  # noqa: E402
from riskbeacon.llm import minhash, pivots, topk  # noqa: E402
from riskbeacon.llm.common import Scratch  # noqa: E402
from riskbeacon.llm.components import components  # noqa: E402

VECTORS = "vec_id long, embedding array<float>, label int, id long, digest string, copies long"


def brute_components(docs, percent):
    sets = [(i, shingle_set(t)) for i, t in docs]
    pairs = [(a, b) for k, (a, x) in enumerate(sets) for b, y in sets[:k]
             if x and y and a is not None and b is not None and 100 * len(x & y) >= percent * len(x | y)]
    return smallest_reachable([i for i, _ in docs if i is not None], pairs)


def near_texts(n, seed=1):
    rng = np.random.default_rng(seed)
    out = []
    for k in range(n):
        base = [f"w{v}" for v in rng.integers(0, 5000, rng.integers(3, 300))]
        out.append(" ".join(base))
        for _ in range(int(rng.integers(0, 4))):
            w = list(base)
            for at in rng.integers(0, len(w), rng.integers(0, 1 + len(w) // 40)):
                w[at] = "changed"
            out.append(" ".join(w).upper() if k % 5 == 0 else " ".join(w))
    return out


def check_documents(spark, df, percent):
    docs = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    want = brute_components(docs, percent)
    got = minhash.near_duplicates(df, percent).collect()
    assert len(got) == len(docs)
    sizes = {(i, len(shingle_set(t))) for i, t in docs}
    for r in got:
        assert (r.doc_id, r.n_shingles) in sizes
        assert r.component_id == (None if r.doc_id is None else want[r.doc_id])
        assert r.kept == (r.doc_id == r.component_id)


def test_near_documents(spark):
    check_documents(spark, rows(spark, near_texts(60)), 85)


def test_near_documents_awkward(spark):
    check_documents(spark, awkward(spark), 85)
    assert minhash.near_duplicates(empty(spark)).count() == 0


def test_large_group_in_small_blocks(spark, monkeypatch):
    """Buckets above their bound and groups of many blocks lose no link."""
    monkeypatch.setattr(minhash, "BUCKET", 5)
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rng = np.random.default_rng(3)
    base = [f"w{v}" for v in rng.integers(0, 5000, 120)]
    texts = []
    for _ in range(80):
        w = list(base)
        for at in rng.integers(0, len(w), 3):
            w[at] = f"c{rng.integers(0, 99)}"
        texts.append(" ".join(w))
    df = rows(spark, texts + near_texts(5, seed=8))
    check_documents(spark, df, 80)


def test_drop_near_duplicates_keeps_one_of_each(spark):
    df = awkward(spark)
    got = minhash.drop_near_duplicates(df)
    assert got.columns == df.columns
    ids = sorted((-1 if r.doc_id is None else r.doc_id) for r in got.select("doc_id").collect())
    assert ids == [-1, 0, 1, 2, 3, 4, 5, 7, 8, 9]  # 6 copies 5, 5 is there twice


def test_components(spark):
    rng = np.random.default_rng(2)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (160, 2))] + [(i, i + 1) for i in range(400, 450)]
    want = smallest_reachable({v for p in pairs for v in p}, pairs)
    df = spark.createDataFrame(pairs, "a long, b long")
    got = {r.node: r.component for r in components(Scratch(spark, "test"), df, "t").collect()}
    assert all(got.get(v, v) == c for v, c in want.items())


def test_components_of_stars_take_no_round(spark, monkeypatch):
    written = []
    plain = Scratch.write
    monkeypatch.setattr(Scratch, "write", lambda self, df, name: written.append(name) or plain(self, df, name))
    df = spark.createDataFrame([(5, 1), (1, 6), (9, 7)], "a long, b long")
    got = {r.node: r.component for r in components(Scratch(spark, "test"), df, "t").collect()}
    assert got == {1: 1, 5: 1, 6: 1, 7: 7, 9: 7} and written == ["t-0"]


def test_blocks_give_their_components(spark, monkeypatch):
    """Components of blocks come with their links: no rounds over the links of one block each."""
    monkeypatch.setattr(minhash, "BLOCK", 8)
    written = []
    plain = Scratch.write
    monkeypatch.setattr(Scratch, "write", lambda self, df, name: written.append(name) or plain(self, df, name))
    check_documents(spark, rows(spark, near_texts(60)), 85)
    assert not [n for n in written if n.startswith("first-")]


def test_bucket_forest_is_stars_around_the_smallest_id():
    same = np.zeros((4, minhash.SKETCH_WORDS), np.uint64).tobytes()
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1] * 4, pa.int64()), pa.array([9, 4, 2, 7], pa.int64()), pa.array([50] * 4, pa.int64()),
         pa.array([same[:8 * minhash.SKETCH_WORDS]] * 4, pa.binary())], names=["band", "id", "n", "sketch"])
    out = pa.Table.from_batches(list(minhash._bucket_forest(0.85)([batch])))
    assert set(zip(out["a"].to_pylist(), out["b"].to_pylist())) == {(4, 2), (7, 2), (9, 2)}


def vectors(spark, x, extra=()):
    data = [(i, [float(v) for v in row], 0, 9, "d", 1) for i, row in enumerate(x)]
    return spark.createDataFrame(data + list(extra), VECTORS)


def clustered(n, d, seed, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 4, d))
    x = [c + rng.normal(size=d) * spread for c in centres for _ in range(3)] + list(rng.normal(size=(n // 4, d)))
    return np.array(x, dtype=np.float32)


def brute_vectors(df, threshold):
    rows_ = df.select("vec_id", "embedding").collect()
    unit = []
    for r in rows_:
        v = None if r.embedding is None or any(e is None for e in r.embedding) else np.array(r.embedding, np.float64)
        ok = v is not None and len(v) and np.isfinite(v).all() and v.any() and r.vec_id is not None
        unit.append(v / np.linalg.norm(v) if ok else None)
    return [(i, j) for i in range(len(rows_)) for j in range(i) if unit[i] is not None and unit[j] is not None
            and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold], rows_


def test_near_vectors(spark):
    x = clustered(240, 16, 4, 0.12)
    x[10] = x[11] = x[12]
    extra = [(500, None, 0, 0, None, 0), (501, [], 0, 0, None, 0), (502, [0.0] * 16, 0, 0, None, 0),
             (503, [float("nan")] * 16, 0, 0, None, 0), (504, [None] + [1.0] * 15, 0, 0, None, 0),
             (505, [float("inf")] + [1.0] * 15, 0, 0, None, 0), (506, [1.0, 2.0], 0, 0, None, 0),
             (507, [2.0, 4.0], 0, 0, None, 0), (None, [float(v) for v in x[10]], 0, 0, None, 0)]
    df = vectors(spark, x, extra)
    pairs, rows_ = brute_vectors(df, 0.9)
    links = np.zeros(len(rows_), int)
    for i, j in pairs:
        links[[i, j]] += 1
    comp = smallest_reachable([r.vec_id for r in rows_ if r.vec_id is not None],
                              [(rows_[i].vec_id, rows_[j].vec_id) for i, j in pairs])
    got = {r.vec_id: r for r in pivots.near_vectors(df).collect()}
    assert len(got) == len(rows_)
    found = sum(got[r.vec_id].n_links for r in rows_)
    assert found >= 0.9 * links.sum() and len(pairs) > 100
    assert all(got[r.vec_id].n_links <= k for r, k in zip(rows_, links))
    same = sum(got[i].component_id == c for i, c in comp.items())
    assert same >= 0.9 * len(comp)
    assert got[None].component_id is None and got[506].n_links == 1 and got[502].n_links == 0
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert pivots.near_vectors(vectors(spark, [])).count() == 0


def test_pivot_lists_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(pivots, "BLOCK", 16)
    df = vectors(spark, clustered(200, 12, 6, 0.02))
    pairs, rows_ = brute_vectors(df, 0.9)
    got = pivots.near_vectors(df).collect()
    assert 2 * len(pairs) >= sum(r.n_links for r in got) >= 0.95 * 2 * len(pairs)


def test_pivot_recall_on_hard_pairs(spark):
    """Pairs just above the threshold: recall against brute force."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = x + rng.normal(size=x.shape) * 0.045  # cosine about 0.93
    df = vectors(spark, np.concatenate((x, y)))
    pairs, _ = brute_vectors(df, 0.9)
    got = sum(r.n_links for r in pivots.near_vectors(df).collect()) / 2
    assert len(pairs) > 1000 and got >= 0.9 * len(pairs)


def hot_cone(n, base, seed, d=64):
    """Unit vectors, a third of them at cosine ``base`` to one direction; half
    of that third are partners of the other half at cosine 0.90 to 0.91."""
    rng = np.random.default_rng(seed)

    def unit(x):
        return x / np.linalg.norm(x, axis=1, keepdims=True)
    x, c, h = unit(rng.normal(size=(n, d))), unit(rng.normal(size=(1, d))), n // 6
    r, u = unit(x[:h] - (x[:h] @ c.T) * c), x[h:2 * h] - (x[h:2 * h] @ c.T) * c
    u = unit(u - (u * r).sum(axis=1, keepdims=True) * r)
    g = (rng.uniform(0.9, 0.91, (h, 1)) - base ** 2) / (1 - base ** 2)
    x[:h], x[h:2 * h] = base * c + np.sqrt(1 - base ** 2) * r, base * c + np.sqrt(1 - base ** 2) * (g * r + np.sqrt(1 - g * g) * u)
    return x, 2 * h


@pytest.mark.parametrize("n,base", [(3000, 0.9), (20000, 0.8), (20000, 0.9)])
def test_pivot_recall_in_a_hot_cone(spark, n, base):
    """Pairs just above the threshold among a third of the rows, at several sizes."""
    x, h = hot_cone(n, base, 7)
    df = spark.createDataFrame(pa.table({"vec_id": np.arange(n), "embedding": list(x)}))
    pairs = (int((x[:h] @ x[:h].T >= 0.9).sum()) - h) // 2
    got = sum(r.n_links for r in pivots.near_vectors(df).filter(f"vec_id < {h}").collect()) / 2
    assert pairs >= 0.99 * h / 2 and 0.95 * pairs <= got <= pairs


def test_candidates_by_shared_pivots():
    """Pairs are candidates in one list only, and exactly those that share enough pivots."""
    rng = np.random.default_rng(4)
    codes = np.array([rng.permutation(12)[:4] for _ in range(60)])
    want = {(i, j) for i in range(60) for j in range(i) if len(set(codes[i]) & set(codes[j])) >= 2}
    got = []
    for pivot in range(12):
        rows = np.flatnonzero((codes == pivot).any(axis=1))
        i_rows, j_rows = np.array_split(np.arange(len(rows)), 2)
        for x, y in ((i_rows, i_rows), (i_rows, j_rows), (j_rows, j_rows)):
            p, q = np.nonzero(pivots.candidates(codes[rows], pivot, 2, x, y))
            got += [(rows[i], rows[j]) for i, j in zip(x[p], y[q]) if i != j and not (len(x) == len(y) and (x == y).all() and i < j)]
    got = [(max(p), min(p)) for p in got]
    assert len(got) == len(set(got)) and set(got) == want


def test_lists_grow_with_the_pivots():
    taken = []
    for n in (3000, 200000):
        x, h = hot_cone(n, 0.9, 5)
        most = 2 * math.isqrt(n)
        sample = x[np.random.default_rng(1).permutation(n)[:2 * most]]
        near = pivots.spread(sample, 0.9, most)
        taken.append(pivots.lists_needed(sample, near, 0.9, pivots.NEAREST, pivots.SHARED))
        a, b = (pivots.pivot_codes(v, near, taken[-1]) for v in (x[:500], x[h // 2:h // 2 + 500]))
        both = [len(set(p) & set(q)) >= pivots.SHARED for p, q in zip(a.tolist(), b.tolist())]
        assert np.mean(both) >= 0.95
    assert taken[0] < taken[1]


def brute_top(df, k, every):
    v = {}
    for r in df.select("vec_id", "embedding").collect():
        if r.vec_id is None or r.embedding is None or any(e is None or not np.isfinite(e) for e in r.embedding):
            continue
        v.setdefault(r.vec_id, []).append([int(np.floor(256 * float(e))) for e in r.embedding])
    out = []
    for q in sorted(i for i in v if i % every == 0):
        got = []
        for mine in {tuple(x) for x in v[q]}:
            got += [(-sum(a * b for a, b in zip(mine, c)), i) for i, cs in v.items() if i != q for c in cs
                    if len(c) == len(mine)]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(got)[:k])]
    return out


def test_top_inner_products(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 40)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 8)).round(1)  # many ties
    x[100:140] = x[100]
    extra = [(400, None, 0, 0, None, 0), (450, [None] * 8, 0, 0, None, 0), (451, [float("nan")] * 8, 0, 0, None, 0),
             (None, [1.0] * 8, 0, 0, None, 0), (500, [1.0, 2.0], 0, 0, None, 0), (7, [0.5] * 8, 0, 0, None, 0),
             (550, [0.0] * 8, 0, 0, None, 0)]
    df = vectors(spark, x, extra)
    got = sorted(tuple(r) for r in topk.top_inner_products(df, 5, 50, bins=16).collect())
    assert got == sorted(brute_top(df, 5, 50))


def test_top_with_few_or_huge(spark):
    few = vectors(spark, [[1.0, 2.0], [3.0, 4.0], [0.0, -1.0]])
    assert sorted(tuple(r) for r in topk.top_inner_products(few, 5, 50).collect()) == brute_top(few, 5, 50)
    big = vectors(spark, [[1e6, 2.0], [3e6, 4.0], [-1e6, 1.0], [1e6, 2.0]])
    assert sorted(tuple(r) for r in topk.top_inner_products(big, 2, 2).collect()) == sorted(brute_top(big, 2, 2))
    assert topk.top_inner_products(vectors(spark, []), 5, 50).count() == 0


def test_hubs_leave_little_outside(spark, monkeypatch):
    """One group of near copies of a text: what meets every block shrinks, and grows no faster than the group."""
    monkeypatch.setattr(minhash, "BLOCK", 32)
    seen = {}
    plain = Scratch.write

    def write(self, df, name):
        out = plain(self, df, name)
        if name == "apart":
            main = out.groupBy("comp").count().orderBy("count", ascending=False).first()["count"]
            seen[name] = (out.count(), main)
        return out
    monkeypatch.setattr(Scratch, "write", write)
    for n in (150, 600):
        rng = np.random.default_rng(n)
        base = [f"w{v}" for v in rng.integers(0, 5000, 200)]
        texts = []
        for _ in range(n):
            w = list(base)
            for at in rng.integers(0, len(w), 4):
                w[at] = f"c{rng.integers(0, 99)}"
            texts.append(" ".join(w))
        df = rows(spark, [" ".join(base)] + texts)
        check_documents(spark, df, 80)
        total, main = seen["apart"]
        assert total > n * 0.9 and total - main <= 0.1 * total
