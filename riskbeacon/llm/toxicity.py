"""Toxicity: a convolutional text classifier, trained in numpy.

A word's vector is the sum of hashed embeddings of the word and two of its
prefixes. Filters of several widths run over the words; their rectified
outputs are max-pooled over segments, and a text's features are, for each
filter, the maximum and the mean of its segments' maxima. A logistic layer
gives the score. The classifier is fitted on a bounded sample of labelled
rows; the decision threshold is calibrated for each language on all labelled
rows that training didn't see.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskbeacon.llm.common import arrow_settings, give_back, held_out, slices_by_bytes, text_column, tidy
from riskbeacon.llm.labels import fit_labels, fit_sample

BUCKETS = 1 << 15
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 6            # of each width
SEGMENT = 32           # words that are max-pooled together
PREFIXES = (5, 7)
LEAST_DOCS = 3         # a bucket seen in fewer sampled texts keeps a zero vector
SAMPLE = 3000          # rows of each label to fit on, at most
LONGEST = 60_000       # characters of a text to fit on, at most; scoring takes whole texts
EPOCHS = 8
THRESHOLD = 0.7        # where there are too few rows to calibrate, over all languages too
STEPS = [round(0.4 + 0.05 * i, 2) for i in range(11)]  # thresholds to choose from
TRIM = ".,;:!?\"'()[]|%$&*#-"


def word_buckets(words: list[str]) -> np.ndarray:
    """Hash buckets of each word: itself and its prefixes (a shorter word is its own prefix)."""
    import xxhash
    h = xxhash.xxh32_intdigest
    out = np.empty((len(words), 1 + len(PREFIXES)), np.int32)
    for k, n in enumerate((None, *PREFIXES)):
        out[:, k] = [h(w[:n], k) % BUCKETS for w in words]
    return out


@dataclass
class Texts:
    """Words of some texts, padded to whole segments: codes into ``buckets``
    (the last code is the padding), and each text's first segment."""
    buckets: np.ndarray
    codes: np.ndarray
    first: np.ndarray

    @staticmethod
    def of(texts: pa.Array) -> "Texts":
        lists = pc.utf8_split_whitespace(pc.utf8_lower(texts))
        code = lists.flatten().dictionary_encode()
        vocab = pc.utf8_trim(code.dictionary, TRIM).to_pylist()
        off = lists.offsets.to_numpy().astype(np.int64)
        off = off - off[0]
        n = np.diff(off)
        segments = -(-(n + max(WIDTHS) - 1) // SEGMENT)
        first = np.concatenate(([0], np.cumsum(segments)))
        codes = np.full(int(first[-1]) * SEGMENT + max(WIDTHS), len(vocab), np.int32)
        indices = code.indices.to_numpy()
        del lists, code
        for a in range(0, len(n), 256):  # a few texts at a time: little memory
            b = min(a + 256, len(n))
            at = np.repeat(first[a:b] * SEGMENT - off[a:b], n[a:b]) + np.arange(off[a], off[b])
            codes[at] = indices[off[a]:off[b]]
        return Texts(word_buckets(vocab), codes, first)


@dataclass
class Cnn:
    embedding: np.ndarray                       # (BUCKETS, DIM)
    filters: list[np.ndarray]                   # one (width, DIM, FILTERS) for each width
    bias: np.ndarray                            # (widths * FILTERS)
    weight: np.ndarray                          # (2 * widths * FILTERS)
    offset: float
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = THRESHOLD                # where a language has none of its own

    def convolve(self, t: Texts) -> np.ndarray:
        """Rectified outputs at every word, (segments, SEGMENT, widths * FILTERS)."""
        vec = np.vstack((self.embedding[t.buckets].sum(axis=1), np.zeros((1, DIM), np.float32)))
        n = len(t.codes) - max(WIDTHS)
        out = []
        for w, f in zip(WIDTHS, self.filters):
            total = 0
            for j in range(w):
                total = total + (vec @ f[j])[t.codes[j:j + n]]
            out.append(total)
        got = np.maximum(np.concatenate(out, axis=1) + self.bias, 0)
        return got.reshape(-1, SEGMENT, got.shape[1])

    def pool(self, conv: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(segment maxima, text features)."""
        seg = conv.max(axis=1)
        n = np.maximum(np.diff(first), 1)[:, None]
        some = np.flatnonzero(np.diff(first))
        top = np.zeros((len(first) - 1, seg.shape[1]), seg.dtype)
        mean = np.zeros_like(top)
        if len(some):
            top[some] = np.maximum.reduceat(seg, first[:-1][some], axis=0)
            mean[some] = np.add.reduceat(seg, first[:-1][some], axis=0) / n[some]
        return seg, np.concatenate((top, mean), axis=1)

    def logits(self, t: Texts) -> np.ndarray:
        _, x = self.pool(self.convolve(t), t.first)
        return x.astype(np.float64) @ self.weight + self.offset

    def score(self, texts: pa.Array) -> np.ndarray:
        got = [sigmoid(self.logits(Texts.of(texts.slice(a, b - a)))) for a, b in slices_by_bytes(texts, 2 << 20)]
        return np.concatenate(got) if got else np.zeros(0)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _start(t: Texts, y: np.ndarray, rng: np.random.Generator) -> tuple[Cnn, np.ndarray]:
    """A model whose first embedding value is the cautious log-odds of the
    bucket's presence, and the buckets that are trained."""
    n_docs = len(y)
    seen = np.zeros((2, BUCKETS))
    for start in range(0, n_docs, 256):  # a few texts at a time: little memory
        span = t.first[start:start + 257]
        doc = np.repeat(np.arange(start, start + len(span) - 1), np.diff(span) * SEGMENT)
        codes = t.codes[span[0] * SEGMENT:span[-1] * SEGMENT]
        real = codes < len(t.buckets)
        for k in range(t.buckets.shape[1]):
            pairs = np.unique(doc[real] * np.int64(BUCKETS) + t.buckets[codes[real], k])
            for v in (0, 1):
                seen[v] += np.bincount(pairs[y[pairs // BUCKETS] == v] % BUCKETS, minlength=BUCKETS)
    n0, n1 = max(1, int((y == 0).sum())), max(1, int((y == 1).sum()))
    odds = np.log((seen[1] + 0.5) / (n1 + 1)) - np.log((seen[0] + 0.5) / (n0 + 1))
    odds = np.maximum(odds - 2 * np.sqrt(1 / (seen[1] + 0.5) + 1 / (seen[0] + 0.5)), 0)
    use = seen.sum(axis=0) >= LEAST_DOCS
    e = rng.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32)
    e[:, 0] += odds
    e[~use] = 0
    filters = [rng.normal(0, 0.3, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    for f in filters:
        f[:, 0, :FILTERS // 2] = 1.0 / len(f) ** 0.5
    n = len(WIDTHS) * FILTERS
    return Cnn(e, filters, np.full(n, -0.3, np.float32), np.full(2 * n, 0.1), -2.0), use


def _take(t: Texts, docs: np.ndarray) -> Texts:
    spans = [np.arange(t.first[d] * SEGMENT, t.first[d + 1] * SEGMENT) for d in docs]
    pad = np.full(max(WIDTHS), len(t.buckets), np.int32)
    codes = np.concatenate([t.codes[s] for s in spans] + [pad])
    kept, small = np.unique(codes, return_inverse=True)
    real = kept < len(t.buckets)
    small = np.where(real[small], small, int(real.sum())).astype(np.int32)
    return Texts(t.buckets[kept[real]], small, np.concatenate(([0], np.cumsum(np.diff(t.first)[docs]))))


def train(texts: pa.Array, y: np.ndarray, weight: np.ndarray, epochs: int = EPOCHS, seed: int = 3,
          batch: int = 64) -> Cnn:
    """Fit by Adam on the weighted logistic loss; embeddings by Adagrad."""
    rng = np.random.default_rng(seed)
    t = Texts.of(texts)
    m, use = _start(t, y, rng)
    params = [*m.filters, m.bias, m.weight]
    first = [np.zeros_like(p) for p in params] + [0.0]
    second = [np.zeros_like(p) for p in params] + [0.0]
    ada = np.full(m.embedding.shape, 1e-3, np.float32)
    weight = weight / weight.mean()
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for s in range(0, len(y), batch):
            docs = order[s:s + batch]
            b = _take(t, docs)
            conv = m.convolve(b)
            seg, x = m.pool(conv, b.first)
            err = (sigmoid(x @ m.weight + m.offset) - y[docs]) * weight[docs] / len(docs)
            n, seg_doc = seg.shape[1], np.repeat(np.arange(len(docs)), np.diff(b.first))
            d_mean = err[:, None] * m.weight[n:] / np.maximum(np.diff(b.first), 1)[:, None]
            d_top = err[:, None] * m.weight[:n]
            g = d_mean[seg_doc] + np.where(seg >= x[seg_doc, :n], d_top[seg_doc], 0)
            g[seg <= 0] = 0
            at = conv.argmax(axis=1) + np.arange(len(seg))[:, None] * SEGMENT
            vec = np.vstack((m.embedding[b.buckets].sum(axis=1), np.zeros((1, DIM), np.float32)))
            d_vec = np.zeros(vec.shape, np.float64)
            grads = []
            for k, w in enumerate(WIDTHS):
                own = slice(k * FILTERS, (k + 1) * FILTERS)
                row, col = np.nonzero(g[:, own])
                gv, where = g[:, own][row, col], at[:, own][row, col]
                df = np.zeros_like(m.filters[k], dtype=np.float64)
                for j in range(w):
                    code = b.codes[where + j]
                    for c in range(FILTERS):
                        of = col == c
                        df[j, :, c] = gv[of] @ vec[code[of]]
                    np.add.at(d_vec, code, gv[:, None] * m.filters[k][j][:, col].T)
                grads.append(df)
            grads += [g.sum(axis=0), x.T @ err + 1e-4 * m.weight, float(err.sum())]
            step += 1
            for i, gr in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * gr
                second[i] = 0.999 * second[i] + 0.001 * gr * gr
                move = 0.02 * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
                if i < len(params):
                    params[i] -= move.astype(params[i].dtype)
                else:
                    m.offset -= float(move)
            hit = np.flatnonzero(np.abs(d_vec[:-1]).sum(axis=1) > 0)
            for k in range(b.buckets.shape[1]):
                rows, d = b.buckets[hit, k], d_vec[hit].astype(np.float32)
                keep = use[rows]
                rows, d = rows[keep], d[keep]
                np.add.at(ada, rows, d * d)
                np.add.at(m.embedding, rows, -0.02 * d / np.sqrt(ada[rows]))
    return m


def calibrate(counts: np.ndarray, fitted: np.ndarray, precision: float = 0.95, least: int = 20) -> float | None:
    """The lowest of ``STEPS`` with that precision, from (label, steps reached)
    counts; None with too few rows of a label. Each label's rows stand for the
    ``fitted`` rows of the label too, which have no fair score: the precision
    is that at the mix of all labelled rows."""
    own = counts.sum(axis=1)
    if own.min() < least:
        return None
    weight = (own + fitted) / own
    for i, t in enumerate(STEPS):
        hit = counts[:, i + 1:].sum(axis=1) * weight
        if hit.any() and hit[1] >= precision * hit.sum():
            return t
    return STEPS[-1]


def _aside(id_col: str) -> Column:
    """A fifth of the ids that is never fitted on, so that small tables have rows to calibrate on."""
    return F.pmod(F.xxhash64(F.col(id_col), F.lit("aside")), F.lit(5)) == 0


def _set_thresholds(docs: DataFrame, labels: DataFrame, fitted: DataFrame, taken: dict[str | None, np.ndarray],
                    model: Cnn) -> None:
    """Thresholds by language and over all, from the scores of all labelled
    rows that weren't fitted on; ``taken`` counts those that were, by label."""
    lang = docs["lang"] if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"), lang.alias("lang"))
    scores = _scored(rows.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))), model, "lang")
    reached = sum((F.col("score") >= F.lit(t)).cast("int") for t in STEPS)
    # texts aren't dealt out: rows are scored first; at most 2 * sample ids
    got = (scores.join(labels, F.col("doc_id") == F.col("id")).join(F.broadcast(fitted), "id", "left_anti")
           .groupBy("lang", "y", reached.alias("reached")).agg(F.count(F.lit(1)).alias("n")).collect())
    counts: dict[str | None, np.ndarray] = {}
    for r in got:
        counts.setdefault(r["lang"], np.zeros((2, len(STEPS) + 1)))[r["y"], r["reached"]] += r["n"]
    if counts:
        model.threshold = calibrate(sum(counts.values()), sum(taken.values())) or THRESHOLD
    for name, own in counts.items():
        t = calibrate(own, taken.get(name, np.zeros(2)))
        if name is not None and t is not None:
            model.thresholds[name] = t


def fit(spark: SparkSession, docs: DataFrame, sf_dir: str, sample: int = SAMPLE, longest: int = LONGEST) -> Cnn:
    """The classifier, from at most ``sample`` rows of each label; all other
    labelled rows, a fifth of the ids at least, calibrate the thresholds by
    language. Without both labels the score is 0 for every text."""
    labels = fit_labels(spark, sf_dir, "toxic")
    totals = {r["y"]: r["n"] for r in labels.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = fit_sample(docs, labels.filter(~_aside("id")), sample, longest).orderBy("id").toArrow()
    if len(rows["y"].unique()) < 2:
        rows = fit_sample(docs, labels, sample, longest).orderBy("id").toArrow()
    y = rows["y"].to_numpy().astype(np.int64)
    if len(set(y.tolist())) < 2:
        n = len(WIDTHS) * FILTERS
        return Cnn(np.zeros((BUCKETS, DIM), np.float32), [np.zeros((w, DIM, FILTERS), np.float32) for w in WIDTHS],
                   np.zeros(n, np.float32), np.zeros(2 * n), -40.0)
    weight = np.array([totals[v] / max(1, (y == v).sum()) for v in y.tolist()], np.float64)
    model = train(pa.concat_arrays(rows["text"].chunks).cast(pa.string()), y, weight)
    fitted = spark.createDataFrame([(i,) for i in sorted(set(rows["id"].to_pylist()))], "id long")
    taken: dict[str | None, np.ndarray] = {}
    for name, v in zip(rows["lang"].to_pylist(), y.tolist()):
        taken.setdefault(name, np.zeros(2))[v] += 1
    del rows
    give_back()
    _set_thresholds(docs, labels, fitted, taken, model)
    return model


def _scored(rows: DataFrame, model: Cnn, *more: str) -> DataFrame:
    """(doc_id, ``more``, score) of (doc_id, text, ``more``), one row per row."""
    arrow_settings(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(model)  # fixed size
    names = ["doc_id", *more]
    schema = T.StructType([*[rows.schema[n] for n in names], T.StructField("score", T.DoubleType())])

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*[b.column(b.schema.get_field_index(n)) for n in names],
                                              pa.array(shared.value.score(text_column(b)))], names=[*names, "score"])

    return rows.mapInArrow(tidy(run), schema)


def toxicity_scores(docs: DataFrame, model: Cnn) -> DataFrame:
    """(doc_id, held_out, score, toxic), one row per row; whole texts, a null
    text scores as an empty one. ``toxic``: the score reaches the threshold of
    the row's language (that over all for a null or uncalibrated language)."""
    lang = docs["lang"] if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"), lang.alias("lang"))
    cut = F.lit(model.threshold)
    if model.thresholds:  # one entry a language with enough labels
        of = F.create_map(*[F.lit(v) for pair in model.thresholds.items() for v in pair])
        cut = F.coalesce(F.try_element_at(of, F.col("lang")), cut)
    return _scored(rows, model, "lang").select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                                               (F.col("score") >= cut).alias("toxic"))


def drop_toxic(docs: DataFrame, model: Cnn) -> DataFrame:
    """The rows of ``docs``, all columns, whose score stays below their
    language's threshold (that over all for a null or uncalibrated language)."""
    arrow_settings(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns

    def run(batches):
        m = shared.value
        for b in batches:
            score = m.score(text_column(b))
            lang = b.column(names.index("lang")).to_pylist() if "lang" in names else [None] * b.num_rows
            most = np.array([m.thresholds.get(v, m.threshold) for v in lang])
            yield b.filter(pa.array(score < most))

    return docs.mapInArrow(tidy(run), docs.schema)
