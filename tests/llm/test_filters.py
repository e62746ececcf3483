"""op1, op3, op8, op10 and the pipeline."""

import sys
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from helpers import awkward, empty, rows, words  # noqa: E402
import corpus_pipeline  # noqa: E402
from riskbeacon.llm import licenses, mixing, quality, queries, toxicity  # noqa: E402

SMALL = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def sql_rows(sql, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con.execute(sql).fetchall()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql_of_queries(spark, name):
    got = [tuple(r) for r in queries.QUERIES[name](spark, "/root/testdata/sf0.001").collect()]
    assert Counter(got) == Counter(sql_rows(queries.ORACLE_SQL[name], "/root/testdata/sf0.001"))


def level_targets(sizes, weights=(5, 2, 1), most=3):
    """Excess reshared by weight until none is above."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {s for s in names if not sizes[s]}
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        open_ = [s for s in names if s not in capped]
        t = {s: left * w[s] / sum(w[o] for o in open_) for s in open_}
        over = {s for s in open_ if t[s] > most * sizes[s]}
        if not over:
            return {s: float(most * sizes[s]) if s in capped else t[s] for s in names}
        capped |= over


def test_mix_targets_and_copies(spark):
    rng = np.random.default_rng(4)
    texts = [(" ".join(["w"] * int(n)), "en", f"s{int(s)}") for n, s in zip(rng.integers(0, 40, 3000), rng.integers(0, 9, 3000)
                                                                            ** 2 // 9)]
    df = rows(spark, texts + [("a b", "en", None), (None, None, "s0"), ("", "en", "none")])
    plan = mixing.mix_plan(df).collect()
    sizes = Counter()
    for t, _, s in texts + [("a b", "en", None), (None, None, "s0"), ("", "en", "none")]:
        sizes[s] += len(words(t))
    want = level_targets(dict(sizes))
    source = [s for _, _, s in texts] + [None, "s0", "none"]
    taken = Counter()
    for r in plan:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6
        assert r.taken == r.size * r.copies and r.copies <= 3
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.2 * want[s] + 60 for s in want)
    assert sorted((r.doc_id, r.copies) for r in mixing.mix_plan(df.repartition(5)).collect()) == sorted(
        (r.doc_id, r.copies) for r in plan)
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    assert Counter(r.doc_id for r in mixed.select("doc_id").collect()) == Counter(
        {r.doc_id: r.copies for r in plan if r.copies})


def test_mix_awkward(spark):
    df = awkward(spark)
    assert mixing.mix_plan(df).count() == df.count()
    assert mixing.mix(empty(spark)).count() == 0 and mixing.mix_plan(empty(spark)).count() == 0


def outside(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


@pytest.mark.parametrize("name,label,least", [("op3_toxicity", "toxic", 0.85), ("op10_quality", "quality", 0.97)])
def test_held_out_accuracy(spark, name, label, least):
    got = {r.doc_id: r for r in queries.QUERIES[name](spark, SMALL).collect()}
    y = dict(sql_rows(f"SELECT doc_id, {label} FROM labels", SMALL))
    assert all(r.held_out == outside(i) and 0 <= r.score <= 1 for i, r in got.items())
    pos = [got[i].score for i, v in y.items() if v == 1 and outside(i)]
    neg = [got[i].score for i, v in y.items() if v == 0 and outside(i)]
    above = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert above >= least


@pytest.fixture(scope="module")
def labelled(spark, tmp_path_factory):
    """Awkward documents with labels, nulls and contradictions among them."""
    d = tmp_path_factory.mktemp("labelled")
    data = [(i, i % 2, (i + 1) % 2) for i in range(12)] + [(None, 1, 1), (3, None, None), (4, 1, 0)]
    spark.createDataFrame(data, LABELS).write.parquet(f"{d}/labels.parquet")
    return str(d)


def test_classifiers_take_awkward_rows(spark, labelled):
    df = awkward(spark)
    for docs in (df, empty(spark)):
        model = toxicity.fit(spark, docs, labelled)
        assert toxicity.toxicity_scores(docs, model).count() == docs.count()
        assert quality.quality_scores(spark, docs, labelled).count() == docs.count()
        assert toxicity.drop_toxic(docs, model).columns == docs.columns
        assert quality.drop_low_quality(spark, docs, labelled).schema == docs.schema
    scores = quality.quality_scores(spark, df, labelled).collect()
    assert all(0 <= r.score <= 1 for r in scores)


@pytest.fixture(scope="module")
def many_labels(spark, tmp_path_factory):
    """6,000 labelled texts, a sixth of them toxic, 8 % in a rare language."""
    d, rng = tmp_path_factory.mktemp("many"), np.random.default_rng(4)
    texts, data = [], []
    for i in range(6000):
        y = int(rng.random() < 1 / 6)
        own = [f"w{v}" for v in rng.integers(0, 300, 30)] + (["vile"] * y if rng.random() < 0.9 else ["vile"])
        texts.append((" ".join(rng.permutation(own)), "xx" if rng.random() < 0.08 else "en", "s"))
        data.append((i, 1, y))
    spark.createDataFrame(data, LABELS).write.parquet(f"{d}/labels.parquet")
    return rows(spark, texts).cache(), str(d)


def test_rare_language_is_calibrated(spark, many_labels):
    """A language with few rows in the fit sample has a threshold from all its labelled rows."""
    model = toxicity.fit(spark, *many_labels, sample=200)
    assert set(model.thresholds) == {"en", "xx"}


def test_thresholds_at_the_mix_of_all_labels():
    """Rows left for calibration at another mix than all rows: the threshold doesn't move."""
    natural = np.zeros((2, 12))
    natural[0, [0, 2, 5, 8]] = 7600, 240, 120, 40
    natural[1, [2, 5, 8, 11]] = 100, 100, 200, 600
    want = toxicity.calibrate(natural, np.zeros(2))
    for left in ((0.125, 1), (1, 0.1)):
        part = natural * np.array(left)[:, None]
        assert toxicity.calibrate(part, (natural - part).sum(axis=1)) == want


def test_thresholds_keep_their_precision(spark, many_labels):
    """Where the fit sample takes most toxic rows, precision holds over all labelled rows."""
    docs, d = many_labels
    model = toxicity.fit(spark, docs, d, sample=600)
    kept = {r.doc_id for r in toxicity.drop_toxic(docs, model).select("doc_id").collect()}
    gone = [r.toxic for r in spark.read.parquet(f"{d}/labels.parquet").collect() if r.doc_id not in kept]
    scores = toxicity.toxicity_scores(docs, model).collect()
    assert np.mean(gone) >= 0.85 and len(scores) == 6000
    assert {r.doc_id for r in scores if not r.toxic} == kept


def test_discriminant_against_densities():
    rng = np.random.default_rng(1)
    x = [rng.multivariate_normal([0, 0], [[1, 0.5], [0.5, 2]], 4000), rng.multivariate_normal([2, 1], np.eye(2), 2000)]
    m = quality.Discriminant.of(np.array([4000.0, 2000.0]), np.array([v.sum(axis=0) for v in x]),
                                np.array([v.T @ v for v in x]))
    right = [(m.score(x[0]) < 0.5).mean(), (m.score(x[1]) >= 0.5).mean()]
    assert min(right) > 0.75


def test_license_lines(spark):
    texts = ["A story.\nReleased under the MIT License.\nMore of the story.",
             "Licensed under CC BY-NC 4.0.\nLicensed under CC BY-SA 4.0.",
             "This work is licensed under the GNU General Public License, version 3.",
             "He lost his driving license in the library.", "The apache helicopter version was free.", None, "",
             "word " * 20000 + "\nlicensed under the apache license, version 2.0"]
    df = rows(spark, texts)
    got = sorted((r.doc_id, r.line, r.family) for r in licenses.license_lines(df.unionByName(df.filter("doc_id = 0"))).filter(
        "confirmed").collect())
    assert got == [(0, 1, "MIT"), (0, 1, "MIT"), (1, 0, "CC-BY-NC"), (1, 1, "CC-BY-SA"), (2, 0, "GPL-3.0"),
                   (7, 1, "Apache-2.0")]
    assert licenses.license_lines(awkward(spark)).filter("confirmed").count() == 0
    assert licenses.license_lines(empty(spark)).count() == 0
    plan = licenses.license_lines(df)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow"))


def test_wrapped_license_notices(spark):
    """Notices over several lines, with marks of comments, are found where they begin, once each."""
    mit = ("/*\n * Permission is hereby granted, free of charge, to any person obtaining\n * a copy of this software and "
           "associated documentation files, to deal\n * in the Software without restriction.\n */\nint x;")
    gpl = ("# This program is free software: you can redistribute it\n# and/or modify it under the terms of the GNU General "
           "Public\n# License as published by the Free Software Foundation, either\n# version 3 of the License, or any later "
           "version.")
    apart = "Permission is hereby granted, free of charge,\n\nto nobody.\n\nDeal in the Software without restriction."
    got = licenses.license_lines(rows(spark, [mit, gpl, apart, f"{mit}\n\n{mit}"])).filter("confirmed").collect()
    assert sorted((r.doc_id, r.line, r.family) for r in got) == [(0, 1, "MIT"), (1, 0, "GPL-3.0"), (3, 1, "MIT"), (3, 8, "MIT")]


def test_licenses_named_and_granted(spark):
    """Identifiers and grants of families that the corpus doesn't hold; sentences that grant nothing;
    notices wrapped over many lines."""
    import textwrap
    grant = next(t for f, t in licenses.TEMPLATES if f == "MIT" and "sublicense" in t)
    texts = {
        "SPDX-License-Identifier: MIT": "MIT", "/* SPDX-License-Identifier: GPL-2.0-or-later */": "GPL-2.0",
        "This is free and unencumbered software released into the public domain.": "Unlicense",
        "The whole thing is distributed under the Mozilla Public License 2.0.": "MPL-2.0",
        "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby "
        "granted, provided that the above\ncopyright notice and this permission notice appear in all copies.": "ISC",
        "\n".join("// " + x for x in textwrap.wrap(grant, 34)): "MIT", "\n".join(grant.split()): "MIT",
        "\n".join(" " * 2000 + x for x in textwrap.wrap(grant, 60)): "MIT",
        "You may not license this work under the MIT license without asking.": None,
        "Our engine was never released under the Apache License 2.0.": None,
        "This code is not licensed under the GNU General Public License, version 3.": None}
    got = {(r.doc_id, r.line, r.family) for r in licenses.license_lines(rows(spark, list(texts))).filter("confirmed").collect()}
    assert got == {(i, 0, f) for i, f in enumerate(texts.values()) if f}


def test_license_scores_against_a_plain_scorer(spark):
    """Every distinct line of the small corpus, scored by a loop over its n-grams."""
    import math
    import re
    seen = {line for _, t in sql_rows("SELECT doc_id, text FROM documents", SMALL) for line in (t or "").split("\n")}
    texts = sorted(seen) + ["Not released under the MIT License.", "spdx-license-identifier: ISC", "license " * 3000]
    table, families, intercepts, thresholds = licenses.train(spark)
    weights = {r.gram: r.w for r in table.collect()}
    shapes = [(f, licenses.shape(t)) for f, t in licenses.TEMPLATES]
    held = set(licenses.anchors())
    want = {}
    for i, text in enumerate(texts):
        words = re.findall(licenses.WORDS_RE, text.lower())
        own = licenses._grams(words)
        known = [weights[g] for g in own if g in weights]
        z = [b + math.fsum(w[k] for w in known) for k, b in enumerate(intercepts)]
        e = [math.exp(v - max(z)) for v in z]
        p, k = max((e[k] / sum(e), -k) for k in range(1, len(e)) if e[k] / sum(e) >= thresholds[families[k]] or k == 1)
        family = families[-k]
        if p < thresholds[family]:
            continue
        similar = max(len(own & shape) / len(shape) for f, shape in shapes if f == family)
        if re.search("(?<![a-z0-9])(?:" + "|".join(map(re.escape, held)) + ")(?![a-z0-9])", text.lower()):
            want[i] = (family, round(p, 6), round(similar, 6))
        else:
            assert similar < licenses.CONFIRM
    got = {r.doc_id: (r.family, round(r.probability, 6), round(r.similarity, 6))
           for r in licenses.license_lines(rows(spark, texts)).collect()}
    assert got == want and want


def test_license_lines_against_the_corpus(spark):
    """Every line of the small corpus that is a template is found, and no other."""
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    bare = {t.lower(): f for f, t in licenses.TEMPLATES}
    want = Counter((i, n, bare[line.lower()]) for i, t in sql_rows("SELECT doc_id, text FROM documents", SMALL)
                   for n, line in enumerate((t or "").split("\n")) if line.lower() in bare)
    got = Counter((r.doc_id, r.line, r.family) for r in licenses.license_lines(df).filter("confirmed").collect())
    assert got == want and want


def test_anchors_bound_what_is_missed():
    import math
    held = set(licenses.anchors())
    for _, t in licenses.TEMPLATES:
        grams = licenses.shape(t)
        assert sum(not held.intersection(g.split()) for g in grams) < math.ceil(licenses.CONFIRM * len(grams))


def test_pairs_bound_what_windows_miss():
    import math
    held = licenses.pairs()
    for _, t in licenses.TEMPLATES:
        grams = licenses.shape(t)
        free = [g for g in grams if not any(f" {p} " in f" {g} " for p in held)]
        assert len(free) < math.ceil(licenses.CONFIRM * len(grams))


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    y = {i: (q, t) for i, q, t in sql_rows("SELECT doc_id, quality, toxic FROM labels", SMALL)}
    seen = [r.doc_id for r in docs.select("doc_id").collect()]
    assert len(corpus_pipeline.STAGES) == 5
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SMALL)
        out.write.parquet(f"{tmp_path}/{k}")
        got = spark.read.parquet(f"{tmp_path}/{k}")
        ids = [r.doc_id for r in got.select("doc_id").collect()]
        if k < 4:
            assert got.columns == docs.columns
        if k < 2:
            at, bad = (1, 1) if k == 0 else (0, 0)
            known = [i for i in seen if i in y]
            kept = set(ids)
            assert np.mean([i in kept for i in known if y[i][at] != bad]) > 0.97
            assert np.mean([i not in kept for i in known if y[i][at] == bad]) > 0.7
        if k == 2:
            assert len(ids) == len(set(ids)) < len(seen)
        if k == 3:
            assert set(ids) <= set(seen) and max(Counter(ids).values()) <= 3
        if k == 4:
            assert set(ids) == set(seen)
        docs, seen = got, ids


def test_pipeline_on_awkward_and_empty_tables(spark, labelled, tmp_path):
    """All stages as run() chains them: every row that stays is packed, rows without text too."""
    names = ["doc_id", "text", "lang", "source", "n_chars", "size", "copies"]
    for k, docs in enumerate((awkward(spark), empty(spark))):
        d = f"{tmp_path}/{k}"
        docs.select(*names).write.parquet(f"{d}/documents.parquet")
        spark.read.parquet(f"{labelled}/labels.parquet").write.parquet(f"{d}/labels.parquet")
        got = corpus_pipeline.run(spark, d).collect()
        assert all(r.length >= 0 and 0 <= r.offset < 4096 and r.doc_tokens >= 1 for r in got)
        known = {r.doc_id for r in docs.select("doc_id").collect()}
        assert {r.doc_id for r in got} <= known and (len(got) > 0) == (k == 0)
