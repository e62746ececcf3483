"""Licence scan: a paragraph classifier, with DataFrame functions only.

Paragraphs are the lines of a text, and windows of consecutive lines for
notices that are wrapped: every window in which a statement of as many words
as the longest template can lie, however it is wrapped. Lines with an anchor word (below) are
described by their word n-grams; a sparse multinomial logistic regression,
trained here on variants of the templates and on sentences that name a
licence without granting it, gives each licence family a probability, and one
for "unknown". A family is predicted where its probability reaches the
family's threshold, which is set on wordings that training didn't see; the
prediction is confirmed where the line holds enough of the n-grams of one of the family's
templates. Only distinct lines are classified; their occurrences are joined
to the result.

Anchors: a set of template words such that a line without any of them can't
hold ``CONFIRM`` of any template's n-grams. Such a line is unknown. Windows need a word pair chosen in
the same way; marks of comments are no words, and a line without a word ends
a paragraph.
"""

from __future__ import annotations

import math
import random
import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskbeacon.llm.common import Scratch

# Statements by which public licences are named or granted.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License."),
    ("Apache-2.0", "Released under the Apache License 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                "or any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL", "This library is licensed under the GNU Lesser General Public License, version 2.1 or later."),
    ("LGPL", "Released under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD", "Released under the BSD 3-Clause License."),
    ("BSD", "Licensed under the BSD 2-Clause License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("CC-BY", "Licensed under CC BY 4.0."),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0", "Dedicated to the public domain under CC0 1.0."),
    ("CC0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in "
                  "source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any "
                  "means."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
                "License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation; either version 2 of the License, "
                "or (at your option) any later version."),
    ("LGPL", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation; either version 2.1 of the License, "
             "or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                 "Affero General Public License as published by the Free Software Foundation, either version 3 of the "
                 "License, or (at your option) any later version."),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, "
             "and to alter it and redistribute it freely, subject to the following restrictions:"),
]
# Names of the families' licences in prose, and their identifiers in files
NAMES = [
    ("Apache-2.0", "Apache License 2.0"), ("MIT", "MIT License"), ("GPL-3.0", "GNU General Public License, version 3"),
    ("GPL-2.0", "GNU General Public License, version 2"), ("LGPL", "GNU Lesser General Public License"),
    ("AGPL-3.0", "GNU Affero General Public License"), ("BSD", "BSD 3-Clause License"),
    ("MPL-2.0", "Mozilla Public License 2.0"), ("ISC", "ISC License"), ("EPL-2.0", "Eclipse Public License 2.0"),
    ("BSL-1.0", "Boost Software License, Version 1.0"), ("Zlib", "zlib License"),
]
SPDX = [
    ("Apache-2.0", "Apache-2.0"), ("MIT", "MIT"), ("GPL-3.0", "GPL-3.0-only"), ("GPL-3.0", "GPL-3.0-or-later"),
    ("GPL-2.0", "GPL-2.0-only"), ("GPL-2.0", "GPL-2.0-or-later"), ("LGPL", "LGPL-2.1-only"), ("LGPL", "LGPL-2.1-or-later"),
    ("LGPL", "LGPL-3.0-only"), ("LGPL", "LGPL-3.0-or-later"), ("AGPL-3.0", "AGPL-3.0-only"),
    ("AGPL-3.0", "AGPL-3.0-or-later"), ("BSD", "BSD-2-Clause"), ("BSD", "BSD-3-Clause"), ("MPL-2.0", "MPL-2.0"),
    ("CC-BY", "CC-BY-4.0"), ("CC-BY-SA", "CC-BY-SA-4.0"), ("CC-BY-NC", "CC-BY-NC-4.0"), ("CC0", "CC0-1.0"), ("ISC", "ISC"),
    ("Unlicense", "Unlicense"), ("EPL-2.0", "EPL-2.0"), ("BSL-1.0", "BSL-1.0"), ("Zlib", "Zlib"),
]
GRANTS = ["Licensed under the {}.", "Released under the {}.", "This project is licensed under the terms of the {}."]
TEMPLATES += [(f, g.format(name)) for f, name in NAMES for g in GRANTS if (f, g.format(name)) not in TEMPLATES]
TEMPLATES += [(f, f"SPDX-License-Identifier: {name}") for f, name in SPDX]
# the same said in words that no template has, for the thresholds alone
UNSEEN_GRANTS = ["Distributed under the {}.", "All code here is made available under the {}.", "Its license is the {}."]
# sentences that name a licence and grant nothing: fitted on, and for the thresholds alone
DENIALS = [
    "You may not license this work under the {} without asking.", "This work is not licensed under the {}.",
    "It was never released under the {}.", "This is no longer licensed under the {}.",
    "She wrote an article about the {} and its history.", "The {} doesn't apply to these files.",
    "We cannot release this project under the {}.", "Do not use code licensed under the {} here.",
    "He asked whether it is licensed under the {}.", "Nothing in this book is released under the {}.",
    "They refused to publish it under the terms of the {}.", "Is this project licensed under the {}?",
]
UNSEEN_DENIALS = [
    "The work may not be released under the {} without our consent.", "Our library was never licensed under the {}.",
    "Read a story about the {} and the people who wrote it.", "This project isn't and will not be licensed under the {}.",
    "The author cannot license it under the {}.",
]
OTHER = [
    "The driver showed a license and the officer wrote the version down.",
    "You may need a license to fish in public waters.",
    "Her work in the public library is licensed by the state.",
    "Read the terms of this work before you use the library.",
    "The committee released a report under the law of the land.",
    "Public domain names were registered by the author.",
    "The software license expired and the project was closed.",
    "General conditions of use are met in this form.",
    "The foundation has published the following documentation.",
    "Copyright law is a public matter and the rights are related.",
    "Permission to enter the building is granted at the gate.",
    "The creative director commons room is open to any person.",
    "A poetic license is not a license at all.",
    "He obtained a copy of the permit free of charge.",
    "The source of the river is subject to change without restriction.",
]
UNSEEN_OTHER = [
    "The library has a public license desk and a version of the map.",
    "A general was free to work under the terms of the peace.",
    "The notice in the file says that the software is old.",
    "Permission was granted to any person with a copy of the form.",
    "The mayor signed a commercial license for the public market.",
]
UNKNOWN = "unknown"
CONFIRM = 0.6      # share of a template's n-grams that a line must hold
GRAMS = 3          # n-grams of one to so many words
VARIANTS = 12      # of each training sentence
WORDS_RE = r"[a-z0-9]+(?:[.+-][a-z0-9]+)*"
LONGEST = max(len(re.findall(WORDS_RE, t.lower())) for _, t in TEMPLATES)  # words of a template: lines of a window, at most
EDGE = 2 * max(len(t) for _, t in TEMPLATES)  # characters of a window's line, runs of other signs taken as one
# words that are too common to anchor a search
_COMMON = set("the of a to is in and or this that for by any under it you with are all on has was at be as without "
              "not work use can may use version terms general public following".split())


def _grams(words: list[str]) -> set[str]:
    return {" ".join(words[i:i + n]) for n in range(1, GRAMS + 1) for i in range(len(words) - n + 1)}


def shape(text: str) -> set[str]:
    """The n-grams of a template that are compared: of an identifier of two
    words only the pair, for the two words apart say nothing."""
    words = re.findall(WORDS_RE, text.lower())
    return {" ".join(words)} if len(words) == 2 else _grams(words)


def anchors(templates: list[tuple[str, str]] = TEMPLATES, confirm: float = CONFIRM) -> list[str]:
    """Words without which no line reaches ``confirm`` of any template: for
    each template its rarer words are taken until the n-grams that hold none
    of them are too few."""
    bags = [re.findall(WORDS_RE, t.lower()) for _, t in templates]
    spread = {w: sum(w in b for b in bags) for b in bags for w in b}
    taken: set[str] = set()
    for bag, (_, text) in zip(bags, templates):
        grams = shape(text)
        rest = sorted((w for w in set(bag) - _COMMON), key=lambda w: (-spread[w], -len(w), w))
        rest += sorted(set(bag) & _COMMON, key=lambda w: (-len(w), w))
        for w in rest:
            free = sum(not taken.intersection(g.split()) for g in grams)
            if free < math.ceil(confirm * len(grams)):
                break
            taken.add(w)
    return sorted(taken)


def pairs(templates: list[tuple[str, str]] = TEMPLATES, confirm: float = CONFIRM) -> list[str]:
    """Word pairs without which no window reaches ``confirm`` of any template."""
    taken: set[str] = set()
    for _, text in templates:
        bag = re.findall(WORDS_RE, text.lower())
        all_grams = shape(text)
        own = sorted({f"{a} {b}" for a, b in zip(bag, bag[1:])},
                     key=lambda g: (sum(w in _COMMON for w in g.split()), -len(g), g))
        for pair in own:
            if sum(not any(f" {t} " in f" {g} " for t in taken) for g in all_grams) < math.ceil(confirm * len(all_grams)):
                break
            taken.add(pair)
    return sorted(taken)


def _phrases(phrases: list[str]) -> str:
    """A pattern of any of the phrases, whatever but words between their words."""
    words = ["[^a-z0-9]+".join(re.escape(w) for w in p.split()) for p in phrases]
    return "(?i)(?<![a-z0-9])(?:" + "|".join(words) + ")(?![a-z0-9])"


def windows(rows: DataFrame) -> DataFrame:
    """(doc_id, doc, line, n, content): ``n`` consecutive lines from ``line`` as one,
    for two lines or more that may hold a wrapped notice. A line that holds a
    whole template is none of them. A statement of at most ``LONGEST`` words
    lies in one of the windows, at whatever words it is wrapped: the lines
    between a window's first and last one hold fewer words than that."""
    some = _phrases(pairs())
    whole = _phrases(sorted({" ".join(re.findall(WORDS_RE, t.lower())) for _, t in TEMPLATES}))
    # an empty string ends a paragraph; explode keeps the arrays from being computed again for each line
    lines = F.transform(F.split("text", "\n", -1), lambda s: F.when(
        s.rlike("[A-Za-z0-9]") & ~s.rlike(whole), F.trim(F.regexp_replace(s, "[^A-Za-z0-9.+-]+", " "))).otherwise(""))
    rows = rows.filter(F.col("text").rlike(some)).select("doc_id", "doc", F.explode(F.array(lines)).alias("ls"))
    # a pair lies in a line, or at the end of one and the start of the next
    tail = F.transform("ls", lambda s: F.substring(s, -EDGE, EDGE))
    head = F.transform("ls", lambda s: F.substring(s, 1, EDGE))
    rows = rows.select("doc_id", "doc", "ls", F.explode(F.array(F.struct(tail.alias("tail"), head.alias("head")))).alias("cut"))
    held = F.transform("ls", lambda s, i: s.rlike(some) | F.concat_ws(" ", s, F.get("cut.head", i + 1)).rlike(some))
    rows = rows.select("doc_id", "doc", "cut", F.explode(F.array(held)).alias("held"))
    # only lines that a pair follows carry the lines after them
    rows = rows.withColumn("after", F.transform("cut.tail", lambda s, i: F.when(
        (s != "") & F.exists(F.slice("held", i + 1, LONGEST), lambda h: h),
        F.concat(F.array(s), F.slice("cut.head", i + 2, LONGEST - 1)))))
    rows = rows.select("doc_id", "doc", F.posexplode("after").alias("line", "after")).filter("after IS NOT NULL")
    rows = rows.withColumn("end", F.array_position("after", ""))
    rows = rows.withColumn("end", F.when(F.col("end") > 0, F.col("end") - 1).otherwise(F.size("after")).cast("int"))
    rows = rows.filter("end >= 2").withColumn("after", F.slice("after", F.lit(1), F.col("end")))
    rows = rows.filter(F.array_join("after", " ").rlike(some))
    sizes = F.transform("after", lambda s: F.regexp_count(F.lower(s), F.lit(WORDS_RE)))
    rows = rows.select("doc_id", "doc", "line", "end", "after", F.explode(F.array(sizes)).alias("sizes"))
    rows = rows.withColumn("n", F.explode(F.filter(F.sequence(F.lit(2), F.col("end")), lambda n: F.aggregate(
        F.slice("sizes", F.lit(2), n - 2), F.lit(0), lambda a, v: a + v) <= LONGEST - 2)))
    return rows.select("doc_id", "doc", "line", "n", F.array_join(F.slice("after", F.lit(1), F.col("n")), " ").alias("content")).filter(
        F.col("content").rlike(some))


def line_words(line: Column) -> Column:
    return F.regexp_extract_all(F.lower(line), F.lit(f"({WORDS_RE})"), 1)


def grams(words: Column) -> Column:
    """Distinct n-grams of a column of words (a column: the lambdas read it often)."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(words), F.lit(1)))

    def runs_of(n: int) -> Column:
        inside = F.filter(starts, lambda i: i + F.lit(n - 1) <= F.size(words))
        return F.transform(inside, lambda i: F.array_join(F.slice(words, i, n), " "))

    parts = [words, *[runs_of(n) for n in range(2, GRAMS + 1)]]
    return F.array_distinct(F.concat(*parts))


def _variants(seed: int, unseen: bool = False) -> list[tuple[str, str]]:
    """(family, sentence): templates with words left out, words before and
    after, sentences that grant nothing, and shuffled templates as unknown.
    ``unseen`` gives other wordings of grants and of the rest instead."""
    rng = random.Random(seed)
    filler = "see the file notice for details from project data by author team 2020 copyright code page text".split()
    grants = [(f, g.format(name)) for f, name in NAMES for g in UNSEEN_GRANTS] if unseen else TEMPLATES
    other = UNSEEN_OTHER if unseen else OTHER
    denials = [d.format(name) for _, name in NAMES for d in (UNSEEN_DENIALS if unseen else DENIALS)]
    out = []
    for family, text in [*grants, *((UNKNOWN, t) for t in [*other, *denials])]:
        words = text.split()
        out.append((family, text))
        for _ in range(VARIANTS if family != UNKNOWN or text in other else 2):
            # a denial keeps all its words: without one it may be a grant
            kept = words if family == UNKNOWN else [w for w in words if rng.random() > 0.06] or words
            lead = rng.sample(filler, rng.randint(0, 3))
            tail = rng.sample(filler, rng.randint(0, 3))
            out.append((family, " ".join([*lead, *kept, *tail])))
        if family != UNKNOWN and len(words) > 4:
            for _ in range(VARIANTS // 2):
                mixed = rng.sample(words, max(1, len(words) // 2))
                out.append((UNKNOWN, " ".join([*rng.sample(filler, 4), *mixed])))
    return out


def train(spark: SparkSession) -> tuple[DataFrame, list[str], list[float], dict[str, float]]:
    """(weights by n-gram, families, intercepts, thresholds).

    The weight table has a row for each n-gram of the sentences fitted on,
    with a weight for each family: bounded by the templates. A family's
    threshold lies half way between the best score for it of wordings that
    grant it nothing and the lowest tenth of its own, both of wordings unseen
    when fitting (of variants, for families that only a template names),
    within 0.3 and 0.9.
    """
    families = [UNKNOWN, *dict.fromkeys(f for f, _ in TEMPLATES)]
    fitted = [*(t for _, t in TEMPLATES), *OTHER, *(d.format(name) for _, name in NAMES[:1] for d in DENIALS)]
    vocab = sorted(set().union(*(_grams(re.findall(WORDS_RE, t.lower())) for t in fitted)))
    vectors = CountVectorizerModel.from_vocabulary(vocab, "grams", "features")
    vectors.setBinary(True)

    def rows(pairs: list[tuple[str, str]]) -> DataFrame:
        data = [(float(families.index(f)), t) for f, t in pairs]
        t = spark.createDataFrame(data, "label double, line string").coalesce(1)
        return vectors.transform(t.withColumn("words", line_words(F.col("line"))).withColumn("grams", grams(F.col("words"))))

    lr = LogisticRegression(regParam=0.002, elasticNetParam=0.2, maxIter=60, family="multinomial", standardization=False)
    model = lr.fit(rows(_variants(1)))
    matrix = model.coefficientMatrix.toArray()
    table = spark.createDataFrame(
        [(g, [float(v) for v in matrix[:, i]]) for i, g in enumerate(vocab)], "gram string, w array<double>").coalesce(1)
    unseen = _variants(2, unseen=True)
    named = {f for f, _ in unseen}
    unseen += [(f, t) for f, t in _variants(3) if f not in named]
    seen = model.transform(rows(unseen)).select("label", vector_to_array("probability").alias("p"))
    thresholds = {}
    cols = [(F.max(F.when(F.col("label") != k, F.col("p")[k])).alias(f"other{k}"),
             F.percentile(F.when(F.col("label") == k, F.col("p")[k]), 0.1).alias(f"own{k}")) for k in range(len(families))]
    got = seen.agg(*[c for pair in cols for c in pair]).first()
    for k, f in enumerate(families[1:], 1):
        thresholds[f] = min(0.9, max(0.3, (got[f"other{k}"] + got[f"own{k}"]) / 2))
    return table, families, [float(v) for v in model.interceptVector.toArray()], thresholds


def license_lines(docs: DataFrame, confirm: float = CONFIRM) -> DataFrame:
    """(doc_id, line, family, probability, similarity, confirmed), a row for
    each line (numbered from 0) for which a licence family is predicted, and
    for the first line of each wrapped notice that is confirmed. Of windows and
    lines that overlap with one family confirmed, the most similar counts, then
    the shortest, then the first.

    Null and empty texts have no lines. Repeated rows repeat their result;
    the order of equally likely families is that of the template list.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "licenses")
    table, families, intercepts, thresholds = train(spark)
    words = anchors(TEMPLATES, confirm)
    pattern = "(?i)(?<![a-z0-9])(?:" + "|".join(re.escape(w) for w in words) + ")(?![a-z0-9])"
    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text")).filter(F.col("text").rlike(pattern))
    rows = rows.withColumn("doc", F.md5(F.col("text").cast("binary")))
    lines = (rows.select("doc_id", "doc", F.posexplode(F.split("text", "\n", -1)).alias("line", "content"))
             .filter(F.col("content").rlike(pattern)))
    lines = lines.select("doc_id", "doc", "line", F.lit(1).alias("n"), "content").unionByName(windows(rows))
    lines = scratch.write(lines.withColumn("key", F.md5(F.col("content").cast("binary"))), "lines")
    distinct = lines.groupBy("key").agg(F.any_value("content").alias("content"))
    worded = distinct.select("key", line_words(F.col("content")).alias("words"))
    parts = worded.select("key", F.explode(grams(F.col("words"))).alias("gram"))
    parts = scratch.write(parts.join(F.broadcast(table), "gram"), "grams")  # the templates' n-grams: bounded
    sums = parts.groupBy("key").agg(*[F.sum(F.col("w")[k]).alias(f"s{k}") for k in range(len(families))])
    # step by step, so that no expression is written out more than once
    z = sums.select("key", F.array(*[F.col(f"s{k}") + F.lit(intercepts[k]) for k in range(len(families))]).alias("z"))
    z = z.withColumn("top", F.array_max("z")).withColumn("e", F.transform("z", lambda v: F.exp(v - F.col("top"))))
    z = z.withColumn("total", F.aggregate("e", F.lit(0.0), lambda a, v: a + v))
    cut = F.array(F.lit(2.0), *[F.lit(thresholds[f]) for f in families[1:]])
    z = z.withColumn("passed", F.zip_with("e", cut, lambda v, t: F.when(v / F.col("total") >= t, v / F.col("total"))
                                          .otherwise(-1.0))).select("key", "passed")
    z = scratch.write(z.withColumn("probability", F.array_max("passed")), "scores")
    p = z.filter("probability > 0").select(
        "key", F.element_at(F.array(*[F.lit(f) for f in families]),
                            F.array_position("passed", F.col("probability")).cast("int")).alias("family"), "probability")
    shapes = [(i, family, g, len(shape(text))) for i, (family, text) in enumerate(TEMPLATES) for g in sorted(shape(text))]
    shapes = spark.createDataFrame(shapes, "template int, of string, g string, size int").coalesce(1)
    like = (parts.select("key", "gram").join(F.broadcast(shapes), F.col("gram") == F.col("g"))
            .groupBy("key", "template", "of").agg((F.count(F.lit(1)) / F.max("size")).alias("share"))
            .groupBy("key", "of").agg(F.max("share").alias("share")))
    judged = p.join(like.withColumnRenamed("key", "k"), (F.col("key") == F.col("k")) & (F.col("family") == F.col("of")),
                    "left").select("key", "family", "probability", F.coalesce("share", F.lit(0.0)).alias("similarity"))
    judged = scratch.write(judged.withColumn("confirmed", F.col("similarity") >= confirm), "judged")
    found = scratch.write(lines.drop("content").join(judged, "key").filter("n = 1 OR confirmed").drop("key"), "found")
    sure = found.filter("confirmed").select("doc", "line", "n", "family", "similarity").distinct()
    order = [F.struct(F.col(f"{t}.similarity"), -F.col(f"{t}.n"), -F.col(f"{t}.line")) for t in "ab"]
    # only windows are left out, and only for one that overlaps: at most 2 * LONGEST lines meet a window
    cell = F.explode(F.sequence(F.col("line"), F.col("line") + F.col("n") - 1))
    a = sure.filter("n > 1").withColumn("cell", cell).alias("a")
    b = sure.withColumn("cell", cell).alias("b")
    worse = a.join(b, (F.col("a.doc") == F.col("b.doc")) & (F.col("a.family") == F.col("b.family"))
                   & (F.col("a.cell") == F.col("b.cell")) & (order[1] > order[0]), "left_semi")
    worse = worse.select("doc", "line", "n", "family").distinct()
    return found.join(worse, ["doc", "line", "n", "family"], "left_anti").select(
        "doc_id", F.col("line").cast("int").alias("line"), "family", "probability", "similarity", "confirmed")
