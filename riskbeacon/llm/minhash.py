"""Near-duplicate documents: MinHash bands, odd sketches, full sets.

1. One pass makes each document's set of distinct shingle hashes and from it
   a digest, the band keys of its MinHash samples and an odd sketch: a
   bitmap in which every (sample number, sample) flips one bit, so that the
   XOR of two bitmaps counts the samples in which two sets differ.
   Documents with equal sets become one class.
2. Classes that share a band key are compared by sketch; only a spanning
   forest of the pairs that may be similar is kept. A bucket above
   ``BUCKET`` classes isn't compared: all its classes stay together.
3. The forests' components are groups that hold every candidate pair. A
   group is split into blocks of bounded size; sketches pick the pairs,
   and full sets confirm links. In a large group the ``HUBS`` classes that
   joined most others in their blocks then meet every block, which joins the
   blocks' parts around them for work in proportion to the group; pairs
   across blocks are compared only for classes that are still outside the
   group's main component.
4. A block's components are known when its links are; later links join whole
   components. What they have become part of is the result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskbeacon.llm.common import Scratch, arrow_settings, slices_by_bytes, text_column, tidy
from riskbeacon.llm.components import Forest, components, runs

WORDS = 5            # words of a shingle
BANDS, ROWS = 24, 5  # a pair at 0.85 is missed once in a million, at 0.8 once in 14,000
SAMPLES = BANDS * ROWS
SKETCH_WORDS = 4     # 256 bits
MARGIN = 0.2         # below the threshold: about five deviations of the sketch's estimate
BUCKET = 1000        # classes of a bucket that are compared with each other
BLOCK = 512          # classes of a block, at most
BLOCK_SHINGLES = 1 << 20
HUBS = 32            # classes that meet every block of a large group first
_MUL = np.random.default_rng(20).integers(1, 1 << 62, SAMPLES).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(texts: pa.Array, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): the shingles of each text, with repeats, as 64-bit hashes.

    Words are runs of anything but ASCII white space, A-Z lower-cased. Fewer
    words than ``size`` make one shingle, no words make none.
    """
    import xxhash
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    code = lists.flatten().dictionary_encode()
    codes = code.indices.to_numpy()
    vocab = code.dictionary.to_pylist()
    table = np.fromiter((xxhash.xxh64_intdigest(w) for w in vocab), np.uint64, len(vocab))
    off = lists.offsets.to_numpy().astype(np.int64)
    off = off - off[0]
    if "" in vocab:  # white space at the ends
        real = codes != vocab.index("")
        off = np.concatenate(([0], np.cumsum(real)))[off]
        codes = codes[real]
    a = table[codes]
    n = np.diff(off)
    out = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    ends = np.concatenate(([0], np.cumsum(out)))
    at = np.repeat(off[:-1] - ends[:-1], out) + np.arange(int(ends[-1]))
    have = np.repeat(np.minimum(n, size), out)
    h = have.astype(np.uint64) * _STEP
    padded = np.concatenate((a, np.zeros(size, np.uint64)))
    for j in range(size):
        h = np.where(j < have, h * _STEP + padded[at + j], h)
    return _mix(h), ends


def _signatures(h: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """MinHash samples, one row per text that has shingles."""
    full = np.flatnonzero(np.diff(ends))
    out = np.empty((len(full), SAMPLES), np.uint64)
    if len(full):
        starts = ends[:-1][full]
        for i in range(SAMPLES):
            out[:, i] = np.minimum.reduceat(h * _MUL[i], starts)
    return out


def _sketch(sig: np.ndarray) -> np.ndarray:
    """Odd sketches: every (sample number, sample) flips one of the bits."""
    bits = _mix(sig + np.arange(SAMPLES, dtype=np.uint64) * _STEP) >> np.uint64(56)  # 0..255
    flat = bits.astype(np.int64) + np.arange(len(sig))[:, None] * 256
    odd = np.bincount(flat.ravel(), minlength=256 * len(sig)).reshape(len(sig), 256) & 1
    return np.packbits(odd.astype(np.uint8), axis=1, bitorder="little").view(np.uint64)


def _bands(sig: np.ndarray) -> np.ndarray:
    out = np.empty((len(sig), BANDS), np.uint64)
    for b in range(BANDS):
        h = np.full(len(sig), b + 1, np.uint64) * _STEP
        for r in range(ROWS):
            h = _mix(h ^ sig[:, b * ROWS + r]) * _STEP
        out[:, b] = h
    return out


def differing(threshold: float) -> int:
    """The most sketch bits in which a pair may differ to be looked at."""
    apart = 2 * SAMPLES * (1 - max(0.0, threshold - MARGIN))
    bits = 64 * SKETCH_WORDS
    return int(bits / 2 * (1 - (1 - 2 / bits) ** apart)) + 1


def sketch_table(docs: DataFrame, size: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, digest, bands, sketch), one row per row."""
    arrow_settings(docs.sparkSession)
    rows = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("n_shingles", T.LongType()),
                           T.StructField("digest", T.BinaryType()),
                           T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("sketch", T.BinaryType())])

    def make(batches):
        for b in batches:
            texts = text_column(b)
            for x, y in slices_by_bytes(texts, 8 << 20):
                h, ends = shingles(texts.slice(x, y - x), size)
                count = np.zeros(y - x, np.int64)
                digest: list[bytes | None] = [None] * (y - x)
                full = np.flatnonzero(np.diff(ends))
                for i in full.tolist():
                    own = np.unique(h[ends[i]:ends[i + 1]])
                    count[i] = len(own)
                    digest[i] = hashlib.md5(own.tobytes(), usedforsecurity=False).digest()
                sig = _signatures(h, ends)
                bands = pa.array(_bands(sig).view(np.int64).ravel())
                off = np.zeros(y - x + 1, np.int32)
                off[full + 1] = BANDS
                sk = [None] * (y - x)
                for i, s in zip(full.tolist(), _sketch(sig)):
                    sk[i] = s.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(x, y - x), pa.array(count, pa.int64()), pa.array(digest, pa.binary()),
                     pa.ListArray.from_arrays(pa.array(np.cumsum(off), pa.int32()), bands), pa.array(sk, pa.binary())],
                    names=schema.names)

    return rows.mapInArrow(tidy(make), schema)


def _apart(sk: np.ndarray, one: np.ndarray) -> np.ndarray:
    return np.bitwise_count(sk ^ one).sum(axis=1)


def _may_link(n1, n2, threshold):
    return np.minimum(n1, n2) >= threshold * np.maximum(n1, n2) - 1e-9


def _bucket_forest(threshold: float):
    """Spanning forests of the pairs of a bucket that may be similar.

    A row that has joined the first row's tree isn't compared any more: its
    pairs with rows of the tree are settled, and those with other rows are
    found when these are compared. So a bucket of copies takes one comparison
    with all its rows, not one for each row. Every tree is given as a star
    around its smallest id: buckets with the same rows give the same links.
    """
    most = differing(threshold)

    def make(batches):
        for t in runs(batches, ["band"]):
            t = t.sort_by("id")  # the smallest index of a tree, its root, is its smallest id
            ids = t["id"].to_numpy()
            n = t["n"].to_numpy()
            sk = np.frombuffer(b"".join(t["sketch"].to_pylist()), np.uint64).reshape(-1, SKETCH_WORDS)
            f = Forest(len(ids))
            for i in range(len(ids)):
                if i and f.find(i) == f.find(0):
                    continue
                for j in np.flatnonzero((_apart(sk, sk[i]) <= most) & _may_link(n, n[i], threshold)).tolist():
                    f.join(i, j)
            root = np.array([f.find(i) for i in range(len(ids))])
            inner = root != np.arange(len(ids))
            if inner.any():
                yield pa.RecordBatch.from_arrays([pa.array(ids[inner], pa.int64()), pa.array(ids[root[inner]], pa.int64())],
                                                 names=["a", "b"])

    return make


def _block_links(threshold: float, percent: int, every: bool):
    """Components of a block that confirmed links join, as (component, the
    smallest one joined with it, links made by comparing its rows with others);
    ``every`` also gives those that nothing joins. Side 1 rows are compared
    with all rows, or all with all where there is no other side."""
    most = differing(threshold)

    def make(batches):
        for t in runs(batches, ["grp", "left", "right"]):
            t = t.combine_chunks()
            comp, side = t["comp"].to_numpy(), t["side"].to_numpy()
            n = t["n"].to_numpy()
            sk = np.frombuffer(b"".join(t["sketch"].to_pylist()), np.uint64).reshape(-1, SKETCH_WORDS)
            sets = [np.frombuffer(x, np.uint64) for x in t["shingles"].to_pylist()]
            vocab, code = np.unique(np.concatenate(sets), return_inverse=True)
            starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
            mark = np.zeros(len(vocab), np.int64)
            known, node = np.unique(comp, return_inverse=True)
            f = Forest(len(known))
            made = np.zeros(len(known), np.int64)
            for i in np.flatnonzero(side == 1).tolist():
                near = (_apart(sk, sk[i]) <= most) & _may_link(n, n[i], threshold)
                near[i] = False
                root = f.find(int(node[i]))
                todo = [j for j in np.flatnonzero(near).tolist() if f.find(int(node[j])) != root]
                if not todo:
                    continue
                own = code[starts[i]:starts[i + 1]]
                mark[own] = 1
                for j in todo:
                    both = int(mark[code[starts[j]:starts[j + 1]]].sum())
                    if 100 * both >= percent * int(n[i] + n[j] - both) and f.join(int(node[i]), int(node[j])):
                        made[node[i]] += 1
                mark[own] = 0
            root = np.array([f.find(k) for k in range(len(known))])
            out = (root != np.arange(len(known))) | every
            if out.any():
                yield pa.RecordBatch.from_arrays([pa.array(x[out], pa.int64()) for x in (known, known[root], made)],
                                                 names=["a", "b", "joined"])

    return make


def _with_sets(docs: DataFrame, members: DataFrame, size: int) -> DataFrame:
    """Members with their full sets, made anew from the texts of their documents."""
    rows = (docs.select(docs["doc_id"].cast("long").alias("id"), docs["text"].alias("text"))
            .join(members, "id").select("id", "grp", "n", "digest", "sketch", "text"))
    schema = T.StructType([rows.schema["id"], rows.schema["grp"], rows.schema["n"], rows.schema["sketch"],
                           T.StructField("shingles", T.BinaryType())])

    def make(batches):
        for b in batches:
            texts = text_column(b)
            digests = b.column(3).to_pylist()
            for x, y in slices_by_bytes(texts, 8 << 20):
                h, ends = shingles(texts.slice(x, y - x), size)
                own = [np.unique(h[ends[i]:ends[i + 1]]).tobytes() for i in range(y - x)]
                same = np.array([hashlib.md5(s, usedforsecurity=False).digest() == d
                                 for s, d in zip(own, digests[x:y])])
                cols = [b.column(i).slice(x, y - x) for i in (0, 1, 2, 4)] + [pa.array(own, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, names=schema.names).filter(pa.array(same))

    return rows.mapInArrow(tidy(make), schema)


def _links(units: DataFrame, threshold: float, percent: int, every: bool = False) -> DataFrame:
    return (units.repartition("grp", "left", "right").sortWithinPartitions("grp", "left", "right")
            .mapInArrow(tidy(_block_links(threshold, percent, every)), "a long, b long, joined long"))


def _merged(rows: DataFrame, comp: DataFrame) -> DataFrame:
    """Rows whose ``comp`` is replaced by the component it has become part of."""
    return (rows.join(comp.select(F.col("node").alias("comp"), "component"), "comp", "left")
            .withColumn("comp", F.coalesce("component", "comp")).drop("component"))


def _hub_units(large: DataFrame) -> DataFrame:
    """Every block of the large groups with the hubs of its group beside it."""
    order = Window.partitionBy("grp").orderBy(F.col("joined").desc(), "id")
    hubs = (large.filter("joined > 0").withColumn("place", F.row_number().over(order)).filter(F.col("place") <= HUBS)
            .withColumn("right", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    return (large.withColumn("right", F.col("block")).withColumn("side", F.lit(0)).unionByName(
        hubs.withColumn("side", F.lit(1)).drop("place"))).withColumn("left", F.lit(0))


def near_duplicates(docs: DataFrame, percent: int = 85, size: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``.

    Documents are linked at 100 * intersection >= percent * union of their
    full shingle sets; ``component_id`` is the smallest id reachable and
    ``kept`` says that it is the document's own. A null or empty text has no
    shingles and no links. Rows with equal ids count as one document of the
    component. A row without an id is its own: component null, kept.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "minhash")
    threshold = percent / 100
    base = scratch.write(sketch_table(docs, size), "sketches")
    # one class for each set; ids are longs
    classes = scratch.write(
        base.filter("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest")
        .agg(F.min(F.col("doc_id").cast("long")).alias("id"), F.any_value("n_shingles").alias("n"),
             F.any_value("bands").alias("bands"), F.any_value("sketch").alias("sketch")), "classes")
    slim = classes.select("id", "n", "digest", "sketch")
    keys = classes.select("id", F.explode("bands").alias("band"))
    size_of = (keys.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("low"))
               .filter("size > 1").withColumnRenamed("band", "key"))
    shared = scratch.write(keys.join(size_of, F.col("band") == F.col("key")).select("id", "band", "size", "low"),
                           "shared")
    hot = shared.filter(F.col("size") > BUCKET).select(F.col("id").alias("a"), F.col("low").alias("b"))
    compared = (shared.filter(F.col("size") <= BUCKET).select("id", "band")
                .join(slim.select("id", "n", "sketch"), "id")
                .repartition("band").sortWithinPartitions("band")
                .select("band", "id", "n", "sketch").mapInArrow(tidy(_bucket_forest(threshold)), "a long, b long"))
    groups = components(scratch, hot.unionByName(compared), "groups")

    members = scratch.write(slim.join(groups.select(F.col("node").alias("id"), F.col("component").alias("grp")), "id"),
                            "members")
    with_sets = scratch.write(_with_sets(docs, members, size), "sets")
    extent = (members.groupBy("grp").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
              .select("grp", F.greatest(F.ceil(F.col("c") / BLOCK), F.ceil(F.col("s") / BLOCK_SHINGLES))
                      .cast("int").alias("blocks")))
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    cols = ["grp", "left", "right", "id", "comp", "side", "n", "sketch", "shingles"]
    sets = with_sets.join(extent, "grp").withColumn("block", block)
    # a class lies in one block, so the blocks' components need no further step
    first = scratch.write(_links(sets.select("grp", F.col("block").alias("left"), F.lit(0).alias("right"), "id",
                                             F.col("id").alias("comp"), F.lit(1).alias("side"), "n", "sketch",
                                             "shingles").select(*cols), threshold, percent, every=True), "links-1")
    linked = first.select(F.col("a").alias("id"), F.col("b").alias("comp"), "joined")

    # large groups: hubs meet every block, then what isn't in the main component does; links are between components
    large = scratch.write(sets.filter("blocks > 1").join(linked, "id"), "large")
    hubs = scratch.write(_links(_hub_units(large).select(*cols), threshold, percent), "links-hubs")
    by_hubs = components(scratch, hubs.select("a", "b"), "joined")
    large = scratch.write(_merged(large, by_hubs), "apart")
    main = (large.groupBy("grp", "comp").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
            .groupBy("grp").agg(F.max_by("comp", F.struct("c", -F.col("comp"))).alias("main"),
                                F.sum("c").alias("all_c"), F.sum("s").alias("all_s"),
                                F.max(F.struct("c", -F.col("comp"), "s")).alias("top")))
    main = main.select("grp", "main", F.greatest(
        F.ceil((F.col("all_c") - F.col("top.c")) / BLOCK), F.ceil((F.col("all_s") - F.col("top.s")) / BLOCK_SHINGLES),
        F.lit(1)).cast("int").alias("outer_blocks"))
    large = large.join(main, "grp")
    outer_block = F.pmod(F.xxhash64("id", F.lit(1)), F.col("outer_blocks")).cast("int")
    outside = large.filter("comp <> main").select(
        "grp", outer_block.alias("left"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("right"), "id",
        "comp", F.lit(1).alias("side"), "n", "sketch", "shingles")
    every = large.select(
        "grp", F.explode(F.sequence(F.lit(0), F.col("outer_blocks") - 1)).alias("left"), F.col("block").alias("right"),
        "id", "comp", F.lit(0).alias("side"), "n", "sketch", "shingles")
    second = scratch.write(_links(outside.unionByName(every).select(*cols), threshold, percent), "links-2")
    linked = _merged(_merged(linked, by_hubs), components(scratch, second.select("a", "b"), "linked"))

    rep = slim.select("digest", "id").join(linked.select("id", "comp"), "id", "left").select(
        "digest", F.coalesce("comp", "id").alias("class_component"))
    # an id with several texts belongs to all their classes
    out = base.select("doc_id", "n_shingles", "digest").join(rep, "digest", "left")
    own = F.col("doc_id").cast("long")
    return out.select("doc_id", "n_shingles", F.when(own.isNotNull(), F.coalesce("class_component", own))
                      .alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, percent: int = 80, size: int = WORDS) -> DataFrame:
    """The rows of ``docs``, all columns, without documents whose component has a smaller id.

    Of rows with equal ids one stays (the smallest text hash); rows without
    an id all stay.
    """
    found = near_duplicates(docs, percent, size).filter("kept AND doc_id IS NOT NULL").select(
        F.col("doc_id").alias("id")).distinct()
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    one = Window.partitionBy("row.doc_id").orderBy(F.xxhash64("row.text"), F.xxhash64("row"))
    kept = (rows.join(found, F.col("row.doc_id") == F.col("id"), "left_semi")
            .withColumn("nth", F.row_number().over(one)).filter("nth = 1").select("row"))
    return kept.unionByName(rows.filter("row.doc_id IS NULL")).select("row.*")
