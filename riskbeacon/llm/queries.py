"""Queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskbeacon.llm import (contamination, licenses, minhash, mixing, packing, pivots, quality, resampling, spelling,
                            tokenbin, tokencount, topk, toxicity)
from riskbeacon.llm.common import read_documents


def tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(read_documents(spark, sf_dir))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def read_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def op2_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_vectors(read_embeddings(spark, sf_dir), threshold=0.9)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    scores = toxicity.toxicity_scores(docs, toxicity.fit(spark, docs, sf_dir))
    return scores.select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "toxic")


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_documents(spark, sf_dir), tokenizer("word_bpe_49k.json"))


def op5_top_inner_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_inner_products(read_embeddings(spark, sf_dir), k=5, every=50)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = tokenbin.token_files(read_documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"))
    return tokenbin.decode_blocks(blocks)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(read_documents(spark, sf_dir), tokenizer("byte_bpe_50k.json"))


def op8_license_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_lines(read_documents(spark, sf_dir))


def op9_near_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_documents(spark, sf_dir), percent=85)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality.quality_scores(spark, read_documents(spark, sf_dir), sf_dir)
    return scores.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def read_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def op11_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contaminated(
        contamination.removal_spans(read_documents(spark, sf_dir), read_benchmark(spark, sf_dir), window=10))


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(read_documents(spark, sf_dir), read_benchmark(spark, sf_dir))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(read_documents(spark, sf_dir))


OP1_SQL = f"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT source, source_size, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][
    CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1] AS weight FROM s),
r AS (
  SELECT *, 3.0::DOUBLE * source_size AS cap,
    sum(3.0::DOUBLE * source_size) OVER o - 3.0::DOUBLE * source_size AS before, sum(weight) OVER o AS after
  FROM (SELECT *, 3.0::DOUBLE * source_size / weight AS ratio FROM w)
  WINDOW o AS (ORDER BY ratio, source ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
l AS (
  SELECT source, source_size, cap, weight, ratio,
    ((SELECT sum(source_size) FROM s)::DOUBLE - before) / ((SELECT sum(weight) FROM w) - after + weight) AS level
  FROM r),
lv AS (SELECT coalesce(max(level) FILTER (WHERE level <= ratio), 0.0) AS level FROM l WHERE source_size > 0),
t AS (SELECT source, source_size, least(cap, weight * (SELECT level FROM lv)) AS target FROM l),
c AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 1.0::DOUBLE END AS rate,
    CAST('0x' || substr(md5(coalesce(CAST(d.doc_id AS VARCHAR), 'null') || ':{mixing.SEED}'), 1, 13) AS BIGINT)
      / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM c
"""

OP5_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS vec FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding])),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.vec, c.vec) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INT) AS rank, vec_id, score FROM r WHERE n <= 5
"""

# DuckDB has no crc32: the table by its rule (reflected polynomial 0xEDB88320),
# then one step a byte over the hex digits of the UTF-8 bytes.
CRC_TABLE = """
crc_table AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END,
                          n::BIGINT) ORDER BY n) AS steps
  FROM range(256) t(n))"""


def crc32_sql(text: str) -> str:
    """SQL for the unsigned crc32 of a text expression; needs ``crc_table`` joined in."""
    digits = f"hex({text})"
    return (f"xor(list_reduce([CAST('0x' || substr({digits}, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT) "
            f"FOR i IN range(len({digits}) // 2)], "
            "lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295)")


AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP11_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    coalesce(regexp_extract_all(translate(text, {AZ}), '{resampling.PLAIN_WORD}'), []) AS words FROM documents),
i AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item,
    regexp_extract_all(translate(text, {AZ}), '{resampling.PLAIN_WORD}') AS words FROM benchmark),
w AS (
  SELECT DISTINCT item, least(len(words), 10) AS size, array_to_string(words[pos:pos + 9], ' ') AS phrase
  FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS pos FROM i WHERE len(words) > 0)),
p AS (SELECT DISTINCT size, phrase FROM w),
runs AS (
  SELECT r, size, pos, array_to_string(words[pos:pos + size - 1], ' ') AS phrase
  FROM (SELECT r, words, size, unnest(range(1, len(words) - size + 2)) AS pos
        FROM d, (SELECT DISTINCT size FROM p) WHERE len(words) >= size)),
o AS (SELECT r, size, pos, phrase FROM runs SEMI JOIN p USING (size, phrase)),
n AS (
  SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(pos, pos + size)) AS word FROM o) GROUP BY r),
t AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM o JOIN w USING (size, phrase)) GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN t USING (r)
"""

OP12_SQL = f"""
WITH {CRC_TABLE},
d AS (
  SELECT row_number() OVER () AS r, doc_id,
    coalesce(regexp_extract_all(translate(text, {AZ}), '{resampling.PLAIN_WORD}'), []) AS words FROM documents),
df AS (SELECT r, unnest(words) AS f FROM d),
tf AS (SELECT unnest(regexp_extract_all(translate(text, {AZ}), '{resampling.PLAIN_WORD}')) AS f FROM benchmark),
u AS (SELECT DISTINCT f FROM (SELECT f FROM df UNION ALL SELECT f FROM tf)),
h AS (SELECT f, {crc32_sql("f")} % 10000 AS bucket FROM u, crc_table),
sc AS (SELECT bucket, count(*) AS s FROM df JOIN h USING (f) GROUP BY bucket),
tc AS (SELECT bucket, count(*) AS t FROM tf JOIN h USING (f) GROUP BY bucket),
g AS (
  SELECT bucket, CAST(floor(1000.0::DOUBLE * ln(
      (CAST(coalesce(t, 0) AS DOUBLE) + 1) * ((SELECT count(*) FROM df) + 10000.0::DOUBLE)
      / ((CAST(coalesce(s, 0) AS DOUBLE) + 1) * ((SELECT count(*) FROM tf) + 10000.0::DOUBLE)))) AS BIGINT) AS gain
  FROM (SELECT DISTINCT bucket FROM h) LEFT JOIN sc USING (bucket) LEFT JOIN tc USING (bucket)),
w AS (SELECT r, CAST(sum(gain) AS BIGINT) AS weight FROM df JOIN h USING (f) JOIN g USING (bucket) GROUP BY r),
x AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000.0::DOUBLE * ln(-ln((
      CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 8) AS BIGINT) + 0.5::DOUBLE)
      / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN w USING (r)),
k AS (
  SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (
      PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) END AS place FROM x)
SELECT doc_id, n_features, weight, score,
  CASE WHEN place <= 10 * (SELECT count(*) FROM x WHERE n_features >= 20) // 100 THEN CAST(place AS BIGINT) END AS rank
FROM k
"""

OP13_SQL = f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), 'null') AS id,
    translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')), {AZ}) AS run FROM documents),
c AS (SELECT id, run, count(*) AS n FROM runs GROUP BY id, run),
h AS (SELECT run, n, {crc32_sql("id || ':' || run")} AS h FROM c, crc_table),
w AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT))
      || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, n FROM h),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM w WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
gone AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
one AS (
  SELECT DISTINCT word, n, other, other_n FROM (
    SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM gone a JOIN gone b
      ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION ALL SELECT a.word, a.n, b.word, b.n FROM gone a JOIN v b ON a.rest = b.word
    UNION ALL SELECT b.word, b.n, a.word, a.n FROM gone a JOIN v b ON a.rest = b.word)),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n
  FROM one GROUP BY word),
f AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * v.n THEN other END AS form,
    CASE WHEN other_n >= 2 * v.n THEN other_n END AS form_n
  FROM v LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS at FROM f
  UNION ALL SELECT walk.word, f.form FROM walk JOIN f ON f.word = walk.at WHERE f.form IS NOT NULL),
top AS (SELECT walk.word, walk.at AS root FROM walk JOIN f ON f.word = walk.at WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM f JOIN top USING (word)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_near_vectors": op2_near_vectors,
    "op3_toxicity": op3_toxicity,
    "op4_pack": op4_pack,
    "op5_top_inner_products": op5_top_inner_products,
    "op6_token_files": op6_token_files,
    "op7_token_counts": op7_token_counts,
    "op8_license_lines": op8_license_lines,
    "op9_near_documents": op9_near_documents,
    "op10_quality": op10_quality,
    "op11_contamination": op11_contamination,
    "op12_resample": op12_resample,
    "op13_spelling_variants": op13_spelling_variants,
}
ORACLE_SQL: dict[str, str] = {"op1_mix_sources": OP1_SQL, "op5_top_inner_products": OP5_SQL,
                              "op11_contamination": OP11_SQL, "op12_resample": OP12_SQL, "op13_spelling_variants": OP13_SQL}
