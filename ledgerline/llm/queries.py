"""The registered queries of this subpackage: thin calls of the operators with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (clusters, crf, exact_dedup, hmm, jaccard, language, mixing, near_dup, packing, quality,
                            spelling, topk, warc)
from ledgerline.llm.common import crc_fold, table


def vocabulary() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest integer inner products of every query vector (id divisible by 20)."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the folds other than 2 of 4."""
    docs = table(spark, sf_dir, "documents")
    model = language.learn(docs, crc_fold(F.col("doc_id"), 4) != 2)
    return language.predict(docs, model).withColumn("held_out", crc_fold(F.col("doc_id"), 4) == 2)


def op3_hmm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every document, learned from the folds other than 2 of 7."""
    return hmm.score_texts(table(spark, sf_dir, "documents"), crc_fold(F.col("doc_id"), 7) == 2)


def op4_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 ids."""
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary())


def op5_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labels of the folds other than 0 of 5."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.learn(docs, labels.where(crc_fold(F.col("doc_id"), 5) != 0))
    return quality.score(docs, model).select(
        "doc_id", (crc_fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"), "size_difference")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the document that stays for its text."""
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op7_warc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as it comes back from the archives written."""
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op8_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels of the folds other than 2 of 4."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = crf.learn(docs, labels.where(crc_fold(F.col("doc_id"), 4) != 2))
    return crf.score(docs, model).select(
        "doc_id", (crc_fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"), "spans")


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words the mix takes of it, and the shards that got it."""
    plan = mixing.mixture(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target",
                       mixing.taken_words(F.col("copies"), F.col("size")).alias("taken"),
                       F.transform("copies", lambda c: c["shard"]).alias("shards"))


def op10_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class of near duplicates (five words, similarity 0.8)."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", "class_size", "kept")


def op11_hadamard_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding with the nearest of 16 centroids after three rounds."""
    return clusters.cluster(table(spark, sf_dir, "embeddings"))


def op12_pivotal_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word with the more frequent word it is a variant of; one slip in 199 words by the contract."""
    return spelling.variants(table(spark, sf_dir, "documents"), slip_every=199)


def op13_combination_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its component of links (three words, 90 % of the union)."""
    return jaccard.linked(table(spark, sf_dir, "documents"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_exact_topk, op2_language_id, op3_hmm_scoring, op4_harmonic_packing,
                             op5_compression_quality, op6_exact_dedup, op7_warc_roundtrip, op8_crf_toxicity,
                             op9_source_mixing, op10_dart_minhash, op11_hadamard_clusters,
                             op12_pivotal_spelling, op13_combination_jaccard)
}


def _cluster_sql(rounds: int = 3, centroids: int = 16) -> str:
    """The clustering in plain SQL: every distance, every mean."""
    near = """a{n} AS MATERIALIZED (SELECT row, min(struct_pack(d := d, k := k)) AS best FROM (
  SELECT v.row, c.k, list_sum(list_transform(list_zip(v.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
  FROM v, c{n} AS c) GROUP BY row)"""
    move = """c{m} AS MATERIALIZED (SELECT c.k, coalesce(m.x, c.x) AS x FROM c{n} AS c LEFT JOIN (
  SELECT k, list((s - ((s % w) + w) % w) // w ORDER BY i) AS x FROM (
    SELECT a.best.k AS k, i, sum(v.x[i])::HUGEINT AS s, count(*)::HUGEINT AS w
    FROM a{n} AS a JOIN v USING (row), range(1, 65) AS r(i) GROUP BY a.best.k, i) GROUP BY k) AS m ON m.k = c.k)"""
    steps = [near.format(n=0)]
    for n in range(rounds):
        steps += [move.format(n=n, m=n + 1), near.format(n=n + 1)]
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id,
    list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::HUGEINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), x) - 1 AS k, x FROM v
  ORDER BY sha256('1:' || vec_id), x LIMIT {centroids}),
{", ".join(steps)}
SELECT v.vec_id, a.best.k::INTEGER AS cluster, a.best.d AS distance,
  sum(a.best.d) OVER (PARTITION BY a.best.k)::BIGINT AS cluster_inertia, sum(a.best.d) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM a{rounds} AS a JOIN v USING (row) JOIN c{rounds} AS c ON c.k = a.best.k"""


_SPACE = r"[\x20\x09-\x0D]+"

LLM_ORACLE: dict[str, str] = {
    "op11_hadamard_clusters": _cluster_sql(),
    "op1_exact_topk": """
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS row, vec_id,
    list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.row, q.vec_id AS query_id, c.vec_id, list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM v AS q JOIN v AS c ON q.row <> c.row WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
    "op6_exact_dedup": rf"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{_SPACE}', ' ', 'g') AS n FROM documents),
g AS (SELECT n, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY n)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.n) AS text_sha256
FROM t JOIN g USING (n)""",
    "op7_warc_roundtrip": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
SELECT p.page_id, p.n AS payload_bytes, p.d AS payload_digest,
  CASE WHEN f.first <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN f.first <> p.page_id THEN f.first END AS refers_to
FROM p LEFT JOIN f USING (d)""",
}
