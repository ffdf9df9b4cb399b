"""Every operator against a brute-force version, with NULLs, empty tables, ties, long texts and clashing columns."""

import collections
import itertools
import math
import os
import random
import re
import sys
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from ledgerline.llm import chain, crf, exact_dedup, hmm, language, mixing, near_dup, packing, quality, topk, warc  # noqa: E402
from ledgerline.llm.common import word_count  # noqa: E402
from ledgerline.llm.queries import LLM_ORACLE, LLM_QUERIES, vocabulary  # noqa: E402
from ledgerline.llm.tokens import Encoder  # noqa: E402

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, row bigint, score string"


def words(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(1, 6))) for _ in range(n))


def edge_docs(spark):
    """NULL id and text, empty, separators only, a very long text, ties, repeated rows; clashing extra columns."""
    long = words(1, 30_000)
    rows = [(1, "a  b\tc", "en"), (2, "a b c", None), (3, "a b c", "en"), (3, "a b c", "en"), (None, "a b c", "de"),
            (4, None, "en"), (5, "", None), (6, " \n\t ", "de"), (7, long, "en"), (8, long, "en"),
            (9, long.replace("a", "b", 3), "en"), (None, None, None), (10, "ÄÖ ü 漢字 <|endoftext|>", "de")]
    return spark.createDataFrame([(*r, f"s{(r[0] or 0) % 3}" if r[0] != 5 else None, 0, 9, "x") for r in rows], DOCS)


def stored_docs(spark, workdir, docs):
    path = f"{workdir}/docs"
    docs.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    mine = LLM_QUERIES[name](spark, SF)
    cols = ", ".join(sorted(mine.columns))
    assert sorted(map(repr, map(tuple, mine.selectExpr(*sorted(mine.columns)).collect()))) == sorted(
        map(repr, con.sql(f"SELECT {cols} FROM ({LLM_ORACLE[name]})").fetchall()))


def test_exact_dedup_edges_and_collisions(spark):
    docs = edge_docs(spark)
    weak = lambda t: F.substring(F.md5(t), 1, 1).cast("binary")  # noqa: E731  many texts share a hash
    for digest in (exact_dedup.md5_bytes, weak):
        got = exact_dedup.duplicate_groups(docs, digest=digest).collect()
        groups = collections.defaultdict(list)
        for r in docs.collect():
            groups[re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "")].append(r.doc_id)
        want = sorted(repr((i, min((x for x in ids if x is not None), default=None), len(ids)))
                      for ids in groups.values() for i in ids)
        assert sorted(repr((r.doc_id, r.keep_id, r.group_size)) for r in got) == want
        assert sum(r.kept for r in got) == len(groups)
    assert exact_dedup.drop_duplicates(docs).count() == len(groups)
    assert exact_dedup.duplicate_groups(docs.limit(0)).count() == 0


def test_packing_rebuilds_every_document(spark):
    docs = edge_docs(spark).withColumn("doc_id", F.monotonically_increasing_id())
    rows = packing.pack(docs.repartition(3), vocabulary()).collect()
    encoder = Encoder.of(vocabulary())
    ids = {r.doc_id: np.append(encoder._ids(r.text or ""), 0).astype("<u4") for r in docs.collect()}
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    for r in rows:
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert (len(part), zlib.crc32(part.tobytes()), len(ids[r.doc_id])) == (r.length, r.ids_crc32, r.doc_tokens)
    for _, group in itertools.groupby(sorted(rows, key=lambda r: (r.sequence_id, r.offset)), lambda r: r.sequence_id):
        at = 0
        for r in group:
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert packing.pack(docs.limit(0), vocabulary()).count() == 0


def test_word_cache_equals_the_tokenizer():
    encoder = Encoder.of(vocabulary())
    texts = [words(3, 200), "It's  two\n\nlines. End.,", "a\nb c", " lead", "tail ", "", "Ünïcode, x 漢字 1234.5", "\n"]
    for got, text in zip(encoder.encode(pa.array(texts)), texts, strict=True):
        assert got.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_mixing_targets_and_repeats(spark, workdir):
    docs = spark.createDataFrame(
        [(i, words(i, 3 + i % 40), "en", s, 0, 1, "x") for i, s in enumerate(random.Random(5).choices(
            ["a", "b", "c", "d", None], [50, 20, 3, 20, 10], k=400))] + [(None, None, None, "a", 0, 1, "x")], DOCS)
    docs = stored_docs(spark, workdir, docs)
    plan = mixing.mixture(docs, block_words=64).collect()
    total, sizes = sum(r.size for r in plan), {r.source: r.source_size for r in plan}
    order = sorted(sizes, key=lambda s: (s is None, s))
    weights, left = {s: 1 + i % 3 for i, s in enumerate(order)}, set(order)
    targets = dict.fromkeys(order, 0.0)
    while True:  # excess reshared by weight until nobody is above three times its size
        rest = total - sum(targets[s] for s in order if s not in left)
        share = {s: rest * weights[s] / sum(weights[x] for x in left) for s in left}
        over = {s for s in left if share[s] > 3 * sizes[s]}
        targets |= {s: 3.0 * sizes[s] if s in over else share[s] for s in left}
        if not over:
            break
        left -= over
    taken = collections.Counter()
    for r in plan:
        assert r.target == pytest.approx(targets[r.source])
        assert len(r.copies) <= 3
        taken[r.source] += r.size * len(r.copies)
    assert all(abs(taken[s] - targets[s]) <= 4 for s in order)
    again = mixing.mixture(docs, block_words=64).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, plan))
    drawn = mixing.draw(docs, block_words=64)
    assert drawn.columns == docs.columns and drawn.count() == sum(len(r.copies) for r in plan)
    assert mixing.mixture(docs.limit(0)).count() == 0
    assert mixing.mixture(stored_docs(spark, workdir + "x", edge_docs(spark))).count() == 13


def test_splitting_tree_is_exact_and_hypergeometric(spark):
    quotas = spark.createDataFrame([(0, 100), (1, 7), (2, 0), (3, 1)], "ord int, blocks bigint")
    leaves = mixing.split_quotas(quotas, 3, seed=1).collect()
    by_source, by_shard = collections.Counter(), collections.Counter()
    for r in leaves:
        assert r.blocks >= 0
        by_source[r.ord] += r.blocks
        by_shard[r.shard] += r.blocks
    assert dict(by_source) == {0: 100, 1: 7, 2: 0, 3: 1}
    assert max(by_shard.values()) - min(by_shard.values()) <= 1
    draw = mixing.hypergeometric("u", "20D", "8D", "5D")
    got = collections.Counter(r[0] for r in spark.range(4000).selectExpr(
        "(id + 0.5D) / 4000 AS u").selectExpr(f"{draw} AS x").collect())
    for x in range(6):
        want = math.comb(8, x) * math.comb(12, 5 - x) / math.comb(20, 5)
        assert got[x] / 4000 == pytest.approx(want, abs=1e-3)


def test_word_count(spark):
    docs = edge_docs(spark)
    for r in docs.select("text", word_count(F.col("text")).alias("n")).collect():
        assert r.n == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))


def test_forward_backward_equals_enumeration(monkeypatch):
    monkeypatch.setattr(chain, "SEGMENT", 3)
    r = np.random.default_rng(0)
    first, move = r.random(2), r.random((2, 2))
    lengths = np.array([1, 8, 3, 0, 7])
    e = r.random((lengths.sum(), 2))
    chains = chain.Chains(lengths)
    logs, rows = chains.forward(lambda at: e[at], first, move, keep=True)
    states, pairs = chains.backward(lambda at: e[at], rows, move)
    at, count = 0, np.zeros((2, 2))
    for i, n in enumerate(lengths):
        total, marginal = 0.0, np.zeros((n, 2))
        for path in itertools.product((0, 1), repeat=int(n)) if n else []:
            p = first[path[0]] * math.prod(e[at + t, s] for t, s in enumerate(path)) * math.prod(
                move[a, b] for a, b in itertools.pairwise(path))
            total += p
            for t, s in enumerate(path):
                marginal[t, s] += p
            for a, b in itertools.pairwise(path):
                count[a, b] += 0
        if n:
            assert math.log(total) == pytest.approx(logs[i])
            assert np.allclose(marginal / total, states[at:at + n])
        at += n
    assert pairs.sum() == pytest.approx(sum(max(0, n - 1) for n in lengths))


def test_hmm_base_and_proper_probabilities(spark):
    docs = edge_docs(spark)
    got = hmm.score_texts(docs, F.coalesce(F.col("doc_id") == 2, F.lit(False))).collect()
    assert len(got) == 13
    counts = collections.Counter()
    token = lambda t: [w.decode() for w in hmm.tokenise(t)] + ["\n"]
    for r in docs.collect():
        if r.doc_id != 2:
            counts.update(token(r.text))
    n, v = sum(counts.values()), len(counts)
    want = sorted(round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in token(r.text)), 6) for r in docs.collect())
    assert sorted(round(r.base_score, 6) for r in got) == want
    assert all(r.train_tokens == n and r.score < 0 and r.n_known <= r.n_tokens for r in got)
    untrained = hmm.score_texts(docs, F.lit(True)).collect()
    assert len(untrained) == 13 and all(r.base_score == 0 and r.n_known == 0 for r in untrained)
    assert hmm.score_texts(docs.limit(0), F.lit(False)).count() == 0


def test_language_edges(spark):
    docs = edge_docs(spark)
    model = language.learn(docs, F.lit(True))
    got = {(r.doc_id, r.lang_pred) for r in language.predict(docs, model).collect()}
    assert {(4, "und"), (5, "und"), (6, "und"), (None, "und")} <= got
    assert (7, "en") in got and (10, "de") in got
    nothing = language.learn(docs.limit(0), F.lit(True))
    assert {r.lang_pred for r in language.predict(docs, nothing).collect()} == {"und"}


@pytest.mark.parametrize("op", [quality, crf])
def test_classifier_edges(spark, op):
    label = "quality" if op is quality else "toxic"
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(1, 0), (7, 1), (9, 1), (10, 0), (2, None), (None, 1), (7, 1)],
                                   f"doc_id bigint, {label} int")
    rows = op.score(docs, op.learn(docs, labels)).collect()
    assert len(rows) == 13 and all(0 <= r.score <= 1 for r in rows)
    constant = op.score(docs, op.learn(docs, labels.where(f"{label} = 1"))).collect()
    assert {r.score for r in constant} == {1.0}
    assert op.score(docs.limit(0), op.learn(docs, labels.limit(0))).count() == 0


@pytest.mark.parametrize(("name", "label", "least"), [("op5_compression_quality", "quality", 0.93),
                                                      ("op8_crf_toxicity", "toxic", 0.88),
                                                      ("op2_language_id", "lang", 0.97)])
def test_held_out_accuracy(spark, name, label, least):
    sf = "/root/testdata/sf0.01"
    got = LLM_QUERIES[name](spark, sf)
    truth = spark.read.parquet(f"{sf}/{'documents' if label == 'lang' else 'labels'}.parquet").select("doc_id", label)
    found = "lang_pred" if label == "lang" else "predicted"
    right = got.where("held_out").join(truth.where(f"{label} IS NOT NULL"), "doc_id").agg(
        F.avg((F.col(found) == F.col(label)).cast("int"))).first()[0]
    assert right >= least


def test_dart_signatures_estimate_weighted_similarity():
    r = np.random.default_rng(2)
    x, y = r.random(200) * 3, r.random(200) * 3
    elements = near_dup.mixed(np.arange(200, dtype=np.uint64))
    both = near_dup.signatures(np.concatenate([elements, elements]), np.repeat([0, 1], 200), 2,
                               np.concatenate([x, y]), size=4000)
    want = np.minimum(x, y).sum() / np.maximum(x, y).sum()
    assert (both[0] == both[1]).mean() == pytest.approx(want, abs=0.04)
    assert (near_dup.signatures(elements, np.zeros(200, int), 2, size=50)[1] == 0).all()


def test_near_duplicates_against_all_pairs(spark, workdir):
    r = random.Random(11)
    base = [words(s, 120) for s in range(6)]
    texts = []
    for i in range(150):
        w = base[i % 6].split()
        for _ in range(r.randint(0, 5)):
            w[r.randrange(len(w))] = f"new{i}"
        texts.append((i, " ".join(w)))
    rows = [(i, t, "en", "s", 0, 1, "x") for i, t in texts] + [(900 + i, d.text, "en", "s", 0, 1, "x")
                                                             for i, d in enumerate(edge_docs(spark).collect())]
    docs = stored_docs(spark, workdir, spark.createDataFrame(rows, DOCS))
    sets = {}
    for i, t, *_ in rows:
        w = t.encode().lower().split() if t else []
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    parent = {i: i for i in sets}

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for a, b in itertools.combinations(sets, 2):
        if sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    got = near_dup.near_duplicates(docs).collect()
    assert {r.doc_id: r.class_id for r in got} == {i: root(i) for i in sets}
    assert near_dup.keep_one(docs).count() == len({root(i) for i in sets})
    assert near_dup.near_duplicates(docs.limit(0)).count() == 0


def test_top_k_against_all_products(spark):
    r = np.random.default_rng(4)
    rows = [(i, (r.standard_normal(6) * r.choice([0.1, 1, 5])).tolist()) for i in range(300)]
    rows += [(i, rows[0][1]) for i in range(300, 340)] + [(400, None), (401, [float("nan")] * 6), (402, [None] * 6),
                                                          (None, rows[1][1]), (403, [1.0, 2.0]), (3, rows[3][1]),
                                                          (5, rows[6][1]), (5, (3 * np.array(rows[7][1])).tolist()),
                                                          (20, rows[8][1])]  # repeated ids: rows of their own
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("norm", F.lit("x"))
    got = topk.top_k(df, F.col("vec_id") % 20 == 0).collect()
    v = [(i, np.floor(64 * np.array(x, np.float32).astype(float)).astype(int)) for i, x in rows
         if i is not None and i != 403 and x and None not in x and not math.isnan(x[0])]
    want = []
    for n, (q, x) in enumerate(v):
        if q % 20 == 0:
            best = sorted(((-int(x @ y), c) for m, (c, y) in enumerate(v) if m != n))[:20]
            want += [(q, k, c, -s) for k, (s, c) in enumerate(best, 1)]
    assert len(want) > len({w[0] for w in want}) * 20  # the repeated query id has its rows twice
    assert sorted(map(tuple, got)) == sorted(want)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_pruning_loses_nothing():
    r = np.random.default_rng(8)
    vectors = (r.standard_normal((500, 8)) * 40).astype("<i8")
    vectors = vectors[np.argsort(-np.linalg.norm(vectors, axis=1), kind="stable")]
    bucket = topk.Bucket(topk._ids(np.arange(500), np.arange(500)), vectors.tobytes(), 8)
    queries = (r.standard_normal((50, 8)) * 40).astype("<i8")
    scores = queries @ vectors.T
    for quantile in (0.5, 0.9, 0.99):
        bounds = np.quantile(scores, quantile, axis=1)
        found = {q: set(ids.tolist()) for q, ids, _ in topk.search(bucket, np.arange(1000, 1050), queries, bounds, 500)}
        for i in range(50):
            assert found.get(1000 + i, set()) == set(np.flatnonzero(scores[i] >= bounds[i]).tolist())


def test_warc_edges_and_pushdown(spark, workdir):
    big = "ä\r\n\r\nWARC/1.1\r\n" * 20
    rows = [(3, "u", big), (2, "u\r\nx", big), (2, None, big), (5, "v", big), (7, "w", "short"), (8, "w", "short"),
            (None, "z", big), (9, "q", None), (10, "q", "")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("digest", F.lit("x"))
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.archive_pages(pages).collect()),
                 key=repr)
    n = len(big.encode())
    assert got == sorted([(3, n, "revisit", 2), (2, n, "response", None), (2, n, "response", None), (5, n, "revisit", 2),
                          (7, 5, "response", None), (8, 5, "response", None), (None, n, "revisit", 2),
                          (9, 0, "response", None), (10, 0, "response", None)], key=repr)
    warc.write_archive(pages, f"{workdir}/warc")
    found = warc.read_archive(spark, f"{workdir}/warc", "record_type", "payload").where("record_type = 'response'")
    assert {bytes(r.payload) for r in found.collect()} == {big.encode(), b"short", b""}
    warc.write_archive(pages.limit(0), f"{workdir}/none")
    assert warc.read_archive(spark, f"{workdir}/none").count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = P.run(spark, SF)
    assert rows.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0
    assert [n for n, _ in P.STAGES] == ["toxicity", "exact dedup", "near dedup", "mixing", "packing"]
    kept = P.drop_toxic(spark, docs, SF)
    assert kept.columns == docs.columns and 0 < kept.count() <= docs.count()
    assert 0 < rows.select("doc_id").distinct().count() <= kept.count()
