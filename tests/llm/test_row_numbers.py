"""Row numbers are stored once: scans that are split another way later still mean the same rows."""

import collections
import itertools
import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from ledgerline.llm import common, mixing, near_dup  # noqa: E402

DOCS = "doc_id bigint, text string, source string"


@pytest.fixture
def resplit(spark, monkeypatch):
    """Every stored frame changes the file splits of the scans planned after it."""
    sizes, store = itertools.cycle(["4k", "128m"]), common.stored
    conf = "spark.sql.files.maxPartitionBytes"

    def storing(df, *options):
        out = store(df, *options)
        spark.conf.set(conf, next(sizes))
        return out

    for module in (common, near_dup, mixing, corpus_pipeline):
        monkeypatch.setattr(module, "stored", storing)
    yield
    spark.conf.unset(conf)


@pytest.fixture
def docs(spark, workdir):
    """Twelve files of 20 texts; the texts of ids 20 k to 20 k + 4 are near copies, ids count down the files."""
    rows = []
    for i in range(240):
        near = 20 * (i // 20) if i % 20 < 5 else i
        words = [f"w{near}x{k}" for k in range(200 if near != i or i % 20 == 0 else 20 + i % 7)]
        rows.append((i, " ".join([*words, f"end{i}"]), f"s{i % 3}"))
    for k in range(12):
        spark.createDataFrame(rows[240 - 20 * k - 20:240 - 20 * k], DOCS).coalesce(1).write.mode("append").parquet(
            f"{workdir}/docs")
    return spark.read.parquet(f"{workdir}/docs")


def test_near_copies_go_whatever_the_splits(docs, resplit):
    kept = near_dup.keep_one(docs)
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(240) if i % 20 not in (1, 2, 3, 4)]
    classes = near_dup.near_duplicates(docs).collect()
    assert {r.doc_id: r.class_id for r in classes} == {i: i - i % 20 if i % 20 < 5 else i for i in range(240)}


def test_the_mix_draws_the_documents_it_planned(docs, resplit, monkeypatch):
    plans, mixture = [], mixing.mixture

    def kept_plan(*args, **options):
        plans.append(common.stored(mixture(*args, **options), "plan"))
        return plans[-1]

    monkeypatch.setattr(mixing, "mixture", kept_plan)
    drawn = collections.Counter(r.doc_id for r in mixing.draw(docs, block_words=64).collect())
    assert drawn == {r.doc_id: len(r.copies) for r in plans[0].collect() if r.copies}


def test_the_toxic_documents_go(spark, docs, resplit, monkeypatch):
    bad = F.col("text").contains("w20x")  # ids 20 to 24
    monkeypatch.setattr(corpus_pipeline.crf, "learn", lambda *a: None)
    monkeypatch.setattr(corpus_pipeline.crf, "score", lambda rows, model, id_col: rows.select(
        id_col, F.when(bad, 1.0).otherwise(0.0).alias("score")))
    kept = corpus_pipeline.drop_toxic(spark, docs, "/root/testdata/sf0.001")
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(240) if not 20 <= i < 25]
