"""Every stage of the pipeline against a plain version, on a small table with odd rows and clashing columns."""

import collections
import itertools
import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from ledgerline.llm import crf, mixing
from ledgerline.llm.common import crc_fold
from ledgerline.llm.queries import vocabulary

SF = "/root/testdata/sf0.001"
CLASHING = ["_row", "_toxic", "_row_here", "_gone", "_copy", "k_id", "K_HASH", "k_text", "_h", "_t", "row", "score", "id"]


def spaced(text):
    return re.sub("[\x20\x09-\x0D]+", " ", text or "")


def word_list(text):
    return [w for w in re.split("[\x20\x09-\x0D]+", text or "") if w]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    to = tmp_path_factory.mktemp("pipeline")
    docs = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    text = docs[3]["text"]
    extra = [(5001, None, "en", None), (5002, "", "en", "web"), (5003, " \n\t", None, "web"), (None, text, "en", "web"),
             (5004, text.replace(" ", "  ", 3), "en", "web"), (docs[3]["doc_id"], text, "en", docs[3]["source"]),
             (5005, text + " one more word", "en", "new"), (5006, "a text of its own, never seen before it", "en", None),
             (5007, "very long " * 5000, "en", "web")]
    docs += [dict(doc_id=i, text=t, lang=lang, source=s, n_chars=None) for i, t, lang, s in extra]
    rows = [{**d, **{c: n for c in CLASHING}} for n, d in enumerate(docs)]
    pq.write_table(pa.Table.from_pylist(rows), f"{to}/documents.parquet")
    pq.write_table(pq.read_table(f"{SF}/labels.parquet"), f"{to}/labels.parquet")
    return str(to)


def key(r):
    return (r["doc_id"], r["text"], r["source"], r["id"])  # id numbers the rows


def bag(rows):
    return collections.Counter(map(key, rows))


def test_every_stage_equals_a_plain_version(spark, folder, workdir):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    stages = dict(P.STAGES)

    def step(name, df):
        out = stages[name](spark, df, folder)
        assert name == "packing" or out.columns == columns
        out.write.parquet(f"{workdir}/{name.replace(' ', '-')}")
        back = spark.read.parquet(f"{workdir}/{name.replace(' ', '-')}")
        return back, [r.asDict() for r in back.collect()]

    before = [r.asDict() for r in docs.collect()]
    kept, rows = step("toxicity", docs)
    labels = spark.read.parquet(f"{folder}/labels.parquet").where(crc_fold(F.col("doc_id"), 4) != 2)
    model = crf.learn(docs, labels)
    scores = {r["id"]: r["score"] for r in crf.score(docs, model, id_col="id").collect()}
    assert bag(rows) == bag(r for r in before if scores[r["id"]] < P.TOXIC_FROM)
    assert 0 < len(before) - len(rows) < 0.4 * len(before)

    before, (kept, rows) = rows, step("exact dedup", kept)
    groups = collections.defaultdict(list)
    for r in before:
        groups[spaced(r["text"])].append(r)
    assert sorted(spaced(r["text"]) for r in rows) == sorted(groups)
    for r in rows:  # the smallest id of its group, NULL last
        assert r["doc_id"] == min((x["doc_id"] for x in groups[spaced(r["text"])]), key=lambda i: (i is None, i or 0))
        assert r in groups[spaced(r["text"])]

    before, (kept, rows) = rows, step("near dedup", kept)
    sets = []
    for r in before:
        w = [x.encode().lower() for x in word_list(r["text"])]
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(before)))
    for i, j in itertools.combinations(range(len(before)), 2):
        if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
            label = [label[i] if x == label[j] else x for x in label]
    classes = collections.defaultdict(list)
    for i, r in zip(label, before):
        classes[i].append(r)
    first = [min(c, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0)) for c in classes.values()]
    assert bag(rows) == bag(first) and len(rows) < len(before)

    before, (kept, rows) = rows, step("mixing", kept)
    size = lambda r: len(word_list(r["text"]))
    by_source = collections.Counter()
    for r in before:
        by_source[r["source"]] += size(r)
    order = sorted(by_source, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), sum(by_source.values())
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        full = {s for s in free if share[s] > 3 * by_source[s]}
        target |= {s: 3 * by_source[s] for s in full} if full else share
        left -= sum(3 * by_source[s] for s in full)
        free = free - full if full else set()
    copies, of = bag(rows), {key(r): r for r in before}
    assert set(copies) <= set(of) and max(copies.values()) <= 3 and all(size(of[k]) for k in copies)
    for s in order:
        taken = sum(n * size(of[k]) for k, n in copies.items() if k[2] == s)
        spare = [size(of[k]) for k in of if k[2] == s and copies[k] < 3 and size(of[k])]
        assert abs(taken - target[s]) <= max(0.5, min(spare, default=0) if taken < target[s] else max(map(size, before)))
    assert len(rows) == sum(copies.values()) > 0

    _, pieces = step("packing", kept)
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(vocabulary())
    expected = collections.Counter()
    for r in rows:
        expected[r["doc_id"]] += len(own.encode(r["text"], add_special_tokens=False).ids) + 1
    packed, ends = collections.Counter(), collections.defaultdict(list)
    for p in pieces:
        packed[p["doc_id"]] += p["length"]
        ends[p["sequence_id"]].append((p["offset"], p["length"]))
    assert packed == expected
    for parts in ends.values():
        at = np.cumsum([0, *[n for _, n in sorted(parts)]])
        assert [o for o, _ in sorted(parts)] == at[:-1].tolist() and at[-1] <= 1024


def test_run_applies_the_stages_in_order(spark, folder):
    assert [n for n, _ in P.STAGES] == ["toxicity", "exact dedup", "near dedup", "mixing", "packing"]
    first = sorted(map(repr, P.run(spark, folder).drop("sequence_id", "offset").collect()))
    assert first and first == sorted(map(repr, P.run(spark, folder).drop("sequence_id", "offset").collect()))


def test_stages_of_an_empty_table(spark, folder):
    empty = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in P.STAGES:
        out = stage(spark, empty, folder)
        assert out.count() == 0 and (name == "packing" or out.columns == empty.columns)
    assert mixing.mixture(empty).count() == 0
