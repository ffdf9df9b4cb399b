"""Results do not depend on how a scan is split; ids equal those of a tokenizer of the test's own."""

import collections
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import mixing
from ledgerline.llm.queries import vocabulary
from ledgerline.llm.tokens import Encoder


def _docs(seed):
    r = random.Random(seed)
    rows = [(i, "w" + " w" * r.randint(0, 60), r.choice(["a", "b", "c", None])) for i in range(600)]
    rows += rows[:40] + [(i, t, "c") for i, t, _ in rows[:20]] + [(None, t, s) for _, t, s in rows[5:25]] + [(9, None, "a")]
    return r.sample(rows, len(rows))


def test_mixture_does_not_depend_on_scan_splits(spark, workdir):
    rows = _docs(1)
    found = []
    for name, order, parts, size in (("one", rows, 1, "128m"), ("many", rows[::-1], 9, "128m"), ("split", rows, 3, "2k")):
        spark.createDataFrame(order, "doc_id int, text string, source string").repartition(parts).write.parquet(
            f"{workdir}/{name}")
        old = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            docs = spark.read.parquet(f"{workdir}/{name}")
            plan = mixing.mixture(docs, block_words=64, levels=3).collect()
            drawn = mixing.draw(docs, block_words=64, levels=3).collect()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        found.append((
            collections.Counter((r.doc_id, r.source, r.size, len(r.copies)) for r in plan),
            collections.Counter((r.doc_id, c.epoch, c.shard, c.place) for r in plan for c in r.copies),
            collections.Counter(drawn)))
    assert found[0] == found[1] == found[2]


def test_prefix_sums_in_groups_equal_plain_ones(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP_BUCKETS", 4)
    r = random.Random(2)
    rows = [(o, n, b, r.randint(0, 9)) for o in range(3) for n in range(2) for b in r.sample(range(40), 25)]
    found = mixing._before(spark.createDataFrame(rows, "ord int, n int, bucket int, words bigint"), "n").collect()
    assert {(x.ord, x.n, x.bucket): x.before for x in found} == {
        (o, n, b): sum(w for p, m, c, w in rows if p == o and (m, c) < (n, b)) for o, n, b, _ in rows}


def test_tree_follows_the_size(spark, monkeypatch):
    assert [mixing.tree_levels(n) for n in (0, 1, 8_000_000, 8_000_001, 10 ** 12)] == [0, 0, 0, 1, 17]
    monkeypatch.setattr(mixing, "STORED_LEVELS", 2)  # the tree goes through stored tables
    quotas = spark.createDataFrame([(0, 1000), (1, 333), (2, 7)], "ord int, blocks bigint")
    leaves = mixing.split_quotas(quotas, 5, seed=1).collect()
    total = collections.Counter()
    for r in leaves:
        total[r.ord] += r.blocks
    assert dict(total) == {0: 1000, 1: 333, 2: 7} and {r.shard for r in leaves} <= set(range(32))


@pytest.mark.parametrize("text", [
    "a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y z", "tail <|endoftext|>", "<|endoftext|>\n<|endoftext|> lead",
    "a  b <|endoftext|>\t c", "<|endoftext| > no token", "plain words."])
def test_ids_with_added_tokens(text):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(vocabulary())
    texts = ["before it", text, "behind it", text]
    for got, t in zip(Encoder.of(vocabulary()).encode(pa.array(texts)), texts, strict=True):
        assert got.tolist() == own.encode(t, add_special_tokens=False).ids


def test_an_added_token_is_one_id():
    found = next(iter(Encoder.of(vocabulary()).encode(pa.array(["a <|endoftext|> b"]))))
    assert len(found) == 4 and 50256 in found.tolist()


def test_hash_order_uses_whole_texts(spark):
    docs = spark.createDataFrame([(1, "w " * 50 + x, "a") for x in ("x", "y")], "doc_id int, text string, source string")
    h = [r[0] for r in docs.select(F.xxhash64(F.lit(17), "doc_id", "source", "text")).collect()]
    assert h[0] != h[1]
