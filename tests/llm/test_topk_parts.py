"""Top-k search over many parts and query groups gives what all products give, and meets a vector's bucket once a group."""

import os
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from ledgerline.llm import topk  # noqa: E402


@pytest.mark.parametrize("copies", [1, 60])
def test_many_parts_and_groups(spark, monkeypatch, copies):
    """Small blocks, so that parts, groups, pruned pairs and two dimensions occur; also with a third of all rows equal."""
    for name, value in (("BUCKET_ROWS", 16), ("QUERY_ROWS", 4), ("PART_BUCKETS", 2), ("GROUP_BLOCKS", 2)):
        monkeypatch.setattr(topk, name, value)
    r = np.random.default_rng(6)
    rows = [(i, (r.standard_normal(5 if i % 3 else 4) * r.choice([0.05, 1, 6])).tolist()) for i in range(240)]
    rows += [(1000 + i, rows[1][1]) for i in range(copies * 2)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(5)
    got = topk.top_k(df, F.col("vec_id") % 10 == 0, k=7).collect()
    v = [(i, np.floor(64 * np.array(x)).astype(int)) for i, x in rows]
    want = []
    for n, (q, x) in enumerate(v):
        if q % 10 == 0:
            best = sorted((-int(x @ y), c) for m, (c, y) in enumerate(v) if m != n and len(y) == len(x))[:7]
            want += [(q, k, c, -s) for k, (s, c) in enumerate(best, 1)]
    assert sorted(map(tuple, got)) == sorted(want)
