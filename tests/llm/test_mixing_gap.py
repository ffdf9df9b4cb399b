"""A very long document at the cut does not leave its source short."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from ledgerline.llm import mixing  # noqa: E402


def test_the_line_goes_on_behind_a_long_document(spark, workdir):
    rows = [(i, "w " * 100, "a") for i in range(200)] + [(200, "w " * 15_000, "a")]
    rows += [(300 + i, "w " * 100, "b") for i in range(350)]
    spark.createDataFrame(rows, "doc_id int, text string, source string").write.parquet(f"{workdir}/docs")
    docs = spark.read.parquet(f"{workdir}/docs")
    behind = 0
    for seed in range(4):
        plan = [r for r in mixing.mixture(docs, seed=seed, block_words=512).collect() if r.source == "a"]
        target = plan[0].target
        assert round(target) == 23_333
        assert abs(sum(r.size * len(r.copies) for r in plan) - target) <= 50
        assert all(len(r.copies) <= 3 for r in plan)
        behind += not next(r for r in plan if r.doc_id == 200).copies
    assert behind  # a seed whose cut falls into the long document
