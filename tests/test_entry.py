"""The driver contract: entry, queries, oracles (checked at sf0.001)."""

import os
import sys

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["nation", "customer", "supplier", "orders", "lineitem"]
# every registered query, the file-writing ones included
from ledgerline.plans.queries import QUERIES  # noqa: E402

QUICK = sorted(QUERIES)


def test_entry_runs(spark):
    df = E.entry(spark)
    got = df.collect()
    assert len(got) == 12
    assert {"from_date", "ledger_account", "balance_out_total"} <= set(df.columns)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    return round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", QUICK)
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    mine = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    rel = con.sql(E.oracle_sql()[name])
    idx = [rel.columns.index(c) for c in cols]
    theirs = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert sorted(rel.columns) == cols
    assert mine == theirs
