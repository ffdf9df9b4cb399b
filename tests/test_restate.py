"""Late deliveries: restated marts equal marts built from everything at once."""

import random
import re
from decimal import Decimal

import pytest
from conftest import SF_SMALL
from helpers import ACCOUNTS, BALANCES, POSTINGS, RATES, D, frame
from pyspark.sql import functions as F

from ledgerline.model import Period
from ledgerline.operators import balance as bal
from ledgerline.operators import restate as rst
from ledgerline.operators import turnover as tov
from ledgerline.plans import pipelines as pl
from ledgerline.plans.queries import Model, write_landing
from ledgerline.sources import sinks

P = Period(D(2018, 1, 1), D(2018, 1, 20))
A, PV = "А", "П"


def _case(spark, seed):
    r = random.Random(seed)
    accounts = []
    for k in range(1, 25):
        if k % 4 == 0:  # two versions with a gap, one of them of the other kind
            accounts += [(P.start, D(2018, 1, 6), k, f"30101810{k:012d}", A, 0, "643"),
                         (D(2018, 1, 12), P.end, k, f"30101810{k:012d}", PV, 5, "978")]
        elif k % 5 == 0:  # opens inside the period
            accounts.append((D(2018, 1, 9), P.end, k, f"30101810{k:012d}", PV, 5, "978"))
        else:
            accounts.append((P.start, P.end if k % 7 else D(2018, 1, 8), k, f"30101810{k:012d}", A, k % 2 * 5, "643"))
    postings = [(D(2018, 1, r.randint(1, 20)), r.randint(1, 24), r.randint(1, 24), Decimal(x), Decimal(x))
                for x in (r.randint(1, 900) for _ in range(400))]
    late = [(D(2018, 1, r.randint(8, 20)), r.choice([1, 4, 5, 8]), r.choice([4, 9, 10]), Decimal(7), Decimal(7))
            for _ in range(12)]
    rates = frame(spark, RATES, [(D(2017, 12, 1), None, 5, Decimal(3), "978")])
    opening = bal.opening_balance(frame(spark, BALANCES, [(P.opening, k, 0, Decimal(100 * k)) for k in range(1, 25)
                                                          if k % 3]), rates, P.opening)
    return frame(spark, ACCOUNTS, accounts), postings, late, rates, opening


def _rows(df):
    return sorted(tuple(r) for r in df.select("on_date", "account_rk", "balance_out", "balance_out_rub").collect())


def _mart(spark, df, path, first):
    sinks.replace_days(df, path, "on_date", first, P.end)
    return spark.read.schema(df.schema).parquet(path)


@pytest.mark.parametrize("seed", [1, 2])
def test_restated_balance_equals_a_rebuild(spark, workdir, seed):
    accounts, postings, late, rates, opening = _case(spark, seed)
    state = lambda rows: tov.turnover_fx(frame(spark, POSTINGS, rows), accounts, rates, P)
    before, after = state(postings), state(postings + late)
    filled = bal.daily_balance(accounts, opening, before, P)
    opening = opening.select(*[F.col(f.name).cast(f.dataType) for f in filled.schema])
    mart = _mart(spark, filled.unionByName(opening), f"{workdir}/balance-{seed}", P.opening)
    since = D(2018, 1, 8)
    late_only = lambda df: df.where(F.col("on_date") >= F.lit(since))
    changes = rst.turnover_changes(late_only(before), late_only(after))
    assert {r.account_rk for r in changes.collect()} <= {1, 4, 5, 8, 9, 10}
    again = rst.restated_balance(accounts, mart, changes, after, P, since)
    expected = [r for r in _rows(bal.daily_balance(accounts, opening, after, P)) if r[0] >= since]
    assert _rows(again) == expected
    plan = again._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"PartitionFilters: \[([^\n]*?)\], PushedFilters", plan)
    assert scans and all("on_date" in s for s in scans)  # days from since on, and the listed starting days
    # a half-written mart: some of its days are new already
    sinks.replace_days(again, f"{workdir}/balance-{seed}", "on_date", D(2018, 1, 12), D(2018, 1, 15))
    half = spark.read.schema(filled.schema).parquet(f"{workdir}/balance-{seed}")
    assert _rows(rst.restated_balance(accounts, half, changes, after, P, since)) == expected


def test_no_change_restates_nothing(spark, workdir):
    accounts, postings, _, rates, opening = _case(spark, 3)
    t = tov.turnover_fx(frame(spark, POSTINGS, postings), accounts, rates, P)
    changes = rst.turnover_changes(t, t)
    assert changes.isEmpty()
    filled = bal.daily_balance(accounts, opening, t, P)
    mart = _mart(spark, filled, f"{workdir}/same", P.start)
    assert _rows(rst.restated_balance(accounts, mart, changes, t, P, D(2018, 1, 18))) == [
        r for r in _rows(filled) if r[0] >= D(2018, 1, 18)]
    with pytest.raises(ValueError):
        rst.restated_balance(accounts, mart, changes, t, P, D(2018, 2, 1))


def test_pipeline_restates_its_marts(spark, workdir):
    m = Model(spark, SF_SMALL)
    since = m.period.start.replace(day=15)
    late = (F.col("oper_date") >= F.lit(since)) & (F.col("credit_account_rk") % 2 == 0)
    all_, some = Model(spark, SF_SMALL), Model(spark, SF_SMALL)
    some._views["postings"] = m.postings().where(~late)
    write_landing(all_, f"{workdir}/landing-all")
    write_landing(some, f"{workdir}/landing-some")
    whole, late_wh = pl.Warehouse(spark, f"{workdir}/wh-whole"), pl.Warehouse(spark, f"{workdir}/wh-late")
    pl.run_fill_procedure(spark, f"{workdir}/landing-all", whole.root, m.period)
    pl.run_fill_procedure(spark, f"{workdir}/landing-some", late_wh.root, m.period)
    assert _rows(pl._balance_mart(late_wh)) != _rows(pl._balance_mart(whole))
    pl.ingest(late_wh, f"{workdir}/landing-all")
    pl.restate(late_wh, m.period, since)
    assert _rows(pl._balance_mart(late_wh)) == _rows(pl._balance_mart(whole))
    report = lambda wh: sorted(map(repr, wh.read("dm", pl.REPORT_TABLE).collect()))
    assert report(late_wh) == report(whole)
