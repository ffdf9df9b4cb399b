"""Deliveries into a chained month, withdrawn again; postings stored by month."""

import datetime as dt

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from ledgerline.model import Period
from ledgerline.plans import pipelines as pl
from ledgerline.plans.queries import Model, write_landing


def _day(wh, day):
    return {r.account_rk: r.balance_out for r in pl._balance_mart(wh).where(F.col("on_date") == F.lit(day)).collect()}


@pytest.mark.parametrize("versioned", [False, True])
def test_a_withdrawn_balance_gives_way_to_the_rolled_one(spark, workdir, versioned):
    m = Model(spark, SF_SMALL)
    landing = f"{workdir}/landing-{versioned}"
    write_landing(m, landing)
    wh = (pl.VersionedWarehouse if versioned else pl.Warehouse)(spark, f"{workdir}/wh-{versioned}")
    pl.ingest(wh, landing)
    pl.fill_turnover(wh, m.period)
    pl.fill_opening(wh, m.period)
    pl.fill_balance(wh, m.period)
    february, last = Period.month(1998, 2), m.period.end
    rolled = _day(wh, last)
    keys = sorted(rolled)[:3]

    def deliver(accounts):
        rows = [(last, k, 0, 1000 + k) for k in accounts] or [(dt.date(1997, 12, 31), 1, 0, 5)]
        wh.refresh(spark.createDataFrame(rows, "on_date date, account_rk bigint, currency_rk int, balance_out int").select(
            "on_date", "account_rk", "currency_rk", F.col("balance_out").cast("decimal(23,8)").alias("balance_out")),
            "ds", "ft_balance_f")
        pl.fill_opening(wh, february)
        return _day(wh, last)

    first = deliver(keys[:2])
    assert first == rolled | {k: 1000 + k for k in keys[:2]}
    assert deliver(keys[1:]) == rolled | {k: 1000 + k for k in keys[1:]}  # the first one is withdrawn
    assert deliver([]) == rolled                                           # all of them are
    deliver(keys[:1])
    wh.refresh(m.balances().select("on_date", "account_rk", "currency_rk",
                                   F.col("balance_out").cast("decimal(23,8)").alias("balance_out")), "ds", "ft_balance_f")
    pl.fill_balance(wh, m.period)  # January is rolled anew
    assert _day(wh, last) == rolled and not wh.has_day(pl.ROLLED, last)


@pytest.mark.parametrize("versioned", [False, True])
def test_a_month_reads_only_its_postings(spark, workdir, versioned):
    m = Model(spark, SF_SMALL)
    landing = f"{workdir}/landing-month-{versioned}"
    write_landing(m, landing)
    wh = (pl.VersionedWarehouse if versioned else pl.Warehouse)(spark, f"{workdir}/wh-month-{versioned}")
    pl.ingest(wh, landing)
    january = wh.in_months("ft_posting_f", m.period)
    whole = wh.read("ds", "ft_posting_f")
    assert whole.columns == january.columns and whole.count() == m.postings().count()
    inside = (F.col("oper_date") >= F.lit(m.period.start)) & (F.col("oper_date") <= F.lit(m.period.end))
    assert january.count() == whole.where(inside).count() > 0
    plan = january._jdf.queryExecution().executedPlan().toString()
    assert all("_month" in line.split("PartitionFilters: [")[1].split("PushedFilters")[0]
               for line in plan.split("\n") if "PartitionFilters: [" in line)
    files = january.select(F.input_file_name().alias("f")).distinct().collect()
    assert files and all("_month=1998-01-01" in r.f for r in files)
