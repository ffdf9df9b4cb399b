"""Months run one after the other; sinks that fail keep the old rows."""

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from ledgerline.functions.ledger import signed_movement
from ledgerline.model import Period
from ledgerline.plans import pipelines as pl
from ledgerline.plans.queries import Model, write_landing
from ledgerline.sources import sinks


def _day(wh, day):
    return sorted(tuple(r) for r in pl._balance_mart(wh).where(F.col("on_date") == F.lit(day)).collect())


def test_second_month_starts_from_the_first_months_last_day(spark, workdir):
    m = Model(spark, SF_SMALL)
    landing = f"{workdir}/landing-chain"
    write_landing(m, landing)
    wh = pl.Warehouse(spark, f"{workdir}/wh-chain")
    pl.run_fill_procedure(spark, landing, wh.root, m.period)
    last = _day(wh, m.period.end)
    assert last
    february = Period.month(1998, 2)
    for _ in range(2):  # running February again changes nothing
        pl.fill_turnover(wh, february)
        pl.fill_opening(wh, february)
        pl.fill_balance(wh, february)
        assert _day(wh, m.period.end) == last


def test_no_opening_at_all_is_an_error(spark, workdir):
    m = Model(spark, SF_SMALL)
    landing = f"{workdir}/landing-none"
    write_landing(m, landing)
    wh = pl.Warehouse(spark, f"{workdir}/wh-none")
    pl.ingest(wh, landing)
    with pytest.raises(ValueError, match="no balances"):
        pl.fill_opening(wh, Period.month(1998, 3))


def test_failing_refresh_keeps_the_old_table(spark, workdir):
    path = f"{workdir}/refresh"
    sinks.full_refresh(spark.range(5), path)
    bad = spark.range(3).select(F.raise_error(F.lit("stop")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="stop"):
        sinks.full_refresh(bad, path)
    assert spark.read.parquet(path).count() == 5
    sinks.full_refresh(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2


def test_unknown_account_kind_has_no_sign(spark):
    rows = spark.createDataFrame([("А",), ("П",), ("A",), (None,)], "char_type string")
    got = [r[0] for r in rows.select(signed_movement(F.lit(3), F.lit(1))).collect()]
    assert got == [2, -2, None, None]


def test_rows_that_no_mart_takes_are_reported(spark, workdir):
    m = Model(spark, SF_SMALL)
    landing = f"{workdir}/landing-unmatched"
    write_landing(m, landing)
    wh = pl.Warehouse(spark, f"{workdir}/wh-unmatched")
    pl.run_fill_procedure(spark, landing, wh.root, m.period)
    out = {n: sinks.read_table(spark, wh.path("rejects", n))
           for n in ("turnover_unmatched", "accounts_without_ledger", "orphan_balances")}
    assert out["orphan_balances"].count() > 0 and out["accounts_without_ledger"].count() == 0
    sums = [F.sum("credit_amount"), F.sum("debet_amount")]
    mart = pl._turnover_mart(wh, m.period)
    left = out["turnover_unmatched"]
    assert left.count() > 0
    got = [a + b for a, b in zip(mart.agg(*sums).first(), left.agg(*sums).first(), strict=True)]
    assert got == list(m.daily_turnover().agg(*sums).first())
    assert got[0] == got[1]  # every posting has both sides somewhere
