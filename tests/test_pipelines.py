"""The composed jobs D1-D4 on the sf0.001 model, against the direct queries."""

import math
import uuid

from conftest import SF_SMALL
from pyspark.sql import functions as F

from ledgerline.plans import pipelines as pl
from ledgerline.plans.queries import Model, write_landing
from ledgerline.sources.specs import REPORT_MEASURES


def _close(a, b):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(float(a), float(b), rel_tol=1e-12, abs_tol=1e-6)


def test_fill_procedure_then_export_and_reload(spark, workdir):
    m = Model(spark, SF_SMALL)
    landing, wh_root = f"{workdir}/landing", f"{workdir}/wh"
    write_landing(m, landing)
    run_id = pl.run_fill_procedure(spark, landing, wh_root, m.period)
    wh = pl.Warehouse(spark, wh_root)

    # journal: the run and its two fill steps finished
    state = {r.status for r in wh.journal().state().collect()}
    assert {"Finished_etl_process", "Finished_fill_dm_account_turnover",
            "Finished_fill_account_balance"} <= state
    assert run_id

    # balance mart = the direct roll-forward (fused plan) + the opening day
    mart = pl._balance_mart(wh)
    direct = m.daily_balance()
    days = mart.where(F.col("on_date") >= F.lit(m.period.start))
    assert days.count() == direct.count()
    diff = days.join(direct.withColumnRenamed("balance_out", "b2").withColumnRenamed("balance_out_rub", "r2"),
                     ["on_date", "account_rk"]).where("balance_out <> b2 OR balance_out_rub <> r2")
    assert diff.count() == 0
    assert mart.where(F.col("on_date") == F.lit(m.period.opening)).count() == m.balances().count()

    # report from the marts = the direct report
    rep = {r.ledger_account: r for r in wh.read("dm", pl.REPORT_TABLE).collect()}
    want = {r.ledger_account: r for r in m.form101().collect()}
    assert set(rep) == set(want)
    for k in want:
        assert all(_close(rep[k][c], want[k][c]) for c in REPORT_MEASURES), k

    # D3 export, then D4 re-import twice: the period is replaced, not doubled
    out = f"{workdir}/export/dm_f101_round_f.csv"
    pl.extract_report(spark, wh.read("dm", pl.REPORT_TABLE), out, wh.journal())
    pl.extract_report(spark, wh.read("dm", pl.REPORT_TABLE), out)
    pl.load_report(spark, out, wh_root, wh.journal())
    pl.load_report(spark, out, wh_root)
    v2 = wh.read("dm", pl.REPORT_V2)
    assert v2.count() == len(want)
    pl.load_report(spark, out, wh_root, mode="append")
    assert wh.read("dm", pl.REPORT_V2).count() == 2 * len(want)

    # rerunning the whole procedure changes nothing (fresh reads: a
    # DataFrame keeps the file listing it was created with)
    before = pl._balance_mart(wh).count()
    pl.run_fill_procedure(spark, landing, wh_root, m.period)
    assert pl._balance_mart(wh).count() == before


def test_load_to_database_derby(spark, workdir):
    m = Model(spark, SF_SMALL)
    landing = f"{workdir}/landing2"
    write_landing(m, landing)
    url = f"jdbc:derby:memory:d2{uuid.uuid4().hex[:8]};create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    written = pl.load_to_database(spark, landing, url, props)
    assert set(written) == {"ft_balance_f", "ft_posting_f", "md_account_d", "md_currency_d",
                            "md_exchange_rate_d", "md_ledger_account_s"}
    rates = spark.read.jdbc(url, "ds.md_exchange_rate_d", properties=props)
    assert rates.count() == m.rates().count()


def test_command_line_runs_the_four_jobs(spark, workdir):
    from ledgerline.__main__ import main

    m = Model(spark, SF_SMALL)
    landing, wh_root = f"{workdir}/landing3", f"{workdir}/wh3"
    write_landing(m, landing)
    assert main(["fill", "--landing", landing, "--warehouse", wh_root, "--month", "1998-01"]) == 0
    out = f"{workdir}/export3"
    assert main(["extract", "--warehouse", wh_root, "--out", out]) == 0
    assert main(["load-report", "--warehouse", wh_root, "--csv", out]) == 0
    wh = pl.Warehouse(spark, wh_root)
    assert wh.read("dm", pl.REPORT_V2).count() == 12
    url = f"jdbc:derby:memory:cli{uuid.uuid4().hex[:8]};create=true"
    assert main(["load-db", "--landing", landing, "--url", url,
                 "--driver", "org.apache.derby.jdbc.EmbeddedDriver"]) == 0


def test_rerun_after_a_day_lost_its_postings(spark, workdir):
    """D1 twice; between the runs every posting of one day is withdrawn. The
    second run must leave no turnover for that day and roll the balances
    without it."""
    import datetime as dt

    from ledgerline.sources import csv as csvio
    from ledgerline.sources.specs import POSTING

    m = Model(spark, SF_SMALL)
    landing, wh_root = f"{workdir}/landing4", f"{workdir}/wh4"
    write_landing(m, landing)
    pl.run_fill_procedure(spark, landing, wh_root, m.period)
    wh = pl.Warehouse(spark, wh_root)
    day = m.period.start + dt.timedelta(days=9)
    assert pl._turnover_mart(wh, m.period).where(F.col("on_date") == F.lit(day)).count() > 0

    fewer = m.postings().where(F.col("oper_date") != F.lit(day))
    csvio.write_delimited(csvio.to_source_layout(fewer, POSTING), f"{landing}/{POSTING.name}.csv",
                          sep=POSTING.sep, upper_header=True, mode="overwrite")
    pl.run_fill_procedure(spark, landing, wh_root, m.period)
    assert pl._turnover_mart(wh, m.period).where(F.col("on_date") == F.lit(day)).count() == 0
    # the balance of that day equals the day before for every account
    b = pl._balance_mart(wh)
    prev = b.where(F.col("on_date") == F.lit(day - dt.timedelta(days=1))).select(
        "account_rk", F.col("balance_out").alias("p"))
    same = b.where(F.col("on_date") == F.lit(day)).join(prev, "account_rk")
    assert same.where(F.col("balance_out") != F.col("p")).count() == 0
    assert same.count() > 0
