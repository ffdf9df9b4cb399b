"""A chained month: what its opening leaves out is reported, partial deliveries keep the rolled rest."""

from decimal import Decimal

from conftest import SF_SMALL
from pyspark.sql import functions as F

from ledgerline.model import Period
from ledgerline.plans import pipelines as pl
from ledgerline.plans.queries import Model, write_landing
from ledgerline.sources import sinks


def test_opening_of_a_chained_month(spark, workdir):
    m = Model(spark, SF_SMALL)
    landing = f"{workdir}/landing-opening"
    write_landing(m, landing)
    wh = pl.Warehouse(spark, f"{workdir}/wh-opening")
    pl.run_fill_procedure(spark, landing, wh.root, m.period)
    february, last = Period.month(1998, 2), m.period.end

    def opening():
        return {r.account_rk: r.balance_out for r in pl._balance_mart(wh).where(F.col("on_date") == F.lit(last)).collect()}

    rolled = opening()
    closed, given = sorted(rolled)[:2]
    accounts, balances = wh.read("ds", "md_account_d"), wh.read("ds", "ft_balance_f")
    one = balances.limit(1)
    end = F.when(F.col("account_rk") == closed, F.least("data_actual_end_date", F.lit(last)))
    sinks.full_refresh(accounts.where((F.col("account_rk") != closed) | (F.col("data_actual_date") <= F.lit(last)))
                       .withColumn("data_actual_end_date", F.coalesce(end, "data_actual_end_date")),
                       wh.path("ds", "md_account_d"))

    pl.fill_opening(wh, february)
    pl.report_unmatched(wh, february)
    orphans = wh.read("rejects", "orphan_balances")
    assert [r.balance_out for r in orphans.where(F.col("account_rk") == closed).collect()] == [rolled[closed]]

    delivered = one.withColumn("on_date", F.lit(last)).withColumn("account_rk", F.lit(given).cast("bigint")).withColumn(
        "balance_out", F.lit(Decimal("12.50")).cast(balances.schema["balance_out"].dataType))
    sinks.full_refresh(balances.unionByName(delivered), wh.path("ds", "ft_balance_f"))
    for _ in range(2):
        pl.fill_opening(wh, february)
        assert opening() == rolled | {given: Decimal("12.50")}
