"""Form 101 from bucketed marts: no shuffle of accounts, opening, turnover or closing balances."""

import re

from conftest import SF_SMALL
from pyspark.sql import functions as F

from ledgerline.model import Period
from ledgerline.plans.queries import Model, form101_of, marts_of
from ledgerline.sources.marts import BucketedMart


def test_no_exchange_between_the_marts(spark, workdir):
    m = Model(spark, SF_SMALL)
    marts = marts_of(m, f"{workdir}/marts")
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in off}
    try:
        for k, v in off.items():
            spark.conf.set(k, v)
        report = form101_of(m, marts)
        rows = report.collect()
        plan = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(rows) == 12 and plan.count("SortMergeJoin") >= 3
    exchanges = re.findall(r"Exchange (?:hash|range|Single)[^\n]*", plan)
    assert exchanges and all("chapter" in e for e in exchanges), exchanges  # the sums per ledger only
    assert not re.search(r"hashpartitioning\(account_rk", plan)


def test_days_are_replaced_and_bucketed(spark, workdir):
    day = F.expr("date_add(DATE'2018-01-01', CAST(id % 3 AS int))")
    rows = spark.range(900).select((F.col("id") % 50).alias("account_rk"), F.col("id").alias("x"), day.alias("on_date"))
    mart = BucketedMart(spark, f"{workdir}/mart", rows.schema, buckets=4)
    p = Period.month(2018, 1)
    mart.replace_days(rows, p.start, p.start.replace(day=3))
    assert mart.read().count() == 900 and mart.read().where("on_date = DATE'2018-01-02'").count() == 300
    one = rows.where("on_date = DATE'2018-01-02' AND x < 100")
    mart.replace_days(one, p.start.replace(day=2), p.start.replace(day=3))  # the 3rd ends empty
    got = mart.read()
    assert (got.where("on_date = DATE'2018-01-01'").count(), got.where("on_date = DATE'2018-01-02'").count(),
            got.where("on_date = DATE'2018-01-03'").count()) == (300, 33, 0)
    again = BucketedMart(spark, f"{workdir}/mart", rows.schema, buckets=4)  # as a new session finds it
    assert sorted(map(tuple, again.read().collect())) == sorted(map(tuple, got.collect()))
    plan = got.groupBy("account_rk").agg(F.sum("x"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan


def test_whole_table_refresh(spark, workdir):
    rows = spark.range(100).select(F.col("id").alias("account_rk"), F.col("id").cast("string").alias("t"))
    mart = BucketedMart(spark, f"{workdir}/accounts", rows.schema, day=None, buckets=4)
    for n in (100, 40):
        mart.refresh(rows.where(F.col("account_rk") < n))
        assert mart.read().count() == n
