"""Interval joins: rates by day bucket and spread, and account versions made disjoint."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from helpers import ACCOUNTS, RATES, D, frame

from ledgerline.operators import fx, sizing
from ledgerline.operators.versions import disjoint_versions

DAY = dt.timedelta(days=1)


def _rates(seed):
    r = random.Random(seed)
    rows = []
    for currency in (5, 6, 7):
        starts = sorted({D(1995, 1, 1) + r.randint(0, 2500) * DAY for _ in range(60)})
        rows += [(s, None if r.random() < 0.1 else s + r.randint(0, 400) * DAY, currency, Decimal(i + 1), "x")
                 for i, s in enumerate(starts)]
    # before the first bucket and behind the last one
    rows += [(D(1900, 1, 1), D(1950, 1, 1), 8, Decimal(1), "x"), (D(1950, 1, 2), D(2300, 1, 1), 8, Decimal(2), "x"),
             (D(2300, 1, 2), None, 8, Decimal(3), "x"), (D(2001, 1, 1), D(2000, 1, 1), 9, Decimal(1), "x")]
    return rows


def _valid(rows, currency, day):
    """The rate that started last among those of the currency, if it still holds."""
    started = [r for r in rows if r[2] == currency and r[0] <= day]
    last = max(started, key=lambda r: r[0], default=None)
    return last[3] if last and (last[1] is None or day <= last[1]) else None


@pytest.mark.parametrize("broadcast_bytes", [sizing.BROADCAST_BYTES, -1])
def test_rate_join_equals_brute_force(spark, workdir, monkeypatch, broadcast_bytes):
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", broadcast_bytes)
    rows = _rates(1)
    frame(spark, RATES, rows).write.mode("overwrite").parquet(f"{workdir}/rates-{broadcast_bytes}")
    rates = spark.read.parquet(f"{workdir}/rates-{broadcast_bytes}")
    r = random.Random(2)
    facts = [(i, D(1994, 6, 1) + r.randint(0, 3200) * DAY, r.choice([5, 5, 5, 6, 7, 9])) for i in range(3000)]
    facts += [(5000 + i, d, 8) for i, d in enumerate([D(1899, 1, 1), D(1930, 1, 1), D(1950, 1, 1), D(1950, 1, 2),
                                                     D(2299, 12, 31), D(2300, 1, 1), D(2300, 1, 2), D(9999, 1, 1)])]
    facts += [(9000, None, 5), (9001, D(1998, 1, 1), None)]
    df = spark.createDataFrame(facts, "id int, on_date date, currency_rk int")
    joined = fx.with_rate_on(df, rates)
    got = {x.id: x.reduced_cource for x in joined.collect()}
    assert got == {i: _valid(rows, c, d) if d else None for i, d, c in facts} and joined.columns == [
        "id", "on_date", "currency_rk", "reduced_cource"]
    plan = joined._jdf.queryExecution().executedPlan().toString()
    if broadcast_bytes > 0:
        assert "BroadcastHashJoin [currency_rk" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_a_hot_currency_is_spread_over_tasks(spark, workdir, monkeypatch):
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", -1)
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
           "spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in off}
    try:
        for k, v in off.items():
            spark.conf.set(k, v)
        facts = spark.range(20_000).selectExpr(
            "id", "DATE'1998-01-05' AS on_date", "CAST(if(id % 10 < 9, 5, 6) AS int) AS currency_rk")
        joined = fx.with_rate_on(facts, frame(spark, RATES, [(D(1998, 1, 1), None, 5, Decimal(2), "x")]))
        sizes = [r["count"] for r in joined.selectExpr("spark_partition_id() AS p").groupBy("p").count().collect()]
        assert sum(sizes) == 20_000 and max(sizes) < 10_000 and len(sizes) > 4  # one currency holds 18,000
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "currency_rk" in plan and "_spread" in plan and "SortMergeJoin" in plan
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_planning_runs_no_job(spark, workdir):
    frame(spark, RATES, _rates(3)).write.mode("overwrite").parquet(f"{workdir}/rates-plan")
    rates = spark.read.parquet(f"{workdir}/rates-plan")
    df = spark.range(10).selectExpr("id", "DATE'1998-01-05' AS on_date", "CAST(5 AS int) AS currency_rk")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning-only", "no job expected")
    try:
        fx.with_rate_on(df, rates)
        assert list(tracker.getJobIdsForGroup("planning-only")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def _by_day(rows):
    """(account, day) -> (number, kind) by the stated precedence."""
    best = {}
    for first, last, key, number, kind, *rest in rows:
        day, stop = first, min(last or D(2031, 1, 1), D(2031, 1, 1))
        rank = (first, -(last or D(9999, 12, 31)).toordinal(), number, kind, *rest)
        while day <= stop:
            best[key, day] = max(best.get((key, day), rank), rank)
            day += DAY
    return {k: v[2:4] for k, v in best.items()}


@pytest.mark.parametrize("days", [366, 20])
def test_disjoint_versions_equal_brute_force(spark, days):
    r = random.Random(days)
    rows = []
    for key in range(40):
        for n in range(r.randint(1, 7)):
            first = D(2028, 1, 1) + r.randint(0, 500) * DAY
            last = None if r.random() < 0.1 else first + r.choice([0, 1, 5, 30, 200, -1]) * DAY
            rows.append((first, last, key, f"{r.randint(0, 3)}", r.choice("АП"), 0, "643"))
            if r.random() < 0.3:
                rows.append(rows[-1])  # delivered twice
            if r.random() < 0.3:
                rows.append((first, first + 10 * DAY, key, f"{n}", "А", 0, "643"))  # equal start
    out = disjoint_versions(frame(spark, ACCOUNTS, rows), days=days).collect()
    expected, got = _by_day(rows), {}
    for v in out:
        day, stop = v.data_actual_date, min(v.data_actual_end_date or D(2031, 1, 1), D(2031, 1, 1))
        while day <= stop:
            assert (v.account_rk, day) not in got
            got[v.account_rk, day] = (v.account_number, v.char_type)
            day += DAY
    assert got == expected
    # no piece could be joined with the next one of the same version
    assert len(out) <= sum(1 for _ in rows) * 2
    assert any(v.data_actual_end_date is None for v in out)


def test_a_version_cut_in_its_middle_comes_back_in_two_pieces(spark):
    rows = [(D(2018, 1, 1), D(2018, 1, 31), 1, "a", "А", 0, "643"), (D(2018, 1, 10), D(2018, 1, 12), 1, "b", "А", 0, "643"),
            (D(2018, 3, 1), D(2018, 2, 1), 1, "c", "А", 0, "643"), (None, D(2018, 2, 1), 2, "d", "А", 0, "643")]
    got = sorted((v.data_actual_date, v.data_actual_end_date, v.account_number)
                 for v in disjoint_versions(frame(spark, ACCOUNTS, rows)).collect())
    assert got == [(D(2018, 1, 1), D(2018, 1, 9), "a"), (D(2018, 1, 10), D(2018, 1, 12), "b"),
                   (D(2018, 1, 13), D(2018, 1, 31), "a")]
    assert disjoint_versions(frame(spark, ACCOUNTS, [])).collect() == []
