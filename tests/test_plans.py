"""Physical plans of the registered queries, under
cluster-like settings: no size-estimate broadcasts, so every broadcast seen
is one the code proved small."""

import re

import pytest
from conftest import SF_SMALL

import __spark_entry__ as E

NO_AUTO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                     "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
# writing queries are left out: their plan is a read-back of files
PLANNED = ["opening_balance", "dedupe_rates", "date_spine", "daily_turnover", "turnover_fx",
           "daily_balance", "ledger_assign", "orphan_balances", "form101", "run_log_status",
           "dedupe_rows", "parse_dates"]


@pytest.fixture(scope="module")
def plans(spark):
    old = {k: spark.conf.get(k, None) for k in NO_AUTO_BROADCAST}
    for k, v in NO_AUTO_BROADCAST.items():
        spark.conf.set(k, v)
    try:
        out = {}
        for name in PLANNED:
            df = E.queries()[name](spark, SF_SMALL)
            df.write.format("noop").mode("overwrite").save()
            out[name] = df._jdf.queryExecution().executedPlan().toString()
        yield out
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", PLANNED)
def test_no_cartesian_or_nested_loop(plans, name):
    assert "CartesianProduct" not in plans[name]
    assert "BroadcastNestedLoopJoin" not in plans[name]


def test_period_filter_reaches_the_lineitem_scan(plans):
    scan = [line for line in plans["turnover_fx"].split("\n") if "lineitem.parquet" in line][0]
    assert "GreaterThanOrEqual(l_shipdate," in scan and "LessThan(l_shipdate," in scan
    assert "ReadSchema: struct<l_orderkey:bigint,l_suppkey:bigint,l_extendedprice:double," \
           "l_shipdate:timestamp_ntz>" in scan


def test_low_cardinality_dimensions_are_broadcast(plans):
    # ledger (J4) and rates (J1, J2) joins: proven small, broadcast even with
    # the size-estimate broadcast switched off; never a shuffle on their key
    assert plans["ledger_assign"].count("BroadcastHashJoin") == 1
    assert plans["form101"].count("BroadcastHashJoin") >= 3
    for name in ("ledger_assign", "form101"):
        assert re.search(r"BroadcastHashJoin \[ledger_account#\d+\]", plans[name]), name
        assert not re.search(r"hashpartitioning\(ledger_account", plans[name]), name
    for name in ("turnover_fx", "form101", "daily_balance", "opening_balance"):
        by_currency = r"BroadcastHashJoin \[currency_rk#\d+\]" if name == "opening_balance" else \
            r"BroadcastHashJoin \[currency_rk#\d+, _bucket#\d+\]"  # J2 meets rates by currency and day bucket
        assert re.search(by_currency, plans[name]), name


def test_roll_forward_window_needs_no_extra_exchange(plans):
    plan = plans["daily_balance"]
    # the balance window (over account_rk) sits directly on the join's sort
    m = re.search(r"Window \[[^\n]*sum\([^\n]*\n(?P<below>(?:[^\n]*\n){2})", plan)
    assert m and "Exchange" not in m.group("below"), plan


def test_turnover_combines_before_the_shuffle(plans):
    plan = plans["daily_turnover"]
    assert plan.index("partial_sum") > plan.index("Exchange hashpartitioning(on_date")
