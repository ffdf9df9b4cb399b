"""Turnover, FX, balance roll-forward and form 101 on hand-made rows,
checked against brute force."""

import datetime as dt
import random
from decimal import Decimal

from helpers import ACCOUNTS, BALANCES, LEDGER, POSTINGS, RATES, D, M, frame

from ledgerline.model import Period
from ledgerline.operators import balance as bal
from ledgerline.operators import report as rep
from ledgerline.operators import turnover as tov
from ledgerline.operators.fx import with_rate_on

P = Period(D(2018, 1, 1), D(2018, 1, 10))
A, PV = "А", "П"


def _accounts(spark):
    return frame(spark, ACCOUNTS, [
        (P.start, P.end, 1, "30101810000000000001", A, 0, "643"),   # domestic, active
        (P.start, P.end, 2, "30102978000000000002", PV, 5, "978"),  # foreign, passive
        (P.start, D(2018, 1, 5), 3, "30101810000000000003", A, 0, "643"),  # closes on the 5th
        (P.start, P.end, 4, "30102978000000000004", PV, 6, "978"),  # no rate at all, no postings
    ])


def _postings(spark):
    return frame(spark, POSTINGS, [
        (D(2018, 1, 2), 2, 1, M(100), M(100)),
        (D(2018, 1, 2), 2, 1, M(100), M(100)),    # identical posting counts twice
        (D(2018, 1, 4), 1, 2, M(30), M(30)),
        (D(2018, 1, 7), 3, 1, M(5), M(5)),        # account 3 already closed: its side is dropped
        (D(2017, 12, 31), 1, 2, M(999), M(999)),  # outside the period
    ])


def _rates(spark):
    return frame(spark, RATES, [
        (D(2017, 12, 1), D(2018, 1, 3), 5, M(2), "978"),
        (D(2018, 1, 4), None, 5, M(3), "978"),   # open end = still valid
    ])


def test_daily_turnover_zero_fills_missing_side(spark):
    t = tov.daily_turnover(_postings(spark), P)
    got = {(r.on_date, r.account_rk): (r.credit_amount, r.debet_amount) for r in t.collect()}
    assert got[(D(2018, 1, 2), 2)] == (200, 0)
    assert got[(D(2018, 1, 2), 1)] == (0, 200)
    assert got[(D(2018, 1, 4), 1)] == (30, 0)
    assert (D(2017, 12, 31), 1) not in got


def test_debits_equal_credits(spark):
    t = tov.daily_turnover(_postings(spark))
    s = t.selectExpr("sum(credit_amount) c", "sum(debet_amount) d").first()
    assert s.c == s.d


def test_rate_as_of_with_open_end_and_default(spark):
    t = tov.value_turnover(tov.daily_turnover(_postings(spark), P), _accounts(spark), _rates(spark))
    got = {(r.on_date, r.account_rk): (r.credit_amount_rub, r.debet_amount_rub) for r in t.collect()}
    assert got[(D(2018, 1, 2), 2)] == (400, 0)       # rate 2 until the 3rd
    assert got[(D(2018, 1, 4), 2)] == (0, 90)        # open-ended rate 3
    assert got[(D(2018, 1, 2), 1)] == (0, 200)       # domestic: no rate -> 1
    assert (D(2018, 1, 7), 3) not in got              # account not valid that day
    assert got[(D(2018, 1, 7), 1)] == (0, 5)


def test_overlapping_rate_intervals_never_multiply_rows(spark):
    rates = frame(spark, RATES, [(D(2018, 1, 1), None, 5, M(2), "978"),
                                 (D(2018, 1, 5), D(2018, 1, 31), 5, M(4), "978")])
    days = spark.createDataFrame([(D(2018, 1, d), 5) for d in range(1, 11)], "on_date date, currency_rk int")
    got = {r.on_date.day: r.reduced_cource for r in with_rate_on(days, rates).collect()}
    assert len(got) == 10
    assert [float(got[d]) for d in range(1, 11)] == [2] * 4 + [4] * 6


def _opening(spark):
    b = frame(spark, BALANCES, [(P.opening, 1, 0, M(1000)), (P.opening, 2, 5, M(50)),
                                (P.opening, 3, 0, M(7)), (P.opening, 4, 6, M(1))])
    return bal.opening_balance(b, _rates(spark), P.opening, rate_rule="as_of")


def _brute_force(accounts, opening, turnover):
    """Full grid, day by day."""
    out = {}
    for a in accounts:
        o = opening.get(a.account_rk, (0, 0))
        cur, cur_rub = Decimal(o[0]), Decimal(o[1])
        d = max(a.data_actual_date, P.start)
        while d <= min(a.data_actual_end_date, P.end):
            c, c_rub, db, db_rub = turnover.get((d, a.account_rk), (0, 0, 0, 0))
            sign = 1 if a.char_type == A else -1
            cur += sign * (db - c)
            cur_rub += sign * (db_rub - c_rub)
            out[(d, a.account_rk)] = (cur, cur_rub)
            d += dt.timedelta(days=1)
    return out


def test_daily_balance_equals_brute_force(spark):
    accounts, rates = _accounts(spark), _rates(spark)
    opening = _opening(spark)
    daily = tov.daily_turnover(_postings(spark), P)
    valued = tov.value_turnover(daily, accounts, rates)
    got_fused = {(r.on_date, r.account_rk): (r.balance_out, r.balance_out_rub)
                 for r in bal.daily_balance(accounts, opening, daily, P, rates=rates).collect()}
    got_mart = {(r.on_date, r.account_rk): (r.balance_out, r.balance_out_rub)
                for r in bal.daily_balance(accounts, opening, valued, P).collect()}
    op = {r.account_rk: (r.balance_out, r.balance_out_rub) for r in opening.collect()}
    tv = {(r.on_date, r.account_rk): (r.credit_amount, r.credit_amount_rub, r.debet_amount, r.debet_amount_rub)
          for r in valued.collect()}
    want = _brute_force(accounts.collect(), op, tv)
    assert got_fused == want
    assert got_mart == want
    # rows = account-days in the period (account 3 only up to the 5th)
    assert len(want) == 10 + 10 + 5 + 10
    # passive foreign account 2, valued at the opening rate 2 (as_of rule)
    assert want[(D(2018, 1, 2), 2)] == (250, 500)


def test_randomised_roll_forward_matches_brute_force(spark):
    rnd = random.Random(7)
    accts = [(P.start, P.end, k, f"3010{k % 2 + 1}810" + "0" * 12, A if k % 2 else PV, 0, "643")
             for k in range(1, 30)]
    posts = [(D(2018, 1, rnd.randint(1, 10)), rnd.randint(1, 29), rnd.randint(1, 29),
              M(rnd.randint(1, 500)), M(rnd.randint(1, 500))) for _ in range(300)]
    accounts = frame(spark, ACCOUNTS, accts)
    rates = frame(spark, RATES, [])
    opening = bal.opening_balance(frame(spark, BALANCES, [(P.opening, k, 0, M(k)) for k in range(1, 25)]),
                                  rates, P.opening)
    daily = tov.daily_turnover(frame(spark, POSTINGS, posts), P)
    got = {(r.on_date, r.account_rk): (r.balance_out, r.balance_out_rub)
           for r in bal.daily_balance(accounts, opening, daily, P, rates=rates).collect()}
    op = {r.account_rk: (r.balance_out, r.balance_out_rub) for r in opening.collect()}
    tv = {(r.on_date, r.account_rk): (r.credit_amount, r.credit_amount, r.debet_amount, r.debet_amount)
          for r in daily.collect()}
    assert got == _brute_force(accounts.collect(), op, tv)


def test_form101_counts_each_balance_once_and_null_rules(spark):
    accounts, rates = _accounts(spark), _rates(spark)
    ledger = frame(spark, LEDGER, [(A, 30101, A, D(2000, 1, 1), None), (A, 30102, PV, D(2000, 1, 1), None)])
    opening = _opening(spark)
    daily = tov.daily_turnover(_postings(spark), P)
    f = {r.ledger_account: r for r in rep.form101(accounts, ledger, opening, daily, P, rates=rates).collect()}
    # 30101: accounts 1 and 3 (domestic); account 1 moved on three days but its
    # balance counts once
    assert f["30101"].balance_in_rub == 1007 and f["30101"].balance_in_val == 0
    assert f["30101"].turn_deb_rub == 205 and f["30101"].turn_cre_rub == 30
    assert f["30101"].balance_out_total == 1007 + 205 - 30
    # 30102: account 2 moved, account 4 never moved and has no rate
    assert f["30102"].turn_cre_val == 400 and f["30102"].turn_deb_val == 90
    assert f["30102"].balance_in_rub == 0 and f["30102"].balance_in_val == 100 + 1
    assert f["30102"].balance_out_val == 101 - 90 + 400
    # closing balance from the mart gives the same report
    mart = bal.daily_balance(accounts, opening, daily, P, rates=rates)
    g = {r.ledger_account: r for r in rep.form101(accounts, ledger, opening, daily, P, closing=mart,
                                                  rates=rates).collect()}
    assert {k: v.asDict() for k, v in g.items()} == {k: v.asDict() for k, v in f.items()}


def test_form101_ledger_without_any_movement(spark):
    accounts = frame(spark, ACCOUNTS, [(P.start, P.end, 1, "30301810000000000001", A, 0, "643"),
                                       (P.start, P.end, 2, "30302978000000000002", PV, 5, "978")])
    ledger = frame(spark, LEDGER, [(A, 30301, A, D(2000, 1, 1), None), (A, 30302, PV, D(2000, 1, 1), None)])
    opening = bal.opening_balance(frame(spark, BALANCES, [(P.opening, 1, 0, M(3)), (P.opening, 2, 5, M(4))]),
                                  frame(spark, RATES, []), P.opening)
    daily = tov.daily_turnover(frame(spark, POSTINGS, []), P)
    f = {r.ledger_account: r for r in rep.form101(accounts, ledger, opening, daily, P,
                                                  rates=frame(spark, RATES, [])).collect()}
    dom, fgn = f["30301"], f["30302"]
    assert (dom.turn_deb_rub, dom.turn_deb_val, dom.turn_deb_total) == (None, 0, None)
    assert (fgn.turn_deb_rub, fgn.turn_deb_val, fgn.turn_deb_total) == (0, None, None)
    assert (dom.balance_out_rub, fgn.balance_out_val) == (3, 4)


def test_account_days_spine(spark):
    spine = bal.account_days(_accounts(spark), P)
    assert spine.count() == 35
    assert spine.where("account_rk = 3").selectExpr("max(on_date) m").first().m == D(2018, 1, 5)


def test_opening_exact_rule_misses_earlier_rate(spark):
    b = frame(spark, BALANCES, [(P.opening, 2, 5, M(50))])
    exact = bal.opening_balance(b, _rates(spark), P.opening).first()
    as_of = bal.opening_balance(b, _rates(spark), P.opening, rate_rule="as_of").first()
    assert exact.balance_out_rub == 50 and as_of.balance_out_rub == 100


def test_hot_account_is_combined_before_the_shuffle(spark):
    """One account on a third of all postings: results stay exact and the
    turnover plan combines map-side (partial sums before the exchange), so
    the hot account leaves each task as one row per day."""
    n = 30000
    posts = spark.range(n).selectExpr(
        "date_add(DATE'2018-01-01', CAST(id % 10 AS INT)) AS oper_date",
        "CASE WHEN id % 3 = 0 THEN 1 ELSE 100 + id % 500 END AS credit_account_rk",
        "1000 + id % 700 AS debet_account_rk",
        "CAST(id % 97 AS DECIMAL(23,8)) AS credit_amount",
        "CAST(id % 97 AS DECIMAL(23,8)) AS debet_amount").repartition(8)
    t = tov.daily_turnover(posts, P)
    plan = t._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_sum") > plan.index("Exchange")  # partial agg sits below the exchange
    hot = {r.on_date.day: r.credit_amount for r in t.where("account_rk = 1").collect()}
    want = {}
    for i in range(0, n, 3):
        want[1 + i % 10] = want.get(1 + i % 10, 0) + i % 97
    assert hot == want
