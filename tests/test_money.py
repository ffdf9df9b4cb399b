"""Rouble amounts equal Python's Decimal, with 8 decimals in amounts and rates."""

import random
from decimal import Decimal, localcontext

import pytest
from helpers import ACCOUNTS, BALANCES, POSTINGS, RATES, D, frame

from ledgerline.functions.money import in_roubles
from ledgerline.model import Period
from ledgerline.operators import balance as bal
from ledgerline.operators import turnover as tov

P = Period(D(2018, 1, 1), D(2018, 1, 10))


def _exact(a, b):
    with localcontext() as c:
        c.prec = 80
        return a * b


@pytest.mark.parametrize("types", [("decimal(33,8)", "decimal(18,8)"), ("decimal(23,8)", "decimal(18,8)"),
                                   ("decimal(28,2)", "decimal(10,4)"), ("decimal(38,8)", "decimal(18,8)")])
def test_products_are_exact(spark, types):
    r = random.Random(1)
    scale, rate_scale = int(types[0][:-1].split(",")[1]), int(types[1][:-1].split(",")[1])
    rows = []
    for i in range(400):
        digits = r.randint(1, 13 + scale)
        a = Decimal(r.randint(-10 ** digits, 10 ** digits)).scaleb(-scale)
        b = Decimal(r.randint(1, 10 ** r.randint(1, 5 + rate_scale))).scaleb(-rate_scale)
        rows.append((i, str(a), str(b)))
    rows += [(900, "0", "1"), (901, "-0.00000001" if scale == 8 else "-0.01", "0.0001"), (902, None, "2"), (903, "5", None)]
    df = spark.createDataFrame(rows, "i int, a string, b string").selectExpr(
        "i", f"CAST(a AS {types[0]}) AS a", f"CAST(b AS {types[1]}) AS b")
    got = {x.i: x.v for x in df.select("i", in_roubles(df, "a", "b").alias("v")).collect()}
    for i, a, b in rows:
        assert got[i] == (None if a is None else _exact(Decimal(a), Decimal(b or 1)))


def test_too_large_is_an_error_not_rounded(spark):
    df = spark.sql("SELECT CAST('9999999999999999999999.5' AS decimal(33,8)) AS a, CAST(5000 AS decimal(18,8)) AS b")
    with pytest.raises(Exception, match="(?i)numeric_value_out_of_range|overflow|cannot be represented"):
        df.select(in_roubles(df, "a", "b")).collect()


def test_marts_are_exact_with_eight_decimals(spark):
    r = random.Random(2)
    money = lambda: Decimal(r.randint(1, 10 ** 18)).scaleb(-8)
    rate = Decimal("63.12345678")
    accounts = frame(spark, ACCOUNTS, [(P.start, P.end, 1, "30101978000000000001", "А", 5, "978"),
                                       (P.start, P.end, 2, "30102978000000000002", "П", 5, "978")])
    rows = [(D(2018, 1, r.randint(1, 10)), 2, 1, money(), money()) for _ in range(60)]
    rates = frame(spark, RATES, [(D(2017, 12, 1), None, 5, rate, "978")])
    opening = bal.opening_balance(frame(spark, BALANCES, [(P.opening, 1, 5, money()), (P.opening, 2, 5, money())]),
                                  rates, P.opening, rate_rule="as_of")
    start = {x.account_rk: (x.balance_out, x.balance_out_rub) for x in opening.collect()}
    assert all(rub == _exact(own, rate) for own, rub in start.values())
    turnover = tov.turnover_fx(frame(spark, POSTINGS, rows), accounts, rates, P)
    for x in turnover.collect():
        assert (x.credit_amount_rub, x.debet_amount_rub) == (_exact(x.credit_amount, rate), _exact(x.debet_amount, rate))
    got = {(x.account_rk, x.on_date): x.balance_out_rub for x in bal.daily_balance(accounts, opening, turnover, P).collect()}
    with localcontext() as c:
        c.prec = 80
        for day in range(1, 11):
            upto = [x for x in rows if x[0] <= D(2018, 1, day)]
            assert got[1, D(2018, 1, day)] == start[1][1] + rate * sum(x[4] for x in upto)
            assert got[2, D(2018, 1, day)] == start[2][1] + rate * sum(x[3] for x in upto)
