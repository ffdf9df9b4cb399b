"""Accounts with several versions inside one period."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.model import Period
from ledgerline.operators import balance as bal
from ledgerline.operators import report as rep

P = Period.month(1998, 1)
ACCOUNT = ("data_actual_date date, data_actual_end_date date, account_rk bigint, account_number string, "
           "char_type string, currency_rk int, currency_code string")
MONEY = "decimal(18,2)"


def day(d):
    return dt.date(1998, 1, d)


@pytest.fixture
def case(spark):
    """Valid 1-15, 16-20 (no movement) and 26-31 January; the last version is under another ledger."""
    def version(first, last, number):
        return (day(first), day(last), 1, number, "А", 0, "643")

    accounts = spark.createDataFrame(
        [version(1, 15, "30101643"), version(16, 20, "30101643"), version(26, 31, "30102643")], ACCOUNT)
    turnover = spark.createDataFrame(
        [(day(5), 1, Decimal(0), Decimal(7)), (day(22), 1, Decimal(0), Decimal(1000)), (day(28), 1, Decimal(2), Decimal(0))],
        f"on_date date, account_rk bigint, credit_amount {MONEY}, debet_amount {MONEY}")
    turnover = turnover.withColumns({"credit_amount_rub": F.col("credit_amount"), "debet_amount_rub": F.col("debet_amount")})
    opening = spark.createDataFrame([(1, Decimal(100), Decimal(100))],
                                    f"account_rk bigint, balance_out {MONEY}, balance_out_rub {MONEY}")
    return accounts, opening, turnover


def test_the_balance_rolls_once_over_all_versions(case):
    accounts, opening, turnover = case
    rows = bal.daily_balance(accounts, opening, turnover, P).collect()
    want = {day(d): 100 if d < 5 else 107 if d < 28 else 105 for d in range(1, 32) if not 21 <= d <= 25}
    assert len(rows) == len(want)
    assert {r["on_date"]: int(r["balance_out"]) for r in rows} == want
    assert all(r["balance_out"] == r["balance_out_rub"] for r in rows)


@pytest.mark.parametrize("from_mart", [False, True])
def test_the_report_counts_opening_and_closing_once(spark, case, from_mart):
    accounts, opening, turnover = case
    ledger = spark.createDataFrame(
        [("А", n, "А", dt.date(1990, 1, 1), None) for n in (30101, 30102)],
        "chapter string, ledger_account int, characteristic string, start_date date, end_date date")
    closing = bal.daily_balance(accounts, opening, turnover, P) if from_mart else None
    rows = {r["ledger_account"]: r for r in rep.form101(accounts, ledger, opening, turnover, P, closing=closing).collect()}
    got = {k: [None if r[c] is None else int(r[c]) for c in
               ("balance_in_total", "turn_deb_total", "turn_cre_total", "balance_out_total")] for k, r in rows.items()}
    assert got == {"30101": [100, 7, 0, 0], "30102": [None, 0, 2, 105]}
