"""Restatement of filled days after a late delivery.

A late posting changes one account's turnover on its day and that account's
balance from that day on; nothing else. The changed set is the exact
difference of two turnover states per (day, account); its accounts are rolled
anew from the last balance before the first changed day, all others keep
their rows. Days before are neither read nor written, but for the one
balance each changed account starts from.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.dates import lit_date
from ledgerline.model import Period
from ledgerline.operators.balance import daily_balance
from ledgerline.operators.turnover import in_period

AMOUNTS = ("credit_amount", "credit_amount_rub", "debet_amount", "debet_amount_rub")


def turnover_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """on_date, account_rk and the change of each amount: (day, account) pairs whose turnover differs.

    One aggregation over both states, the old one negated; amounts are
    exact decimals, so a pair without a change sums to 0. It combines
    map-side: a hot account leaves a task as one row per day.
    """
    keys = ["on_date", "account_rk"]
    signed = new.select(*keys, *AMOUNTS).unionByName(
        old.select(*keys, *[(-F.col(c)).alias(c) for c in AMOUNTS]), allowMissingColumns=False)
    changed = signed.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in AMOUNTS])
    some = F.lit(False)
    for c in AMOUNTS:
        some = some | (F.col(c) != 0)
    return changed.where(some)


def changed_accounts(changes: DataFrame) -> DataFrame:
    """account_rk, first_day: the accounts of the changes, with their first changed day."""
    return changes.groupBy("account_rk").agg(F.min("on_date").alias("first_day"))


def starting_days(accounts: DataFrame, changed: DataFrame, since: dt.date, period: Period) -> DataFrame:
    """account_rk, on_date: the last day before ``since`` on which each changed
    account has a balance; the opening date if it was not valid in the period before."""
    before = accounts.where((F.col("data_actual_date") < lit_date(since))
                            & (F.col("data_actual_end_date") >= lit_date(period.start))).select(
        F.col("account_rk").alias("_rk"),
        F.least("data_actual_end_date", lit_date(since - dt.timedelta(days=1))).alias("_day"))
    return changed.select("account_rk").join(before, F.col("account_rk") == F.col("_rk"), "left").groupBy(
        "account_rk").agg(F.coalesce(F.max("_day"), lit_date(period.opening)).alias("on_date"))


def restated_balance(accounts: DataFrame, balance: DataFrame, changes: DataFrame, turnover: DataFrame,
                     period: Period, since: dt.date) -> DataFrame:
    """The balance rows of the days ``since`` .. end of period after the changes.

    ``balance``: the filled mart (on_date, account_rk, balance_out,
    balance_out_rub), holding the opening date and the period;
    ``turnover``: the new valued turnover of the days from ``since`` on;
    ``changes``: of :func:`turnover_changes`, none before ``since``.
    Running it again on a half-written mart gives the same rows: changed
    accounts are rolled from a day before ``since``, never from their own rows.

    The few days that changed accounts start from are looked up first (at
    most the days of the period), so the scan of the mart is pruned to them
    and to the days from ``since`` on.
    """
    if not period.start <= since <= period.end:
        raise ValueError(f"{since} is not in {period.start}..{period.end}")
    changed = changed_accounts(changes)
    starts = starting_days(accounts, changed, since, period)
    days = [r["on_date"] for r in starts.select("on_date").distinct().collect()]
    opening = balance.where(F.col("on_date").isin(days)).join(
        starts, ["account_rk", "on_date"], "left_semi") if days else balance.where(F.lit(False))
    rest_of = Period(since, period.end)
    mine = accounts.join(changed.select("account_rk"), "account_rk", "left_semi")
    moved = in_period(turnover, "on_date", rest_of).join(changed.select("account_rk"), "account_rk", "left_semi")
    rolled = daily_balance(mine, opening, moved, rest_of)
    kept = in_period(balance, "on_date", rest_of).join(changed.select("account_rk"), "account_rk", "left_anti")
    columns = ["on_date", "account_rk", "balance_out", "balance_out_rub"]
    # the types of the mart: its days are files of one schema
    return kept.select(*columns).unionByName(
        rolled.select(*[F.col(c).cast(balance.schema[c].dataType) for c in columns]))
