"""Daily account turnover (J8, A3) and its valuation in roubles.

Contract of the per-day mart (the fill procedure is not part of the source,
so this is the stated design): for every (day, account) with at least one
posting, the sum of credits and the sum of debits in account currency, a
missing side stored as 0, and each sum times the rate of the account's
currency valid that day, or times 1 when no rate is valid.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.dates import lit_date
from ledgerline.model import Period
from ledgerline.functions.money import in_roubles
from ledgerline.operators.fx import with_rate_on


def in_period(df: DataFrame, date_col: str, period: Period | None) -> DataFrame:
    if period is None:
        return df
    return df.where(F.col(date_col).between(lit_date(period.start), lit_date(period.end)))


def unpivot_postings(postings: DataFrame) -> DataFrame:
    """One posting -> two account movements.

    on_date, account_rk, credit_amount, debet_amount: the credited account
    gets the credit amount and a zero debit, the debited account the
    reverse. A generator, not a union, so the postings are scanned once.
    """
    money = postings.schema["credit_amount"].dataType
    zero = F.lit(0).cast(money)
    sides = F.array(
        F.struct(F.col("credit_account_rk").alias("account_rk"),
                 F.col("credit_amount").cast(money).alias("credit_amount"),
                 zero.alias("debet_amount")),
        F.struct(F.col("debet_account_rk").alias("account_rk"),
                 zero.alias("credit_amount"),
                 F.col("debet_amount").cast(money).alias("debet_amount")))
    return postings.select(F.col("oper_date").alias("on_date"), F.inline(sides))


def daily_turnover(postings: DataFrame, period: Period | None = None) -> DataFrame:
    """A3: on_date, account_rk, credit_amount, debet_amount.

    Unpivot, then one aggregation whose partial step runs before the
    shuffle: a hot account leaves each task as one row per day.
    """
    moves = unpivot_postings(in_period(postings, "oper_date", period))
    return moves.groupBy("on_date", "account_rk").agg(
        F.sum("credit_amount").alias("credit_amount"),
        F.sum("debet_amount").alias("debet_amount"))


def value_turnover(turnover: DataFrame, accounts: DataFrame, rates: DataFrame) -> DataFrame:
    """Turnover of accounts valid on the day, with rouble amounts.

    on_date, account_rk, credit_amount, credit_amount_rub, debet_amount,
    debet_amount_rub. The account version valid on the day gives the
    currency (J3: inner, a movement on an account not valid that day is
    dropped); the rate valid that day converts (J2), 1 when none. Turnover
    is aggregated before valuation: sum(amount) x rate equals
    sum(amount x rate) exactly (:mod:`ledgerline.functions.money`), and the join then
    sees one row per (day, account) instead of one per posting.
    """
    t = turnover.alias("_t")
    a = accounts.select("account_rk", "currency_rk", "data_actual_date",
                        "data_actual_end_date").alias("_a")
    cond = ((F.col("_t.account_rk") == F.col("_a.account_rk"))
            & F.col("_t.on_date").between(F.col("_a.data_actual_date"),
                                          F.col("_a.data_actual_end_date")))
    joined = t.join(a, cond, "inner").select(
        "_t.on_date", "_t.account_rk", "_a.currency_rk", "_t.credit_amount", "_t.debet_amount")
    rated = with_rate_on(joined, rates, "on_date", "currency_rk", out="_rate")
    return rated.select(
        "on_date", "account_rk",
        "credit_amount", in_roubles(rated, "credit_amount", "_rate").alias("credit_amount_rub"),
        "debet_amount", in_roubles(rated, "debet_amount", "_rate").alias("debet_amount_rub"))


def unmatched_turnover(turnover: DataFrame, accounts: DataFrame) -> DataFrame:
    """Turnover on days on which its account is not valid, or of no known
    account: the rows :func:`value_turnover` leaves out."""
    valid = accounts.select(F.col("account_rk").alias("_rk"), "data_actual_date", "data_actual_end_date")
    return turnover.join(valid, (F.col("account_rk") == F.col("_rk"))
                         & F.col("on_date").between(F.col("data_actual_date"), F.col("data_actual_end_date")),
                         "left_anti")


def turnover_fx(postings: DataFrame, accounts: DataFrame, rates: DataFrame,
                period: Period | None) -> DataFrame:
    """The per-day turnover mart for a period (``fill_account_turnover``
    for every day of the period at once)."""
    return value_turnover(daily_turnover(postings, period), accounts, rates)
