"""Opening valuation (S9, P7, P8, J1, P13) and the daily balance
roll-forward (W1, W1r, W2, J3)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.dates import date_days, lit_date
from ledgerline.functions.ledger import signed_movement
from ledgerline.functions.money import as_rub, in_roubles
from ledgerline.model import Period
from ledgerline.operators.fx import rates_starting_on, with_rate_on
from ledgerline.operators.sizing import spread_join


def opening_balance(balances: DataFrame, rates: DataFrame, on_date: dt.date,
                    rate_rule: str = "exact") -> DataFrame:
    """on_date, account_rk, balance_out, balance_out_rub for the seed day.

    ``exact`` (default): the rate whose validity starts on ``on_date``,
    else 1 -- the source system's rule, which misses a rate that started
    earlier and is still valid. ``as_of``: the rate valid on ``on_date``.
    Rates must be unique per (date, currency) (A2) or balances multiply.
    """
    b = balances.where(F.col("on_date") == lit_date(on_date))
    if rate_rule == "exact":
        valued = spread_join(b, rates_starting_on(rates, on_date), "currency_rk", "left")
    elif rate_rule == "as_of":
        valued = with_rate_on(b, rates, "on_date", "currency_rk")
    else:
        raise ValueError(f"unknown rate rule {rate_rule!r}")
    return valued.select(
        lit_date(on_date).alias("on_date"), "account_rk", "balance_out",
        in_roubles(valued, "balance_out", "reduced_cource").alias("balance_out_rub"))


def accounts_in_period(accounts: DataFrame, period: Period) -> DataFrame:
    """Account versions valid on some day of the period, with the days they
    cover inside it (J3)."""
    start, end = lit_date(period.start), lit_date(period.end)
    return (accounts
            .where((F.col("data_actual_date") <= end) & (F.col("data_actual_end_date") >= start))
            .withColumn("first_day", F.greatest("data_actual_date", start))
            .withColumn("last_day", F.least("data_actual_end_date", end)))


def account_days(accounts: DataFrame, period: Period) -> DataFrame:
    """account_rk, on_date for every day each account is valid in the
    period. A generator per account row: no calendar table, no join."""
    a = accounts_in_period(accounts, period)
    return a.select("account_rk", F.explode(date_days(F.col("first_day"), F.col("last_day")))
                    .alias("on_date"))


def movements(base: DataFrame, turnover: DataFrame, rates: DataFrame | None = None) -> DataFrame:
    """Each account row of ``base`` (account_rk, currency_rk, first_day,
    last_day, ...) with its turnover days inside its validity (J3), or one
    row with NULL ``on_date`` when it has none. A single join on account_rk.

    ``turnover`` is the valued mart (with ``*_rub`` columns), or, when
    ``rates`` is given, the plain daily turnover: it is then valued here
    with the currency the account row already carries (J2), which saves a
    second scan and shuffle of the accounts.
    """
    cols = ["account_rk", "on_date", "credit_amount", "debet_amount"]
    if rates is None:
        cols += ["credit_amount_rub", "debet_amount_rub"]
    t = turnover.select(*cols).alias("_t")
    b = base.alias("_b")
    cond = ((F.col("_b.account_rk") == F.col("_t.account_rk"))
            & F.col("_t.on_date").between(F.col("_b.first_day"), F.col("_b.last_day")))
    mv = b.join(t, cond, "left").select("_b.*", *[F.col(f"_t.{c}") for c in cols[1:]])
    if rates is None:
        return mv
    mv = with_rate_on(mv, rates, "on_date", "currency_rk", out="_rate")
    return (mv.withColumn("credit_amount_rub", in_roubles(mv, "credit_amount", "_rate"))
            .withColumn("debet_amount_rub", in_roubles(mv, "debet_amount", "_rate")).drop("_rate"))


def daily_balance(accounts: DataFrame, opening: DataFrame, turnover: DataFrame,
                  period: Period, rates: DataFrame | None = None) -> DataFrame:
    """on_date, account_rk, balance_out, balance_out_rub for every day each
    account is valid in the period (``fill_account_balance`` for all days).

    out(d) = opening + sum of signed turnover up to d (active: debit minus
    credit, passive: credit minus debit); the rouble balance rolls the
    rouble turnover the same way from the rouble opening. A missing opening
    counts as 0. ``turnover``/``rates`` as in :func:`movements`. An account
    may have any number of versions in the period, with gaps between them;
    they must not overlap. The balance is rolled once per account over all
    its versions, each day's movement signed by the version valid that day,
    and every version shows its own days; a gap shows none.

    Plan: accounts + opening + turnover meet in one join on account_rk (the
    turnover keeps only days with movement), a running sum per account
    orders at most one row per movement day, and only then is every row
    expanded over the days until the next movement. The window reuses the
    join's partitioning, never sees the full accounts x days grid, and the
    grid is never shuffled.
    """
    acc = accounts_in_period(accounts, period).select(
        "account_rk", "char_type", "currency_rk", "first_day", "last_day")
    op = opening.select("account_rk", F.col("balance_out").alias("_open"),
                        F.col("balance_out_rub").alias("_open_rub"))
    base = acc.join(op, "account_rk", "left").select(
        "account_rk", "char_type", "currency_rk", "first_day", "last_day",
        F.coalesce("_open", F.lit(0)).alias("_open"),
        as_rub(F.coalesce("_open_rub", F.lit(0))).alias("_open_rub"))
    mv = movements(base, turnover, rates)

    # both windows use the join's partitioning and one sort
    w = Window.partitionBy("account_rk").orderBy("first_day", "on_date")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    of_version = Window.partitionBy("account_rk", "first_day").orderBy("on_date")
    moved = signed_movement(F.col("debet_amount"), F.col("credit_amount"))
    # rouble amounts: a difference of two of their type is exact, and so is a sum of one with a sum cast back
    moved_rub = as_rub(signed_movement(as_rub("debet_amount_rub"), as_rub("credit_amount_rub")))
    rolled = mv.select(
        "account_rk", "first_day", "last_day", "_open", "_open_rub", "on_date",
        F.sum(moved).over(upto).alias("_cum"), as_rub(F.sum(moved_rub).over(upto)).alias("_cum_rub"),
        F.coalesce(F.sum(moved).over(before), F.lit(0)).alias("_prior"),
        as_rub(F.coalesce(F.sum(moved_rub).over(before), F.lit(0))).alias("_prior_rub"),
        F.lead("on_date").over(of_version).alias("_next"),
        F.row_number().over(of_version).alias("_k"))

    until = lambda c: F.coalesce(F.date_sub(c, 1), F.col("last_day"))
    segments = F.array(
        # days of a version before its first movement carry the balance so far
        F.struct(F.when(F.col("_k") == 1, F.col("first_day")).alias("d0"),
                 until(F.col("on_date")).alias("d1"),
                 (F.col("_open") + F.col("_prior")).alias("v"),
                 (F.col("_open_rub") + F.col("_prior_rub")).alias("v_rub")),
        # a movement day and the quiet days after it carry the running total
        F.struct(F.col("on_date").alias("d0"), until(F.col("_next")).alias("d1"),
                 (F.col("_open") + F.col("_cum")).alias("v"),
                 (F.col("_open_rub") + F.col("_cum_rub")).alias("v_rub")))
    seg = rolled.select("account_rk", F.inline(segments))
    return seg.select(
        F.explode(date_days(F.col("d0"), F.col("d1"))).alias("on_date"), "account_rk",
        F.col("v").alias("balance_out"), F.col("v_rub").alias("balance_out_rub"))
