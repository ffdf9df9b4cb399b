"""Ledger assignment (J4), orphan balances (J7) and form 101 (A4, A5, J5,
J6, W3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.dates import lit_date
from ledgerline.functions.ledger import currency_class_sums, is_domestic, ledger_code, signed_movement
from ledgerline.functions.money import as_rub
from ledgerline.model import Period
from ledgerline.operators.balance import accounts_in_period, movements
from ledgerline.operators.sizing import spread_join
from ledgerline.operators.turnover import in_period


def ledgers_in_period(ledger: DataFrame, period: Period) -> DataFrame:
    """Ledger rows valid over the whole period; an open end date is valid."""
    return ledger.where(
        (F.col("start_date") <= lit_date(period.start))
        & (F.col("end_date").isNull() | (F.col("end_date") >= lit_date(period.end))))


def assign_ledger(accounts: DataFrame, ledger: DataFrame, period: Period) -> DataFrame:
    """Each account with the ledger named by the first five characters of
    its number: accounts columns + ledger_account, chapter, characteristic.
    The ledger is a small dimension; a ledger that holds most accounts is spread."""
    led = ledgers_in_period(ledger, period).select("ledger_account", "chapter", "characteristic")
    return spread_join(accounts.withColumn("ledger_account", ledger_code("account_number")), led, "ledger_account")


def accounts_without_ledger(accounts: DataFrame, ledger: DataFrame, period: Period) -> DataFrame:
    """Account versions of the period whose ledger is not valid over the whole
    period, or does not exist: form 101 leaves them out."""
    led = ledgers_in_period(ledger, period).select(F.col("ledger_account").alias("_ledger"))
    acc = accounts_in_period(accounts, period)
    return acc.join(led, ledger_code("account_number") == F.col("_ledger"), "left_anti").select(*accounts.columns)


def orphan_balances(balances: DataFrame, accounts: DataFrame, period: Period) -> DataFrame:
    """Opening balances whose account is not valid in the period: they
    would silently drop out of every mart.

    An anti join, written as a left join that keeps the unmatched rows: the
    optimizer pushes a ``left_anti`` into every branch of a union on the
    left (the balance table often is one), which would shuffle the large
    account side once per branch; the left join shuffles it once. Matched
    rows are dropped however many account versions match, so nothing
    multiplies.
    """
    valid = (accounts_in_period(accounts, period).select("account_rk")
             .withColumn("_valid", F.lit(True)))
    b = balances.where(F.col("on_date") == lit_date(period.opening))
    return (b.join(valid, "account_rk", "left").where(F.col("_valid").isNull())
            .drop("_valid").select(*b.columns))


def form101(accounts: DataFrame, ledger: DataFrame, opening: DataFrame,
            turnover: DataFrame, period: Period, closing: DataFrame | None = None,
            rates: DataFrame | None = None) -> DataFrame:
    """Monthly trial balance per ledger, split domestic / foreign.

    from_date, to_date, chapter, ledger_account (text), characteristic and
    {balance_in, turn_deb, turn_cre, balance_out} x {rub, val, total}, all
    in roubles. ``opening`` holds the rouble balances of the day before the
    period (account_rk, balance_out_rub); ``turnover`` the daily turnover,
    valued, or plain together with ``rates`` (see ``balance.movements``);
    ``closing`` the balance mart if it was built (its row on each account's
    last valid day of the period is the closing balance), else the closing
    balance is rolled here from opening and turnover (the same recurrence as
    the mart).

    Turnover is summed per account version before the accounts meet their
    opening balance, so each account contributes its balances once, whatever
    the number of its movement days and versions: the opening counts under
    the first version valid in the period, the closing balance under the
    last (0 under the others), turnover under the version valid that day. An account without turnover keeps NULL
    turnover: its class column adds nothing, the other class column adds 0,
    the total stays NULL if no account of the ledger moved. The per-ledger
    sums are combined map-side, so a ledger holding most accounts is no hot
    spot.
    """
    acc = assign_ledger(accounts_in_period(accounts, period), ledger, period)
    keys = ["account_rk", "currency_rk", "currency_code", "char_type", "chapter",
            "ledger_account", "characteristic", "first_day", "last_day"]
    base = acc.select(*keys)
    mv = movements(base, in_period(turnover, "on_date", period), rates)
    # grouped, and rolled, on the join key (plus attributes of the account): no shuffle
    per_account = mv.groupBy(*keys).agg(as_rub(F.sum("debet_amount_rub")).alias("_deb"),
                                        as_rub(F.sum("credit_amount_rub")).alias("_cre"))
    bin_ = opening.select("account_rk", as_rub("balance_out_rub").alias("_in"))
    versions = Window.partitionBy("account_rk").orderBy("first_day")
    upto = versions.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = per_account.join(bin_, "account_rk", "left").select(
        "*", (F.row_number().over(versions) == 1).alias("_first"),
        F.lead("first_day").over(versions).isNull().alias("_last"),
        as_rub(F.sum(as_rub(signed_movement(F.col("_deb"), F.col("_cre")))).over(upto)).alias("_moved"))
    if closing is not None:
        # the balance of the account's last valid day in the period. The day is a range, not a join
        # key: the join then needs no other partitioning than the account's, which all sides have
        bout = in_period(closing, "on_date", period).select(
            F.col("account_rk").alias("_rk"), F.col("on_date").alias("_day"), F.col("balance_out_rub").alias("_out"))
        rows = rows.join(bout, (F.col("account_rk") == F.col("_rk")) & (F.col("_day") >= F.col("last_day"))
                         & (F.col("_day") <= F.col("last_day")), "left").drop("_rk", "_day")
    else:
        rows = rows.withColumn(
            "_out", F.coalesce(F.col("_in"), F.lit(0)) + F.col("_moved"))
    rows = (rows.withColumn("_in", F.when(F.col("_first"), F.col("_in")))
            .withColumn("_out", F.when(F.col("_last"), F.col("_out")).otherwise(F.lit(0))))
    dom = is_domestic("currency_code")
    measures = (currency_class_sums("_in", dom, "balance_in")
                + currency_class_sums("_deb", dom, "turn_deb")
                + currency_class_sums("_cre", dom, "turn_cre")
                + currency_class_sums("_out", dom, "balance_out"))
    agg = rows.groupBy("chapter", "ledger_account", "characteristic").agg(*measures)
    return agg.select(
        lit_date(period.start).alias("from_date"), lit_date(period.end).alias("to_date"),
        "chapter", F.col("ledger_account").cast("string").alias("ledger_account"),
        "characteristic", *[m for m in agg.columns
                            if m not in ("chapter", "ledger_account", "characteristic")])
