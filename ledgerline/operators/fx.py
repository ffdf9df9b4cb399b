"""Exchange-rate lookups."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.dates import lit_date
from ledgerline.operators.sizing import SPREAD, spread_join

OPEN_END = dt.date(9999, 12, 31)
#: Days per bucket of the interval join.
BUCKET_DAYS = 32
#: Buckets are numbered between these days; what lies beyond falls into the first or the last.
FIRST_DAY, LAST_DAY = dt.date(1980, 1, 1), dt.date(2100, 1, 1)


def rates_starting_on(rates: DataFrame, day: dt.date) -> DataFrame:
    """Rates whose validity starts exactly on ``day`` (J1: the opening rate
    of the balance seed). The date predicate runs before the join."""
    return (rates.where(F.col("data_actual_date") == lit_date(day))
            .select("currency_rk", "reduced_cource"))


def rate_intervals(rates: DataFrame) -> DataFrame:
    """currency_rk, valid_from, valid_to, reduced_cource with at most one
    interval per (currency, day).

    An open end date means "still valid". Overlaps are cut: an interval
    ends the day before the next one of the same currency starts, so an
    interval join never multiplies rows. Rate tables are per currency and
    day at most, so the per-currency window stays small.
    """
    w = Window.partitionBy("currency_rk").orderBy("data_actual_date")
    nxt = F.lead("data_actual_date").over(w)
    end = F.coalesce(F.col("data_actual_end_date"), lit_date(OPEN_END))
    return rates.select(
        "currency_rk", F.col("data_actual_date").alias("valid_from"),
        F.when(nxt.isNotNull(), F.least(end, F.date_sub(nxt, 1))).otherwise(end).alias("valid_to"),
        "reduced_cource")


def day_bucket(day: Column, days: int = BUCKET_DAYS) -> Column:
    """Number of the bucket a day falls into. Days before ``FIRST_DAY`` and
    after ``LAST_DAY`` share the outermost buckets, so an open interval has a
    bounded number of them."""
    inside = F.least(F.greatest(day, lit_date(FIRST_DAY)), lit_date(LAST_DAY))
    return F.floor(F.unix_date(inside) / days).cast("int")


def in_buckets(intervals: DataFrame, first: str = "valid_from", last: str = "valid_to",
               days: int = BUCKET_DAYS) -> DataFrame:
    """A row per interval and bucket it touches, with the column ``_bucket``; empty intervals have none."""
    touched = F.sequence(day_bucket(F.col(first), days), day_bucket(F.col(last), days))
    return intervals.where(F.col(first) <= F.col(last)).withColumn("_bucket", F.explode(touched))


def with_rate_on(df: DataFrame, rates: DataFrame, date_col: str = "on_date",
                 currency_col: str = "currency_rk", out: str = "reduced_cource",
                 spread: int = SPREAD, days: int = BUCKET_DAYS) -> DataFrame:
    """Left interval join (J2): the rate of ``currency_col`` valid on
    ``date_col``; NULL when there is none, or where date or currency is NULL.

    Validity is split into buckets of days and the join is an equi-join on
    (currency, bucket, spread): a row meets the few rates of its currency
    and bucket, however long the rate history, and a hot currency's rows of
    one bucket go to ``spread`` tasks (see :mod:`ledgerline.operators.sizing`).
    The interval itself stays a condition of the join, so the outermost
    buckets are exact, too.
    """
    r = in_buckets(rate_intervals(rates), days=days).select(
        F.col("currency_rk").alias("_r_currency"), F.col("_bucket").alias("_r_bucket"),
        F.col("valid_from").alias("_r_from"), F.col("valid_to").alias("_r_to"),
        F.col("reduced_cource").alias("_r_rate"))
    d = df.withColumn("_bucket", day_bucket(F.col(date_col), days))
    cond = ((F.col(currency_col) == F.col("_r_currency")) & (F.col("_bucket") == F.col("_r_bucket"))
            & F.col(date_col).between(F.col("_r_from"), F.col("_r_to")))
    return spread_join(d, r, cond, "left", spread).select(*df.columns, F.col("_r_rate").alias(out))
