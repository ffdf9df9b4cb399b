"""The jobs users run (D1-D4), as plain functions over a warehouse root on
shared storage.

Layout under ``warehouse``::

    ds/<table>                     conformed inputs (full refresh), postings by month
    rejects/<table>                rows that failed conform
    rejects/{turnover_unmatched,accounts_without_ledger,orphan_balances}
                                   rows the marts of the last filled period leave out
    dm/account_turnover_f          per-day turnover, partitioned by on_date
    dm/account_balance_f           per-day balances, partitioned by on_date
    dm/f101_round_f                form 101, partitioned by from_date, to_date
    dm/f101_round_f_v2             re-imported (edited) form 101
    logs/events                    run journal

Every step reads what the previous step wrote, so a step is the unit of
recovery: a lost executor re-runs tasks of the current step only, and a
failed step can be re-run alone. Per-day marts are refreshed per day:
re-running a period replaces exactly its days, including days that no
longer have rows.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.model import RUN_STATUSES, Period
from ledgerline.operators import balance as bal
from ledgerline.operators import report as rep
from ledgerline.operators import restate as rst
from ledgerline.operators import turnover as tov
from ledgerline.operators.conform import Conformed, conform, dedupe
from ledgerline.operators.runlog import RunJournal
from ledgerline.sources import csv as csvio
from ledgerline.sources import jdbc, sinks
from ledgerline.sources.ingest import ingest_folder, load_detail_store
from ledgerline.sources.publish import Release
from ledgerline.sources.specs import REGISTRY, REPORT, REPORT_KEYS

(ETL_START, ETL_END, TURNOVER_START, TURNOVER_END, BALANCE_START, BALANCE_END,
 EXTRACT_START, EXTRACT_END, LOAD_START, LOAD_END) = RUN_STATUSES

TURNOVER_MART = "account_turnover_f"
BALANCE_MART = "account_balance_f"
ROLLED = "account_balance_rolled"  # opening days as rolled, before deliveries replaced some of their rows
REPORT_TABLE = "f101_round_f"
REPORT_V2 = "f101_round_f_v2"
# Mart money type: one type for every partition of a mart, wide enough for
# bank-wide sums; 8 decimals keep rouble values of foreign amounts exact to
# far below a kopeck.
MART_MONEY = "decimal(38,8)"


#: Partition column of the ds tables with a folder per month.
MONTH = "_month"


def _by_month(df: DataFrame, layer: str, name: str) -> tuple[DataFrame, tuple[str, ...]]:
    """The rows as stored, and their partition columns."""
    spec = REGISTRY.get(name)
    if layer != "ds" or spec is None or spec.month_of is None:
        return df, ()
    return df.withColumn(MONTH, F.trunc(spec.month_of, "MM")), (MONTH,)


def _mart_types(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast(MART_MONEY).alias(c) if t.startswith("decimal") else F.col(c)
                       for c, t in df.dtypes])


@dataclass
class Warehouse:
    spark: SparkSession
    root: str

    def path(self, layer: str, name: str) -> str:
        return sinks.table_path(self.root, layer, name)

    def read(self, layer: str, name: str) -> DataFrame:
        return self._stored(layer, name).drop(MONTH)

    def _stored(self, layer: str, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(layer, name))

    def in_months(self, name: str, period: Period) -> DataFrame:
        """The rows of a ds table with a folder per month that may lie in the period: only its months are read."""
        month = F.col(MONTH).cast("string")
        first, last = period.start.replace(day=1).isoformat(), period.end.replace(day=1).isoformat()
        found = self._stored("ds", name)
        # a table of a load without rows has no month
        return found.where(month.between(first, last)).drop(MONTH) if MONTH in found.columns else found

    def journal(self) -> RunJournal:
        return RunJournal(self.spark, self.path("logs", "events"))

    def refresh(self, df: DataFrame, layer: str, name: str) -> None:
        """Replace a whole table; a ds table with a date of its own in folders per month."""
        df, columns = _by_month(df, layer, name)
        sinks.full_refresh(df, self.path(layer, name), columns)

    def replace_days(self, df: DataFrame, name: str, first: dt.date, last: dt.date) -> None:
        """Replace the days of a per-day mart, those without rows included."""
        sinks.replace_days(df, self.path("dm", name), "on_date", first, last)

    def replace_periods(self, df: DataFrame, name: str) -> None:
        """Replace the periods (from_date, to_date) that ``df`` has rows of."""
        sinks.refresh_partitions(df, self.path("dm", name), ["from_date", "to_date"])

    def add_to_periods(self, df: DataFrame, name: str) -> None:
        """Add rows to the periods (from_date, to_date) of a table."""
        sinks.append(df, self.path("dm", name), ["from_date", "to_date"])

    def read_days(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.path("dm", name))

    def has_day(self, name: str, day: dt.date) -> bool:
        return sinks.has_rows(self.spark, self.path("dm", name), "on_date", day)

    def publish(self) -> None:
        """Nothing to do: every table counts as soon as it is written."""


class VersionedWarehouse(Warehouse):
    """A warehouse whose runs are published as a whole (see :mod:`ledgerline.sources.publish`).

    It shows the last version when it was opened and what was written through
    it since; others see that only after ``publish``. The journal is not
    versioned: it records runs that broke off, too.
    """

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark, root)
        self.release = Release(spark, root)
        self._empty: dict[str, T.StructType] = {}

    def _stored(self, layer: str, name: str) -> DataFrame:
        return self.release.read(f"{layer}/{name}", self._empty.get(f"{layer}/{name}"))

    def refresh(self, df: DataFrame, layer: str, name: str) -> None:
        df, columns = _by_month(df, layer, name)
        if columns:
            self._empty[f"{layer}/{name}"] = df.schema  # should no month have rows
            self.release.write_parts(df, f"{layer}/{name}", list(columns), lambda part: True)
        else:
            self.release.write(df, f"{layer}/{name}")

    def replace_days(self, df: DataFrame, name: str, first: dt.date, last: dt.date) -> None:
        rows = df.where(F.col("on_date").between(F.lit(first), F.lit(last)))
        self.release.write_parts(rows, f"dm/{name}", ["on_date"], lambda part: first.isoformat() <= part.split("=")[1]
                                 <= last.isoformat())

    def replace_periods(self, df: DataFrame, name: str) -> None:
        self.release.write_parts(df, f"dm/{name}", ["from_date", "to_date"], lambda part: False)

    def add_to_periods(self, df: DataFrame, name: str) -> None:
        # a period's folder belongs to one run: the rows it has are written again with the new ones
        keys, table = ["from_date", "to_date"], f"dm/{name}"
        if self.release.has(table):
            old = self.release.read(table, df.schema).select(*df.columns)
            df = df.unionByName(old.join(df.select(*keys).distinct(), keys, "left_semi"))
        self.release.write_parts(df, table, keys, lambda part: False)

    def read_days(self, name: str, schema: str) -> DataFrame:
        return self.release.read(f"dm/{name}", schema)

    def has_day(self, name: str, day: dt.date) -> bool:
        return f"on_date={day.isoformat()}" in self.release.tables.get(f"dm/{name}", {})

    def publish(self) -> None:
        self.release.publish()


def open_warehouse(spark: SparkSession, root: str, versioned: bool = False) -> Warehouse:
    return VersionedWarehouse(spark, root) if versioned else Warehouse(spark, root)


def ingest(wh: Warehouse, landing_dir: str) -> list[str]:
    """CSV landing folder -> ds tables. Returns the unknown files."""
    result = ingest_folder(wh.spark, landing_dir)
    load_detail_store(result, wh.refresh)
    return result.unknown


def fill_turnover(wh: Warehouse, period: Period) -> None:
    """dm.account_turnover_f for every day of the period."""
    t = tov.turnover_fx(wh.in_months("ft_posting_f", period), wh.read("ds", "md_account_d"),
                        wh.read("ds", "md_exchange_rate_d"), period)
    wh.replace_days(_mart_types(t), TURNOVER_MART, period.start, period.end)


def fill_opening(wh: Warehouse, period: Period, rate_rule: str = "exact") -> None:
    """The seed row of every account on the opening date.

    Balances delivered for that date count first. If the month before was run
    (the mart has the day before, too), they replace the rolled rows of their
    accounts and all other accounts keep theirs; else they are the whole day
    (the source system emptied the whole mart). The rolled rows of the day are
    kept aside when deliveries first replace some, so a balance that a later
    delivery withdraws gives way to the rolled one again. Where none are
    delivered the day must have been rolled. With neither there is nothing to
    start from, which is an error.
    """
    o = bal.opening_balance(wh.read("ds", "ft_balance_f"), wh.read("ds", "md_exchange_rate_d"),
                            period.opening, rate_rule)
    day = period.opening
    rolled = wh.has_day(BALANCE_MART, day - dt.timedelta(days=1))
    delivered = not o.isEmpty()
    if rolled and delivered and not wh.has_day(ROLLED, day):
        wh.replace_days(_balance_mart(wh).where(F.col("on_date") == F.lit(day)), ROLLED, day, day)
    if delivered:
        o = _mart_types(o)
        if rolled:
            kept = _balance_mart(wh, ROLLED).where(F.col("on_date") == F.lit(day))
            o = o.unionByName(kept.join(o.select("account_rk"), "account_rk", "left_anti"))
        wh.replace_days(o, BALANCE_MART, day, day)
    elif wh.has_day(ROLLED, day):  # all deliveries were withdrawn
        wh.replace_days(_balance_mart(wh, ROLLED).where(F.col("on_date") == F.lit(day)), BALANCE_MART, day, day)
    elif not wh.has_day(BALANCE_MART, period.opening):
        raise ValueError(f"no balances delivered or rolled for {period.opening}")


def _balance_mart(wh: Warehouse, name: str = BALANCE_MART) -> DataFrame:
    # partition column typed explicitly: a day partition is a date
    return wh.read_days(
        name, "account_rk bigint, balance_out decimal(38,8), balance_out_rub decimal(38,8), on_date date")


def _turnover_mart(wh: Warehouse, period: Period) -> DataFrame:
    t = wh.read_days(
        TURNOVER_MART, "account_rk bigint, credit_amount decimal(38,8), credit_amount_rub decimal(38,8), "
        "debet_amount decimal(38,8), debet_amount_rub decimal(38,8), on_date date")
    return tov.in_period(t, "on_date", period)


def fill_balance(wh: Warehouse, period: Period) -> None:
    """dm.account_balance_f for every day of the period, rolled forward
    from the opening partition over the turnover mart."""
    opening = _balance_mart(wh).where(F.col("on_date") == F.lit(period.opening))
    b = bal.daily_balance(wh.read("ds", "md_account_d"), opening, _turnover_mart(wh, period), period)
    wh.replace_days(_mart_types(b), BALANCE_MART, period.start, period.end)
    if wh.has_day(ROLLED, period.end):  # rolled anew: what was kept aside of the last day is out of date
        wh.replace_days(_mart_types(b).where(F.lit(False)), ROLLED, period.end, period.end)


def fill_report(wh: Warehouse, period: Period) -> None:
    """dm.f101_round_f for the period, from the two marts."""
    marts = _balance_mart(wh)
    opening = marts.where(F.col("on_date") == F.lit(period.opening))
    f = rep.form101(wh.read("ds", "md_account_d"), wh.read("ds", "md_ledger_account_s"), opening,
                    _turnover_mart(wh, period), period, closing=marts)
    wh.replace_periods(_mart_types(f), REPORT_TABLE)


def report_unmatched(wh: Warehouse, period: Period) -> None:
    """Writes what the marts of the period leave out: turnover without a valid
    account, accounts without a ledger, balances of the opening used (delivered
    or rolled) without an account."""
    accounts = wh.read("ds", "md_account_d")
    turnover = tov.daily_turnover(wh.in_months("ft_posting_f", period), period)
    found = {"turnover_unmatched": tov.unmatched_turnover(turnover, accounts),
             "accounts_without_ledger": rep.accounts_without_ledger(
                 accounts, wh.read("ds", "md_ledger_account_s"), period),
             "orphan_balances": rep.orphan_balances(_balance_mart(wh), accounts, period)}
    for name, rows in found.items():
        wh.refresh(rows, "rejects", name)


def restate(wh: Warehouse, period: Period, since: dt.date) -> None:
    """The marts of a filled period after postings from ``since`` on were
    delivered late (and ingested): changed accounts get their balances from
    their first changed day on, the report is summed again.

    The balances are replaced before the turnover they are compared with, so a
    run that breaks off in between finds the same changes again.
    """
    rest_of = Period(since, period.end)
    accounts = wh.read("ds", "md_account_d")
    new = _mart_types(tov.turnover_fx(wh.in_months("ft_posting_f", rest_of), accounts, wh.read("ds", "md_exchange_rate_d"),
                                      rest_of))
    changes = rst.turnover_changes(_turnover_mart(wh, rest_of), new)
    wh.refresh(changes, "dm", f"{TURNOVER_MART}_changes")
    b = rst.restated_balance(accounts, _balance_mart(wh), wh.read("dm", f"{TURNOVER_MART}_changes"), new, period, since)
    wh.replace_days(_mart_types(b), BALANCE_MART, since, period.end)
    wh.replace_days(new, TURNOVER_MART, since, period.end)
    fill_report(wh, period)


def run_fill_procedure(spark: SparkSession, landing_dir: str, warehouse: str,
                       period: Period, versioned: bool = False) -> str:
    """Ingest -> turnover -> opening -> balance (-> report), journalled.
    Returns the log id of the whole run.

    With ``versioned`` the run's tables are published together at its end: a
    run that breaks off, or is refused because another one was published
    meanwhile, leaves the last version as it was."""
    wh = open_warehouse(spark, warehouse, versioned)
    j = wh.journal()
    with j.step(ETL_START, ETL_END) as run_id:
        ingest(wh, landing_dir)
        with j.step(TURNOVER_START, TURNOVER_END):
            fill_turnover(wh, period)
        fill_opening(wh, period)
        with j.step(BALANCE_START, BALANCE_END):
            fill_balance(wh, period)
        fill_report(wh, period)
        report_unmatched(wh, period)
        wh.publish()
    return run_id


def run_restatement(spark: SparkSession, landing_dir: str, warehouse: str, period: Period, since: dt.date,
                    versioned: bool = False) -> str:
    """D1 after a late delivery: ingest, then the marts of the filled period
    restated from ``since`` on, journalled. Returns the log id."""
    if not period.start <= since <= period.end:
        raise ValueError(f"{since} is not in the period")
    wh = open_warehouse(spark, warehouse, versioned)
    with wh.journal().step(ETL_START, ETL_END) as run_id:
        ingest(wh, landing_dir)
        restate(wh, period, since)
        report_unmatched(wh, period)
        wh.publish()
    return run_id


def load_to_database(spark: SparkSession, landing_dir: str, url: str, properties: dict,
                     schema: str = "ds", drop_identical_rows: bool | None = None) -> dict[str, str]:
    """Landing CSVs -> database tables, each fully refreshed. Whole-row
    duplicates are dropped by each table's own rule (postings keep theirs);
    ``True`` drops them everywhere, the source system's rule for this job.
    Rejected rows go to
    ``<table>_rejects`` with their reason and original text."""
    written = {}
    for c in ingest_folder(spark, landing_dir).tables.values():
        spec = c.spec
        table = f"{schema}.{spec.name}"
        jdbc.refresh_table(dedupe(c.accepted, spec, identical_rows=drop_identical_rows),
                           url, table, properties)
        jdbc.refresh_table(c.rejects, url, f"{table}_rejects", properties)
        written[spec.name] = table
    return written


def extract_report(spark: SparkSession, report: DataFrame, out_dir: str,
                   journal: RunJournal | None = None) -> None:
    """D3: report table -> CSV folder with header (re-runnable). Columns
    leave in the report's declared order: the re-import reads by position,
    and a partitioned table lists its partition columns last."""
    def work():
        csvio.write_delimited(report.select(*REPORT.columns), out_dir, sep=REPORT.sep,
                              mode="overwrite")
    if journal is None:
        work()
    else:
        with journal.step(EXTRACT_START, EXTRACT_END):
            work()


def conform_report_csv(spark: SparkSession, path: str) -> Conformed:
    """The (possibly hand-edited) report CSV: good rows, typed, and rejects."""
    return conform(csvio.read_typed(spark, path, REPORT), REPORT)


def read_report_csv(spark: SparkSession, path: str) -> DataFrame:
    """The good rows of the report CSV, typed; dates cast."""
    return conform_report_csv(spark, path).table


def load_report(spark: SparkSession, csv_path: str, warehouse: str | Warehouse,
                journal: RunJournal | None = None, mode: str = "replace_period") -> None:
    """Edited report CSV -> dm.f101_round_f_v2 of a warehouse (or its root).

    ``replace_period`` (default): each (from_date, to_date) period in the
    file replaces the same period in the table, so a daily re-run does not
    duplicate rows. ``append``: the source system's behaviour, every run
    adds its rows. Lines that do not fit the report go, with their reason
    and text, to rejects/f101_round_f_v2, replaced by every load."""
    if mode not in ("replace_period", "append"):
        raise ValueError(f"unknown mode {mode!r}")
    wh = Warehouse(spark, warehouse) if isinstance(warehouse, str) else warehouse

    def work():
        found = conform_report_csv(spark, csv_path)
        wh.refresh(found.rejects, "rejects", REPORT_V2)
        df = found.table.select(*REPORT.columns)
        if mode == "append":
            wh.add_to_periods(df, REPORT_V2)
        else:
            wh.replace_periods(df, REPORT_V2)
        wh.publish()
    if journal is None:
        work()
    else:
        with journal.step(LOAD_START, LOAD_END):
            work()


def extract_report_from_database(spark: SparkSession, url: str, table: str, properties: dict, out_dir: str,
                                 journal: RunJournal | None = None) -> None:
    """D3 with the report in a database: table -> CSV folder with header.
    A report has a row per ledger and period, so one connection reads it."""
    found = jdbc.read_table(spark, url, table, properties)
    # database dialects return names in their own case
    extract_report(spark, found.toDF(*[c.lower() for c in found.columns]), out_dir, journal)


def load_report_to_database(spark: SparkSession, csv_path: str, url: str, table: str, properties: dict, batch: str,
                            journal: RunJournal | None = None, mode: str = "replace_period") -> bool:
    """D4 with a database target: the edited report CSV into ``table``, its rejects into ``<table>_rejects``.

    The rows move in one transaction under the name ``batch``; a batch loaded
    before is left out (False). ``replace_period`` removes the periods of the file
    in that transaction, ``append`` adds the rows to them."""
    if mode not in ("replace_period", "append"):
        raise ValueError(f"unknown mode {mode!r}")

    def work() -> bool:
        found = conform_report_csv(spark, csv_path)
        jdbc.refresh_table(found.rejects, url, f"{table}_rejects", properties)
        # widest decimals a database has to take: the report's own scale, 31 digits
        rows = found.table.select(*[F.col(c).cast("decimal(31,8)").alias(c) if t.startswith("decimal") else F.col(c)
                                    for c, t in found.table.select(*REPORT.columns).dtypes])
        return jdbc.append_once(rows, url, table, batch, properties,
                                replace=REPORT_KEYS[:2] if mode == "replace_period" else ())
    if journal is None:
        return work()
    with journal.step(LOAD_START, LOAD_END):
        return work()
