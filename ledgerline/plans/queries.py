"""The registered queries: each is ``(spark, sf_dir) -> DataFrame`` over the
banking views of the driver tables for the default period.

Money leaves as ``double`` (computed exactly in decimals first), so results
compare by value with the SQL oracles in ``plans/oracle.py``. Queries that
exercise a sink write to a fresh folder under the session's checkpoint root
and return the lazy read-back.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.dates import parse_date, render_date
from ledgerline.functions.money import in_roubles
from ledgerline.model import DASHED_DATE, DEFAULT_PERIOD, DOTTED_DATE, ISO_DATE, Period
from ledgerline.operators import balance as bal
from ledgerline.operators import conform as cf
from ledgerline.operators import report as rep
from ledgerline.operators import restate as rst
from ledgerline.operators import runlog
from ledgerline.operators import turnover as tov
from ledgerline.operators import versions as ver
from ledgerline.operators.fx import with_rate_on
from ledgerline.operators.sizing import estimated_bytes
from ledgerline.session import shared_dir
from ledgerline.sources import csv as csvio
from ledgerline.plans import pipelines as pl
from ledgerline.sources import fixtures as fx
from ledgerline.sources import register as reg
from ledgerline.sources import sinks
from ledgerline.sources.headers import read_aligned
from ledgerline.sources.ingest import deliveries, ingest_folder
from ledgerline.sources.marts import BucketedMart
from ledgerline.sources.specs import (ACCOUNT, BALANCE, CURRENCY, EXCHANGE_RATE, LEDGER,
                                      POSTING, REPORT, REPORT_MEASURES)
from ledgerline.streaming import turnover as st

Query = Callable[[SparkSession, str], DataFrame]


def _money_out(df: DataFrame, cols) -> DataFrame:
    cols = set(cols)
    return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def _once(method):
    """Build a view once per Model: the same DataFrame object is reused by
    every query step that needs it (plan construction is not free)."""
    name = method.__name__

    def wrapper(self):
        if name not in self._views:
            self._views[name] = method(self)
        return self._views[name]

    wrapper.__name__ = name
    wrapper.__doc__ = method.__doc__
    return wrapper


def _materialize(spark: SparkSession, df: DataFrame) -> DataFrame:
    """A table in the session's checkpoint folder (shared storage on a
    cluster), read back: computed once, lineage cut, survives the loss of the
    executors that computed it. Spark knows its size when it plans joins."""
    path = shared_dir(spark, "dimension")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Model:
    """The banking tables of one period over one driver-table folder;
    ``versions``: part of the accounts have two versions in the period;
    ``"overlapping"``: several that overlap, as delivered."""

    def __init__(self, spark: SparkSession, sf_dir: str, period: Period = DEFAULT_PERIOD,
                 versions: bool | str = False):
        self.spark, self.period, self.versions = spark, period, versions
        self.db = fx.DriverTables.shared(spark, sf_dir)
        self._views: dict[str, DataFrame] = {}

    @_once
    def account_parts(self) -> DataFrame:
        return fx.account_parts(self.db, self.period)

    @_once
    def accounts(self) -> DataFrame:
        a = fx.accounts(self.db, self.period, self.account_parts())
        if self.versions == "overlapping":
            return ver.disjoint_versions(fx.overlapping(a, self.period))
        return fx.versioned(a, self.period) if self.versions else a

    @_once
    def balances(self) -> DataFrame:
        return fx.opening_balances(self.db, self.period, self.account_parts())

    @_once
    def postings(self) -> DataFrame:
        return fx.postings(self.db)

    @_once
    def rates_raw(self) -> DataFrame:
        return fx.exchange_rates_raw(self.db, self.period)

    @_once
    def rates(self) -> DataFrame:
        """Deduped rates (at most currencies x intervals rows), materialized
        once: the broadcast size checks and every join then read this small
        result instead of re-deriving it from all supplier quotes."""
        return _materialize(self.spark, cf.keep_first(
            self.rates_raw(), EXCHANGE_RATE.dedupe_keys, EXCHANGE_RATE.dedupe_order))

    @_once
    def ledger(self) -> DataFrame:
        """The ledger dimension (a dozen rows), materialized once for the
        same reason."""
        return _materialize(self.spark, fx.ledger(self.db))

    @_once
    def currencies(self) -> DataFrame:
        return fx.currencies(self.db, self.period)

    @_once
    def opening(self) -> DataFrame:
        return bal.opening_balance(self.balances(), self.rates(), self.period.opening)

    @_once
    def turnover(self) -> DataFrame:
        return tov.turnover_fx(self.postings(), self.accounts(), self.rates(), self.period)

    @_once
    def daily_turnover(self) -> DataFrame:
        """Turnover of the period in account currency (not yet valued)."""
        return tov.daily_turnover(self.postings(), self.period)

    @_once
    def daily_balance(self) -> DataFrame:
        return bal.daily_balance(self.accounts(), self.opening(), self.daily_turnover(),
                                 self.period, rates=self.rates())

    def prefetch(self, *views: str) -> None:
        """Build independent views at once (their eager checkpoints are
        separate jobs that can share the cluster)."""
        with ThreadPoolExecutor(max_workers=len(views)) as pool:
            for f in [pool.submit(getattr(self, v)) for v in views]:
                f.result()

    @_once
    def form101(self) -> DataFrame:
        self.prefetch("rates", "ledger")
        return rep.form101(self.accounts(), self.ledger(), self.opening(), self.daily_turnover(),
                           self.period, rates=self.rates())


# --- step 1: the opening valuation -----------------------------------------

def q_opening_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Model(spark, sf_dir)
    return _money_out(m.opening(), ["balance_out", "balance_out_rub"])


def q_opening_balance_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The opening valuation with the rate valid on the opening date
    instead of the rate starting on it."""
    m = Model(spark, sf_dir)
    o = bal.opening_balance(m.balances(), m.rates(), m.period.opening, rate_rule="as_of")
    return _money_out(o, ["balance_out", "balance_out_rub"])


def q_dedupe_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Model(spark, sf_dir)
    return _money_out(m.rates().select("currency_rk", "data_actual_date", "data_actual_end_date",
                                       "reduced_cource", "code_iso_num"), ["reduced_cource"])


# --- step 2: scans, dates, dedupe, refresh ---------------------------------

def q_csv_typed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Model(spark, sf_dir)
    path = shared_dir(spark, "csv-typed") + f"/{ACCOUNT.name}.csv"
    csvio.write_delimited(csvio.to_source_layout(m.accounts(), ACCOUNT), path,
                          sep=ACCOUNT.sep, upper_header=True)
    return cf.conform(csvio.read_typed(spark, path, ACCOUNT), ACCOUNT).table


def q_csv_string_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Model(spark, sf_dir)
    path = shared_dir(spark, "csv-string") + f"/{POSTING.name}.csv"
    csvio.write_delimited(csvio.to_source_layout(m.postings(), POSTING), path, sep=",")
    return csvio.read_text_columns(spark, path, sep=",")


def q_parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Model(spark, sf_dir).postings()
    d = F.col("oper_date")
    return p.select(
        "credit_account_rk", "debet_account_rk",
        parse_date(render_date(d, ISO_DATE), ISO_DATE).alias("d_iso"),
        parse_date(render_date(d, DOTTED_DATE), DOTTED_DATE).alias("d_dotted"),
        parse_date(render_date(d, DASHED_DATE), DASHED_DATE).alias("d_dashed"))


def write_landing(m: Model, folder: str) -> None:
    """The six source files of the model, in their delivered layout.

    The six writes are independent jobs; they are submitted together so the
    scheduler can run their tasks side by side."""
    tables = [(BALANCE, m.balances()), (POSTING, m.postings()), (ACCOUNT, m.accounts()),
              (CURRENCY, m.currencies()), (EXCHANGE_RATE, m.rates_raw()), (LEDGER, m.ledger())]
    jobs = [(csvio.to_source_layout(df, spec), f"{folder}/{spec.name}.csv", spec.sep)
            for spec, df in tables]
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        done = [pool.submit(csvio.write_delimited, df, path, sep, "overwrite", True)
                for df, path, sep in jobs]
        for f in done:
            f.result()


def q_ingest_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Model(spark, sf_dir)
    folder = shared_dir(spark, "landing")
    write_landing(m, folder)
    return ingest_folder(spark, folder).counts()


def write_damaged_landing(m: Model, folder: str) -> None:
    """Postings in two deliveries and accounts, some lines damaged by their
    account key, and a file of no known table.

    Postings, by credit customer modulo 50: 0 a date in another pattern, 1 a
    letter in the key, 2 a word for the amount, 3 the last field missing, 4 a
    field too many, 5 no key. Accounts of every seventh customer: Latin A.
    """
    def lines(df: DataFrame, spec, path: str) -> None:
        # one column holding whole lines: the writer must not mend them
        header = spec.sep.join(spec.columns)
        (df.toDF(header).write.option("header", True).option("sep", "\u0001").option("quote", "").csv(path))

    key, kind = F.col("credit_account_rk"), (F.col("credit_account_rk") / 3).cast("bigint") % 50
    day = F.when(kind == 0, render_date("oper_date", DOTTED_DATE)).otherwise(render_date("oper_date", DASHED_DATE))
    credit = (F.when(kind == 1, F.concat(F.lit("x"), key)).when(kind == 5, F.lit(""))
              .otherwise(key.cast("string")))
    amount = F.when(kind == 2, F.lit("abc")).otherwise(F.col("credit_amount").cast("string"))
    debit_amount = F.col("debet_amount").cast("string")
    line = F.concat_ws(";", day, credit, F.col("debet_account_rk").cast("string"), amount,
                       F.when(kind != 3, debit_amount), F.when(kind == 4, F.lit("1")))
    postings = m.postings()
    for n in (1, 2):
        part = postings.where(F.col("debet_account_rk") % 2 == n - 1)
        lines(part.select(line), POSTING, f"{folder}/{POSTING.name}.{n}.csv")
    latin = (F.col("account_rk") % 21 == 0)
    accounts = m.accounts().withColumn("char_type", F.when(latin, F.lit("A")).otherwise(F.col("char_type")))
    csvio.write_delimited(csvio.to_source_layout(accounts, ACCOUNT), f"{folder}/{ACCOUNT.name}.csv", sep=ACCOUNT.sep)
    csvio.write_delimited(m.currencies(), f"{folder}/notes.csv")


def q_ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected rows of a damaged landing folder by table and reason."""
    m = Model(spark, sf_dir)
    folder = shared_dir(spark, "landing-damaged")
    write_damaged_landing(m, folder)
    return ingest_folder(spark, folder).reject_counts(spark)


def q_full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Model(spark, sf_dir)
    path = shared_dir(spark, "refresh") + "/ds/md_account_d"
    sinks.full_refresh(m.accounts(), path)
    sinks.full_refresh(m.accounts(), path)
    return sinks.read_table(spark, path)


def q_dedupe_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = Model(spark, sf_dir).accounts()
    return cf.drop_identical_rows(a.unionByName(a))


def q_mart_day_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Model(spark, sf_dir)
    path = shared_dir(spark, "mart") + "/dm/account_turnover_f"
    month = m.turnover()
    # the 15th is written with doubled amounts, and a day before the period that must end empty
    day, outside = m.period.start.replace(day=15), m.period.opening
    wrong = month.where(F.col("on_date") == F.lit(day))
    doubled = wrong.select(*[(F.col(c) * 2).cast(t).alias(c) if t.startswith("decimal") else F.col(c)
                             for c, t in wrong.dtypes])
    first = month.where(F.col("on_date") != F.lit(day)).unionByName(doubled).unionByName(
        wrong.withColumn("on_date", F.lit(outside)))
    sinks.refresh_partitions(first, path, ["on_date"])
    again = tov.turnover_fx(m.postings(), m.accounts(), m.rates(), Period(day, day))
    sinks.replace_days(again, path, "on_date", day, day)
    sinks.replace_days(again, path, "on_date", outside, outside)
    back = spark.read.schema(month.schema).parquet(path)
    out = back.groupBy("on_date").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("credit_amount").alias("credit_amount"),
        F.sum("credit_amount_rub").alias("credit_amount_rub"),
        F.sum("debet_amount").alias("debet_amount"),
        F.sum("debet_amount_rub").alias("debet_amount_rub"))
    return _money_out(out, ["credit_amount", "credit_amount_rub", "debet_amount", "debet_amount_rub"])


# --- step 3: spine, turnover, FX -------------------------------------------

def q_date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Model(spark, sf_dir)
    return bal.account_days(m.accounts(), m.period)


def q_daily_turnover(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Model(spark, sf_dir)
    return _money_out(tov.daily_turnover(m.postings()), ["credit_amount", "debet_amount"])


def q_turnover_fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Model(spark, sf_dir)
    return _money_out(m.turnover(), ["credit_amount", "credit_amount_rub", "debet_amount",
                                     "debet_amount_rub"])


# --- step 4: balances ------------------------------------------------------

def q_daily_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = Model(spark, sf_dir).daily_balance()
    return _money_out(b, ["balance_out", "balance_out_rub"])


def q_account_versions_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roll-forward when accounts have several versions in the period."""
    b = Model(spark, sf_dir, versions=True).daily_balance()
    return _money_out(b, ["balance_out", "balance_out_rub"])


def q_turnover_fx_long_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All turnover, valued with seven years of rates that overlap, leave gaps and end open."""
    m = Model(spark, sf_dir)
    rates = _materialize(spark, cf.keep_first(
        fx.long_rates_raw(m.db), EXCHANGE_RATE.dedupe_keys, EXCHANGE_RATE.dedupe_order))
    of = m.account_parts().select(F.col("account_rk").alias("_rk"), "currency_rk")
    moved = tov.daily_turnover(m.postings()).join(of, F.col("account_rk") == F.col("_rk")).drop("_rk")
    rated = with_rate_on(moved, rates, out="rate")
    out = rated.select("on_date", "account_rk", "currency_rk", "rate",
                       in_roubles(rated, "credit_amount", "rate").alias("credit_amount_rub"),
                       in_roubles(rated, "debet_amount", "rate").alias("debet_amount_rub"))
    return _money_out(out, ["rate", "credit_amount_rub", "debet_amount_rub"])


def q_account_versions_disjoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping, nested and equally starting account versions, cut so that one counts on a day."""
    return Model(spark, sf_dir, versions="overlapping").accounts()


def q_overlapping_versions_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roll-forward over versions that were delivered overlapping."""
    b = Model(spark, sf_dir, versions="overlapping").daily_balance()
    return _money_out(b, ["balance_out", "balance_out_rub"])


def q_balance_restated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The balance mart, filled without some postings of the month's last part and restated when they arrive late."""
    m = Model(spark, sf_dir)
    root, first_late = shared_dir(spark, "restated"), m.period.start.replace(day=11)
    late = (F.col("credit_account_rk") % 7 == 0) & (F.col("oper_date") >= F.lit(first_late))
    early = tov.turnover_fx(m.postings().where(~late), m.accounts(), m.rates(), m.period)
    turnover, balance = f"{root}/account_turnover_f", f"{root}/account_balance_f"
    sinks.replace_days(early, turnover, "on_date", m.period.start, m.period.end)
    early = spark.read.schema(early.schema).parquet(turnover)
    filled = bal.daily_balance(m.accounts(), m.opening(), early, m.period)
    opening = m.opening().select(*[F.col(f.name).cast(f.dataType) for f in filled.schema])
    sinks.replace_days(filled.unionByName(opening), balance, "on_date", m.period.opening, m.period.end)
    mart = spark.read.schema(filled.schema).parquet(balance)

    rest_of = Period(first_late, m.period.end)
    new = tov.turnover_fx(m.postings(), m.accounts(), m.rates(), rest_of)
    changes = rst.turnover_changes(tov.in_period(early, "on_date", rest_of), new)
    again = rst.restated_balance(m.accounts(), mart, _materialize(spark, changes), new, m.period, first_late)
    # the balances first: after a crash in between the same changes are found again
    sinks.replace_days(again, balance, "on_date", first_late, m.period.end)
    sinks.replace_days(new, turnover, "on_date", first_late, m.period.end)
    back = spark.read.schema(filled.schema).parquet(balance)
    return _money_out(tov.in_period(back, "on_date", m.period), ["balance_out", "balance_out_rub"])


# --- step 5: ledger, orphans, report ---------------------------------------

def q_ledger_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Model(spark, sf_dir)
    return rep.assign_ledger(m.accounts(), m.ledger(), m.period).select(
        "account_rk", "ledger_account", "chapter", "characteristic")


def q_orphan_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Model(spark, sf_dir)
    o = rep.orphan_balances(m.balances(), m.accounts(), m.period)
    return _money_out(o.select("account_rk", "currency_rk", "balance_out"), ["balance_out"])


def q_form101(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _money_out(Model(spark, sf_dir).form101(), REPORT_MEASURES)


def marts_of(m: Model, root: str) -> dict[str, BucketedMart]:
    """The accounts, the turnover and the balances of the period (with the opening date) as bucketed marts."""
    parts = {"md_account_d": (m.accounts(), None), "account_turnover_f": (m.turnover(), "on_date"),
             "account_balance_f": (m.daily_balance(), "on_date")}
    marts = {n: BucketedMart(m.spark, f"{root}/{n}", df.schema, day=day) for n, (df, day) in parts.items()}
    marts["md_account_d"].refresh(m.accounts())
    marts["account_turnover_f"].replace_days(m.turnover(), m.period.start, m.period.end)
    opening = m.opening().select(*[F.col(f.name).cast(f.dataType) for f in m.daily_balance().schema])
    marts["account_balance_f"].replace_days(m.daily_balance().unionByName(opening), m.period.opening, m.period.end)
    return marts


def form101_of(m: Model, marts: dict[str, BucketedMart]) -> DataFrame:
    balance = marts["account_balance_f"].read()
    return rep.form101(marts["md_account_d"].read(), m.ledger(), balance.where(F.col("on_date") == F.lit(m.period.opening)),
                       marts["account_turnover_f"].read(), m.period, closing=balance)


def q_form101_from_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form 101 out of stored marts, bucketed by account: opening, turnover and closing balances as they stand there."""
    m = Model(spark, sf_dir)
    return _money_out(form101_of(m, marts_of(m, shared_dir(spark, "bucketed"))), REPORT_MEASURES)


def q_turnover_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Model(spark, sf_dir)
    left = tov.unmatched_turnover(m.daily_turnover(), m.accounts())
    return _money_out(left.select("on_date", "account_rk", "credit_amount", "debet_amount"),
                      ["credit_amount", "debet_amount"])


def q_accounts_without_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts that form 101 leaves out when one ledger is closed inside the period."""
    m = Model(spark, sf_dir)
    closed = F.when(F.col("ledger_account") == fx.CUSTOMER_LEDGER_BASE + 3, F.lit(m.period.start.replace(day=20)))
    ledger = m.ledger().withColumn("end_date", F.coalesce(closed, F.col("end_date")))
    return rep.accounts_without_ledger(m.accounts(), ledger, m.period).select("account_rk", "account_number")


def q_form101_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form 101 when accounts have several versions, also under two ledgers."""
    return _money_out(Model(spark, sf_dir, versions=True).form101(), REPORT_MEASURES)


# --- step 6: export / re-import, journal -----------------------------------

def q_report_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Model(spark, sf_dir)
    path = shared_dir(spark, "export") + f"/{REPORT.name}.csv"
    csvio.write_delimited(m.form101(), path, sep=REPORT.sep)
    back = cf.conform(csvio.read_typed(spark, path, REPORT), REPORT).table
    return _money_out(back, REPORT_MEASURES)


def q_run_log_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runlog.run_state(fx.run_events(fx.DriverTables.shared(spark, sf_dir)))


def q_posting_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.streaming import stream_ingest

    m = Model(spark, sf_dir)
    root = shared_dir(spark, "stream")
    landing, table = f"{root}/landing/{POSTING.name}", f"{root}/ds/{POSTING.name}"
    csvio.write_delimited(csvio.to_source_layout(m.postings(), POSTING), landing, sep=POSTING.sep)
    q = stream_ingest(spark, POSTING, landing, table, f"{root}/_checkpoint/{POSTING.name}",
                      rejects_dir=f"{root}/rejects/{POSTING.name}")
    q.awaitTermination()
    back = spark.read.parquet(table)
    return _money_out(back.select(*POSTING.columns), ["credit_amount", "debet_amount"])


#: Bytes of ``lineitem`` a delivered file of postings stands for, once a delivery has more than four.
FILE_BYTES = 32 << 20


def _delivered_files(m: Model) -> int:
    """Files of a delivery, an even number: four, and more as the postings grow, so that no task writes a quarter of them.

    From the size of the table's files, so it costs no job."""
    return max(4, 2 * math.ceil(estimated_bytes(m.db.table("lineitem")) / FILE_BYTES / 2))


def _dealt(part: DataFrame, files: int) -> DataFrame:
    """Postings in the source layout, dealt to the files by their content: a delivery made again has the same files,
    in any order of rows, and no key has a file of its own."""
    return csvio.to_source_layout(part, POSTING).repartition(files, *POSTING.columns)


def q_landing_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings delivered in two loads, the second of which brings all files of the first again, under another name."""
    m = Model(spark, sf_dir)
    root = shared_dir(spark, "redelivered")
    landing, warehouse = f"{root}/landing", f"{root}/warehouse"
    first = F.col("debet_account_rk") % 2 == 0
    files = _delivered_files(m)

    def deliver(part: DataFrame, name: str) -> None:
        csvio.write_delimited(_dealt(part, files), f"{landing}/{POSTING.name}.{name}.csv", sep=POSTING.sep)

    deliver(m.postings().where(first), "1")
    reg.ingest_new(spark, landing, warehouse, "monday")
    deliver(m.postings().where(first), "1-again")
    deliver(m.postings().where(~first), "2")
    reg.ingest_new(spark, landing, warehouse, "tuesday")
    return _money_out(reg.read_loaded(spark, warehouse, POSTING), ["credit_amount", "debet_amount"])


def q_ingest_reordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings in four files: as declared, columns swapped, one column more, one less."""
    m = Model(spark, sf_dir)
    folder = shared_dir(spark, "landing-reordered")
    kind = F.col("debet_account_rk") % 4
    source = csvio.to_source_layout(m.postings(), POSTING)
    c = POSTING.columns
    for n, columns in enumerate((c, [c[4], c[1], c[0], c[3], c[2]], [c[0], "note", *c[1:]], [c[0], c[1], c[2], c[4]])):
        part = source.withColumn("note", F.concat(F.lit("no. "), "credit_account_rk")).where(kind == n)
        csvio.write_delimited(part.select(*columns), f"{folder}/{POSTING.name}.{n}.csv", sep=POSTING.sep, upper_header=n == 1)
    paths = deliveries(spark, folder)[0][POSTING.name]
    out = cf.conform(read_aligned(spark, paths, POSTING), POSTING).table
    return _money_out(out, ["credit_amount", "debet_amount"])


def q_turnover_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turnover of all postings, taken from a stream of files in several micro-batches and folded in between."""
    m = Model(spark, sf_dir)
    root = shared_dir(spark, "turnover-stream")
    landing, mart = f"{root}/landing/{POSTING.name}", f"{root}/dm/account_turnover_f"
    files = _delivered_files(m)
    for n in range(2):
        part = m.postings().where(F.col("debet_account_rk") % 2 == n)
        csvio.write_delimited(_dealt(part, files), landing, sep=POSTING.sep, mode="append")
        # half of the delivery in a micro-batch
        st.stream_turnover(spark, landing, mart, f"{root}/_checkpoint", max_files_per_trigger=files // 2).awaitTermination()
        if n == 0:
            st.compact(spark, mart, max(b for _, b, _ in st.folders(spark, mart)), m.period.start)
    return _money_out(st.read_turnover(spark, mart), ["credit_amount", "debet_amount"])


def q_report_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exported report loaded into the _v2 table twice, and once more by appending; every row with its number."""
    m = Model(spark, sf_dir)
    root = shared_dir(spark, "reload")
    pl.extract_report(spark, m.form101(), f"{root}/report.csv")
    for mode in ("replace_period", "replace_period", "append"):
        pl.load_report(spark, f"{root}/report.csv", root, mode=mode)
    back = spark.read.parquet(sinks.table_path(root, "dm", pl.REPORT_V2)).select(*REPORT.columns)
    out = back.groupBy(*REPORT.columns).agg(F.count("*").alias("n_rows"))
    return _money_out(out, REPORT_MEASURES)


def q_run_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of single runs by key, from a compacted journal and the events that came after."""
    db = fx.DriverTables.shared(spark, sf_dir)
    events = fx.run_events(db).withColumn("log_id", F.col("log_id").cast("string"))
    journal = runlog.RunJournal(spark, shared_dir(spark, "journal") + "/logs/events")
    late = F.col("kind") == "end"
    journal.add(events.where(~late))
    journal.compact()
    journal.add(events.where(late))
    wanted = [str(n) for n in range(1, 1000, 7)]
    return journal.runs(wanted)


def q_balance_two_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """January filled and closed, then February rolled from its last day; balances of both months."""
    m = Model(spark, sf_dir)
    february = Period.month(m.period.end.year + m.period.end.month // 12, m.period.end.month % 12 + 1)
    # the accounts of the period stay open through the next month
    last = F.col("data_actual_date") == F.lit(m.period.start)
    accounts = m.accounts().withColumn("data_actual_end_date", F.when(last, F.lit(february.end)).otherwise(
        F.col("data_actual_end_date")))
    mart = shared_dir(spark, "two-months") + "/dm/account_balance_f"
    opening, schema = m.opening(), None
    for period in (m.period, february):
        turnover = tov.daily_turnover(m.postings(), period)
        b = bal.daily_balance(accounts, opening, turnover, period, rates=m.rates())
        schema = schema or b.schema
        sinks.replace_days(b.select(*[F.col(f.name).cast(f.dataType) for f in schema]), mart, "on_date",
                           period.start, period.end)
        opening = spark.read.schema(schema).parquet(mart).where(F.col("on_date") == F.lit(period.end))
    return _money_out(spark.read.schema(schema).parquet(mart), ["balance_out", "balance_out_rub"])


QUERIES: dict[str, Query] = {
    "landing_redelivered": q_landing_redelivered,
    "ingest_reordered": q_ingest_reordered,
    "turnover_stream": q_turnover_stream,
    "report_reload": q_report_reload,
    "run_lookup": q_run_lookup,
    "balance_two_months": q_balance_two_months,
    "opening_balance": q_opening_balance,
    "opening_balance_as_of": q_opening_balance_as_of,
    "dedupe_rates": q_dedupe_rates,
    "csv_typed_scan": q_csv_typed_scan,
    "csv_string_scan": q_csv_string_scan,
    "parse_dates": q_parse_dates,
    "ingest_row_counts": q_ingest_row_counts,
    "ingest_rejects": q_ingest_rejects,
    "full_refresh": q_full_refresh,
    "dedupe_rows": q_dedupe_rows,
    "mart_day_refresh": q_mart_day_refresh,
    "date_spine": q_date_spine,
    "daily_turnover": q_daily_turnover,
    "turnover_fx": q_turnover_fx,
    "daily_balance": q_daily_balance,
    "account_versions_balance": q_account_versions_balance,
    "turnover_fx_long_rates": q_turnover_fx_long_rates,
    "account_versions_disjoint": q_account_versions_disjoint,
    "overlapping_versions_balance": q_overlapping_versions_balance,
    "balance_restated": q_balance_restated,
    "ledger_assign": q_ledger_assign,
    "turnover_unmatched": q_turnover_unmatched,
    "accounts_without_ledger": q_accounts_without_ledger,
    "orphan_balances": q_orphan_balances,
    "form101": q_form101,
    "form101_versions": q_form101_versions,
    "form101_from_marts": q_form101_from_marts,
    "report_roundtrip": q_report_roundtrip,
    "run_log_status": q_run_log_status,
    "posting_stream_ingest": q_posting_stream_ingest,
}
