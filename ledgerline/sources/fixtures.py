"""The banking model as views over the driver's TPC-H-like tables.

Every view is a projection (or a join in the case of postings) of the given
tables, so its size grows with them:

* accounts: one per customer (``3*c_custkey``), per supplier
  (``3*s_suppkey+1``) and a reserve account per nation (``3*n_nationkey+2``);
  the three key ranges never collide at any scale.
* opening balances: ``c_acctbal`` / ``s_acctbal``; ``1000*(key+1)`` for
  reserve accounts. Customer accounts with a negative balance were closed at
  the opening date: they have a balance but no account in the period.
* postings: one per lineitem, dated ``l_shipdate``; the order's customer is
  credited and the supplier debited with ``l_extendedprice``.
* currencies: from ``nation``; exchange rates: quotes filed by every
  supplier for its nation's currency (key dedupe keeps the lowest).
* ledger: five customer ledgers (one per market segment), five supplier
  ledgers (nation key mod 5) and two reserve ledgers.

The rules are stated once here and once, as SQL, in ``plans/oracle.py``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.dates import lit_date
from ledgerline.model import ACTIVE, PASSIVE, RUN_STATUSES, Period

# ---------------------------------------------------------------------------
# Fixed values of the fixture mapping.
# ---------------------------------------------------------------------------
# TPC-H market segments in alphabetical order -> ledgers 30101..30105.
MARKET_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
CUSTOMER_LEDGER_BASE = 30100
SUPPLIER_LEDGER_BASE = 30201      # + nation key mod 5
RESERVE_LEDGER_DOMESTIC = 30301   # nations 0 and 1
RESERVE_LEDGER_FOREIGN = 30302
LEDGER_CHAPTER = "А"
LEDGER_VALID_FROM = "1990-01-01"
LEDGER_VALID_TO = "2050-12-31"
MONEY_IN = "decimal(18,2)"
RATE_IN = "decimal(10,4)"


class DriverTables:
    """Lazy access to ``{sf_dir}/{name}.parquet``; only the columns a view
    selects are read. ``shared`` hands out one instance per session and
    folder: the driver tables are read-only, so their DataFrames (file
    listing, footer schema) are built once."""

    _shared: dict = {}

    @classmethod
    def shared(cls, spark: SparkSession, sf_dir: str) -> "DriverTables":
        key = (id(spark), sf_dir.rstrip("/"))
        if key not in cls._shared:
            cls._shared[key] = cls(spark, sf_dir)
        return cls._shared[key]

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        # one DataFrame object per table: the file listing and footer read
        # happen once, however many views use the table
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]


def currency_code(key: F.Column) -> F.Column:
    return (F.when(key == 0, F.lit("643")).when(key == 1, F.lit("810"))
            .otherwise((key + 100).cast("string")))


def char_type_of(ledger: F.Column) -> F.Column:
    return F.when(ledger % 2 == 1, F.lit(ACTIVE)).otherwise(F.lit(PASSIVE))


def _customer_ledger() -> F.Column:
    pos = F.array_position(F.array(*[F.lit(s) for s in MARKET_SEGMENTS]), F.col("c_mktsegment"))
    return F.when(pos > 0, pos + CUSTOMER_LEDGER_BASE).cast("int")


def _account_parts(db: DriverTables, period: Period) -> DataFrame:
    """account_rk, currency_rk, ledger_account, validity, opening amount."""
    start, end = lit_date(period.start), lit_date(period.end)
    closed_from, opening = lit_date(period.previous_month_start), lit_date(period.opening)
    customers = db.table("customer").select(
        (F.col("c_custkey") * 3).alias("account_rk"),
        F.col("c_nationkey").cast("int").alias("currency_rk"),
        _customer_ledger().alias("ledger_account"),
        F.when(F.col("c_acctbal") < 0, closed_from).otherwise(start).alias("data_actual_date"),
        F.when(F.col("c_acctbal") < 0, opening).otherwise(end).alias("data_actual_end_date"),
        F.col("c_acctbal").cast(MONEY_IN).alias("opening_amount"))
    suppliers = db.table("supplier").select(
        (F.col("s_suppkey") * 3 + 1).alias("account_rk"),
        F.col("s_nationkey").cast("int").alias("currency_rk"),
        (F.col("s_nationkey") % 5 + SUPPLIER_LEDGER_BASE).cast("int").alias("ledger_account"),
        start.alias("data_actual_date"), end.alias("data_actual_end_date"),
        F.col("s_acctbal").cast(MONEY_IN).alias("opening_amount"))
    reserve = db.table("nation").select(
        (F.col("n_nationkey").cast("bigint") * 3 + 2).alias("account_rk"),
        F.col("n_nationkey").cast("int").alias("currency_rk"),
        F.when(F.col("n_nationkey") <= 1, F.lit(RESERVE_LEDGER_DOMESTIC))
        .otherwise(F.lit(RESERVE_LEDGER_FOREIGN)).cast("int").alias("ledger_account"),
        start.alias("data_actual_date"), end.alias("data_actual_end_date"),
        ((F.col("n_nationkey") + 1) * 1000).cast(MONEY_IN).alias("opening_amount"))
    return reduce(DataFrame.unionByName, [customers, suppliers, reserve])


def account_parts(db: DriverTables, period: Period) -> DataFrame:
    """The union both the account and the balance view are cut from."""
    return _account_parts(db, period)


def accounts(db: DriverTables, period: Period, parts: DataFrame | None = None) -> DataFrame:
    """md_account_d: data_actual_date, data_actual_end_date, account_rk,
    account_number, char_type, currency_rk, currency_code."""
    p = parts if parts is not None else _account_parts(db, period)
    code = currency_code(F.col("currency_rk"))
    number = F.concat(F.col("ledger_account").cast("string"), code,
                      F.lpad(F.col("account_rk").cast("string"), 12, "0"))
    return p.select(
        "data_actual_date", "data_actual_end_date", "account_rk",
        number.alias("account_number"),
        char_type_of(F.col("ledger_account")).alias("char_type"),
        "currency_rk", code.alias("currency_code"))


def versioned(accounts: DataFrame, period: Period) -> DataFrame:
    """md_account_d with two versions of every fifth customer account inside the period.

    The first version ends on the 15th; the next starts on the 16th, or on
    the 21st for even keys (a gap). Every third of these moves to the
    foreign reserve ledger with its second version.
    """
    start, end = lit_date(period.start), lit_date(period.end)
    key, number = F.col("account_rk"), F.col("account_number")

    def version(first, last, text):
        return F.struct(first.alias("data_actual_date"), last.alias("data_actual_end_date"),
                        text.alias("account_number"))

    resumed = F.when(key % 2 == 0, F.date_add(start, 20)).otherwise(F.date_add(start, 15))
    moved = F.when(key % 45 == 0, F.concat(F.lit(str(RESERVE_LEDGER_FOREIGN)), F.substring(number, 6, 100))
                   ).otherwise(number)
    split = (key % 15 == 0) & (F.col("data_actual_date") == start)
    versions = F.when(split, F.array(version(start, F.date_add(start, 14), number), version(resumed, end, moved))
                      ).otherwise(F.array(version(F.col("data_actual_date"), F.col("data_actual_end_date"), number)))
    rest = [c for c in accounts.columns if c not in ("data_actual_date", "data_actual_end_date", "account_number")]
    return accounts.select(*rest, F.inline(versions)).select(*accounts.columns)


def overlapping(accounts: DataFrame, period: Period) -> DataFrame:
    """md_account_d with overlapping versions of every fifth customer account.

    Over the account's own version lie one that starts with it and ends on
    the 5th, one from the 8th to the 20th and inside it one from the 10th to
    the 12th of the opposite kind; the second and third under the reserve
    ledgers.
    """
    start, end, number, kind = (F.col(c) for c in (
        "data_actual_date", "data_actual_end_date", "account_number", "char_type"))

    def version(first, last, ledger, of_kind):
        text = number if ledger is None else F.concat(F.lit(str(ledger)), F.substring(number, 6, 100))
        return F.struct(first.alias("data_actual_date"), last.alias("data_actual_end_date"),
                        text.alias("account_number"), of_kind.alias("char_type"))

    own = version(start, end, None, kind)
    more = F.array(own, version(start, F.date_add(start, 4), RESERVE_LEDGER_DOMESTIC, kind),
                   version(F.date_add(start, 7), F.date_add(start, 19), RESERVE_LEDGER_FOREIGN, kind),
                   version(F.date_add(start, 9), F.date_add(start, 11), None,
                           F.when(kind == ACTIVE, F.lit(PASSIVE)).otherwise(F.lit(ACTIVE))))
    several = (F.col("account_rk") % 15 == 0) & (start == lit_date(period.start))
    rest = [c for c in accounts.columns
            if c not in ("data_actual_date", "data_actual_end_date", "account_number", "char_type")]
    return accounts.select(*rest, F.inline(F.when(several, more).otherwise(F.array(own)))).select(*accounts.columns)


def opening_balances(db: DriverTables, period: Period, parts: DataFrame | None = None) -> DataFrame:
    """ft_balance_f: on_date, account_rk, currency_rk, balance_out."""
    p = parts if parts is not None else _account_parts(db, period)
    return p.select(lit_date(period.opening).alias("on_date"), "account_rk", "currency_rk",
                    F.col("opening_amount").alias("balance_out"))


def postings(db: DriverTables) -> DataFrame:
    """ft_posting_f: oper_date, credit_account_rk, debet_account_rk,
    credit_amount, debet_amount; the whole history."""
    li = db.table("lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    od = db.table("orders").select("o_orderkey", "o_custkey")
    amount = F.col("l_extendedprice").cast(MONEY_IN)
    return li.join(od, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_shipdate").cast("date").alias("oper_date"),
        (F.col("o_custkey") * 3).alias("credit_account_rk"),
        (F.col("l_suppkey") * 3 + 1).alias("debet_account_rk"),
        amount.alias("credit_amount"), amount.alias("debet_amount"))


def currencies(db: DriverTables, period: Period) -> DataFrame:
    """md_currency_d: currency_rk, data_actual_date, data_actual_end_date,
    currency_code, code_iso_char."""
    n = F.col("n_nationkey").cast("int")
    return db.table("nation").select(
        n.alias("currency_rk"), lit_date(period.start).alias("data_actual_date"),
        lit_date(period.end).alias("data_actual_end_date"),
        currency_code(n).alias("currency_code"),
        F.upper(F.substring("n_name", 1, 3)).alias("code_iso_char"))


def exchange_rates_raw(db: DriverTables, period: Period) -> DataFrame:
    """md_exchange_rate_d as delivered, before key dedupe: rate quotes.

    Every supplier quotes the rate of its nation's currency, for nations
    from 2 on except keys ending in 4 or 9, over three intervals: the
    previous month up to the day before the opening date, the opening date
    alone, and the period. The quote is the currency's base rate plus
    0.25 x (s_suppkey mod 4), so one (date, currency) key carries as many
    quotes as the nation has suppliers; key dedupe keeps the lowest. The
    raw table grows with ``supplier``; the deduped one has at most
    3 x 18 rows.
    """
    intervals = F.array(
        F.struct(lit_date(period.previous_month_start).alias("d0"),
                 F.date_sub(lit_date(period.opening), 1).alias("d1")),
        F.struct(lit_date(period.opening).alias("d0"), lit_date(period.opening).alias("d1")),
        F.struct(lit_date(period.start).alias("d0"), lit_date(period.end).alias("d1")))
    quotes = (db.table("supplier")
              .select(F.col("s_nationkey").cast("int").alias("currency_rk"), "s_suppkey")
              .where((F.col("currency_rk") >= 2) & (F.col("currency_rk") % 5 != 4))
              .select("currency_rk", "s_suppkey", F.inline(intervals)))
    # rate in 1/100: base (1.0 .. 5.9 in steps of 0.1) + quote offset
    hundredths = ((10 + (F.col("currency_rk") * 7 + F.month("d0")) % 50) * 10
                  + (F.col("s_suppkey") % 4) * 25)
    return quotes.select(
        F.col("d0").alias("data_actual_date"), F.col("d1").alias("data_actual_end_date"),
        "currency_rk",
        (hundredths.cast(RATE_IN) / 100).cast(RATE_IN).alias("reduced_cource"),
        currency_code(F.col("currency_rk")).alias("code_iso_num"))


#: Rate history: quotes of a supplier, days between them and first day.
LONG_RATE_QUOTES, LONG_RATE_STEP, LONG_RATE_START = 130, 20, "1994-12-01"


def long_rates_raw(db: DriverTables) -> DataFrame:
    """Seven years of rate quotes, in the layout of md_exchange_rate_d.

    Every supplier quotes its nation's currency (those that have rates, see
    :func:`exchange_rates_raw`) every 20 days, suppliers with odd keys a
    week later. A quote holds for 31 days, into the next ones; every tenth
    for 6 days only, which leaves gaps; the last has an open end.
    """
    n = F.col("n")
    first = F.date_add(F.lit(LONG_RATE_START).cast("date"), (n * LONG_RATE_STEP + F.col("s_suppkey") % 2 * 7).cast("int"))
    last = F.when(n < LONG_RATE_QUOTES - 1, F.date_add("d0", F.when(n % 10 == 9, 5).otherwise(30)))
    quotes = (db.table("supplier").select(F.col("s_nationkey").cast("int").alias("currency_rk"), "s_suppkey")
              .where((F.col("currency_rk") >= 2) & (F.col("currency_rk") % 5 != 4))
              .withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(LONG_RATE_QUOTES - 1)))).withColumn("d0", first))
    hundredths = (10 + (F.col("currency_rk") * 7 + n) % 50) * 10 + (F.col("s_suppkey") % 4) * 25
    return quotes.select(
        F.col("d0").alias("data_actual_date"), last.alias("data_actual_end_date"), "currency_rk",
        (hundredths.cast(RATE_IN) / 100).cast(RATE_IN).alias("reduced_cource"),
        currency_code(F.col("currency_rk")).alias("code_iso_num"))


def ledger(db: DriverTables) -> DataFrame:
    """md_ledger_account_s: every ledger an account of the fixture can
    carry, derived from the segments and nations present in the data."""
    seg = db.table("customer").select(_customer_ledger().alias("ledger_account"))
    sup = db.table("nation").select(
        (F.col("n_nationkey") % 5 + SUPPLIER_LEDGER_BASE).cast("int").alias("ledger_account"))
    res = db.table("nation").select(
        F.when(F.col("n_nationkey") <= 1, F.lit(RESERVE_LEDGER_DOMESTIC))
        .otherwise(F.lit(RESERVE_LEDGER_FOREIGN)).cast("int").alias("ledger_account"))
    led = F.col("ledger_account")
    return (reduce(DataFrame.unionByName, [seg, sup, res]).where(led.isNotNull()).distinct()
            .select(
                F.lit(LEDGER_CHAPTER).alias("chapter"),
                F.lit(None).cast("string").alias("chapter_name"),
                F.lit(3).alias("section_number"),
                F.lit(None).cast("string").alias("section_name"),
                F.lit(None).cast("string").alias("subsection_name"),
                (led / 100).cast("int").alias("ledger1_account"),
                F.lit(None).cast("string").alias("ledger1_account_name"),
                led,
                F.lit(None).cast("string").alias("ledger_account_name"),
                char_type_of(led).alias("characteristic"),
                F.lit(LEDGER_VALID_FROM).cast("date").alias("start_date"),
                F.lit(LEDGER_VALID_TO).cast("date").alias("end_date")))


def run_events(db: DriverTables) -> DataFrame:
    """Run journal events, one run per order: a start event at o_orderdate
    and, for finished orders (status 'F'), an end event one day later."""
    o = db.table("orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    ev = F.array(
        F.struct(F.lit("start").alias("kind"), F.col("o_orderdate").alias("event_time"),
                 F.lit(RUN_STATUSES[0]).alias("status")),
        F.struct(F.lit("end").alias("kind"),
                 (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("event_time"),
                 F.lit(RUN_STATUSES[1]).alias("status")))
    ev = F.when(F.col("o_orderstatus") == "F", ev).otherwise(F.slice(ev, 1, 1))
    return o.select(F.col("o_orderkey").alias("log_id"), F.inline(ev))
