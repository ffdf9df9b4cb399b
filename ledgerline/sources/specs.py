"""Table registry: what each delimited input looks like and how it is conformed.

Columns are declared positionally, as the files are read (the header row is
skipped, not matched). Names are lower case; Spark resolves them without
regard to case, so upper-case headers in files do not matter. Dates arrive as
text and are parsed with the table's pattern; keys are ``bigint`` so account
numbers of any bank size fit.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

from ledgerline.model import ACTIVE, DASHED_DATE, DOTTED_DATE, ISO_DATE, MONEY, PASSIVE, RATE


#: Scan column with the text of a line whose fields do not fit their types or number.
RAW_LINE = "_raw_line"


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    # columns read as text and parsed to DATE with ``date_format``
    date_columns: tuple[str, ...] = ()
    date_format: str | None = None
    # declared NOT NULL: a row with NULL here (after parsing) is rejected
    required: tuple[str, ...] = ()
    # the only values a column may hold; a row with another one is rejected
    allowed: dict[str, tuple[str, ...]] = field(default_factory=dict)
    # keep one row per key (A2): the lowest by ``dedupe_order``
    dedupe_keys: tuple[str, ...] = ()
    dedupe_order: tuple[str, ...] = ()
    # whole-row duplicates are dropped (A1); off for fact tables
    drop_identical_rows: bool = True
    # the stored table has a folder per month of this date
    month_of: str | None = None
    sep: str = ";"
    layer: str = "ds"

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    @property
    def scan_schema(self) -> T.StructType:
        """The columns as read, and the whole line where it does not fit them."""
        return T.StructType([*self.schema.fields, T.StructField(RAW_LINE, T.StringType(), True)])


_TYPES = {
    "STRING": T.StringType(), "INT": T.IntegerType(), "BIGINT": T.LongType(),
    "DECIMAL(23,8)": MONEY, "DECIMAL(18,8)": RATE, "DECIMAL(38,8)": T.DecimalType(38, 8),
}


def _schema(columns: str) -> T.StructType:
    """``"name TYPE, name TYPE, ..."`` with the few types used here."""
    fields = []
    for item in re.split(r",\s*(?![^()]*\))", columns):
        name, typ = item.split()
        fields.append(T.StructField(name, _TYPES[typ], True))
    return T.StructType(fields)


BALANCE = TableSpec(
    name="ft_balance_f",
    schema=_schema("on_date STRING, account_rk BIGINT, currency_rk INT, balance_out DECIMAL(23,8)"),
    date_columns=("on_date",), date_format=DOTTED_DATE,
    required=("on_date", "account_rk"),
)

POSTING = TableSpec(
    name="ft_posting_f",
    schema=_schema(
        "oper_date STRING, credit_account_rk BIGINT, debet_account_rk BIGINT, "
        "credit_amount DECIMAL(23,8), debet_amount DECIMAL(23,8)"),
    date_columns=("oper_date",), date_format=DASHED_DATE,
    required=("oper_date", "credit_account_rk", "debet_account_rk"),
    # two identical postings on one day are two postings
    drop_identical_rows=False, month_of="oper_date",
)

ACCOUNT = TableSpec(
    name="md_account_d",
    schema=_schema(
        "data_actual_date STRING, data_actual_end_date STRING, account_rk BIGINT, "
        "account_number STRING, char_type STRING, currency_rk INT, currency_code STRING"),
    date_columns=("data_actual_date", "data_actual_end_date"), date_format=ISO_DATE,
    required=("data_actual_date", "data_actual_end_date", "account_rk", "account_number",
              "char_type", "currency_rk", "currency_code"),
    allowed={"char_type": (ACTIVE, PASSIVE)},
)

CURRENCY = TableSpec(
    name="md_currency_d",
    schema=_schema(
        "currency_rk INT, data_actual_date STRING, data_actual_end_date STRING, "
        "currency_code STRING, code_iso_char STRING"),
    date_columns=("data_actual_date", "data_actual_end_date"), date_format=ISO_DATE,
    required=("currency_rk", "data_actual_date"),
)

EXCHANGE_RATE = TableSpec(
    name="md_exchange_rate_d",
    schema=_schema(
        "data_actual_date STRING, data_actual_end_date STRING, currency_rk INT, "
        "reduced_cource DECIMAL(18,8), code_iso_num STRING"),
    date_columns=("data_actual_date", "data_actual_end_date"), date_format=ISO_DATE,
    required=("data_actual_date", "currency_rk"),
    dedupe_keys=("data_actual_date", "currency_rk"),
    dedupe_order=("data_actual_end_date", "reduced_cource", "code_iso_num"),
)

LEDGER = TableSpec(
    name="md_ledger_account_s",
    schema=_schema(
        "chapter STRING, chapter_name STRING, section_number INT, section_name STRING, "
        "subsection_name STRING, ledger1_account INT, ledger1_account_name STRING, "
        "ledger_account INT, ledger_account_name STRING, characteristic STRING, "
        "start_date STRING, end_date STRING"),
    date_columns=("start_date", "end_date"), date_format=ISO_DATE,
    required=("ledger_account", "start_date"),
)

# The exported trial-balance report (form 101), comma separated. Dates are
# cast, not parsed with a pattern; empty fields are NULL. Ledger totals get
# the widest decimal: a bank-wide sum outgrows the 15 integer digits of
# the input money type.
REPORT = TableSpec(
    name="dm_f101_round_f",
    schema=_schema(
        "from_date STRING, to_date STRING, chapter STRING, ledger_account STRING, "
        "characteristic STRING, "
        "balance_in_rub DECIMAL(38,8), balance_in_val DECIMAL(38,8), balance_in_total DECIMAL(38,8), "
        "turn_deb_rub DECIMAL(38,8), turn_deb_val DECIMAL(38,8), turn_deb_total DECIMAL(38,8), "
        "turn_cre_rub DECIMAL(38,8), turn_cre_val DECIMAL(38,8), turn_cre_total DECIMAL(38,8), "
        "balance_out_rub DECIMAL(38,8), balance_out_val DECIMAL(38,8), balance_out_total DECIMAL(38,8)"),
    date_columns=("from_date", "to_date"), date_format=None,
    required=("from_date", "to_date", "ledger_account"),
    sep=",", layer="dm", drop_identical_rows=False,
)

REGISTRY: dict[str, TableSpec] = {
    s.name: s for s in (BALANCE, POSTING, ACCOUNT, CURRENCY, EXCHANGE_RATE, LEDGER)
}

REPORT_MEASURES = tuple(
    f"{m}_{c}" for m in ("balance_in", "turn_deb", "turn_cre", "balance_out")
    for c in ("rub", "val", "total"))
REPORT_KEYS = ("from_date", "to_date", "chapter", "ledger_account", "characteristic")
