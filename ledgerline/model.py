"""Shared vocabulary: reporting period, money types and fixed values."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the conventions of the source system for the
# results to be right; they are data, not logic.
# ---------------------------------------------------------------------------
# Currency codes booked in the domestic ("RUB") columns of form 101.
DOMESTIC_CURRENCY_CODES = ("643", "810")
# Account / ledger characteristic: Cyrillic capital letters.
ACTIVE = "А"   # "А", active account: balance grows with debits
PASSIVE = "П"  # "П", passive account: balance grows with credits
# Date patterns of the delimited inputs.
ISO_DATE = "yyyy-MM-dd"      # accounts, currencies, rates, ledger
DOTTED_DATE = "dd.MM.yyyy"   # balances
DASHED_DATE = "dd-MM-yyyy"   # postings
# Run journal statuses.
RUN_STATUSES = (
    "Started_etl_process", "Finished_etl_process",
    "Start_fill_dm_account_turnover", "Finished_fill_dm_account_turnover",
    "Start_fill_account_balance", "Finished_fill_account_balance",
    "Start_extract_to_csv", "Finished_extract_to_csv",
    "Start_load_to_pg", "Finished_load_to_pg",
)

# Money is exact. Inputs that arrive as text are read into these types.
MONEY = T.DecimalType(23, 8)
RATE = T.DecimalType(18, 8)


@dataclass(frozen=True)
class Period:
    """An inclusive reporting period ``[start, end]``.

    ``opening`` is the day before ``start``: the date of the balance that
    seeds the roll-forward.
    """

    start: dt.date
    end: dt.date

    def __post_init__(self) -> None:
        if self.end < self.start:
            raise ValueError(f"empty period {self.start}..{self.end}")

    @classmethod
    def month(cls, year: int, month: int) -> "Period":
        start = dt.date(year, month, 1)
        nxt = dt.date(year + (month == 12), month % 12 + 1, 1)
        return cls(start, nxt - dt.timedelta(days=1))

    @property
    def opening(self) -> dt.date:
        return self.start - dt.timedelta(days=1)

    @property
    def previous_month_start(self) -> dt.date:
        o = self.opening
        return dt.date(o.year, o.month, 1)

    @property
    def days(self) -> int:
        return (self.end - self.start).days + 1


# The period every registered query reports on.
DEFAULT_PERIOD = Period.month(1998, 1)
