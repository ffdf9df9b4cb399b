"""Ledger rules at column level."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.model import ACTIVE, DOMESTIC_CURRENCY_CODES, PASSIVE


def ledger_code(account_number: Column | str = "account_number") -> Column:
    """The second-order ledger account: the first five characters of the
    account number, as an integer."""
    c = F.col(account_number) if isinstance(account_number, str) else account_number
    return F.substring(c, 1, 5).try_cast("int")


def is_domestic(currency_code: Column | str = "currency_code") -> Column:
    c = F.col(currency_code) if isinstance(currency_code, str) else currency_code
    return c.isin(*DOMESTIC_CURRENCY_CODES)


def is_active(char_type: Column | str = "char_type") -> Column:
    c = F.col(char_type) if isinstance(char_type, str) else char_type
    return c == F.lit(ACTIVE)


def signed_movement(debit: Column, credit: Column, char_type: Column | str = "char_type") -> Column:
    """Change of the balance caused by a day's turnover.

    Active accounts grow with debits, passive ones with credits. A missing
    side counts as zero. Any other kind (a Latin letter, NULL) gives NULL,
    never a silently chosen sign.
    """
    d = F.coalesce(debit, F.lit(0))
    c = F.coalesce(credit, F.lit(0))
    kind = F.col(char_type) if isinstance(char_type, str) else char_type
    return F.when(is_active(kind), d - c).when(kind == F.lit(PASSIVE), c - d)


def currency_class_sums(value: Column | str, domestic: Column, prefix: str) -> list[Column]:
    """Three aggregate columns: domestic part, foreign part, total.

    NULL rules are those of the report: a NULL value adds nothing to the
    class sums while the other class contributes 0, and the total is NULL
    when every value is NULL.
    """
    v = F.col(value) if isinstance(value, str) else value
    return [
        F.sum(F.when(domestic, v).otherwise(F.lit(0))).alias(f"{prefix}_rub"),
        F.sum(F.when(~domestic, v).otherwise(F.lit(0))).alias(f"{prefix}_val"),
        F.sum(v).alias(f"{prefix}_total"),
    ]
