"""Date columns: parse with a pattern, cast, render, and day ranges."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: Column | str, pattern: str) -> Column:
    """Text -> DATE with a fixed pattern; a malformed value gives NULL.

    ``try_to_date`` keeps one bad row from failing the whole load under ANSI
    mode; callers count the NULLs as rejects.
    """
    return F.try_to_date(_col(c), pattern)


def cast_date(c: Column | str) -> Column:
    """Text in ISO form -> DATE by cast (the report re-import); bad -> NULL."""
    return _col(c).try_cast("date")


def render_date(c: Column | str, pattern: str) -> Column:
    """DATE -> text in ``pattern`` (what a source system would write)."""
    return F.date_format(_col(c), pattern)


def date_days(first: Column, last: Column) -> Column:
    """Array of every day in ``[first, last]``; empty when ``first > last``.

    Used with ``explode`` it expands one row into one row per day, so a
    calendar never needs a join.
    """
    return F.when(first <= last, F.sequence(first, last, F.expr("INTERVAL 1 DAY"))) \
        .otherwise(F.array().cast("array<date>"))


def lit_date(d: dt.date) -> Column:
    return F.lit(d).cast("date")
