"""Conform raw delimited tables (P1-P6, A1, A2) and account for rejects."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.dates import cast_date, parse_date
from ledgerline.sources.specs import RAW_LINE, TableSpec

REJECT_REASON = "_reject_reason"


def _parsed(spec: TableSpec) -> dict[str, Column]:
    if spec.date_format:
        return {c: parse_date(c, spec.date_format) for c in spec.date_columns}
    return {c: cast_date(c) for c in spec.date_columns}


PARSED = "_parsed_"  # prefix of the hidden parsed-date columns of a staged table


def reject_reason(spec: TableSpec, parsed: dict[str, Column] | None = None,
                  raw_line: bool = False) -> Column:
    """'' for a good row, else a comma list of ``bad_value`` (a malformed
    field or number of fields; only with ``raw_line``), ``bad_date:<col>``,
    ``missing:<col>`` and ``bad_code:<col>``, evaluated on the raw row."""
    parsed = parsed or _parsed(spec)
    checks = [F.when(F.col(RAW_LINE).isNotNull(), F.lit("bad_value"))] if raw_line else []
    for c in spec.date_columns:
        checks.append(F.when(F.col(c).isNotNull() & parsed[c].isNull(), F.lit(f"bad_date:{c}")))
    for c in spec.required:
        checks.append(F.when(F.col(c).isNull(), F.lit(f"missing:{c}")))
    for c, values in spec.allowed.items():
        checks.append(F.when(~F.col(c).isin(*values), F.lit(f"bad_code:{c}")))
    return F.concat_ws(",", *checks) if checks else F.lit("")


def stage(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Raw rows, as read, with a reject reason column. Each date is parsed
    once, into a hidden column that both the check and the accepted row
    use."""
    hidden = {f"{PARSED}{c}": e for c, e in _parsed(spec).items()}
    staged = raw.withColumns(hidden)
    parsed = {c: F.col(f"{PARSED}{c}") for c in spec.date_columns}
    return staged.withColumn(REJECT_REASON, reject_reason(spec, parsed, RAW_LINE in raw.columns))


def accept(staged: DataFrame, spec: TableSpec) -> DataFrame:
    """The good rows of a staged table, dates typed in place."""
    ok = staged.where(F.col(REJECT_REASON) == "")
    return ok.select(*[F.col(f"{PARSED}{c}").alias(c) if c in spec.date_columns else F.col(c)
                       for c in spec.columns])


def reject(staged: DataFrame) -> DataFrame:
    """The rejected rows with their reason. Dates keep the text they arrived
    with, and a malformed line is kept whole, so it can be corrected."""
    bad = staged.where(F.col(REJECT_REASON) != "")
    return bad.drop(*[c for c in staged.columns if c.startswith(PARSED)])


def keep_first(df: DataFrame, keys: list[str] | tuple[str, ...],
               order: list[str] | tuple[str, ...]) -> DataFrame:
    """One row per key: the smallest by ``order`` and then by the remaining
    columns (NULLs sort first), so the choice is deterministic.

    Written as ``min(struct(...))`` per key rather than ``row_number``: the
    minimum is combined map-side, so a key that holds a third of the table
    is reduced inside each task before the shuffle.
    """
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    return picked.select(*keys, "_first.*").select(*df.columns)


def drop_identical_rows(df: DataFrame) -> DataFrame:
    """Whole-row dedupe (A1). Lossy for fact tables: two identical postings
    are two postings, so the registry switches it off there."""
    return df.dropDuplicates()


@dataclass
class Conformed:
    spec: TableSpec
    staged: DataFrame

    @property
    def accepted(self) -> DataFrame:
        """Accepted rows, typed, before dedupe."""
        return accept(self.staged, self.spec)

    @property
    def table(self) -> DataFrame:
        """Accepted rows, typed, deduped as the spec says."""
        return dedupe(self.accepted, self.spec)

    @property
    def rejects(self) -> DataFrame:
        return reject(self.staged)


def dedupe(df: DataFrame, spec: TableSpec, identical_rows: bool | None = None) -> DataFrame:
    if spec.drop_identical_rows if identical_rows is None else identical_rows:
        df = drop_identical_rows(df)
    if spec.dedupe_keys:
        df = keep_first(df, spec.dedupe_keys, spec.dedupe_order)
    return df


def conform(raw: DataFrame, spec: TableSpec) -> Conformed:
    return Conformed(spec, stage(raw, spec))
