"""Delimited scans and writes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.dates import render_date
from ledgerline.sources.specs import RAW_LINE, TableSpec


def typed_options(spec: TableSpec) -> dict[str, str]:
    """Reader options of a declared-schema scan; the number of fields is
    checked whatever columns a query selects."""
    return {"header": "true", "sep": spec.sep, "mode": "PERMISSIVE", "encoding": "UTF-8",
            "columnNameOfCorruptRecord": RAW_LINE, "columnPruning": "false"}


def every_field_checked(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The scan with a ``RAW_LINE`` that depends on all typed columns.

    The reader converts only the columns a query needs and marks a line only
    for those, so a count could accept a line that a full read rejects. The
    condition always holds; it keeps the typed columns in the scan.
    """
    typed = [F.col(f.name).isNull().cast("int") for f in spec.schema.fields if f.dataType.typeName() != "string"]
    return df.withColumn(RAW_LINE, F.when(reduce(Column.__add__, typed) >= 0, F.col(RAW_LINE))) if typed else df


def read_typed(spark: SparkSession, path: str | list[str], spec: TableSpec) -> DataFrame:
    """Declared-schema scan: header skipped, columns by position; one path
    or several of one table.

    A field that does not fit its type, or a wrong number of fields, leaves
    the whole line in ``RAW_LINE``; the conform step rejects such rows. No
    schema inference, so the scan is a single pass.
    """
    return every_field_checked(spark.read.schema(spec.scan_schema).options(**typed_options(spec)).csv(path), spec)


def read_text_columns(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Untyped scan: every column is a string, names from the header."""
    return (spark.read.option("header", True).option("sep", sep)
            .option("inferSchema", False).csv(path))


def to_source_layout(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Project a conformed table back to the layout its source file has:
    spec column order, dates rendered with the spec's pattern."""
    cols = []
    for name in spec.columns:
        if name in spec.date_columns and spec.date_format:
            cols.append(render_date(name, spec.date_format).alias(name))
        else:
            cols.append(F.col(name))
    return df.select(*cols)


def write_delimited(df: DataFrame, path: str, sep: str = ";", mode: str = "overwrite",
                    upper_header: bool = False) -> None:
    """CSV with a header row. ``overwrite`` makes a re-run replace the
    previous export instead of failing on the existing folder."""
    if upper_header:
        df = df.toDF(*[c.upper() for c in df.columns])
    (df.write.mode(mode).option("header", True).option("sep", sep)
     .option("encoding", "UTF-8").csv(path))
