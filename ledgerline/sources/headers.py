"""Files whose columns are named by their own header line.

A delivered file may have its columns in another order, lack some or have
more. Each file's header is read in a scan of the files; files are grouped by
header and each group is read by the declared schema in the header's order,
so all typing, rejects and quoting are those of the positional scan. Columns
are then matched by name, in any case of letters.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.sources.csv import typed_options
from ledgerline.sources.specs import RAW_LINE, TableSpec


def header_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """file, header: the first line of every file that has one.

    Only a file's first split can hold it, and inside a task lines come in
    order. One text scan finds the least line number of every file, a second
    one fetches these lines: a task holds a number per file, never the lines
    (``min_by`` of a string would sort them). Both scans cut the files into
    the same splits, so a line has the same number in both.
    """
    lines = spark.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at")).where("start = 0")
    first = lines.groupBy("file").agg(F.min("at").alias("at")).select("at")
    return lines.join(F.broadcast(first), "at", "left_semi").select("file", F.col("value").alias("header"))


def names_of(header: str, sep: str) -> tuple[str, ...]:
    return tuple(n.strip().strip('"').strip().lower() for n in header.lstrip("﻿").split(sep))


def layouts(spark: SparkSession, paths: str | list[str], spec: TableSpec) -> dict[tuple[str, ...], list[str]]:
    """Files by their column names, in the header's order. A row per file reaches the driver, as in a listing."""
    out: dict[tuple[str, ...], list[str]] = {}
    for r in header_lines(spark, paths).orderBy("file").collect():
        out.setdefault(names_of(r["header"], spec.sep), []).append(r["file"])
    return out


def differences(names: tuple[str, ...], spec: TableSpec) -> list[tuple[str, str]]:
    """(kind, column): missing, extra, repeated and moved columns of a layout."""
    known = spec.columns
    found = [("missing", c) for c in known if c not in names]
    found += [("extra", c) for c in dict.fromkeys(names) if c not in known]
    found += [("repeated", c) for c in dict.fromkeys(names) if names.count(c) > 1]
    common = [c for c in dict.fromkeys(names) if c in known]
    found += [("moved", c) for c, d in zip(common, [c for c in known if c in names], strict=True) if c != d]
    return found


def report(spark: SparkSession, paths: str | list[str], spec: TableSpec) -> DataFrame:
    """file, kind, column: how the files differ from the declared layout; no rows for files that do not."""
    rows = [(f, kind, column) for names, files in layouts(spark, paths, spec).items()
            for kind, column in differences(names, spec) for f in files]
    return spark.createDataFrame(rows, "file string, kind string, column string")


def read_aligned(spark: SparkSession, paths: str | list[str], spec: TableSpec) -> DataFrame:
    """The declared columns and ``RAW_LINE`` of all files, each read in the order of its own header.

    A missing column is NULL, so the conform step rejects the rows of a file
    that lacks a required one; extra columns are read as text, so the number
    of fields is checked, and left out. Of a repeated column the first counts.
    Files without a header line have no rows.
    """
    types = {f.name: f.dataType for f in spec.schema.fields}
    parts = []
    for names, files in layouts(spark, paths, spec).items():
        fields, own = [], {}
        for i, name in enumerate(names):
            column = f"_c{i}"
            first = name in types and name not in own
            fields.append(T.StructField(column, types[name] if first else T.StringType(), True))
            if first:
                own[name] = column
        fields.append(T.StructField(RAW_LINE, T.StringType(), True))
        scan = spark.read.schema(T.StructType(fields)).options(**typed_options(spec)).csv(files)
        typed = [c for n, c in own.items() if not isinstance(types[n], T.StringType)]
        # always true; keeps all typed columns in the scan, whose check marks the line
        kept = F.when(F.xxhash64(*typed) % 2 < 2, F.col(RAW_LINE)) if typed else F.col(RAW_LINE)
        parts.append(scan.select(
            *[(F.col(own[c]) if c in own else F.lit(None).cast(types[c])).alias(c) for c in spec.columns],
            kept.alias(RAW_LINE), F.col("_metadata.file_path").alias("_file")))
    if not parts:
        schema = T.StructType([*spec.scan_schema.fields, T.StructField("_file", T.StringType(), True)])
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts)
