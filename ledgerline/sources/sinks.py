"""Table sinks for the detail store and the marts.

Tables are parquet folders under a warehouse root that lives on shared
storage. A written table is also where lineage is cut: later steps read it
back instead of recomputing, so a lost executor only re-runs the last step.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table_path(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}"


def _fs(spark: SparkSession, path: str):
    """(Hadoop file system of the path, Path class)."""
    jvm = spark.sparkContext._jvm
    make = jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def _swap(fs, fresh, target, aside) -> None:
    """Put ``fresh`` in the place of ``target``; the old content is moved aside and comes back on failure."""
    had = fs.exists(target)
    if had and not fs.rename(target, aside):
        raise OSError(f"cannot move {target} aside")
    if fs.exists(fresh) and not fs.rename(fresh, target):
        if had:
            fs.rename(aside, target)
        raise OSError(f"cannot move {fresh} to {target}")


def full_refresh(df: DataFrame, path: str, partition_cols: tuple[str, ...] = ()) -> None:
    """Replace the whole table. The rows are written next to it first, so a
    failing write leaves the old table as it was."""
    root, mark = path.rstrip("/"), uuid.uuid4().hex
    fresh, aside = f"{root}-new-{mark}", f"{root}-old-{mark}"
    if partition_cols:
        df.sortWithinPartitions(*partition_cols).write.partitionBy(*partition_cols).parquet(fresh)
    else:
        df.write.parquet(fresh)
    fs, make = _fs(df.sparkSession, root)
    _swap(fs, make(fresh), make(root), make(aside))
    fs.delete(make(aside), True)


def has_rows(spark: SparkSession, path: str, column: str, day: dt.date) -> bool:
    """Whether a day-partitioned table exists and has rows on the day."""
    root = f"{path.rstrip('/')}/{column}={day.isoformat()}"
    fs, make = _fs(spark, root)
    return fs.exists(make(root)) and not spark.read.parquet(root).isEmpty()


def refresh_partitions(df: DataFrame, path: str, partition_cols: list[str]) -> None:
    """Replace only the partitions present in ``df`` (per-day mart refresh).

    Each task sorts its rows by the partition columns so it keeps one open
    file at a time; no shuffle is added, so a heavy day is still written by
    many tasks. Days not in ``df`` keep their old content.
    """
    (df.sortWithinPartitions(*partition_cols)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).parquet(path))


def append(df: DataFrame, path: str, partition_cols: list[str] | None = None) -> None:
    w = df.write.mode("append")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def replace_days(df: DataFrame, path: str, column: str, first: dt.date, last: dt.date) -> None:
    """Make the days ``first..last`` of a day-partitioned table equal to
    ``df`` -- including days for which ``df`` has no rows, which a dynamic
    partition overwrite would leave with their old content.

    The rows are written (in parallel, by Spark) into a staging folder
    inside the table folder, which readers ignore (leading ``_``); then, on
    the driver, each day's old folder is moved into staging and the new one
    moved in: metadata operations only, one per day of the range, each
    checked. A refused move raises and keeps the day's old rows; staging is
    removed only when all days are in place, so a re-run completes the step.
    """
    spark = df.sparkSession
    root = path.rstrip("/")
    staging = f"{root}/_staging-{uuid.uuid4().hex}"
    rows = df.where(F.col(column).between(F.lit(first), F.lit(last)))
    rows.sortWithinPartitions(column).write.mode("overwrite").partitionBy(column).parquet(staging)

    fs, make = _fs(spark, root)
    day = first
    while day <= last:
        name = f"{column}={day.isoformat()}"
        _swap(fs, make(f"{staging}/{name}"), make(f"{root}/{name}"), make(f"{staging}/_old-{name}"))
        day += dt.timedelta(days=1)
    fs.delete(make(staging), True)
