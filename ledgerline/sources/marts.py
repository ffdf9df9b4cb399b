"""Marts bucketed by account (J6, W1): joins between them need no shuffle.

A mart is a folder of Parquet files, one folder per day, each day dealt to the
same number of buckets by the account key. Registered in the session's catalog
(the in-memory one does), Spark knows the buckets: tables of equal buckets
meet bucket by bucket. The folders hold everything; a new session registers
them again.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.sources.sinks import _fs, _swap

#: Buckets of a mart; on a cluster a multiple of its cores.
BUCKETS = 16


class BucketedMart:
    """A table at ``path`` with buckets by ``key`` and, with ``day``, a folder per day."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str = "account_rk",
                 day: str | None = "on_date", buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.day, self.buckets = spark, path.rstrip("/"), key, day, buckets
        # partition columns come last, as in the files' table
        fields = [f for f in schema.fields if f.name != day] + [f for f in schema.fields if f.name == day]
        self.schema = T.StructType(fields)
        self.name = self._name(self.path)

    @staticmethod
    def _name(path: str) -> str:
        return f"ledgerline_{hashlib.md5(path.encode()).hexdigest()}"

    def _create(self, name: str, path: str) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        days = f"PARTITIONED BY ({self.day})" if self.day else ""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {days} CLUSTERED BY ({self.key}) "
                       f"SORTED BY ({self.key}) INTO {self.buckets} BUCKETS LOCATION '{path}'")

    def read(self) -> DataFrame:
        """The table as its folders stand now."""
        fs, make = _fs(self.spark, self.path)
        fs.mkdirs(make(self.path))
        self._create(self.name, self.path)
        if self.day:
            self.spark.sql(f"MSCK REPAIR TABLE {self.name} SYNC PARTITIONS")
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def _staged(self, df: DataFrame) -> str:
        """The rows written as a bucketed table of its own, one file per day and bucket; its folder."""
        folder = f"{self.path}-staging-{uuid.uuid4().hex}"
        name = self._name(folder)
        typed = df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])
        self._create(name, folder)
        # dealt like the buckets: a task holds one bucket and writes one file a day
        dealt = typed.repartition(self.buckets, self.key)
        dealt.sortWithinPartitions(*[c for c in (self.day, self.key) if c]).write.mode("append").insertInto(name)
        self.spark.sql(f"DROP TABLE {name}")  # an external table: the files stay
        return folder

    def refresh(self, df: DataFrame) -> None:
        """Replace the whole table."""
        folder, aside = self._staged(df), f"{self.path}-old-{uuid.uuid4().hex}"
        fs, make = _fs(self.spark, self.path)
        _swap(fs, make(folder), make(self.path), make(aside))
        fs.delete(make(aside), True)

    def replace_days(self, df: DataFrame, first: dt.date, last: dt.date) -> None:
        """Make the days ``first..last`` equal to ``df``, days without rows included; others stay."""
        folder = self._staged(df.where(F.col(self.day).between(F.lit(first), F.lit(last))))
        fs, make = _fs(self.spark, self.path)
        fs.mkdirs(make(self.path))
        day = first
        while day <= last:
            name = f"{self.day}={day.isoformat()}"
            _swap(fs, make(f"{folder}/{name}"), make(f"{self.path}/{name}"), make(f"{folder}/_old-{name}"))
            day += dt.timedelta(days=1)
        fs.delete(make(folder), True)
