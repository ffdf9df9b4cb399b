"""Publishing a run as a whole.

A run writes its tables into a folder of its own and changes nothing readers
see. At the end one small file, the manifest of the next version, is moved
into place; it names, for every table, the folders that make it up. Readers
take the last manifest. So a run that breaks off anywhere leaves the whole old
state, and its folders are never looked at.

Versions are numbered. A run notes the last number when it begins and may only
publish the next one; if another run has published meanwhile, it is refused
and nothing it wrote counts. The move never replaces a file: on HDFS and
object stores that rename without overwriting it is atomic, so one of two runs
at the same moment fails.

Versions are kept until ``expire`` removes old ones, with the folders no kept
version names.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerline.sources.sinks import _fs

RUNS = "_runs"
#: A folder that no version names may belong to a run that is not done; after this long it counts as broken off.
LONGEST_RUN = dt.timedelta(days=2)


class PublishRefused(RuntimeError):
    """Another run published a version since this one began."""


class Releases:
    """The published versions of a warehouse."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._pointers = f"{self.root}/_published"

    def numbers(self) -> list[int]:
        fs, make = _fs(self.spark, self.root)
        found = fs.globStatus(make(f"{self._pointers}/[0-9]*")) or []
        return sorted(int(st.getPath().getName()) for st in found)

    def manifest(self, number: int) -> dict[str, dict[str, str]]:
        """Table -> (partition folder, '' for a table without -> folder of the run that wrote it), of a version."""
        if not number:
            return {}
        fs, make = _fs(self.spark, self.root)
        stream = fs.open(make(self._name(number)))
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _name(self, number: int) -> str:
        return f"{self._pointers}/{number:012d}"

    def last(self) -> tuple[int, dict[str, dict[str, str]]]:
        number = max(self.numbers(), default=0)
        return number, self.manifest(number)

    def publish(self, number: int, manifest: dict[str, dict[str, str]]) -> None:
        """Make ``manifest`` version ``number``; refused if that version exists."""
        fs, make = _fs(self.spark, self.root)
        jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
        fresh = make(f"{self._pointers}/_new-{uuid.uuid4().hex}")
        out = fs.create(fresh, False)
        out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        out.close()
        target = make(self._name(number))
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        keep = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)  # no overwriting
        try:
            context.rename(fs.makeQualified(fresh), fs.makeQualified(target), keep)
        except Exception as e:
            fs.delete(fresh, False)
            if fs.exists(target):
                raise PublishRefused(f"version {number} was published by another run") from e
            raise

    def expire(self, keep: int = 3, longest_run: dt.timedelta = LONGEST_RUN) -> tuple[list[int], list[str]]:
        """Remove all but the last ``keep`` versions and the folders none of them names: (versions, folders) removed.

        A folder goes only if nothing was written to it for ``longest_run``, so
        runs that are not yet published keep theirs, and those of runs that
        broke off go in time. Manifests go first: broken off anywhere, no
        version is left whose folders are gone, and the next call removes the
        rest. Readers of a removed version fail; the last version always stays.
        """
        if keep < 1:
            raise ValueError("the last version stays")
        numbers = self.numbers()
        old, kept = numbers[:-keep], numbers[-keep:]
        named = {run for n in kept for parts in self.manifest(n).values() for run in parts.values()}
        fs, make = _fs(self.spark, self.root)
        for number in old:
            fs.delete(make(self._name(number)), False)
        removed, limit = [], (dt.datetime.now(dt.UTC) - longest_run).timestamp() * 1000
        for folder in fs.globStatus(make(f"{self.root}/{RUNS}/*")) or []:
            name = f"{RUNS}/{folder.getPath().getName()}"
            # a run's second level (layer/table) is written anew with every table
            times = [st.getModificationTime() for st in fs.globStatus(make(f"{self.root}/{name}/*/*")) or []]
            if name not in named and max([folder.getModificationTime(), *times]) <= limit:
                fs.delete(folder.getPath(), True)
                removed.append(name)
        return old, sorted(removed)


class Release:
    """The tables as one run sees them: the version it began with, and over it what it has written itself."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.releases = spark, Releases(spark, root)
        self.number, self.tables = self.releases.last()
        self.run = f"{RUNS}/{uuid.uuid4().hex}"

    def _folder(self, run: str, name: str) -> str:
        return f"{self.releases.root}/{run}/{name}"

    def has(self, name: str) -> bool:
        return name in self.tables

    def write(self, df: DataFrame, name: str) -> None:
        """Replace a whole table."""
        df.write.mode("overwrite").parquet(self._folder(self.run, name))
        self.tables[name] = {"": self.run}

    def write_parts(self, df: DataFrame, name: str, columns: list[str], drop: Callable[[str], bool]) -> None:
        """Replace the partitions of a table for whose folder name ``drop`` holds, and those ``df`` has rows of.

        Each write of a run has a folder of its own, so a second one of the same table does not touch the first.
        """
        run = f"{self.run}-{uuid.uuid4().hex[:8]}"
        path = self._folder(run, name)
        df.sortWithinPartitions(*columns).write.partitionBy(*columns).parquet(path)
        fs, make = _fs(self.spark, path)
        found = fs.globStatus(make("/".join([path, *[f"{c}=*" for c in columns]]))) or []
        parts = ["/".join(st.getPath().toUri().getPath().split("/")[-len(columns):]) for st in found]
        kept = {p: r for p, r in self.tables.get(name, {}).items() if not drop(p)}
        self.tables[name] = kept | {p: run for p in parts}

    def read(self, name: str, schema: T.StructType | str | None = None) -> DataFrame:
        """The table; the schema is needed where a partition column's type is not the one its folders suggest,
        and for a table that may have no partition left."""
        by_run: dict[str, list[str]] = {}
        for part, run in self.tables[name].items():
            by_run.setdefault(run, []).append(part)
        frames = []
        for run, parts in by_run.items():
            reader, path = self.spark.read, self._folder(run, name)
            reader = reader.schema(schema) if schema else reader
            frames.append(reader.parquet(path) if parts == [""] else reader.option("basePath", path).parquet(
                *[f"{path}/{p}" for p in sorted(parts)]))
        if not frames:
            return self.spark.createDataFrame([], schema)
        return reduce(DataFrame.unionByName, frames)

    def publish(self) -> int:
        """Make what this run sees the next version; its number."""
        self.releases.publish(self.number + 1, self.tables)
        self.number += 1
        return self.number
