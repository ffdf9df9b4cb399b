"""Run journal.

The source system inserts a row when a step starts and updates it when the
step ends. Here the journal is append-only: every start and every end is an
event row (log_id, kind, event_time, status) and the state of a run is a
fold of its events. Appends never conflict, a re-run adds events instead of
overwriting, and the "finished" event is written only after the work
succeeded (a failure writes a failed status).
"""

from __future__ import annotations

import datetime as dt
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.sources.files import list_folder

EVENT_SCHEMA = T.StructType([
    T.StructField("log_id", T.StringType(), False),
    T.StructField("kind", T.StringType(), False),
    T.StructField("event_time", T.TimestampNTZType(), False),
    T.StructField("status", T.StringType(), False),
])


def run_state(events: DataFrame) -> DataFrame:
    """log_id, start_time, end_time, status: one row per run.

    start_time is the earliest start event, end_time the latest end event
    (NULL while running), status the status of the latest event; at equal
    times an end event wins over a start event. All three are map-side
    combinable, so a run with very many events is no hot spot.
    """
    is_end = F.col("kind") == "end"
    return events.groupBy("log_id").agg(
        F.min(F.when(~is_end, F.col("event_time"))).alias("start_time"),
        F.max(F.when(is_end, F.col("event_time"))).alias("end_time"),
        F.max_by("status", F.struct("event_time", is_end.cast("int"))).alias("status"))


#: Folded runs kept beside the events.
STATE_SCHEMA = T.StructType([
    T.StructField("log_id", T.StringType(), False),
    T.StructField("start_time", T.TimestampNTZType(), True),
    T.StructField("end_time", T.TimestampNTZType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("last_time", T.TimestampNTZType(), True),
    T.StructField("last_is_end", T.IntegerType(), True),
])


def _as_state(events: DataFrame) -> DataFrame:
    """Each event as a state of its run."""
    is_end = F.col("kind") == "end"
    return events.select(
        "log_id", F.when(~is_end, F.col("event_time")).alias("start_time"),
        F.when(is_end, F.col("event_time")).alias("end_time"), "status", F.col("event_time").alias("last_time"),
        is_end.cast("int").alias("last_is_end"))


def merge_states(states: DataFrame) -> DataFrame:
    """One state per run out of several; the same rules as :func:`run_state`, so states and events mix."""
    latest = F.struct("last_time", "last_is_end")
    return states.groupBy("log_id").agg(
        F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"),
        F.max_by("status", latest).alias("status"), F.max(latest).alias("_l")).select(
        "log_id", "start_time", "end_time", "status", F.col("_l.last_time").alias("last_time"),
        F.col("_l.last_is_end").alias("last_is_end"))


class RunJournal:
    """Append-only journal stored as a parquet table at ``path``.

    ``compact`` folds events into one state per run, beside the events; readers
    merge the last fold with the events it does not hold. The fold is sorted by
    key and its files carry a bloom filter on it, so looking up a run skips
    row groups. Times are UTC, so events of hosts in several zones are in order.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self._folds = f"{self.path}_state"

    def _append(self, log_id: str, kind: str, status: str) -> None:
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        row = [(log_id, kind, now, status)]
        self.add(self.spark.createDataFrame(row, EVENT_SCHEMA).coalesce(1))

    def add(self, events: DataFrame) -> None:
        """Append events (log_id, kind, event_time, status)."""
        events.select(*[F.col(f.name).cast(f.dataType) for f in EVENT_SCHEMA]).write.mode("append").parquet(self.path)

    def start(self, status: str) -> str:
        log_id = uuid.uuid4().hex
        self._append(log_id, "start", status)
        return log_id

    def end(self, log_id: str, status: str) -> None:
        self._append(log_id, "end", status)

    @contextmanager
    def step(self, start_status: str, end_status: str):
        log_id = self.start(start_status)
        try:
            yield log_id
        except BaseException:
            self.end(log_id, f"Failed_{start_status}")
            raise
        self.end(log_id, end_status)

    def _fold(self) -> tuple[int, str | None, set[str]]:
        """(number, folder, event files it holds) of the last whole fold."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self._folds)
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        done = [st.getPath() for st in (fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{self._folds}/fold=*/state/_SUCCESS")) or [])]
        numbers = sorted(int(p.getParent().getParent().getName().split("=")[1]) for p in done)
        if not numbers:
            return 0, None, set()
        folder = f"{self._folds}/fold={numbers[-1]}"
        held = {r["file"] for r in self.spark.read.schema("file string").parquet(f"{folder}/files").collect()}
        return numbers[-1], folder, held  # a row per file, as in a listing

    def _event_files(self) -> list[str]:
        return [f for f in list_folder(self.spark, self.path) if f.endswith(".parquet")]

    def _states(self, keys: list[str] | None = None) -> DataFrame:
        """States of the last fold and of the events it does not hold, of some keys or all."""
        only = (lambda df: df) if keys is None else (lambda df: df.where(F.col("log_id").isin(keys)))
        _, folder, held = self._fold()
        open_ = [f"{self.path}/{f}" for f in self._event_files() if f not in held]
        parts = [only(self.spark.read.schema(STATE_SCHEMA).parquet(f"{folder}/state"))] if folder else []
        if open_:
            parts.append(_as_state(only(self.spark.read.schema(EVENT_SCHEMA).parquet(*open_))))
        if not parts:
            return self.spark.createDataFrame([], STATE_SCHEMA)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def compact(self, row_group_bytes: int = 1 << 20) -> None:
        """Fold all events there are now into a new state table, then remove what it holds.

        The fold counts once its state is whole (its ``_SUCCESS`` stands); until
        then readers use the last one and all events. Events written meanwhile
        stay events. Left-over event files of a broken-off removal are known to
        the fold and not counted again. One compaction runs at a time.
        """
        number, old, held = self._fold()
        files = self._event_files()
        folder = f"{self._folds}/fold={number + 1}"
        self.spark.createDataFrame([(f,) for f in sorted(set(files) | held)], "file string").coalesce(1).write.mode(
            "overwrite").parquet(f"{folder}/files")
        merged = merge_states(self._states())
        (merged.repartitionByRange("log_id").sortWithinPartitions("log_id").write.mode("overwrite")
         .option("parquet.bloom.filter.enabled#log_id", "true").option("parquet.block.size", row_group_bytes)
         .parquet(f"{folder}/state"))
        jvm = self.spark.sparkContext._jvm
        make = jvm.org.apache.hadoop.fs.Path
        fs = make(self.path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        for f in files:
            fs.delete(make(f"{self.path}/{f}"), False)
        if old:
            fs.delete(make(old), True)

    def events(self) -> DataFrame:
        """The events not folded yet."""
        _, _, held = self._fold()
        open_ = [f"{self.path}/{f}" for f in self._event_files() if f not in held]
        return self.spark.read.schema(EVENT_SCHEMA).parquet(*open_) if open_ else self.spark.createDataFrame([], EVENT_SCHEMA)

    def state(self) -> DataFrame:
        return merge_states(self._states()).select("log_id", "start_time", "end_time", "status")

    def run(self, log_id: str) -> DataFrame:
        """State of one run: the key filter is applied before the fold, and
        reaches the parquet scans as a pushed filter."""
        return self.runs([log_id])

    def runs(self, log_ids: list[str]) -> DataFrame:
        """States of the runs with these keys; unknown keys have no row."""
        return merge_states(self._states(list(log_ids))).select("log_id", "start_time", "end_time", "status")
