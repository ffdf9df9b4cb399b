"""Daily turnover kept up to date by a stream of postings (A3).

Each micro-batch is summed per (day, account) and written to the folders of
its months, under its batch number (a folder per day would hold a few rows of
a batch). The sums of all batches are the turnover.
The batch number makes a batch's write repeatable: a batch that broke off
half-way is run again on the same files by the stream's checkpoint and
replaces its own folders, those written and those not. Turnover is a sum, so
no state has to be held, a posting may be late by any time, and none is
dropped behind a watermark. ``compact`` folds the batches of quiet months.
"""

from __future__ import annotations

import datetime as dt
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators.conform import accept, reject
from ledgerline.operators.turnover import daily_turnover
from ledgerline.sources.sinks import _fs
from ledgerline.sources.specs import POSTING, TableSpec

MONEY = "decimal(38,8)"
#: ``upto`` of a batch's own sums; a folded file holds all batches up to its number.
OWN = -1
_SCHEMA = (f"on_date date, account_rk bigint, credit_amount {MONEY}, debet_amount {MONEY}, month date, batch bigint, "
           "upto bigint")


def _write(sums: DataFrame, mart: str, batch: int, upto: int) -> None:
    """Sums (on_date, account_rk, amounts) to the folders month / batch / upto, each folder replaced as a whole.

    Rebalanced by month: few files a folder, and a month too large for one task is split.
    """
    rows = sums.select(
        "on_date", "account_rk", F.col("credit_amount").cast(MONEY).alias("credit_amount"),
        F.col("debet_amount").cast(MONEY).alias("debet_amount"), F.trunc("on_date", "MM").alias("month"),
        F.lit(batch).cast("bigint").alias("batch"), F.lit(upto).cast("bigint").alias("upto"))
    (rows.hint("rebalance", "month").sortWithinPartitions("month", "on_date").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("month", "batch", "upto").parquet(mart))


def write_batch(postings: DataFrame, mart: str, batch: int) -> None:
    """The turnover of one micro-batch, in the folders of its months; repeating it replaces them."""
    _write(daily_turnover(postings), mart, batch, OWN)


def folders(spark: SparkSession, mart: str) -> list[tuple[dt.date, int, int]]:
    """(month, batch, upto) of every folder: a listing, no data is read."""
    fs, make = _fs(spark, mart)
    found = fs.globStatus(make(f"{mart.rstrip('/')}/month=*/batch=*/upto=*")) or []
    parts = [[x.split("=", 1)[1] for x in st.getPath().toUri().getPath().split("/")[-3:]] for st in found]
    return sorted((dt.date.fromisoformat(d), int(b), int(u)) for d, b, u in parts)


def live_folders(found: list[tuple[dt.date, int, int]]) -> list[tuple[dt.date, int, int]]:
    """The folders that count: of each month the last fold, and the batches behind it."""
    last: dict[dt.date, int] = {}
    for month, _, upto in found:
        last[month] = max(upto, last.get(month, OWN))
    return [(m, b, u) for m, b, u in found if (u == last[m] if u != OWN else b > last[m])]


def _path(mart: str, month: dt.date, batch: int, upto: int) -> str:
    return f"{mart.rstrip('/')}/month={month.isoformat()}/batch={batch}/upto={upto}"


def _read(spark: SparkSession, mart: str, some: list[tuple[dt.date, int, int]]) -> DataFrame:
    if not some:
        return spark.createDataFrame([], _SCHEMA)
    return spark.read.schema(_SCHEMA).option("basePath", mart).parquet(*[_path(mart, *x) for x in some])


def _summed(sums: DataFrame) -> DataFrame:
    """Sums of several folders, added up.

    Brought together by key first: each folder has a (day, account) once, so
    sums inside the tasks before the shuffle would merge next to nothing, and
    no key has more rows than its month has folders.
    """
    return sums.repartition("on_date", "account_rk").groupBy("on_date", "account_rk").agg(
        F.sum("credit_amount").alias("credit_amount"), F.sum("debet_amount").alias("debet_amount"))


def read_turnover(spark: SparkSession, mart: str) -> DataFrame:
    """on_date, account_rk, credit_amount, debet_amount: the turnover of all postings taken so far."""
    return _summed(_read(spark, mart, live_folders(folders(spark, mart))))


def compact(spark: SparkSession, mart: str, upto: int, before: dt.date) -> None:
    """Fold all batches up to number ``upto`` of the months that ended before ``before``.

    Readers count a fold instead of the batches it holds from the moment its
    folder stands; what it replaces is removed after that, and left-overs of a
    run that broke off in between do not count.
    """
    quiet = lambda month: (month + dt.timedelta(days=31)).replace(day=1) <= before
    live = [x for x in live_folders(folders(spark, mart)) if quiet(x[0]) and x[1] <= upto]
    several = {m for m, n in Counter(m for m, _, _ in live).items() if n > 1}  # one folder is folded as it is
    taken = [x for x in live if x[0] in several]
    _write(_summed(_read(spark, mart, taken)), mart, upto, upto)
    found = folders(spark, mart)
    counting = set(live_folders(found))
    fs, make = _fs(spark, mart)
    for folder in found:
        if quiet(folder[0]) and folder not in counting:
            fs.delete(make(_path(mart, *folder)), True)


def stream_turnover(spark: SparkSession, landing: str, mart: str, checkpoint: str, rejects: str | None = None,
                    spec: TableSpec = POSTING, max_files_per_trigger: int | None = None,
                    available_now: bool = True) -> StreamingQuery:
    """Start the stream: new posting files of ``landing`` go into the turnover at ``mart``, each exactly once.

    Rejected rows go to ``rejects``, under their batch number.
    """
    from ledgerline.streaming.landing import _stream

    def take(batch: DataFrame, number: int) -> None:
        write_batch(accept(batch, spec), mart, number)
        if rejects:
            reject(batch).write.mode("overwrite").parquet(f"{rejects}/batch={number}")

    writer = _stream(spark, spec, landing, max_files_per_trigger).writeStream.foreachBatch(take).option(
        "checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": "1 minute"}
    return writer.trigger(**trigger).start()
