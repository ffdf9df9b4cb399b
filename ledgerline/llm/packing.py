"""Harmonic packing of tokenised documents into sequences of fixed capacity.

A document's ids are cut into slots that are exact reciprocal fractions of the
capacity C (C, C/2, C/4, ... down to ``least_slot``) and a tail shorter than
the least slot. A piece of length n belongs to class k = floor(C / n), and a
bin of class k holds k pieces whatever their order, so classes are filled
without looking at any other piece: a piece's place follows from its number
within its class. Numbers are given by each worker on its own and shifted by a
prefix sum over the (worker, class) counts, the only thing that meets.
Cutting is deterministic; full slots waste nothing, tails at most 1/k of a bin.
A class's last, incomplete bin is split into power-of-two sequences where its
pieces allow that (they do for all but the tails).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import ship, stored
from ledgerline.llm.tokens import Encoder

_PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    T.StructField("doc_tokens", T.LongType()), T.StructField("worker", T.LongType()),
    T.StructField("number", T.LongType()),
])


def cut(tokens: int, capacity: int, least_slot: int) -> list[int]:
    """Piece lengths of a document, in order: whole sequences, halving slots, a tail."""
    out, rest = [capacity] * (tokens // capacity), tokens % capacity
    slot = capacity // 2
    while slot >= least_slot:
        if rest & slot:
            out.append(slot)
            rest -= slot
        slot //= 2
    return out + [rest] if rest else out


def _pieces(vocabulary: str, capacity: int, least_slot: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, numbers = Encoder.of(vocabulary), {}
        for batch in batches:
            workers = batch.column("worker")
            if not len(workers):
                continue
            worker = workers[0].as_py()
            rows: list[tuple] = []
            keys = batch.column("doc_id").to_pylist()
            for key, ids in zip(keys, encoder.encode(batch.column("text")), strict=True):
                ids = np.append(ids, np.uint16(end_id)).astype("<u4")
                at = 0
                for n in cut(len(ids), capacity, least_slot):
                    numbers[n] = number = numbers.get(n, -1) + 1
                    rows.append((key, at, n, zlib.crc32(ids[at:at + n].tobytes()), len(ids), worker, number))
                    at += n
                if len(rows) > 50_000:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)
    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(column, pa.int64()) for column in zip(*rows, strict=True)], names=_PIECES.names)


def pack(docs: DataFrame, vocabulary: str, capacity: int = 1024, least_slot: int = 16, end_id: int = 0,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, pack_class.

    Every row of ``docs`` is a document of its own, repeated ids included (a
    mixture repeats documents on purpose). NULL text counts as empty and gives
    one piece of one id, the end; a NULL id stays NULL; an empty table gives no
    piece. ``sequence_id`` holds the piece length in its low digits, so bins of
    different lengths never share one. Offsets in a sequence are gapless from
    0. ``capacity`` and ``least_slot`` must be powers of two.
    """
    if capacity & (capacity - 1) or least_slot & (least_slot - 1) or not 0 < least_slot <= capacity:
        raise ValueError("capacity and least_slot must be powers of two")
    ship(docs.sparkSession)
    pieces = stored(docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.spark_partition_id().cast("bigint").alias("worker"),
    ).mapInArrow(_pieces(vocabulary, capacity, least_slot, end_id), _PIECES), "pack-pieces")

    # pieces are numbered per length: below the least slot as many lengths as classes, above it the halving slots
    counts = pieces.groupBy("worker", "length").agg(F.max("number").alias("last"))
    by_class = Window.partitionBy("length")
    before = F.sum(F.col("last") + 1).over(by_class.orderBy("worker").rowsBetween(Window.unboundedPreceding, -1))
    shifts = stored(counts.select(
        F.col("worker").alias("s_worker"), F.col("length").alias("s_length"),
        F.coalesce(before, F.lit(0)).alias("shift"), F.sum(F.col("last") + 1).over(by_class).alias("in_class")),
        "pack-shifts")
    placed = pieces.join(shifts, (F.col("worker") == F.col("s_worker")) & (F.col("length") == F.col("s_length")))
    placed = placed.selectExpr(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "in_class", f"{capacity} div length AS k",
        "shift + number AS index").selectExpr("*", "index div k AS bin", "index % k AS slot")
    # the last bin of a class of an exact fraction: its pieces form sequences of 2^b pieces, by the digits of their number
    left = F.col("in_class") - F.col("bin") * F.col("k")
    whole = F.struct(F.lit(0).cast("bigint").alias("part"), F.col("slot").alias("at"))
    halves = (F.lit(capacity) % F.col("length") == 0) & (left < F.col("k"))
    placed = placed.withColumn("inside", F.when(halves, _split_slot("slot", left, capacity)).otherwise(whole))
    digits = 2 * capacity
    number = (F.col("bin") * digits + F.col("inside.part")) * digits + F.col("length")
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", number.alias("sequence_id"),
                         (F.col("inside.at") * F.col("length")).alias("offset"), F.col("k").alias("pack_class"))


def _split_slot(slot: str, left, capacity: int):
    """For ``left`` pieces: which power-of-two run of them holds this slot, and its place there."""
    result = F.struct(F.lit(0).cast("bigint").alias("part"), F.col(slot).alias("at"))
    size = 1
    while size < capacity:  # runs in falling order of size: the run of 2^b starts after all larger ones
        lower = left - left % (2 * size)
        holds = (left.bitwiseAND(F.lit(size)) > 0) & (F.col(slot) >= lower) & (F.col(slot) < lower + size)
        result = F.when(holds, F.struct(F.lit(size).cast("bigint").alias("part"),
                                        (F.col(slot) - lower).alias("at"))).otherwise(result)
        size *= 2
    return result
