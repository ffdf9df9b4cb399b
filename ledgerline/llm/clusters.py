"""Centroid clustering by progressive search over Walsh-Hadamard coefficients.

Vectors and centroids of integers are transformed by the unnormalised
Walsh-Hadamard transform, in exact integer arithmetic. The transform keeps
squared distances up to the factor ``dim``, and its coefficients, in order of
their number of sign changes, go from coarse to fine. The differences to all
centroids are summed over the coarsest coefficients first; the centroid that is
then nearest is carried to the end and its distance is a bound. A centroid
whose running sum passes the bound is strictly worse and goes; the others take
the next coefficients, and those that are left finish all of them. Sums only
grow, so nothing that could be nearest, ties included, is ever dropped.

A round is one scan: every task emits count and coefficient sums of its rows
per centroid, Spark adds them up, and the driver sees a centroid's sums only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import ship, stored

#: Coefficients summed when centroids are dropped; a last stage takes all.
STAGES = (4, 8, 16, 32)
#: Vectors worked on at a time.
STEP_ROWS = 4096
#: Coefficients below this keep 64-bit sums exact; larger ones are summed as Python integers.
_SAFE = 2 ** 27
#: Largest scaled component: squared distances of 64 of them fit a long.
LARGEST = 2 ** 27


def transform(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of the last axis (a power of two), coefficients from coarse to fine."""
    out, size, half = x.copy(), x.shape[-1], 1
    while half < size:
        pairs = out.reshape(*x.shape[:-1], size // (2 * half), 2, half)
        a, b = pairs[..., 0, :] + pairs[..., 1, :], pairs[..., 0, :] - pairs[..., 1, :]
        out = np.stack([a, b], axis=-2).reshape(x.shape)
        half *= 2
    return out[..., coarse_to_fine(size)]


def inverse(coefficients: list[int]) -> list[int]:
    """The exact integers whose transform this is."""
    size = len(coefficients)
    natural = np.empty(size, object)
    natural[coarse_to_fine(size)] = coefficients
    half = 1
    while half < size:
        pairs = natural.reshape(size // (2 * half), 2, half)
        natural = np.stack([pairs[:, 0] + pairs[:, 1], pairs[:, 0] - pairs[:, 1]], axis=1).reshape(size)
        half *= 2
    return [int(x) // size for x in natural]


def coarse_to_fine(size: int) -> np.ndarray:
    """Places of the transform's natural order, by number of sign changes: a place's number of
    sign changes is the Gray decoding of its reversed bits."""
    bits = size.bit_length() - 1
    changes = []
    for i in range(size):
        code = int(f"{i:0{bits}b}"[::-1], 2) if bits else 0
        rank = 0
        while code:
            rank, code = rank ^ code, code >> 1
        changes.append(rank)
    return np.argsort(changes)


def nearest(rows: np.ndarray, centroids: np.ndarray, stages: tuple[int, ...] = STAGES) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance times dim) of each row's nearest centroid, ties to the smaller number.

    Both sides are coefficients from coarse to fine.
    """
    n, size = rows.shape
    cuts = [0, *[s for s in stages if s < size], size]
    head = rows[:, None, :cuts[1]] - centroids[None, :, :cuts[1]]
    sums = (head * head).sum(axis=2)
    guess = sums.argmin(axis=1)
    rest = rows - centroids[guess]
    bound = (rest * rest).sum(axis=1)
    row, centroid = np.nonzero(sums <= bound[:, None])
    sums = sums[row, centroid]
    for a, b in zip(cuts[1:-1], cuts[2:], strict=True):
        more = rows[row, a:b] - centroids[centroid, a:b]
        sums = sums + (more * more).sum(axis=1)
        alive = sums <= bound[row]
        row, centroid, sums = row[alive], centroid[alive], sums[alive]
    # rows in order; of a row, the least distance first, then the smaller number
    order = np.lexsort((centroid, sums, row)) if sums.dtype != object else np.array(
        sorted(range(len(row)), key=lambda i: (row[i], sums[i], centroid[i])), int)
    first = order[np.unique(row[order], return_index=True)[1]]
    return centroid[first], sums[first]


def _whole(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, size)


def _exact(rows: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both sides, as Python integers if 64 bits might not do."""
    most = max(int(np.abs(rows).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    return (rows, centroids) if most < _SAFE else (rows.astype(object), centroids.astype(object))


def _vectors(rows: DataFrame, id_col: str, vector_col: str, scale: int, dim: int) -> DataFrame:
    """vec_id, seed (lowercase hex SHA-256 of ``1:<vec_id>``), c (coefficients of the scaled integers), stored."""
    x = F.col(vector_col).cast("array<double>")
    usable = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    fits = lambda e: F.when(F.abs(e * scale) < LARGEST, F.floor(e * scale)).otherwise(
        F.raise_error(F.lit(f"a scaled component beyond {LARGEST}: squared distances would not fit a long")).cast("bigint"))
    ints = rows.where(x.isNotNull() & (F.size(x) == dim) & usable).select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.transform(x, fits).alias("v"))
    size = 1 << max(0, dim - 1).bit_length()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = np.zeros((batch.num_rows, size), np.int64)
            v[:, :dim] = _whole(batch.column("v"), dim)
            c = transform(v)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(c) + 1) * size, pa.int32()), pa.array(c.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("seed"), lists],
                                             names=["vec_id", "seed", "c"])

    seed = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    return stored(ints.select("vec_id", seed.alias("seed"), "v").mapInArrow(
        run, "vec_id bigint, seed string, c array<bigint>"), "cluster-vectors")


def _assigned(vectors: DataFrame, centroids: np.ndarray, size: int, dim: int) -> DataFrame:
    """vec_id, cluster, distance of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, STEP_ROWS):
                part = batch.slice(at, STEP_ROWS)
                cluster, distance = nearest(*_exact(_whole(part.column("c"), size), centroids))
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), pa.array(cluster, pa.int32()),
                     pa.array([int(d) // size for d in distance], pa.int64())], names=["vec_id", "cluster", "distance"])

    return vectors.select("vec_id", "c").mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


def _sums(vectors: DataFrame, centroids: np.ndarray, size: int) -> dict[int, tuple[int, list[int]]]:
    """Count and coefficient sums of each non-empty cluster: at most a number per centroid and coefficient."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), size + 1), object)
        for batch in batches:
            for at in range(0, batch.num_rows, STEP_ROWS):
                rows = _whole(batch.slice(at, STEP_ROWS).column("c"), size)
                cluster, _ = nearest(*_exact(rows, centroids))
                counts += np.bincount(cluster, minlength=len(centroids))
                for k in np.unique(cluster).tolist():
                    sums[k, :size] += rows[cluster == k].sum(axis=0)
        found = np.flatnonzero(counts)
        for k in found.tolist():
            values = [int(counts[k]), *map(int, sums[k, :size])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k] * (size + 1), pa.int32()), pa.array(range(size + 1), pa.int32()), pa.array(values, pa.int64())],
                names=["cluster", "at", "value"])

    parts = vectors.select("c").mapInArrow(run, "cluster int, at int, value bigint")
    total = parts.groupBy("cluster", "at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    out: dict[int, list[int]] = {}
    for r in total.collect():
        out.setdefault(r["cluster"], [0] * (size + 1))[r["at"]] = int(r["value"])
    return {k: (v[0], v[1:]) for k, v in out.items()}


def cluster(rows: DataFrame, centroids: int = 16, rounds: int = 3, scale: int = 64, dim: int = 64,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256: a row per usable vector.

    Usable: exactly ``dim`` components, none NULL or non-finite; each counts as
    floor(scale * x). The first centroids are the vectors with the smallest
    SHA-256 of ``1:<vec_id>`` (repeated ids: the smaller vector of coefficients
    first; a NULL id last), as many as there are if fewer than ``centroids``. A
    round moves every non-empty centroid to its vectors' componentwise floor
    of the mean. Repeated rows are vectors of their own; an empty table, or
    one without usable vectors, gives no rows. Scaled components from 2^27 on
    are an error: their squared distances do not fit a long.
    """
    ship(rows.sparkSession)
    vectors = _vectors(rows, id_col, vector_col, scale, dim)
    size = 1 << max(0, dim - 1).bit_length()
    first = vectors.orderBy(F.col("seed").asc_nulls_last(), "c").limit(centroids).select("c").collect()
    points = [inverse(list(r["c"])) for r in first]

    def coefficients() -> np.ndarray:
        return transform(np.array(points, np.int64).reshape(len(points), size))

    for _ in range(rounds if points else 0):
        for k, (n, sums) in _sums(vectors, coefficients(), size).items():
            points[k] = [s // n for s in inverse(sums)]
    schema = "vec_id bigint, cluster int, distance bigint"
    spark = rows.sparkSession
    placed = stored(_assigned(vectors, coefficients(), size, dim) if points else spark.createDataFrame([], schema),
                    "cluster-placed")
    totals = {r["cluster"]: int(r["d"]) for r in placed.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}  # a number per centroid
    inertia = sum(totals.values())
    digests = [(k, totals.get(k, 0), inertia, hashlib.sha256(",".join(map(str, p[:dim])).encode()).hexdigest())
               for k, p in enumerate(points)]
    known = spark.createDataFrame(digests, "c_cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return placed.join(F.broadcast(known), F.col("cluster") == F.col("c_cluster")).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
