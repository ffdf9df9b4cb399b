"""Exact top-k inner products by norm-bucketed retrieval.

Candidates are sorted by length and cut into buckets. A first pass compares
every query with the bucket of the longest vectors; the k-th score so found is
a lower bound for the query's result. For every other bucket the bound becomes
a cosine threshold, bound / (query length * longest length in the bucket):
above 1 the bucket is skipped; otherwise the task counts what length pruning
(the prefix of vectors long enough to reach the bound) and coordinate pruning
(vectors whose value at one of the query's largest coordinates is possible at
that cosine) would leave, takes the smaller set, and verifies its products.
Neighbouring buckets form a part, query blocks a group; a part meets a group
only if its longest vector can reach the group's least bound. Such a pair is
one cogroup, so a pair's buckets and queries travel once and no key grows with
the table. It goes through its buckets from the longest vectors down and keeps
the k best of each query, whose least score is the query's bound for the next.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import ship, stored

#: Rows per bucket and per query block; coordinates tried per query.
BUCKET_ROWS, QUERY_ROWS, FOCUS = 4096, 512, 3
#: Buckets of a part, query blocks of a group: what a cogroup holds at once (24 MB at 64 dimensions).
PART_BUCKETS, GROUP_BLOCKS = 8, 16
#: Numbers that the parts of one dimension are dealt over when they are paired with groups.
SPREAD = 16
#: Buckets are numbered by range of lengths and within it.
RANGE = 1_000_000
#: Share of a bucket from which a product of whole blocks is cheaper than picked rows.
DENSE = 0.2
_EXACT = 2.0 ** 53


def _vectors(rows: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """row (a number of its own), vec_id, v (array of integers), norm, dim of usable rows."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    ints = rows.where(F.col(id_col).isNotNull() & x.isNotNull() & finite).select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.transform(x, lambda e: F.floor(e * scale)).alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, e: s + e.cast("double") * e))
    return stored(ints.select("vec_id", "v", norm.alias("norm"), F.size("v").alias("dim"),
                              F.monotonically_increasing_id().alias("row")), "topk-vectors")


def _matrix(values: pa.ChunkedArray | pa.Array, n: int) -> np.ndarray:
    return values.flatten().to_numpy().reshape(n, -1) if n else np.zeros((0, 0), np.int64)


def _ids(rows: np.ndarray, ids: np.ndarray) -> bytes:
    return np.stack([rows, ids], axis=1).astype("<i8").tobytes()


def _buckets(vectors: DataFrame) -> DataFrame:
    """bucket, part, dim, longest, n, ids (two int64 a row: row, vec_id), matrix (int64): rows in falling order of length, stored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        name, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            cuts = np.unique(np.concatenate([np.arange(0, len(dims), BUCKET_ROWS),
                                             np.flatnonzero(np.diff(dims)) + 1, [len(dims)]]))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name * RANGE + number]), pa.array([int(dims[a])], pa.int32()),
                     pa.array([part.column("norm")[0].as_py()]), pa.array([b - a]),
                     pa.array([_ids(part.column("row").to_numpy(), part.column("vec_id").to_numpy())], pa.binary()),
                     pa.array([part.column("v").flatten().to_numpy().astype("<i8").tobytes()], pa.binary())],
                    names=["bucket", "dim", "longest", "n", "ids", "matrix"])
                number += 1

    parts = max(1, -(-vectors.count() // (PART_BUCKETS * BUCKET_ROWS)))
    order = ["dim", F.desc("norm"), "vec_id", "row"]
    ranged = vectors.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("row", "vec_id", "v", "norm", "dim")
    found = stored(ranged.mapInArrow(run, "bucket bigint, dim int, longest double, n bigint, ids binary, matrix binary"),
                   "topk-buckets")
    # neighbouring ranges make up a part where a session has cut more of them than asked for
    ranges = (found.agg(F.max("bucket")).first()[0] or 0) // RANGE + 1
    at, number = F.expr(f"bucket div {RANGE}"), F.col("bucket") % RANGE
    return found.withColumn("part", F.floor(at * min(parts, ranges) / ranges) * RANGE + F.floor(number / PART_BUCKETS))


def _query_blocks(queries: DataFrame, blocks: int) -> DataFrame:
    """q_group, q_dim, q_reach, q_ids, q_bounds, q_matrix of queries (row, vec_id, v, norm, dim, bound), stored; no vector
    shorter than ``q_reach`` reaches a bound."""
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        for at in range(0, len(rows), 2 * QUERY_ROWS):
            part = rows.iloc[at:at + 2 * QUERY_ROWS]
            bound = part["bound"].to_numpy(float)
            out.append({
                "q_group": key[0] // GROUP_BLOCKS, "q_dim": key[1],
                "q_reach": float((bound / np.maximum(part["norm"].to_numpy(), 1e-300)).min()),
                "q_ids": _ids(part["row"].to_numpy(), part["vec_id"].to_numpy()), "q_bounds": bound.astype("<f8").tobytes(),
                "q_matrix": np.stack(part["v"].to_list()).astype("<i8").tobytes()})
        return pd.DataFrame(out)

    block = F.pmod(F.xxhash64("vec_id", "row"), F.lit(blocks)).alias("block")
    found = queries.select("row", "vec_id", "v", "norm", "dim", "bound", block).groupBy("block", "dim").applyInPandas(
        run, "q_group bigint, q_dim int, q_reach double, q_ids binary, q_bounds binary, q_matrix binary")
    return stored(found, "topk-queries")


class Bucket:
    """A bucket with what pruning needs, built on first use."""

    def __init__(self, ids: bytes, matrix: bytes, dim: int):
        self.rows, self.ids = np.frombuffer(ids, "<i8").reshape(-1, 2).T
        self.ints = np.frombuffer(matrix, "<i8").reshape(len(self.ids), dim)
        self.values = self.ints.astype(np.float64)
        self.norms = np.sqrt((self.values ** 2).sum(axis=1))
        self.largest = float(np.abs(self.values).max(initial=0.0))
        self._sorted: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def coordinate(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows in order of their unit vectors' coordinate f, those values)."""
        if f not in self._sorted:
            unit = np.divide(self.values[:, f], self.norms, out=np.zeros(len(self.ids)), where=self.norms > 0)
            order = np.argsort(unit, kind="stable")
            self._sorted[f] = order, unit[order]
        return self._sorted[f]

    def products(self, queries: np.ndarray, rows=slice(None)) -> np.ndarray:
        """Exact integer products of query rows with bucket rows."""
        bound = float(np.abs(queries).max(initial=0)) * self.largest * queries.shape[1]
        if bound < _EXACT:
            return (queries.astype(np.float64) @ self.values[rows].T).astype(np.int64)
        return queries @ self.ints[rows].T  # 64-bit arithmetic


def possible(unit_value: float, cosine: float) -> tuple[float, float]:
    """Range of a unit vector's coordinate, given a query's there and a least cosine between them."""
    at, around = np.arccos(np.clip(unit_value, -1, 1)), np.arccos(np.clip(cosine, -1, 1))
    high = 1.0 if at <= around else np.cos(at - around)
    low = -1.0 if at + around >= np.pi else np.cos(at + around)
    return low - 1e-9, high + 1e-9


def search(bucket: Bucket, ids: np.ndarray, queries: np.ndarray, bounds: np.ndarray, k: int) -> Iterator[tuple]:
    """(query row, vec ids, scores): the bucket's k best of each query (``ids``: its row number) that reach its
    bound, ties to smaller ids; a query's own row is left out."""
    norms = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))
    longest, n = float(bucket.norms.max(initial=0.0)), len(bucket.ids)
    dense, prefix = [], np.zeros(len(ids), int)
    picked: list[tuple[int, np.ndarray]] = []
    for i, (bound, norm) in enumerate(zip(bounds.tolist(), norms.tolist(), strict=True)):
        reach = norm * longest
        if bound > reach * (1 + 1e-12) + 1e-9:
            continue
        if bound <= 0 or reach == 0:
            dense.append(i)
            prefix[i] = n
            continue
        # length pruning: norms fall, so the vectors long enough are a prefix
        prefix[i] = int(np.searchsorted(-bucket.norms, -(bound / norm) * (1 - 1e-12), side="right"))
        cosine = bound / reach * (1 - 1e-12)
        best = None
        for f in np.argsort(-np.abs(queries[i]), kind="stable")[:FOCUS].tolist():
            rows, values = bucket.coordinate(f)
            low, high = possible(queries[i, f] / norm, cosine)
            a, b = np.searchsorted(values, low, "left"), np.searchsorted(values, high, "right")
            if best is None or b - a < best[1] - best[0]:
                best = (a, b, rows)
        if best[1] - best[0] < min(prefix[i], DENSE * n):
            picked.append((i, best[2][best[0]:best[1]]))
        elif prefix[i]:
            dense.append(i)
    if dense:
        rows = slice(0, int(prefix[dense].max()))
        for i, scores in zip(dense, bucket.products(queries[dense], rows), strict=True):
            yield _best(ids[i], bucket.rows[rows], bucket.ids[rows], scores, bounds[i], k)
    for i, rows in picked:
        if len(rows):
            yield _best(ids[i], bucket.rows[rows], bucket.ids[rows], bucket.products(queries[i:i + 1], rows)[0],
                        bounds[i], k)


def _best(query: int, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, bound: float, k: int) -> tuple:
    good = np.flatnonzero((scores >= bound) & (rows != query))
    if len(good) > k:
        least = np.partition(scores[good], len(good) - k)[len(good) - k]
        good = good[scores[good] >= least]
    order = good[np.lexsort((ids[good], -scores[good]))][:k]
    return query, ids[order], scores[order]


class Held:
    """The k best candidates of each query a task has met."""

    def __init__(self, k: int):
        self.k = k
        self.best: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}

    def bound(self, row: int, bound: float) -> float:
        """What a candidate must reach to count: ties with the k-th may still come by a smaller id."""
        found = self.best.get(row)
        return bound if found is None or len(found[1]) < self.k else max(bound, float(found[2][-1]))

    def add(self, row: int, query_id: int, ids: np.ndarray, scores: np.ndarray) -> None:
        if row in self.best:
            _, old_ids, old_scores = self.best[row]
            ids, scores = np.concatenate([old_ids, ids]), np.concatenate([old_scores, scores])
            order = np.lexsort((ids, -scores))[:self.k]
            ids, scores = ids[order], scores[order]
        self.best[row] = query_id, ids, scores

    def rows(self) -> pd.DataFrame:
        sizes = [len(ids) for _, ids, _ in self.best.values()]
        names = np.array([(row, query_id) for row, (query_id, _, _) in self.best.items()], np.int64).reshape(-1, 2)
        join = lambda i: np.concatenate([x[i] for x in self.best.values()] or [np.zeros(0, np.int64)])
        return pd.DataFrame({"query_row": np.repeat(names[:, 0], sizes), "query_id": np.repeat(names[:, 1], sizes),
                             "vec_id": join(1), "score": join(2)})


def _search_pairs(buckets: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """query_row, query_id, vec_id, score, stored: of each part and group that may hold results, at most k rows a query."""
    def run(key: tuple, parts: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
        held, queries = Held(k), []
        for g in groups.itertuples(index=False):
            rows, ids = np.frombuffer(g.q_ids, "<i8").reshape(-1, 2).T
            queries.append((rows, dict(zip(rows.tolist(), ids.tolist(), strict=True)), g.q_reach,
                            np.frombuffer(g.q_bounds, "<f8"), np.frombuffer(g.q_matrix, "<i8").reshape(len(ids), -1)))
        for p in parts.sort_values(["longest", "bucket"], ascending=[False, True]).itertuples(index=False):
            bucket = None
            for rows, names, reach, least, matrix in queries:
                if p.longest * (1 + 1e-9) < reach:
                    continue
                bucket = bucket or Bucket(p.ids, p.matrix, p.dim)
                bounds = np.array([held.bound(r, b) for r, b in zip(rows.tolist(), least.tolist(), strict=True)])
                for q, found, scores in search(bucket, rows, matrix, bounds, k):
                    if len(found):
                        held.add(int(q), names[int(q)], found, scores)
        return held.rows()

    spread = F.pmod(F.xxhash64("part"), F.lit(SPREAD))
    parts = buckets.groupBy("part", "dim").agg(F.max("longest").alias("longest")).withColumn("spread", spread)
    groups = blocks.groupBy("q_group", "q_dim").agg(F.min("q_reach").alias("q_reach")).withColumn(
        "q_spread", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    pairs = stored(parts.join(groups, (F.col("dim") == F.col("q_dim")) & (F.col("spread") == F.col("q_spread")) &
                              (F.col("longest") * (1 + 1e-9) >= F.col("q_reach"))).select(
        F.col("part").alias("a"), F.col("dim").alias("d"), F.col("q_group").alias("g")), "topk-pairs")
    left = buckets.join(pairs, (F.col("part") == F.col("a")) & (F.col("dim") == F.col("d"))).select(
        "a", "d", "g", "bucket", "dim", "longest", "ids", "matrix")
    right = blocks.join(pairs, (F.col("q_group") == F.col("g")) & (F.col("q_dim") == F.col("d"))).select(
        F.col("a").alias("q_a"), F.col("d").alias("q_d"), F.col("g").alias("q_g"), "q_reach", "q_ids", "q_bounds",
        "q_matrix")
    return stored(left.groupBy("a", "d", "g").cogroup(right.groupBy("q_a", "q_d", "q_g")).applyInPandas(
        run, "query_row bigint, query_id bigint, vec_id bigint, score bigint"), "topk-found")


def top_k(rows: DataFrame, is_query: Column, k: int = 20, scale: int = 64, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of each query with all other rows.

    Components count as floor(scale * x). Ties go to the smaller id; with
    fewer than k other rows all are returned. Rows with a NULL id, a NULL
    vector or a NULL or non-finite component take no part; rows that repeat an
    id are candidates, and queries, of their own: only a query's own row is left
    out; vectors of different dimension are never compared. Ties, also of rows
    with one id, are cut at k. ``is_query`` is a condition on ``vec_id``. An
    empty table gives no rows.
    """
    ship(rows.sparkSession)
    vectors = _vectors(rows, id_col, vector_col, scale)
    buckets = _buckets(vectors)
    queries = vectors.where(is_query)
    blocks = max(1, -(-queries.count() // QUERY_ROWS))

    longest = Window.partitionBy("dim").orderBy(F.desc("longest"), "bucket")
    first = stored(buckets.select("dim", "longest", "bucket").withColumn("at", F.row_number().over(longest))
                   .where("at = 1").select(F.col("bucket").alias("first")), "topk-first")
    start = _query_blocks(queries.withColumn("bound", F.lit(float("-inf"))), blocks)
    head = buckets.join(first, F.col("bucket") == F.col("first"), "left_semi")
    seeds = _search_pairs(head, start, k)

    bounds = seeds.groupBy("query_row").agg(F.count("*").alias("found"), F.min("score").alias("least"))
    bounded = queries.join(bounds, F.col("row") == F.col("query_row"), "left").withColumn(
        "bound", F.when(F.col("found") >= k, F.col("least").cast("double")).otherwise(F.lit(float("-inf"))))
    later = _query_blocks(bounded, blocks)
    other = buckets.join(first, F.col("bucket") == F.col("first"), "left_anti")
    found = seeds.unionByName(_search_pairs(other, later, k))
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
