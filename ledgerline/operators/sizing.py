"""Joins of facts to a dimension on a low-cardinality key (ledger code, currency).

Such a join must not send all rows of a hot key to one task:

* A dimension that the planner estimates at ``BROADCAST_BYTES`` or less is
  broadcast. The estimate comes from the sizes of the files it is read from
  (dimensions are stored tables), so it costs no job; it is Spark's own, and
  a dimension of unknown size counts as large.
* Beyond that the join is a shuffle join with spread keys: every fact row
  draws one of ``spread`` numbers from its own hash, every dimension row is
  repeated for each number, and the join is on (key, number). A key's facts
  go to ``spread`` tasks, whatever its share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Estimated bytes of a dimension up to which it is broadcast.
BROADCAST_BYTES = 8 << 20
#: Tasks the facts of one key go to at most in a shuffle join.
SPREAD = 16


def estimated_bytes(df: DataFrame) -> int:
    """The planner's size estimate; no job runs. Unknown sizes come out huge."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread_join(facts: DataFrame, dim: DataFrame, on: Column | str, how: str = "inner",
                spread: int = SPREAD) -> DataFrame:
    """``facts.join(dim, on, how)`` for a dimension with a hot key (see module text).

    ``on``: a column name both sides have, or a condition over the columns of
    both; ``how``: ``inner`` or ``left``.
    """
    if estimated_bytes(dim) <= BROADCAST_BYTES:
        return facts.join(F.broadcast(dim), on, how)
    left = facts.withColumn("_spread", F.pmod(F.xxhash64(*facts.columns), F.lit(spread)))
    right = dim.withColumn("_dim_spread", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(spread - 1).cast("bigint"))))
    same = F.col("_spread") == F.col("_dim_spread")
    if isinstance(on, str):
        right = right.withColumnRenamed(on, "_dim_key")
        return left.join(right, same & (F.col(on) == F.col("_dim_key")), how).drop("_dim_key", "_spread", "_dim_spread")
    return left.join(right, same & on, how).drop("_spread", "_dim_spread")
