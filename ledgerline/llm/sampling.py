"""Bounded samples of labelled rows, for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import stored

_RANGE = float(2 ** 63)


def bounded_sample(labelled: DataFrame, label: str, most: int, seed: int = 5) -> DataFrame:
    """At most ``most`` rows of (doc_id, label) per label, chosen by hash: the same rows on every run.

    Each label first keeps the rows under a hash limit expected to leave
    twice the number wanted, so the ranking sees a bounded number of rows
    whatever the label's share. Rows with a NULL id or label are no example;
    of ids labelled twice the smaller label counts.
    """
    known = labelled.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(
        F.min(label).alias(label))
    known = known.withColumn("_h", F.abs(F.xxhash64(F.lit(seed), "doc_id").cast("double")) / _RANGE)
    counts = known.groupBy(F.col(label).alias("_label")).agg(F.count("*").alias("_n"))
    near = known.join(F.broadcast(counts) if counts.count() <= 10_000 else counts, F.col(label) == F.col("_label"))
    near = near.where(F.col("_h") * F.col("_n") <= 2 * most + 100)
    rank = F.row_number().over(Window.partitionBy(label).orderBy("_h", "doc_id"))
    return near.withColumn("_rank", rank).where(F.col("_rank") <= most).select("doc_id", label, "_h")


def sample_texts(docs: DataFrame, sample: DataFrame, label: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(text, label, h) of the sampled documents: whole texts, NULL as empty, in one partition by h."""
    ids = sample.select(F.col("doc_id").alias("_doc"), F.col(label).alias("_label"), "_h")
    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    found = texts.join(F.broadcast(ids), F.col("_id") == F.col("_doc"))  # bounded by the sample's size
    # stored first: gathering the sample in one task must not draw the scan into that task
    sample = stored(found.select(F.col("_text").alias("text"), F.col("_label").alias("label"), F.col("_h").alias("h")),
                    "sample")
    return sample.coalesce(1).sortWithinPartitions("h")
