"""Exact duplicates by a 128-bit content hash, checked by bytes.

Texts are equal when they are identical after every run of separators became
one space; NULL counts as the empty text. Rows are grouped by the hash of
that text, and distinct (hash, text) pairs, compared by bytes, show whether
one hash stands for several texts; the rows of such a hash are grouped by the
text itself. No step holds a group of copies in one task: both aggregates
combine before the shuffle, and the join that brings a group's result back to
its rows has an exchange on either side, which AQE splits for a hot group.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import free_name, one_space, stored


def md5_bytes(text: Column) -> Column:
    return F.unhex(F.md5(text))


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     digest: Callable[[Column], Column] = md5_bytes) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, content_hash, exact_text.

    Exactly one row of each group is kept: the one with the smallest id, NULL
    ids last; of rows that repeat this id, the first in reading order.
    ``exact_text`` is NULL unless the row's hash is shared by several texts.
    An empty table gives an empty result; other columns play no part.
    """
    text = one_space(F.col(text_col))
    parts = docs.select(F.col(id_col).alias("doc_id"), text.alias("t")).select(
        "doc_id", "t", digest(F.col("t")).alias("content_hash"))
    row = F.monotonically_increasing_id().alias("row")
    sha = F.sha2(F.col("t"), 256).alias("text_sha256")
    rows = stored(parts.select("doc_id", "content_hash", sha, row), "exact-rows").withColumn(
        "exact_text", F.lit(None).cast("string"))

    # byte comparison: the grouping key holds the text, so equal hashes of unequal texts stay apart
    clash = stored(parts.groupBy("content_hash", "t").agg(F.lit(1).alias("one"))
                   .groupBy("content_hash").agg(F.count("*").alias("texts"))
                   .where("texts > 1").select("content_hash"), "exact-clash")
    if not clash.isEmpty():
        hard = parts.join(clash, "content_hash", "left_semi").select(
            "doc_id", "content_hash", sha, row, F.col("t").alias("exact_text"))
        rows = stored(rows.join(clash, "content_hash", "left_anti").unionByName(hard), "exact-hard")

    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    groups = stored(
        rows.groupBy("content_hash", "exact_text")
        .agg(F.count("*").alias("group_size"), first.alias("first"))
        .select(F.col("content_hash").alias("g_hash"), F.col("exact_text").alias("g_text"),
                "group_size", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row")),
        "exact-groups")
    same = (F.col("content_hash") == F.col("g_hash")) & F.col("exact_text").eqNullSafe(F.col("g_text"))
    return rows.join(groups, same).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        "text_sha256", "content_hash", "exact_text")


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents whose row is kept, unchanged and with all their columns.

    Rows that repeat both the id and the text of the kept row are the same
    document; one of them stays.
    """
    groups = duplicate_groups(docs, id_col, text_col)
    k_id, k_hash, k_text, h, t = (free_name(docs, x) for x in ("k_id", "k_hash", "k_text", "_h", "_t"))
    keys = stored(groups.where("kept").select(
        F.col("doc_id").alias(k_id), F.col("content_hash").alias(k_hash),
        F.col("exact_text").alias(k_text)), "exact-kept")
    text = one_space(F.col(text_col))
    match = (F.col(id_col).eqNullSafe(F.col(k_id)) & (md5_bytes(text) == F.col(k_hash))
             & (F.col(k_text).isNull() | (F.col(k_text) == text)))
    found = docs.join(keys, match, "left_semi")
    repeats = groups.groupBy("doc_id", "content_hash", "exact_text").count().where("count > 1")
    if repeats.isEmpty():
        return found
    once = found.withColumn(h, md5_bytes(text)).withColumn(t, text)
    return once.dropDuplicates([id_col, h, t]).drop(h, t)
