"""The corpus pipeline: toxicity, exact duplicates, near duplicates, mixing, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which ``run`` writes as Parquet and rereads as the
next stage's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import crf, exact_dedup, mixing, near_dup, packing
from ledgerline.llm.common import crc_fold, free_name, numbered, stored, table
from ledgerline.llm.queries import vocabulary

#: Documents whose toxicity score reaches this go.
TOXIC_FROM = 0.3


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below ``TOXIC_FROM``; learned from the labelled documents outside fold 2 of 4.

    The score is joined back by a stored row number, so repeated and NULL ids
    stay documents of their own; each row's text decides alone. NULL texts
    are scored as empty; without labelled documents of both kinds there is no
    model and nothing goes. All columns come back, whatever their names.
    """
    labels = table(spark, sf_dir, "labels").where(crc_fold(F.col("doc_id"), 4) != 2)
    model = crf.learn(docs, labels)
    if "constant" in (model or {}):
        return docs
    row = free_name(docs, "_row")
    rows = numbered(docs, row)
    out = free_name(rows, "_toxic")
    toxic = stored(crf.score(rows, model, id_col=row).where(F.col("score") >= TOXIC_FROM).select(
        F.col(row).alias(out)), "pipeline-toxic")
    return rows.join(toxic, F.col(row) == F.col(out), "left_anti").drop(row)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text (NULL is empty, runs of separators are one space): the one with the
    smallest id, NULL last; of rows equal in id and text one. All columns come back; an empty table stays empty."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the smallest id, NULL last. Texts without
    words are classes of their own. All columns come back; an empty table stays empty."""
    return near_dup.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes, each as often as it takes them, dealt to shards. Texts without words are
    not taken; a NULL source is a source. All columns come back; an empty table stays empty."""
    return mixing.draw(docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents in sequences of at most 1024 ids, a row per piece (not the columns of
    documents); every copy is packed. An empty table gives no pieces."""
    return packing.pack(docs, vocabulary())


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_copies), ("near dedup", drop_near_copies),
          ("mixing", mix_sources), ("packing", pack_documents)]

#: Learned scores, signatures and hash permutations have no SQL; tests/llm/test_pipeline.py compares every stage
#: with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, one after the other."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs


LLM_QUERIES = {"pipeline": run}
LLM_ORACLE: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
