"""Language of a text by the nearest of several centroids per language.

A text is a TF-IDF vector, of unit length, of hashed byte 2-grams and 3-grams of
its lower-cased letters; whatever stands between letters counts as one space. Document frequencies come from all training documents;
the centroids of a language are the means of a spherical k-means over a
bounded sample of its documents. A text gets the language of the centroid with
the highest cosine; below the cosine that nearly all of that centroid's own
sample reaches, the result is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import ship
from ledgerline.llm.sampling import bounded_sample, sample_texts

#: Hashed n-gram features, and bytes of a text hashed at a time.
FEATURES = 1 << 13
_STEP = 4_000_000
#: Largest model that is broadcast, in bytes.
MODEL_BYTES = 256_000_000
UNDETERMINED = "und"
#: Bytes of lower-cased UTF-8 that are no part of a letter count as a space.
_LETTERS = np.array([b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)], np.uint8)


def gram_counts(text: str) -> np.ndarray:
    """How often each hashed 2-gram and 3-gram of letters occurs in the text (float32)."""
    data = _LETTERS[np.frombuffer(text.lower().encode(), np.uint8)]
    gap = data == 32
    gap[1:] &= gap[:-1].copy()
    gap[:1] = False
    data = data[~gap]
    out = np.zeros(FEATURES, np.float32)
    for at in range(0, len(data), _STEP):
        part = data[at:at + _STEP + 2].astype(np.uint32)
        two = part[:-1] * np.uint32(0x9E3779B1) + part[1:] * np.uint32(0x85EBCA6B)
        three = two[:-1] * np.uint32(0xC2B2AE35) + part[2:] * np.uint32(0x27D4EB2F)
        if at + _STEP + 2 <= len(data):  # the next step starts with the last 2-gram of this one
            two = two[:_STEP]
        for grams in (two, three):
            out += np.bincount(grams >> np.uint32(32 - 13), minlength=FEATURES).astype(np.float32)
    return out


def unit(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of counts as unit TF-IDF vectors; a row without grams stays zero."""
    x = np.log1p(counts) * idf
    norm = np.sqrt((x * x).sum(axis=-1, keepdims=True))
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def spherical_kmeans(x: np.ndarray, clusters: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """(centroids, assignment). Starts from rows far from one another, so it is the same on every run."""
    centres = [x.mean(axis=0)]
    near = x @ (centres[0] / max(1e-9, float(np.linalg.norm(centres[0]))))
    chosen = [int(np.argmax(near))]
    near = x @ x[chosen[0]]
    while len(chosen) < min(clusters, len(x)):
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[chosen[-1]])
    centre = x[chosen].copy()
    at = np.zeros(len(x), int)
    for _ in range(rounds):
        at = np.argmax(x @ centre.T, axis=1)
        for k in range(len(centre)):
            if (at == k).any():
                mean = x[at == k].mean(axis=0)
                centre[k] = mean / max(1e-9, float(np.linalg.norm(mean)))
    used = np.unique(at)
    return centre[used], np.searchsorted(used, at)


def learn(docs: DataFrame, train: Column, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text",
          clusters: int = 3, sample_per_language: int = 300, reject_share: float = 0.01) -> dict:
    """The model, from the documents where ``train`` holds and the language is not NULL.

    Sample bound: ``sample_per_language`` documents of each language build the
    centroids; document frequencies cover every training document. Whole texts
    count, whatever their length; an empty text adds no gram. Rows that repeat
    an id count each in the frequencies and once in the sample, under the
    smaller of its languages. No training document gives a model without
    languages. A model of more than ``MODEL_BYTES`` (2,600 languages) is an error.
    """
    spark = docs.sparkSession
    ship(spark)
    training = docs.where(train & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            for text in batch.column("text"):
                seen += gram_counts(text.as_py()) > 0
                n += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, FEATURES)), pa.array(np.append(n, seen))], names=["gram", "docs"])

    sums = training.select("text").mapInArrow(frequencies, "gram bigint, docs bigint").groupBy("gram").agg(
        F.sum("docs").alias("docs")).toPandas()  # FEATURES + 1 rows
    if sums.empty or sums.docs.sum() == 0:
        return {"languages": []}
    docs_with = np.zeros(FEATURES + 1)
    docs_with[sums.gram.to_numpy() + 1] = sums.docs.to_numpy()
    idf = np.log((1 + docs_with[0]) / (1 + docs_with[1:])).astype(np.float32) + 1.0

    sample = sample_texts(docs, bounded_sample(training.select("doc_id", "lang"), "lang", sample_per_language),
                          "lang", id_col, text_col)

    def centroids(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        x = unit(np.array([gram_counts(t) for t in rows.sort_values("h").text]), idf)
        centre, at = spherical_kmeans(x, clusters)
        own = (x * centre[at]).sum(axis=1)
        limits = [float(np.quantile(own[at == k], reject_share)) for k in range(len(centre))]
        return pd.DataFrame({"lang": key[0], "least": limits, "centre": [c.tobytes() for c in centre]})

    rows = sample.groupBy("label").applyInPandas(centroids, "lang string, least double, centre binary")
    languages = sample.select("label").distinct().count()
    if languages * clusters * FEATURES * 4 > MODEL_BYTES:
        raise ValueError(f"{languages} languages exceed a model of {MODEL_BYTES} bytes")
    found = rows.toPandas().sort_values(["lang", "centre"])
    return {"languages": found.lang.tolist(), "least": found.least.to_numpy(), "idf": idf,
            "centres": np.array([np.frombuffer(c, np.float32) for c in found.centre])}


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, lang_pred, score, rejected for every row.

    ``und`` with score 0 where the text is NULL, has no letter, or nothing was
    learned; else the language of the nearest centroid and its cosine, and
    whether that cosine is below the centroid's limit. Of equally near
    centroids the first in the order of languages counts. Whole texts are
    read; repeated rows get equal results; an empty table gives no rows; other
    columns play no part.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            texts, n = batch.column("text"), len(batch.column("text"))
            names, scores, rejected = [UNDETERMINED] * n, np.zeros(n), np.ones(n, bool)
            for at in range(0, n if m["languages"] else 0, 128):
                part = [t.as_py() for t in texts[at:at + 128]]
                rows = [i for i, t in enumerate(part) if t and any(map(str.isalpha, t))]
                if not rows:
                    continue
                cosines = unit(np.array([gram_counts(part[i]) for i in rows]), m["idf"]) @ m["centres"].T
                best = np.argmax(cosines, axis=1)
                for i, k, c in zip(rows, best.tolist(), cosines.max(axis=1).tolist(), strict=True):
                    names[at + i], scores[at + i] = m["languages"][k], min(1.0, max(0.0, c))
                    rejected[at + i] = c < m["least"][k]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(names, pa.string()), pa.array(scores), pa.array(rejected)],
                names=[id_col, "lang_pred", "score", "rejected"])

    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"`{id_col}` bigint, lang_pred string, score double, rejected boolean")
