"""Quality by compression: a dictionary of good text against one of bad text.

Two zstandard dictionaries are trained on labelled text, one per label. Every
block of a document is compressed with either; the difference of the two
compressed sizes over their sum says which dictionary knows the text better.
A logistic curve over that difference and the compression ratio, fitted on
labelled documents that built no dictionary, turns it into a probability.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import ship
from ledgerline.llm.sampling import bounded_sample, sample_texts

#: Block in bytes, dictionary size in bytes, compression level.
BLOCK, DICTIONARY, LEVEL = 2000, 32_768, 3
#: Knots of the piecewise-linear terms of the calibration.
_DIFFERENCE_KNOTS = (-0.1, -0.05, -0.02, 0.0, 0.02, 0.05, 0.1)
_RATIO_KNOTS = (0.05, 0.1, 0.2, 0.3, 0.4, 0.5)


class Sizes:
    """Compressed sizes of a text under the good and the bad dictionary."""

    def __init__(self, good: bytes, bad: bytes):
        self.compressors = [_compressor(good), _compressor(bad)]

    def features(self, text: str) -> tuple[float, float]:
        """Normalised size difference, and compressed size per byte."""
        data = text.encode()
        if not data:
            return 0.0, 1.0
        good, bad = (sum(len(c.compress(data[at:at + BLOCK])) for at in range(0, len(data), BLOCK))
                     for c in self.compressors)
        return (good - bad) / (good + bad), min(2.0, min(good, bad) / len(data))


def _compressor(dictionary: bytes):
    import zstandard

    options = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    if not dictionary:
        return zstandard.ZstdCompressor(**options)
    known = zstandard.ZstdCompressionDict(dictionary)
    known.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=known, **options)


def train_dictionary(texts: list[str]) -> bytes:
    """A dictionary of at most ``DICTIONARY`` bytes; plain content where the texts are too few to train one."""
    import zstandard

    blocks = [data[at:at + BLOCK] for data in map(str.encode, texts) for at in range(0, len(data), BLOCK)]
    try:
        return zstandard.train_dictionary(DICTIONARY, blocks).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[-DICTIONARY:]


def _terms(features: np.ndarray) -> np.ndarray:
    difference, ratio = features[:, 0], features[:, 1]
    hinges = [np.maximum(0.0, difference - k) for k in _DIFFERENCE_KNOTS]
    hinges += [np.maximum(0.0, ratio - k) for k in _RATIO_KNOTS]
    return np.column_stack([np.ones(len(features)), difference, ratio, *hinges])


def logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30.0, 30.0)))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weighted ridge logistic regression by Newton steps."""
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = logistic(x @ beta)
        gradient = x.T @ (weight * (y - p)) - ridge * beta
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, gradient)
        beta += step * min(1.0, 5.0 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-6:
            break
    return beta


def fit(texts: list[str], labels: np.ndarray, share: float) -> dict:
    """Dictionaries from every second document of a label, the calibration from the others (all, if few)."""
    if not len(texts) or len(set(labels.tolist())) < 2:
        return {"constant": float(share)}
    turn = np.zeros(len(texts), int)
    for label in (0, 1):
        at = np.flatnonzero(labels == label)
        turn[at] = np.arange(len(at)) % 2
    few = min((labels == 0).sum(), (labels == 1).sum()) < 40
    parts = [train_dictionary([t for t, y, k in zip(texts, labels, turn, strict=True) if y == label and (few or k == 0)])
             for label in (1, 0)]
    sizes = Sizes(*parts)
    held = np.ones(len(texts), bool) if few else turn == 1
    x = _terms(np.array([sizes.features(t) for t, k in zip(texts, held, strict=True) if k]))
    y = labels[held].astype(float)
    weight = np.where(y == 1, share / max(1, (y == 1).sum()), (1 - share) / max(1, (y == 0).sum())) * len(y)
    return {"good": parts[0], "bad": parts[1], "beta": fit_logistic(x, y, weight).tolist()}


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_docs: int = 1500, **columns: str) -> dict:
    """The fitted model, from at most ``sample_docs`` documents of each label (0 and 1) in ``labels``.

    Labels other than 0 and 1, and NULL ids, are no examples; of an id labelled
    twice the smaller label counts; rows of ``docs`` that repeat an id are
    examples each. NULL texts are empty. Below 40 documents of a label the same
    ones build the dictionary and the calibration. With one label only, or
    none, the model is the constant share of label 1 (0.5 without labels).
    """
    usable = labels.where(F.col(label).isin(0, 1)).select("doc_id", label)
    counts = {r["y"]: r["n"] for r in usable.groupBy(F.col(label).alias("y")).agg(F.count("*").alias("n")).collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values())) if counts else 0.5
    ship(docs.sparkSession)
    texts = sample_texts(docs, bounded_sample(usable, label, sample_docs), label, **columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, ys = [], []
        for batch in batches:
            found += batch.column("text").to_pylist()
            ys += batch.column("label").to_pylist()
        model = fit(found, np.array(ys, int), share)
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.get("good")], pa.binary()), pa.array([model.get("bad")], pa.binary()),
             pa.array([json.dumps([model.get("constant"), model.get("beta")])])], names=["good", "bad", "rest"])

    row = texts.mapInArrow(run, "good binary, bad binary, rest string").first()
    if row is None:  # an empty sample has no partition to run in
        return {"constant": float(share)}
    constant, beta = json.loads(row["rest"])
    if constant is not None:
        return {"constant": constant}
    return {"good": bytes(row["good"]), "bad": bytes(row["bad"]), "beta": beta}


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text",
          out: str = "score") -> DataFrame:
    """``id_col``, score and size_difference of every document; NULL text counts as empty.

    Whole texts are compressed, block by block; an empty one has difference 0
    and ratio 1. Equal texts get equal scores; repeated rows stay; an empty table
    gives no rows; other columns play no part.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of DICTIONARY bytes at most
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        sizes = None if "constant" in known else Sizes(known["good"], known["bad"])
        for batch in batches:
            if not len(batch.column(0)):
                continue
            if sizes is None:
                difference = np.zeros(len(batch.column(0)))
                value = np.full(len(difference), known["constant"])
            else:
                features = np.array([sizes.features(t.as_py() or "") for t in batch.column("text")])
                difference, value = features[:, 0], logistic(_terms(features) @ np.array(known["beta"]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(value), pa.array(difference)],
                                             names=[id_col, out, "size_difference"])

    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"`{id_col}` bigint, `{out}` double, size_difference double")
