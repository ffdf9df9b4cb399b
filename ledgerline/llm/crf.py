"""Toxic spans by a linear-chain conditional random field.

Labels come per document, so tokens are labelled first: a feature (the word,
or its first 4, 5 or 6 letters) that is far more frequent in documents marked
toxic than in the others marks a word; marked words in toxic documents are
the toxic tokens. A two-state linear chain over word features and label
transitions is trained on them by gradient steps with forward-backward
marginals. Scoring runs forward-backward over whole documents; tokens with a
marginal of at least a half form the offending spans, and a logistic curve
over the highest marginal and the expected number of toxic tokens, fitted on
other labelled documents, gives the document's probability.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.chain import Chains
from ledgerline.llm.common import ship
from ledgerline.llm.quality import fit_logistic, logistic
from ledgerline.llm.sampling import bounded_sample, sample_texts

#: Letters of the prefixes that are features, and marks cut off a word's ends.
PREFIXES = (4, 5, 6)
_MARKS = ".,!?;:|\"'()[]*#%$&"
#: A feature marks a word if it is in this share of toxic documents, and this much more frequent there.
LEAST_SHARE, LEAST_RATIO = 0.02, 25.0
#: Documents and gradient steps of the chain's training; weights kept per model.
CHAIN_DOCS, STEPS, WEIGHTS = 400, 40, 200_000
#: Words whose weight a worker keeps, and tokens worked on at a time.
CACHED_WORDS, STEP_TOKENS = 300_000, 400_000
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def features(word: str) -> list[str]:
    """The word without case and outer marks, and its prefixes; none for a word of marks."""
    w = word.strip(_MARKS).lower()
    return [w, *(f"{w[:k]}-" for k in PREFIXES if len(w) >= k)] if w else []


def split_words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct words, each token's word, tokens per text); words are runs without ASCII white space."""
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    keep = pc.not_equal(flat, "")
    counts = np.diff(np.concatenate([[0], np.cumsum(keep.to_numpy(zero_copy_only=False))])[
        lists.offsets.to_numpy() - lists.offsets.to_numpy()[0]]) if len(texts) else np.zeros(0, int)
    coded = flat.filter(keep).dictionary_encode()
    return coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy(), counts


def toxic_features(docs: list[set[str]], labels: np.ndarray) -> set[str]:
    """Features that mark a word, by document frequency."""
    toxic, clean = Counter(), Counter()
    for found, label in zip(docs, labels, strict=True):
        (toxic if label else clean).update(found)
    n_toxic, n_clean = max(1, int(labels.sum())), max(1, int((labels == 0).sum()))
    least = max(3.0, LEAST_SHARE * n_toxic)
    return {f for f, n in toxic.items()
            if n >= least and n / n_toxic >= LEAST_RATIO * (clean[f] + 0.5) / n_clean}


def marginals(scores: np.ndarray, lengths: np.ndarray, move: np.ndarray) -> np.ndarray:
    """P(token is toxic) for chains with token scores (log-odds) and transition weights ``move`` (2 x 2, logs)."""
    chains, table = Chains(lengths), np.exp(move)
    weight = np.ones((len(scores), 2))
    weight[:, 1] = np.exp(np.clip(scores, -25.0, 25.0))
    emit = lambda at: weight.take(at, axis=0)
    _, rows = chains.forward(emit, np.ones(2), table, keep=True)
    out, pairs = chains.backward(emit, rows, table)
    return out[:, 1] if len(scores) else np.zeros(0), pairs


def train_chain(words: list[str], tokens: np.ndarray, lengths: np.ndarray, tags: np.ndarray) -> dict:
    """Feature weights, bias and transitions by Adam steps on the regularised log likelihood of the tags."""
    names: dict[str, int] = {}
    rows, cols = [], []
    for i, w in enumerate(words):
        for f in features(w):
            rows.append(i)
            cols.append(names.setdefault(f, len(names)))
    rows, cols = np.array(rows, int), np.array(cols, int)
    starts = np.cumsum(lengths) - lengths
    inside = np.ones(len(tokens), bool)
    inside[starts[lengths > 0]] = False
    at = np.flatnonzero(inside)
    seen = np.zeros((2, 2))
    np.add.at(seen, (tags[at - 1], tags[at]), 1.0)
    value = np.zeros(len(names) + 5)  # weights, bias, four transitions
    value[-5] = -3.0
    m, v = np.zeros_like(value), np.zeros_like(value)
    for step in range(1, STEPS + 1):
        by_word = np.bincount(rows, value[cols], minlength=len(words)) + value[-5]
        p, pairs = marginals(by_word[tokens], lengths, value[-4:].reshape(2, 2))
        error = np.bincount(tokens, tags - p, minlength=len(words))
        gradient = np.concatenate([np.bincount(cols, error[rows], minlength=len(names)), [error.sum()],
                                   (seen - pairs).ravel()]) - 0.1 * value
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient ** 2
        value += 0.3 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)
    order = np.argsort(-np.abs(value[:-5]), kind="stable")[:WEIGHTS]
    letters = list(names)
    return {"weights": {letters[i]: float(value[i]) for i in order.tolist() if abs(value[i]) > 1e-3},
            "bias": float(value[-5]), "move": value[-4:].reshape(2, 2).tolist()}


class Tagger:
    """Marginals and document features of texts under a trained chain."""

    def __init__(self, model: dict):
        self.weights, self.bias = model["weights"], model["bias"]
        self.move = np.array(model["move"])
        self.cache: dict[str, float] = {}

    def _score(self, word: str) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in features(word))

    def tag(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        """(tokens, marginals) of each text, in order."""
        sizes, at = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)), 0
        while at < len(texts):
            done = sizes[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(sizes, done + 6 * STEP_TOKENS)))
            words, tokens, lengths = split_words(texts.slice(at, stop - at))
            get = self.cache.get
            scores = np.array([self._score(w) if (s := get(w)) is None else s for w in words])
            if len(self.cache) < CACHED_WORDS:
                self.cache.update(zip(words, scores.tolist(), strict=True))
            p, _ = marginals(scores[tokens] if len(tokens) else np.zeros(0), lengths, self.move)
            ends = np.cumsum(lengths)
            for n, end in zip(lengths.tolist(), ends.tolist(), strict=True):
                yield n, p[end - n:end]
            at = stop


def document_terms(n: int, p: np.ndarray) -> list[float]:
    """What the calibration sees: log-odds of the highest marginal, expected toxic tokens, length."""
    top = float(np.clip(p.max(initial=0.0), 1e-9, 1 - 1e-9))
    return [1.0, np.log(top / (1 - top)), float(np.log1p(p[p > 0.01].sum())), float(np.log1p(n)) * 0.1]


def spans(text: str, p: np.ndarray) -> list[tuple[int, int]]:
    """Character offsets (start, end) of runs of tokens with a marginal of at least a half."""
    out: list[tuple[int, int]] = []
    joined = False
    for word, q in zip(_WORD.finditer(text), p.tolist(), strict=True):
        if q >= 0.5:
            start = out.pop()[0] if joined else word.start()
            out.append((start, word.end()))
        joined = q >= 0.5
    return out


def fit(texts: list[str], labels: np.ndarray, share: float) -> dict:
    """Token labels and chain from every second document of a label, calibration from the others (all, if few)."""
    if len(set(labels.tolist())) < 2:
        return {"constant": float(share)}
    turn = np.zeros(len(texts), int)
    for label in (0, 1):
        at = np.flatnonzero(labels == label)
        turn[at] = np.arange(len(at)) % 2
    few = min((labels == 0).sum(), (labels == 1).sum()) < 100
    first = np.flatnonzero((turn == 0) | few)
    words, tokens, lengths = split_words(pa.array([texts[i] for i in first], pa.string()))
    ends = np.cumsum(lengths)
    by_word = [features(w) for w in words]
    docs = [{f for w in np.unique(tokens[e - n:e]).tolist() for f in by_word[w]}
            for n, e in zip(lengths.tolist(), ends.tolist(), strict=True)]
    marked = toxic_features(docs, labels[first])
    word_marked = np.array([any(f in marked for f in fs) for fs in by_word], bool)

    toxic, clean = (np.flatnonzero(labels[first] == y)[:CHAIN_DOCS // 2] for y in (1, 0))
    chosen = np.concatenate([toxic, clean])
    pick = np.concatenate([np.arange(ends[i] - lengths[i], ends[i]) for i in chosen])
    tags = (word_marked[tokens[pick]] & np.repeat(labels[first][chosen] == 1, lengths[chosen])).astype(int)
    used, small = np.unique(tokens[pick], return_inverse=True)
    model = train_chain([words[i] for i in used.tolist()], small, lengths[chosen], tags)

    second = np.flatnonzero((turn == 1) | few)
    x = np.array([document_terms(n, p) for n, p in
                  Tagger(model).tag(pa.array([texts[i] for i in second], pa.string()))])
    y = labels[second].astype(float)
    weight = np.where(y == 1, share / max(1, (y == 1).sum()), (1 - share) / max(1, (y == 0).sum())) * len(y)
    return model | {"beta": fit_logistic(x, y, weight, ridge=0.05).tolist()}


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample_docs: int = 1500, **columns: str) -> dict:
    """The fitted model, from at most ``sample_docs`` documents of each label (0 and 1) in ``labels``.

    Every second of them labels tokens, the others fit the calibration (all do
    both below 100 of a label); at most ``CHAIN_DOCS`` / 2 of each label train
    the chain, of which the ``WEIGHTS`` greatest feature weights above 0.001
    are kept. Labels other than 0 and 1, and NULL ids, are no examples; of an
    id labelled twice the smaller label counts; rows of ``docs`` that repeat an
    id are examples each; NULL texts are empty. With one label only, or none,
    the model is the constant share of label 1.
    """
    usable = labels.where(F.col(label).isin(0, 1)).select("doc_id", label)
    counts = {r["y"]: r["n"] for r in usable.groupBy(F.col(label).alias("y")).agg(F.count("*").alias("n")).collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    ship(docs.sparkSession)
    texts = sample_texts(docs, bounded_sample(usable, label, sample_docs), label, **columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, ys = [], []
        for batch in batches:
            found += batch.column("text").to_pylist()
            ys += batch.column("label").to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([json.dumps(fit(found, np.array(ys, int), share))])], names=["model"])

    row = texts.mapInArrow(run, "model string").first()
    return json.loads(row["model"]) if row else {"constant": float(share)}


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, score, spans (array of character offsets) of every document; NULL text counts as empty.

    Forward-backward runs over the whole text, whatever its length; a text
    without words has no spans and the score of no toxic token. Equal texts get
    equal results; repeated rows stay; an empty table gives no rows; other
    columns play no part.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most WEIGHTS feature weights
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        tagger = None if "constant" in known else Tagger(known)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            texts, n = batch.column("text"), batch.num_rows
            value, found = np.full(n, known.get("constant", 0.0)), [[] for _ in range(n)]
            if tagger and n:
                terms = []
                for i, (tokens, p) in enumerate(tagger.tag(texts)):
                    terms.append(document_terms(tokens, p))
                    if p.max(initial=0.0) >= 0.5:
                        found[i] = [{"start": a, "end": b} for a, b in spans(texts[i].as_py(), p)]
                value = logistic(np.array(terms) @ np.array(known["beta"]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(value), pa.array(found, kind)],
                                             names=[id_col, "score", "spans"])

    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
                       ).mapInArrow(run, f"`{id_col}` bigint, score double, spans array<struct<start: int, end: int>>")
