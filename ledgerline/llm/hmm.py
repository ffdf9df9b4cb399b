"""Hidden Markov language model over whole texts.

Tokens are counted once, in chunks of documents: a chunk is one row with its
word list, the documents' tokens as positions in that list, and the words'
training counts. Every word that occurs in training text has emissions of its
own, whatever its count; all other words share one unknown symbol. In state s
a word of count c has the weight

    (1 - BASE_SHARE) * (expected(word, s) + base) / (expected(s) + 1) + BASE_SHARE * base

with base = (c + 1) / (n + v + 1) for n training tokens of v words, so the
weights of a state add up to 1 and the rule is the same for any corpus.

Counts and expected counts are a table over all words, dealt by hash to
buckets; a bucket's row holds them as arrays. A block is what a chunk and a
bucket share: the places of the chunk's words in the bucket's arrays. A chunk
lists its words by hash, so a bucket's words are a run of the list and the
blocks, in order of their buckets, make up the whole of it: values travel
without keys. A Baum-Welch pass sends the weights of the states to the chunks
by the blocks, runs forward-backward on their training documents, and adds the
expected counts back up by bucket. Scoring is one scaled forward pass. So no
task and no driver ever holds the vocabulary.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.chain import Chains
from ledgerline.llm.common import discard, ship, stored
from ledgerline.llm.near_dup import mixed

#: The end of a text as a token; no word holds a separator.
END = "\n"
#: Tokens per chunk, tokens and bytes of text worked on at a time.
CHUNK_TOKENS, STEP_TOKENS, STEP_BYTES = 2_000_000, 250_000, 6_000_000
#: Buckets of the word table at least, a power of two; (chunk, word) pairs per bucket beyond.
BUCKETS, BUCKET_PAIRS = 64, 250_000
#: Buckets or chunks a task gets on average at most.
GROUPS_A_TASK = 2
#: Seed of Spark's xxhash64, whose order of words is used on both sides.
HASH_SEED = 42
#: Share of every state's emissions that follows the base, so none is near 0.
BASE_SHARE = 0.15
_CHUNK = ("chunk string, ids array<bigint>, held array<boolean>, lengths array<int>, tokens binary, "
          "words array<string>, counts array<bigint>")


def tokenise(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased, split at ASCII white space; both leave other UTF-8 bytes alone."""
    return text.encode().lower().split() if text else []


def split_words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct words, each token's word, tokens per text) by the rules of :func:`tokenise`."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat, ends = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    real = pc.not_equal(flat, "")
    counts = np.diff(np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])[ends - ends[0]])
    coded = flat.filter(real).dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(), counts


def _steps_of(texts: pa.Array) -> Iterator[pa.Array]:
    """Slices of about ``STEP_BYTES`` bytes, a text at least."""
    sizes, at = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)), 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + STEP_BYTES)))
        yield texts.slice(at, stop - at)
        at = stop


def encode(docs: DataFrame, held: Column, id_col: str, text_col: str) -> DataFrame:
    """The chunks (see module text), stored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        from pyspark import TaskContext

        word_hash = partial(xxhash.xxh64_intdigest, seed=HASH_SEED)
        name, number = TaskContext.get().partitionId(), 0
        words: dict[str, int] = {}
        ids, holds, lengths, tokens, counted = [], [], [], [], 0

        def chunk() -> pa.RecordBatch:
            flat, sizes, held_ = np.concatenate(tokens), np.concatenate(lengths), np.concatenate(holds)
            counts = np.bincount(flat[np.repeat(~held_, sizes)], minlength=len(words))
            listed = pa.array(words.keys(), pa.string())
            order = np.argsort(np.fromiter(map(word_hash, words), np.uint64, len(words)), kind="stable")
            place = np.empty(len(words), np.int32)
            place[order] = np.arange(len(words))
            one = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
            return pa.RecordBatch.from_arrays(
                [pa.array([f"{name}-{number}"]), one(pa.concat_arrays(ids)), one(pa.array(held_)),
                 one(pa.array(sizes.astype(np.int32))), pa.array([packed(place[flat])], pa.binary()),
                 one(listed.take(pa.array(order))), one(pa.array(counts[order]))],
                names=["chunk", "ids", "held", "lengths", "tokens", "words", "counts"])

        for batch in batches:
            at = 0
            for texts in _steps_of(batch.column("text")):
                found, code, size = split_words(texts)
                end = words.setdefault(END, len(words))
                of = np.fromiter((words.setdefault(w, len(words)) for w in found), np.int32, len(found))
                # the end of each text behind its words
                tokens.append(np.insert(of[code], np.cumsum(size), end).astype(np.int32))
                lengths.append(size + 1)
                holds.append(batch.column("held").slice(at, len(texts)).to_numpy(zero_copy_only=False).astype(bool))
                ids.append(batch.column("id").slice(at, len(texts)))
                at += len(texts)
                counted += len(tokens[-1])
                if counted >= CHUNK_TOKENS:
                    yield chunk()
                    words, ids, holds, lengths, tokens, counted = {}, [], [], [], [], 0
                    number += 1
        if counted:
            yield chunk()

    ship(docs.sparkSession)
    return stored(docs.select(F.col(id_col).cast("bigint").alias("id"), held.alias("held"),
                              F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(run, _CHUNK), "lm-chunks")


def packed(tokens: np.ndarray) -> bytes:
    """The places as zstandard, byte by byte of their four bytes: they travel with every pass."""
    import zstandard

    return zstandard.compress(np.ascontiguousarray(tokens.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes(), 3)


def unpacked(data: bytes) -> np.ndarray:
    import zstandard

    raw = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(raw.T).view("<i4").ravel()


def tilt(words: np.ndarray, states: int) -> np.ndarray:
    """words x states factors exp(z / 2), z normal by the word's hash: what tells states apart at the start."""
    h = pd.util.hash_array(np.asarray(words, object), categorize=False)
    keys = h[:, None] + (np.arange(2 * states, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    u = ((mixed(keys) >> np.uint64(11)).astype(float) + 0.5) * 2.0 ** -53
    return np.exp(0.5 * np.sqrt(-2.0 * np.log(u[:, :states])) * np.cos(2.0 * np.pi * u[:, states:]))


def start(states: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, move) before training."""
    move = np.full((states, states), 0.05 / max(1, states - 1)) if states > 1 else np.ones((1, 1))
    if states > 1:
        np.fill_diagonal(move, 0.95)
    return np.full(states, 1.0 / states), move


def emissions(expected: np.ndarray, totals: np.ndarray, base: np.ndarray) -> np.ndarray:
    """words x states weights (see module text)."""
    own = (expected + base[:, None]) / (totals + 1.0)
    return (1 - BASE_SHARE) * own + BASE_SHARE * base[:, None]


def maximise(firsts: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, move) of the expected counts."""
    return (firsts + 0.1) / (firsts + 0.1).sum(), (moves + 0.1) / (moves + 0.1).sum(axis=1, keepdims=True)


def _steps(lengths: np.ndarray) -> Iterator[slice]:
    """Runs of documents of about ``STEP_TOKENS`` tokens."""
    ends, at = np.cumsum(lengths), 0
    while at < len(lengths):
        done = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, done + STEP_TOKENS)))
        yield slice(at, stop)
        at = stop


def expected_counts(symbols: np.ndarray, lengths: np.ndarray, model: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected (first, move, emission) counts of the texts under the model."""
    first, move, emit = model
    firsts, moves, emits = np.zeros_like(first), np.zeros_like(move), np.zeros_like(emit)
    ends = np.cumsum(lengths)
    for part in _steps(lengths):
        here = symbols[ends[part.start] - lengths[part.start]:ends[part.stop - 1]]
        chains = Chains(lengths[part])
        weights = lambda at, here=here: emit.take(here.take(at), axis=0)
        _, rows = chains.forward(weights, first, move, keep=True)
        states, pairs = chains.backward(weights, rows, move)
        moves += pairs
        firsts += states[np.cumsum(lengths[part]) - lengths[part]].sum(axis=0)
        for s in range(len(first)):
            emits[:, s] += np.bincount(here, states[:, s], minlength=len(emit))
    return firsts, moves, emits


def _dealt(df: DataFrame, key: str, groups: int) -> DataFrame:
    """The rows by key over enough partitions that one holds a few groups, however many there are."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-groups // GROUPS_A_TASK)), key)


def _word_table(chunks: DataFrame, states: int) -> tuple[DataFrame, DataFrame, int]:
    """(table, blocks, buckets), stored.

    table: bucket, counts, expected (binary, a place per word), sums (training
    tokens, training words, expected tokens per state). blocks: bucket, chunk,
    place (binary, in the order of the chunk's words), and for each bucket a row
    without chunk that has its counts.
    """
    pairs = chunks.agg(F.sum(F.size("counts"))).first()[0] or 0
    bits = max(BUCKETS.bit_length() - 1, (-(-pairs // BUCKET_PAIRS) - 1).bit_length())
    rows = chunks.select("chunk", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "w")).select(
        F.shiftrightunsigned(F.xxhash64("w.words"), 64 - bits).alias("bucket"), "chunk", "at",
        F.col("w.words").alias("word"), F.col("w.counts").alias("c"))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["chunk", "at"], ignore_index=True)
        place, words = pd.factorize(rows["word"])
        counts = np.zeros(len(words), np.int64)
        np.add.at(counts, place, rows["c"].to_numpy())
        expected = (counts[:, None] * tilt(words, states)).astype("<f4")
        sums = [float(counts.sum()), float((counts > 0).sum()), *expected.sum(axis=0, dtype=float)]
        out = [(key[0], None, None, counts.astype("<i8").tobytes(), expected.tobytes(), sums)]
        for chunk, part in rows.groupby("chunk").indices.items():
            out.append((key[0], chunk, place[np.sort(part)].astype("<i4").tobytes(), None, None, None))
        return pd.DataFrame(out, columns=["bucket", "chunk", "place", "counts", "expected", "sums"])

    both = stored(rows.groupBy("bucket").applyInPandas(
        run, "bucket bigint, chunk string, place binary, counts binary, expected binary, sums array<double>"), "lm-words")
    return (both.where("chunk IS NULL").select("bucket", "counts", "expected", "sums"),
            both.select("bucket", "chunk", "place", "counts"), 1 << bits)


def _sums(table: DataFrame, n: int) -> np.ndarray:
    """The sums of all buckets."""
    out = np.zeros(n)
    for r in table.select(F.posexplode("sums").alias("k", "x")).groupBy("k").agg(F.sum("x").alias("x")).collect():
        out[r["k"]] = r["x"]
    return out


def _at_chunks(table: DataFrame, blocks: DataFrame, buckets: int, columns: str, values) -> DataFrame:
    """The blocks (bucket, chunk) with what ``values`` makes of a bucket's (counts, expected): arrays with a row
    per word, sent in the order of the chunk's words."""
    names = [c.split()[0] for c in columns.split(", ")]

    def run(key: tuple, rows: pd.DataFrame, parts: pd.DataFrame) -> pd.DataFrame:
        arrays = values(np.frombuffer(rows["counts"].iloc[0], "<i8"), np.frombuffer(rows["expected"].iloc[0], "<f4"))
        places = [np.frombuffer(x, "<i4") for x in parts["place"]]
        return parts[["bucket", "chunk"]].assign(**{n: [x[p].tobytes() for p in places]
                                                    for n, x in zip(names, arrays, strict=True)})

    return _dealt(table.select("bucket", "counts", "expected"), "bucket", buckets).groupBy("bucket").cogroup(
        _dealt(blocks.where("chunk IS NOT NULL").select("bucket", "chunk", "place"), "bucket", buckets).groupBy(
            "bucket")).applyInPandas(run, f"bucket bigint, chunk string, {columns}")


def _joined(words: pd.DataFrame, column: str, kind: str, width: int) -> np.ndarray:
    """The arrays of a chunk's blocks, put together in the order of its words."""
    return np.concatenate([np.frombuffer(x, kind) for x in words[column]]).reshape(-1, width)


def _em_pass(chunks: DataFrame, n_chunks: int, table: DataFrame, blocks: DataFrame, buckets: int, first: np.ndarray,
             move: np.ndarray, totals: np.ndarray, size: float) -> DataFrame:
    """The table with the expected counts of all training documents; sums: (first, move, tokens per state)."""
    states = len(first)

    def weights(counts: np.ndarray, expected: np.ndarray) -> list[np.ndarray]:
        return [emissions(expected.reshape(-1, states), totals, (counts + 1) / size).astype("<f4")]

    def expect(key: tuple, words: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        words = words.sort_values("bucket", ignore_index=True)
        out = words[["bucket", "chunk"]].iloc[:0 if rows.empty else None]
        values, sums = [], []
        if len(out):
            emit = _joined(words, "emit", "<f4", states).astype(np.float64)
            row = rows.iloc[0]
            held, lengths = np.asarray(row["held"], bool), np.asarray(row["lengths"], np.int64)
            tokens = unpacked(row["tokens"])[np.repeat(~held, lengths)]
            found = expected_counts(tokens, lengths[~held], (first, move, emit))
            ends = np.cumsum([len(x) // (4 * states) for x in words["emit"]])
            values = [x.astype("<f4").tobytes() for x in np.split(found[2], ends[:-1])]
            sums = [np.concatenate([found[0], found[1].ravel(), found[2].sum(axis=0)])] + [None] * (len(out) - 1)
        return out.assign(expected=values, sums=sums)

    def add(key: tuple, rows: pd.DataFrame, parts: pd.DataFrame) -> pd.DataFrame:
        counts = rows["counts"][rows["chunk"].isna()].iloc[0]
        places = {c: p for c, p in zip(rows["chunk"], rows["place"], strict=True) if p is not None}
        expected = np.zeros((len(counts) // 8, states))
        sums = np.zeros(states * (states + 2))
        for chunk, values, some in zip(parts["chunk"], parts["expected"], parts["sums"], strict=True):
            # a block's places are distinct
            expected[np.frombuffer(places[chunk], "<i4")] += np.frombuffer(values, "<f4").reshape(-1, states)
            if some is not None:
                sums += some
        return pd.DataFrame({"bucket": [key[0]], "counts": [counts], "expected": [expected.astype("<f4").tobytes()],
                             "sums": [sums]})

    trained = chunks.where(F.exists("held", lambda x: ~x)).select(
        F.col("chunk").alias("part"), "held", "lengths", "tokens")
    sent = _at_chunks(table, blocks, buckets, "emit binary", weights)
    parts = _dealt(sent, "chunk", n_chunks).groupBy("chunk").cogroup(
        _dealt(trained, "part", n_chunks).groupBy("part")).applyInPandas(
            expect, "bucket bigint, chunk string, expected binary, sums array<double>")
    return stored(_dealt(blocks, "bucket", buckets).groupBy("bucket").cogroup(
        _dealt(parts, "bucket", buckets).groupBy("bucket")).applyInPandas(
            add, "bucket bigint, counts binary, expected binary, sums array<double>"), "lm-words")


def score_texts(docs: DataFrame, held: Column, states: int = 4, passes: int = 3,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Documents where ``held`` is not true train the model, all are scored, each
    with its end as a last token; NULL and empty texts are the end alone. Rows
    with repeated or NULL ids are documents of their own. With no training
    document every token has weight 1 of the base and of the model.
    """
    chunks = encode(docs, F.coalesce(held, F.lit(False)), id_col, text_col)
    n_chunks = chunks.count()
    table, blocks, buckets = _word_table(chunks, states)
    n, v, *totals = _sums(table, 2 + states).tolist()
    totals, size = np.array(totals), n + v + 1
    first, move = start(states)
    for done in range(passes if n else 0):
        last, table = table, _em_pass(chunks, n_chunks, table, blocks, buckets, first, move, totals, size)
        if done:
            discard(last)  # the table of the pass before; the first one is stored with the blocks
        firsts, moves, totals = np.split(_sums(table, states * (states + 2)), [states, states * (states + 1)])
        first, move = maximise(firsts, moves.reshape(states, states))
    known = _at_chunks(table, blocks, buckets, "counts binary, expected binary",
                       lambda counts, expected: [counts, expected.reshape(-1, states)])
    return _score(chunks, n_chunks, known, first, move, totals, int(n), size)


def _score(chunks: DataFrame, n_chunks: int, known: DataFrame, first: np.ndarray, move: np.ndarray,
           totals: np.ndarray, n: int, size: float) -> DataFrame:
    def run(key: tuple, words: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        words = words.sort_values("bucket", ignore_index=True)
        counts = _joined(words, "counts", "<i8", 1).ravel()
        expected = _joined(words, "expected", "<f4", len(first))
        weight = (counts + 1) / size
        emit, base = emissions(expected, totals, weight), np.log10(weight)
        out = []
        for row in rows.itertuples(index=False):
            lengths = np.asarray(row.lengths, np.int64)
            tokens = unpacked(row.tokens)
            ends = np.cumsum(lengths)
            logs = np.empty(len(lengths))
            for part in _steps(lengths):
                here = tokens[ends[part.start] - lengths[part.start]:ends[part.stop - 1]]
                logs[part] = Chains(lengths[part]).forward(
                    lambda at, here=here: emit.take(here.take(at), axis=0), first, move)[0]
            at = ends - lengths
            sums = [np.add.reduceat(x.take(tokens), at) for x in (base, (counts > 0).astype(np.int64))]
            out.append(pd.DataFrame({
                "doc_id": pd.array(list(row.ids), dtype="Int64"), "held_out": np.asarray(row.held, bool),
                "n_tokens": lengths, "n_known": sums[1], "train_tokens": n, "base_score": sums[0],
                "score": logs / math.log(10)}))
        return pd.concat(out)

    parts = chunks.select(F.col("chunk").alias("part"), "ids", "held", "lengths", "tokens")
    return _dealt(known, "chunk", n_chunks).groupBy("chunk").cogroup(
        _dealt(parts, "part", n_chunks).groupBy("part")).applyInPandas(
        run, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
             "base_score double, score double")
