"""Spelling variants by pivotal grams: words one edit apart, found by two disjoint rare bigrams.

All bigrams of a word are ordered by the number of words that hold them, the
rarest first; a word's prefix is its first three (and further ones equal to the
last of them). Of these a dynamic program chooses two that do not overlap and
are rarest together, its pivots. One edit spoils one pivot at most, so if two
words are one edit apart, a pivot of the word whose prefix ends earlier in the
order is in the other's prefix.

Positions limit where. Let the pivots stand at p < q. An edit that leaves the
pivot at p alone and comes after it leaves all before it alone, too: the other
word begins with the same p + 2 letters. Any other edit comes before q: the
other word ends with the same letters from q on. So the first pivot is looked up
with all that stands before it and the second with all that stands behind it,
among gram prefixes indexed the same two ways by words of length -1, +0 and +1.
What is found is verified: parities of letters and of bigrams first, then the
edit distance. Nothing is compared but words that share such a key.

The bigrams are those of an alphabet of 90 letters (a-z and U+00C0 to U+00FF
after lower-casing), 8,100 at most, whatever the corpus; their order is the one
thing sent to all tasks.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import ship, stored

#: A word's letters after lower-casing A-Z.
LETTERS = "a-zÀ-ÿ"
#: Words counted in a task before their counts leave it.
HELD_WORDS = 200_000
#: Rows of candidate keys per Arrow batch.
STEP_ROWS = 20_000
#: One edit changes this many bigrams at most (two go, two come) and this many letters.
GRAMS_CHANGED, LETTERS_CHANGED = 4, 2


def word_counts(docs: DataFrame, least_length: int = 6, least_count: int = 5, slip_every: int | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of all words of at least ``least_length`` letters and ``least_count`` occurrences, stored.

    A word is a maximal run of letters, A-Z lower-cased. With ``slip_every``
    words get a reproducible slip: where that number divides the CRC-32 h of
    ``<doc_id>:<word>`` (a NULL id is empty), the letter at h modulo the word's
    length is left out. NULL texts have no words.
    """
    runs = re.compile(f"[{LETTERS}]{{{least_length},}}")  # a shorter run stays too short with a letter less

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def counted() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())],
                                              names=["word", "n"])

        for batch in batches:
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                found = runs.findall(text.as_py().encode().lower().decode())
                if slip_every is None:
                    held.update(found)
                else:
                    start = zlib.crc32(f"{'' if key is None else key}:".encode())
                    for word, n in Counter(found).items():
                        h = zlib.crc32(word.encode(), start)
                        if h % slip_every == 0:
                            word = word[:h % len(word)] + word[h % len(word) + 1:]
                            if len(word) < least_length:
                                continue
                        held[word] += n
                if len(held) >= HELD_WORDS:
                    yield counted()
                    held.clear()
        if held:
            yield counted()

    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counts = texts.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return stored(counts.where(F.col("n") >= least_count), "spelling-words")


def gram_order(words: DataFrame) -> tuple[dict[str, int], list[int]]:
    """(rank of every bigram, number of words that hold it by rank): rarest first, then by code points; 8,100 at most."""
    at = F.sequence(F.lit(1), F.length("word") - 1)
    grams = F.array_distinct(F.transform(at, lambda i: F.substring("word", i, F.lit(2))))
    held = words.where(F.length("word") >= 2).select(F.explode(grams).alias("gram")).groupBy("gram").agg(
        F.count("*").alias("n"))
    rows = held.orderBy("n", "gram").collect()
    return {r["gram"]: k for k, r in enumerate(rows)}, [r["n"] for r in rows]


def prefix(word: str, order: dict[str, int]) -> list[tuple[int, int]]:
    """(rank, place) of the word's three first bigrams in the order, and of all others equal to the last."""
    grams = sorted((order[word[i:i + 2]], i) for i in range(len(word) - 1))
    last = grams[min(2, len(grams) - 1)][0]
    return [g for g in grams if g[0] <= last]


def pivots(grams: list[tuple[int, int]], weight: list[int]) -> tuple[int, int]:
    """Places p < q of the two disjoint bigrams of least weight (by rank) together.

    Dynamic program over the places from left to right: the lightest single
    bigram that ends before a place, and with it the lightest pair.
    """
    best_pair, single, waiting = None, None, []
    for rank, at in sorted(grams, key=lambda g: g[1]):
        while waiting and waiting[0][1] + 2 <= at:  # disjoint from here on
            w, p = waiting.pop(0)
            if single is None or w < single[0]:
                single = (w, p)
        if single is not None and (best_pair is None or single[0] + weight[rank] < best_pair[0]):
            best_pair = (single[0] + weight[rank], single[1], at)
        waiting.append((weight[rank], at))
    return best_pair[1], best_pair[2]


def _parities(word: str) -> tuple[int, int]:
    """64-bit parities of the word's letters and of its bigrams."""
    letters = grams = 0
    before = None
    for c in map(ord, word):
        letters ^= 1 << (c & 63)
        if before is not None:
            grams ^= 1 << ((before * 31 + c * 7) & 63)
        before = c
    return letters - (letters >> 63 << 64), grams - (grams >> 63 << 64)


def _keys(words: DataFrame, order: tuple[dict[str, int], list[int]]) -> tuple[DataFrame, DataFrame]:
    """(probes, index), stored: rows (side, length, part, last, word, letters, grams).

    ``part`` is the beginning up to, or the rest from, a pivot (probes) or any
    bigram of the prefix (index); ``length`` the length of the index's word;
    ``last`` the rank of the word's last prefix bigram.
    """
    sent = words.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, weight = sent.value
        columns: list[list] = [[] for _ in range(8)]

        def rows() -> pa.RecordBatch:
            kinds = [pa.bool_(), pa.string(), pa.int32(), pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
            out = pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["probe", "side", "length", "part", "last", "word", "letters", "grams"])
            for c in columns:
                c.clear()
            return out

        for batch in batches:
            for word in batch.column("word").to_pylist():
                found = prefix(word, ranks)
                last, size = max(found)[0], len(word)
                letters, grams = _parities(word)
                keys = [(False, side, size, part) for _, at in found
                        for side, part in (("<", word[:at + 2]), (">", word[at:]))]
                p, q = pivots(found, weight)
                keys += [(True, side, n, part) for n in (size - 1, size, size + 1)
                         for side, part in (("<", word[:p + 2]), (">", word[q:]))]
                for key in keys:
                    for c, x in zip(columns, (*key, last, word, letters, grams), strict=True):
                        c.append(x)
                if len(columns[0]) >= STEP_ROWS:
                    yield rows()
        if columns[0]:
            yield rows()

    keys = stored(words.select("word").mapInArrow(
        run, "probe boolean, side string, length int, part string, last int, word string, letters bigint, grams bigint"),
        "spelling-keys", "probe")
    return keys.where("probe").drop("probe"), keys.where("NOT probe").drop("probe")


def near_words(words: DataFrame) -> DataFrame:
    """(word, near): every ordered pair of different words exactly one inserted, deleted or replaced letter apart.

    ``words``: a column ``word`` of distinct words of at least five letters, as
    three bigrams always hold two disjoint ones. Stored.
    """
    ship(words.sparkSession)
    probes, index = _keys(words, gram_order(words))
    o = index.select(*[F.col(c).alias(f"o_{c}") for c in index.columns])
    alike = ((F.bit_count(F.col("letters").bitwiseXOR(F.col("o_letters"))) <= LETTERS_CHANGED)
             & (F.bit_count(F.col("grams").bitwiseXOR(F.col("o_grams"))) <= GRAMS_CHANGED))
    one_edit = F.when(alike, F.levenshtein("word", "o_word", 1)).otherwise(F.lit(-1)) == 1
    found = probes.join(o, (F.col("side") == F.col("o_side")) & (F.col("length") == F.col("o_length"))
                        & (F.col("part") == F.col("o_part")) & (F.col("last") <= F.col("o_last")) & one_edit)
    both = F.explode(F.array(F.struct(F.col("word"), F.col("o_word").alias("near")),
                             F.struct(F.col("o_word").alias("word"), F.col("word").alias("near")))).alias("pair")
    return stored(found.select(both).select("pair.word", "pair.near").distinct(), "spelling-near")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of rows (word, form): the end of each chain of forms, by doubling steps. Stored.

    Counts grow along a chain, so it ends.
    """
    at = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = at.select(F.col("word").alias("s_word"), F.col("root").alias("s_root"))
        moved = stored(at.join(step, F.col("root") == F.col("s_word"), "left").select(
            "word", F.coalesce("s_root", "root").alias("root"), F.col("s_root").isNotNull().alias("moved")),
            "spelling-roots")
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        at = moved.select("word", "root")


def variants(docs: DataFrame, least_length: int = 6, least_count: int = 5, ratio: int = 5,
             slip_every: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n: a row per word of :func:`word_counts`.

    ``n_near``: number of words one edit away. ``form``: the most frequent of
    them (ties: the first in code-point order) if it occurs at least ``ratio``
    times as often as the word, else NULL; ``form_n`` its count. ``root``: the
    word reached by following forms, the word itself without one. NULL, empty
    and wordless texts add nothing, repeated rows count again, texts of any
    length are read whole, other columns play no part; an empty table gives no
    rows. ``ratio`` must be at least 2, so chains of forms end.
    """
    if ratio < 2 or least_length < 5:
        raise ValueError("ratio must be 2 or more, least_length 5 or more")
    words = word_counts(docs, least_length, least_count, slip_every, id_col, text_col)
    near = near_words(words)
    counted = near.join(words.select(F.col("word").alias("w"), F.col("n").alias("near_n")), F.col("near") == F.col("w"))
    best = counted.groupBy(F.col("word").alias("b_word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("k"), "near")).alias("best"))
    found = stored(words.join(best, F.col("word") == F.col("b_word"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(-F.col("best.k") >= ratio * F.col("n"), F.struct(
            F.col("best.near").alias("form"), (-F.col("best.k")).alias("form_n"))).alias("to")), "spelling-forms")
    roots = _roots(found.where("to IS NOT NULL").select("word", "to.form")).withColumnRenamed("word", "r_word")
    return found.join(roots, F.col("word") == F.col("r_word"), "left").select(
        "word", F.col("to.form").alias("form"), F.coalesce("root", "word").alias("root"), "n", "n_near",
        F.col("to.form_n").alias("form_n"))
