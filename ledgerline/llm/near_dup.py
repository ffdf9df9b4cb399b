"""Near duplicates by DartMinHash signatures and banded candidate search, verified exactly.

A text is the set of its runs of five words (A-Z lower-cased), each a weighted
element; the registered query uses weight 1, as its similarity is that of the
sets (their Jaccard similarity), not of how often a run occurs. Every unit of an element's weight throws a
Poisson sequence of darts, all of them hashed from the element and the unit
alone, so two texts throw the same darts at what they share. A dart has a rank
and a coordinate; per coordinate the dart of least rank is the signature
value. Only darts up to a rank that leaves few coordinates empty are thrown;
a text with an empty coordinate throws on to twice that rank.

Rows of ``BANDS`` x ``ROWS`` values form buckets. Instead of all pairs of a
bucket, its most central member (the one that shares most places with others)
is compared with all members; the verified links make components; then only
members outside the pivot's component are compared with the members of other
components, if their sizes and the 512-bit parities of their elements allow a
link. A pair is compared once, however many buckets it shares. So every pair of
a bucket is compared, or ruled out exactly, or known to be in one component,
and a large group of near copies costs its size, not its square. Equal sets
are one node from the start.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import free_name, numbered, ship, stored

WORDS, BANDS, ROWS = 5, 40, 7
#: Elements of texts whose darts are thrown together.
STEP_ELEMENTS = 150_000
#: Most row numbers that are broadcast; 64-bit words of a parity.
SENT_ROWS, PARITY = 2_000_000, 8
_GOLD, _MIX1, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_COORDINATE, _PLACE, _UNIT = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input sways every bit of the output."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def _times(n: int) -> np.uint64:
    """n steps of the golden-ratio sequence, modulo 2^64."""
    return np.uint64(n * int(_GOLD) % 2 ** 64)


def _fraction(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def signatures(elements: np.ndarray, owner: np.ndarray, texts: int, weights: np.ndarray | None = None,
               size: int = BANDS * ROWS) -> np.ndarray:
    """texts x size signature values; ``owner``: the text of each element, a text's elements distinct.

    ``weights``: positive reals, default 1. Rows of texts without elements are 0.
    """
    if weights is None:
        base, room = elements, None
        total = np.bincount(owner, minlength=texts).astype(float)
    else:
        units = np.ceil(weights).astype(np.int64)
        at = np.repeat(np.arange(len(elements)), units)
        unit = np.arange(len(at)) - np.repeat(np.cumsum(units) - units, units)
        base = mixed(elements[at] + unit.astype(np.uint64) * _UNIT)
        room = np.minimum(1.0, weights[at] - unit)
        owner, total = owner[at], np.bincount(owner, weights, minlength=texts)
    base = mixed(base + _GOLD)
    rank, value = np.full(texts * size, np.inf), np.zeros(texts * size, np.uint64)
    limit = np.divide(size * (math.log(size) + 2.0), total, out=np.zeros(texts), where=total > 0)
    todo = total > 0
    while todo.any():
        use = np.flatnonzero(todo[owner])
        here, who = base[use], owner[use]
        free = None if room is None else room[use]
        at, n = np.zeros(len(use)), 0
        while len(here):
            n += 1
            dart = mixed(here + _times(n))
            at = at - np.log(_fraction(dart))
            keep = np.flatnonzero(at <= limit[who])
            here, who, at, dart = here[keep], who[keep], at[keep], dart[keep]
            hit = slice(None)
            if free is not None:
                free = free[keep]
                hit = np.flatnonzero(_fraction(mixed(dart ^ _PLACE)) < free)
            slot = who[hit] * size + (mixed(dart[hit] ^ _COORDINATE) % np.uint64(size)).astype(np.int64)
            np.minimum.at(rank, slot, at[hit])
            first = np.flatnonzero(rank[slot] == at[hit])
            value[slot[first]] = dart[hit][first]
        todo &= np.isinf(rank.reshape(texts, size)).any(axis=1)
        limit[todo] *= 2.0
    return value.reshape(texts, size)


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(element hashes, text of each) of the distinct runs of five words; shorter texts are one run of all words."""
    import xxhash

    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    offsets = lists.offsets.to_numpy() - (lists.offsets[0].as_py() if len(texts) else 0)
    flat = lists.flatten()
    keep = pc.not_equal(flat, "")
    ends = np.concatenate([[0], np.cumsum(keep.to_numpy(zero_copy_only=False))])[offsets]
    coded = flat.filter(keep).dictionary_encode()
    words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    word = mixed(hashes)[coded.indices.to_numpy()] if len(words) else np.zeros(0, np.uint64)
    counts = np.diff(ends)
    owner = np.repeat(np.arange(len(texts)), counts)
    run = np.zeros(len(word), np.uint64)
    padded = np.concatenate([word, np.zeros(WORDS, np.uint64)])
    place = np.arange(len(word)) - np.repeat(ends[:-1], counts)
    left = np.repeat(counts, counts) - place
    for k in range(WORDS):
        run = mixed(run + _times(k + 1) + np.where(left > k, padded[k:k + len(word)], np.uint64(0)))
    whole = (left >= WORDS) | (place == 0)
    run, owner = run[whole], owner[whole]
    order = np.lexsort((run, owner))
    run, owner = run[order], owner[order]
    new = np.ones(len(run), bool)
    new[1:] = (run[1:] != run[:-1]) | (owner[1:] != owner[:-1])
    return run[new], owner[new]


def _steps(texts: pa.Array) -> Iterator[pa.Array]:
    """Slices of about ``STEP_ELEMENTS`` words."""
    sizes, at = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)), 0
    while at < len(texts):
        done = sizes[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(sizes, done + 6 * STEP_ELEMENTS)))
        yield texts.slice(at, stop - at)
        at = stop


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def features(texts: DataFrame) -> DataFrame:
    """Of rows (row, doc_id, text): row, doc_id, n (elements), set_a, set_b (128-bit hash of the set), bands (array of bucket keys), stored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in _steps(batch.column("text")):
                n = len(texts)
                element, owner = shingles(texts)
                counts = np.bincount(owner, minlength=n)
                sums = []
                for salt in (_PLACE, _UNIT):
                    ends = np.concatenate([[np.uint64(0)], np.cumsum(mixed(element ^ salt), dtype=np.uint64)])
                    edge = np.concatenate([[0], np.cumsum(counts)])
                    sums.append(_signed(ends[edge[1:]] - ends[edge[:-1]]))
                values = signatures(element, owner, n).reshape(n, BANDS, ROWS)
                key = np.zeros((n, BANDS), np.uint64)
                for r in range(ROWS):
                    key = mixed(key * _GOLD + values[:, :, r])
                key = mixed(key + np.arange(BANDS, dtype=np.uint64) * _UNIT)
                bands = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * BANDS, pa.int32()),
                                                 pa.array(_signed(key.ravel())))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(at, n), batch.column("doc_id").slice(at, n), pa.array(counts),
                     pa.array(sums[0]), pa.array(sums[1]), bands],
                    names=["row", "doc_id", "n", "set_a", "set_b", "bands"])
                at += n

    ship(texts.sparkSession)
    return stored(texts.select("row", "doc_id", "text").mapInArrow(
        run, "row bigint, doc_id bigint, n bigint, set_a bigint, set_b bigint, bands array<bigint>"), "near-features")


def _sets(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """row, elements (array of 64-bit hashes), parity (of the elements by their last bits) of the given rows, stored.

    Up to ``SENT_ROWS`` row numbers are sent to the scan's tasks (8 bytes each); beyond that the join shuffles.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in _steps(batch.column("text")):
                element, owner = shingles(texts)
                edge = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))])
                lists = pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(_signed(element)))
                bits = np.zeros((len(texts), 64 * PARITY), bool)
                np.logical_xor.at(bits, (owner, (element % np.uint64(64 * PARITY)).astype(np.int64)), True)
                words = np.packbits(bits, axis=1, bitorder="little").view("<i8")
                parity = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * PARITY, pa.int32()),
                                                  pa.array(words.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(at, len(texts)), lists, parity],
                                                 names=["row", "elements", "parity"])
                at += len(texts)

    rows = stored(rows.select(F.col("row").alias("r")), "near-involved")
    rows = F.broadcast(rows) if rows.count() <= SENT_ROWS else rows
    found = texts.select("row", "text").join(rows, F.col("row") == F.col("r"), "left_semi")
    return stored(found.mapInArrow(run, "row bigint, elements array<bigint>, parity array<bigint>"), "near-sets")


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) with a Jaccard similarity of at least ``least``, stored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"), strict=True)):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                both = len(np.intersect1d(x, y, assume_unique=True))
                good[i] = both >= least * (len(x) + len(y) - both) - 1e-9
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(good)),
                                              batch.column("b").filter(pa.array(good))], names=["a", "b"])

    left = pairs.join(sets.select(F.col("row").alias("ra"), F.col("elements").alias("x")), F.col("a") == F.col("ra"))
    both = left.join(sets.select(F.col("row").alias("rb"), F.col("elements").alias("y")), F.col("b") == F.col("rb"))
    return stored(both.select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint"), "near-links")


def _may_link(least: float) -> Column:
    """False only where sizes or parities rule a link of two sides (a_n, a_parity, b_n, b_parity) out: unequal bits
    are elements of one side alone, and linked sets have at most (1 - least) / (1 + least) of their sizes of these."""
    a, b = F.col("a_n"), F.col("b_n")
    apart = sum((F.bit_count(F.col("a_parity")[i].bitwiseXOR(F.col("b_parity")[i])) for i in range(PARITY)), F.lit(0))
    return ((F.least(a, b) >= least * F.greatest(a, b) - 1e-9)
            & (apart * (1 + least) <= (a + b) * (1 - least) + 1e-6))


def components(links: DataFrame) -> DataFrame:
    """(row, label): connected components of links (a, b); the label is the smallest row. Stored.

    Each round moves every node to the least label around it and then to that
    label's own label, so paths shrink by halves.
    """
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                  .where("a <> b").distinct(), "near-edges")
    labels = stored(both.groupBy(F.col("a").alias("row")).agg(F.least(F.min("b"), F.first("a")).alias("label")),
                    "near-labels")
    while True:
        around = both.join(labels, F.col("b") == F.col("row")).groupBy(F.col("a").alias("node")).agg(
            F.min("label").alias("near"))
        moved = labels.join(around, F.col("row") == F.col("node")).select(
            "row", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = moved.select(F.col("row").alias("j_row"), F.col("label").alias("j_label"))
        moved = stored(moved.join(jump, F.col("label") == F.col("j_row")).select(
            "row", "old", F.least("label", "j_label").alias("label")), "near-labels")
        if moved.where("old <> label").isEmpty():
            return moved.select("row", "label")
        labels = moved.select("row", "label")


def near_duplicates(docs: DataFrame, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text",
                    row_col: str | None = None) -> DataFrame:
    """One row per input row: row, doc_id, class_id, class_size, kept.

    Rows are in one class if a chain of pairs with a similarity of at least
    ``least`` joins them. ``class_id`` is the smallest id of the class (NULL if
    it has none); one row of a class is kept, the one with the smallest id,
    NULL last, then the first in reading order. Texts without words have no
    elements and are classes of their own; texts of fewer than five words are
    one element, so equal ones are copies. Repeated rows are copies. ``row`` is
    ``row_col`` of a stored table that has its rows numbered; without it they
    are numbered here and stored with their texts.
    """
    columns = F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    texts = docs.select(F.col(row_col).alias("row"), *columns) if row_col else numbered(docs, "row", *columns)
    found = features(texts)
    copies = stored(found.where("n > 0").groupBy("set_a", "set_b").agg(F.min("row").alias("node")), "near-nodes")
    nodes = found.join(copies.select("node"), F.col("row") == F.col("node"), "left_semi")
    places = nodes.select("row", "n", F.explode("bands").alias("bucket"))
    shared = places.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = stored(places.join(shared.withColumnRenamed("bucket", "s"), F.col("bucket") == F.col("s")).drop("s"),
                     "near-members")
    central = members.groupBy(F.col("row").alias("c_row")).agg(F.sum("size").alias("centre"))
    members = stored(members.join(central, F.col("row") == F.col("c_row")).select("bucket", "row", "n", "centre"),
                     "near-members")
    sets = _sets(texts, members.select("row").distinct())

    pivots = stored(members.groupBy("bucket").agg(F.max(F.struct("centre", "row", "n")).alias("p")).select(
        F.col("bucket").alias("p_bucket"), F.col("p.row").alias("pivot"), F.col("p.n").alias("p_n")), "near-pivots")
    with_pivot = members.join(pivots, F.col("bucket") == F.col("p_bucket"))
    ratio = lambda x, y: F.least(x, y) >= least * F.greatest(x, y) - 1e-9
    a, b = F.least("row", "pivot").alias("a"), F.greatest("row", "pivot").alias("b")
    # of each set what tells whether a link is possible
    size = lambda side: sets.select(F.col("row").alias(f"{side}_row"), F.size("elements").alias(f"{side}_n"),
                                    F.col("parity").alias(f"{side}_parity"))
    may = _may_link(least)
    pairs = stored(with_pivot.where((F.col("row") != F.col("pivot")) & ratio(F.col("n"), F.col("p_n")))
                   .select(a, b).distinct(), "near-pairs")
    possible = pairs.join(size("a"), F.col("a") == F.col("a_row")).join(size("b"), F.col("b") == F.col("b_row")).where(may)
    links = _verified(possible.select("a", "b"), sets, least)

    label = components(links).withColumnRenamed("row", "l_row")
    placed = with_pivot.join(label, F.col("row") == F.col("l_row"), "left").select(
        "bucket", "row", "n", "pivot", F.coalesce("label", "row").alias("own"))
    pivot_label = label.withColumnRenamed("l_row", "pl_row").withColumnRenamed("label", "pl")
    placed = stored(placed.join(pivot_label, F.col("pivot") == F.col("pl_row"), "left").select(
        "bucket", "row", "n", "own", F.coalesce("pl", "pivot").alias("main"), "pivot"), "near-placed")
    # outside the pivot's component: compared with every member of another component but the pivot, done above
    outside = placed.where("own <> main").select(
        F.col("bucket").alias("o_bucket"), F.col("row").alias("a"), F.col("own").alias("a_own")).join(
            size("a"), F.col("a") == F.col("a_row")).drop("a_row")
    open_buckets = stored(outside.select(F.col("o_bucket").alias("open")).distinct(), "near-open")
    other = placed.where("row <> pivot").join(open_buckets, F.col("bucket") == F.col("open"), "left_semi").select(
        "bucket", F.col("row").alias("b"), F.col("own").alias("b_own"), (F.col("own") == F.col("main")).alias("inside")).join(
            size("b"), F.col("b") == F.col("b_row")).drop("b_row")
    met = other.join(outside, (F.col("bucket") == F.col("o_bucket")) & (F.col("a_own") != F.col("b_own"))
                     & (F.col("inside") | (F.col("b") < F.col("a"))) & may)
    pairs = stored(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "near-pairs")
    more = _verified(pairs, sets, least)

    final = components(links.unionByName(more)).withColumnRenamed("row", "l_row")
    of_node = stored(copies.join(final, F.col("node") == F.col("l_row"), "left").select(
        F.col("set_a").alias("na"), F.col("set_b").alias("nb"), F.coalesce("label", "node").alias("class")), "near-class")
    rows = found.join(of_node, (F.col("set_a") == F.col("na")) & (F.col("set_b") == F.col("nb")) & (F.col("n") > 0),
                      "left").select("row", "doc_id", F.coalesce("class", -1 - F.col("row")).alias("class"))
    rows = stored(rows, "near-rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    classes = stored(rows.groupBy("class").agg(F.count("*").alias("class_size"), first.alias("first")).select(
        F.col("class").alias("c"), "class_size", F.col("first.doc_id").alias("class_id"),
        F.col("first.row").alias("keep_row")), "near-classes")
    return rows.join(classes, F.col("class") == F.col("c")).select(
        "row", "doc_id", "class_id", "class_size", (F.col("row") == F.col("keep_row")).alias("kept"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The documents whose row is kept, with the columns of ``docs``."""
    here = free_name(docs, "_row_here")
    rows = numbered(docs, here)
    out = free_name(rows, "_gone")
    gone = near_duplicates(rows, row_col=here, **options).where("NOT kept").select(F.col("row").alias(out))
    return rows.join(stored(gone, "near-gone"), F.col(here) == F.col(out), "left_anti").drop(here)
