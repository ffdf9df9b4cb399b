"""Jaccard join of documents' word n-grams by token-combination prefixes.

A document is its set of distinct runs of three words. Sets are nodes, so equal
ones meet once. At a similarity of 90 % at most n // 10 of a set's n tokens are
missing in a partner (its slack). Three steps narrow down:

1. Tokens of a hash-chosen quarter are counted over all sets. A set with more
   tokens of its own alone than its slack has no partner.
2. The same over all tokens of what is left.
3. Prefixes. Tokens are ordered: those in one set first, then the quarter's by
   the number of sets that hold them, then the rest. A token's class follows
   from that number: rare tokens count singly (k = 1), frequent ones in
   combinations of k = 2, very frequent ones of k = 3, inside groups by hash. A
   prefix is extended until the sum over its groups of (tokens - (k - 1)) passes
   the slack. Of two sets that link, take the one whose prefix ends first: at
   most its slack of its prefix tokens is missing in the other, so some group
   has k tokens in common, all of them in the other's prefix, too. Single
   tokens and k-combinations of a group are therefore the index.

The number of groups follows a set's size, halved class by class (a scheme); a
set near the lower end of its class is indexed under the scheme below, too, so
two sets that may link share a scheme.

Sets under one index key are not compared pair by pair: the key's most central
set (the pivot) is compared with all; the links make components; then sets
outside the pivot's component are compared with those of other components, if
the sizes and a 512-bit parity of the tokens allow a link. Every pair that
shares a key is compared, or ruled out exactly, or known to be in one component.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import ship, stored
from ledgerline.llm.near_dup import components, mixed

#: Tokens with none of these hash bits set are the quarter counted first.
QUARTER = 3 << 40
#: Sets that hold a token: up to the first number it counts singly, up to the second in pairs, beyond in triples.
SINGLE_UPTO, PAIRS_UPTO = 8, 256
#: Tokens above a group's k - 1 that a group of pairs or triples is meant to hold in the smallest set of a scheme.
GROUP_TOKENS = {2: 3, 3: 2}
#: Words of text worked on at a time; 64-bit words of a parity.
STEP_BYTES, PARITY = 900_000, 8
#: Most (id, text hash) rows of sets that are sent to the tasks of a scan, some 40 bytes each.
SENT_ROWS = 2_000_000
_GOLD, _A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)


def tokens(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes, text of each) of the distinct runs of ``words`` words, A-Z lower-cased, in order of hash.

    A text of fewer words is one run of them all, one without words has none.
    """
    import xxhash

    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat, ends = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    ends = ends - ends[0] if len(ends) else np.zeros(1, np.int64)
    real = pc.not_equal(flat, "")
    counts = np.diff(np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])[ends])
    coded = flat.filter(real).dictionary_encode()
    known = [xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()]
    word = mixed(np.array(known, np.uint64))[coded.indices.to_numpy()] if known else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(texts)), counts)
    after = np.repeat(np.cumsum(counts), counts) - np.arange(len(word))  # words from here to the text's end
    first = after == counts[owner]
    run, ahead = np.zeros(len(word), np.uint64), np.concatenate([word, np.zeros(words, np.uint64)])
    for k in range(words):
        here = np.where(after > k, ahead[k:k + len(word)] + np.uint64(k + 1), np.uint64(0))
        run = mixed((run ^ here) * _GOLD)
    full = (after >= words) | first
    run, owner = run[full], owner[full]
    order = np.lexsort((run, owner))
    run, owner = run[order], owner[order]
    new = np.ones(len(run), bool)
    new[1:] = (run[1:] != run[:-1]) | (owner[1:] != owner[:-1])
    return run[new], owner[new]


def _steps(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """(offset, slice) of about ``STEP_BYTES`` bytes, a text at least."""
    sizes, at = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)), 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + STEP_BYTES)))
        yield at, texts.slice(at, stop - at)
        at = stop


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()),
                                    pa.array(values.view(np.int64)))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text (NULL as empty), h (64-bit hash of the text)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h"))


def features(keyed: DataFrame, words: int) -> DataFrame:
    """doc_id, h, n (tokens), set_a, set_b (128-bit hash of the set), quarter (tokens counted first), stored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in _steps(batch.column("text")):
                token, owner = tokens(texts, words)
                counts = np.bincount(owner, minlength=len(texts))
                edge = np.concatenate([[0], np.cumsum(counts)])
                sums = []
                for salt in (_A, _B):
                    upto = np.concatenate([[np.uint64(0)], np.cumsum(mixed(token ^ salt), dtype=np.uint64)])
                    sums.append(pa.array((upto[edge[1:]] - upto[edge[:-1]]).view(np.int64)))
                early = (token & np.uint64(QUARTER)) == 0
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(at, len(texts)), batch.column("h").slice(at, len(texts)),
                     pa.array(counts), *sums, _lists(token[early], np.bincount(owner[early], minlength=len(texts)))],
                    names=["doc_id", "h", "n", "set_a", "set_b", "quarter"])

    return stored(keyed.mapInArrow(
        run, "doc_id bigint, h bigint, n bigint, set_a bigint, set_b bigint, quarter array<bigint>"), "jaccard-features")


def _own_tokens(rows: DataFrame, holder: str, held: str) -> DataFrame:
    """(owner, own): number of tokens that one holder alone has. One shuffle of the tokens: a token whose
    smallest and largest holder are the same has no other."""
    parts = rows.select(F.col(holder).alias("holder"), F.explode(held).alias("token"))
    alone = parts.groupBy("token").agg(F.min("holder").alias("owner"), F.max("holder").alias("other")).where(
        "owner = other")
    return alone.groupBy("owner").agg(F.count("*").alias("own"))


def _slack(n: Column, percent: int) -> Column:
    return F.floor(n * (100 - percent) / 100)


def _sets(keyed: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """(node, tokens) of nodes (node, f_id, f_h: id and text hash of a document with the set), stored.

    Up to ``SENT_ROWS`` nodes are sent to the scan's tasks; beyond that the join shuffles.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in _steps(batch.column("text")):
                token, owner = tokens(texts, words)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(at, len(texts)), _lists(token, np.bincount(owner, minlength=len(texts)))],
                    names=["node", "tokens"])

    count = nodes.count()
    wanted = nodes.select("node", "f_id", "f_h")
    found = keyed.join(F.broadcast(wanted) if count <= SENT_ROWS else wanted,
                       (F.col("h") == F.col("f_h")) & F.col("doc_id").eqNullSafe(F.col("f_id")))
    sets = stored(found.select("node", "text").mapInArrow(run, "node bigint, tokens array<bigint>"), "jaccard-sets")
    # rows that repeat id and text give a set more than once
    return sets if sets.count() == count else stored(sets.dropDuplicates(["node"]), "jaccard-sets")


def schemes(n: int, percent: int) -> list[int]:
    """Size classes (powers of two) a set of n tokens is indexed under."""
    own = n.bit_length() - 1
    return [own, own - 1] if -(-n * percent // 100) < 1 << own else [own]


def groups(scheme: int, k: int, percent: int) -> int:
    """Number of groups of the tokens of class k."""
    return max(1, (1 << scheme) * (100 - percent) // (100 * GROUP_TOKENS[k]))


def combos(n: int, own: int, counted: list[tuple[int, int]], held: np.ndarray, percent: int) -> list[tuple]:
    """Index keys (scheme, k, tokens...) of a set of n tokens, ``own`` of them its own alone.

    ``counted``: (number of sets, token) of the quarter's tokens that two sets
    at least hold; ``held``: all tokens.
    """
    slack = n * (100 - percent) // 100
    out = []
    for scheme in schemes(n, percent):
        many = {k: groups(scheme, k, percent) for k in GROUP_TOKENS}
        found: dict[tuple[int, int], list[int]] = {}

        def extend(line, reached: int, many=many, found=found) -> int:
            for k, token in line:
                if reached > slack:
                    break
                where = (k, token % many[k]) if k > 1 else (1, 0)
                group = found.setdefault(where, [])
                group.append(token)
                reached += len(group) >= k
            return reached

        line = sorted(counted)
        reached = extend(((1 if c <= SINGLE_UPTO else 2 if c <= PAIRS_UPTO else 3, t) for c, t in line), own)
        if reached <= slack:
            # the quarter is not enough: the rest in order, uncounted, in pairs. Among it are tokens of the set
            # alone; only those of the quarter count as such from the start
            early = (held & np.int64(QUARTER)) == 0
            found.clear()
            start = int(early.sum()) - len(line)
            reached = extend(((1 if c <= SINGLE_UPTO else 2 if c <= PAIRS_UPTO else 3, t) for c, t in line), start)
            rest = np.sort(held[~early]).tolist()
            # groups of their own, so no key mixes counted and uncounted tokens
            other: dict[tuple[int, int], list[int]] = {}
            reached = extend(((2, t) for t in rest), reached, found=other)
            found.update({(k, -1 - g): ts for (k, g), ts in other.items()})
        for (k, _), group in found.items():
            out += [(scheme, k, *c) for c in combinations(sorted(group), k)]
    return out


def _hashed(keys: list[tuple]) -> np.ndarray:
    out = np.empty(len(keys), np.int64)
    by_k: dict[int, list[int]] = {}
    for i, key in enumerate(keys):
        by_k.setdefault(key[1], []).append(i)
    for at in by_k.values():
        rows = np.array([keys[i] for i in at], np.int64).view(np.uint64)
        h = np.zeros(len(at), np.uint64)
        for c in range(rows.shape[1]):
            h = mixed((h ^ rows[:, c]) * _GOLD + _A)
        out[at] = h.view(np.int64)
    return np.unique(out)


def _index(kept: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, n, parity, keys) of rows (node, n, own), stored."""
    held = stored(kept.join(sets.withColumnRenamed("node", "s_node"), F.col("node") == F.col("s_node")).drop("s_node"),
                  "jaccard-kept")
    early = held.select("node", F.explode(F.filter("tokens", lambda t: t.bitwiseAND(F.lit(QUARTER)) == 0)).alias("token"))
    counts = early.groupBy(F.col("token").alias("c_token")).agg(F.count("*").alias("c")).where("c > 1")
    counted = early.join(counts, F.col("token") == F.col("c_token")).groupBy(F.col("node").alias("l_node")).agg(
        F.collect_list(F.struct("c", "token")).alias("counted"))  # at most the tokens of one set

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, parity = [], []
            for n, own, tokens_, counted_ in zip(batch.column("n").to_pylist(), batch.column("own").to_pylist(),
                                                 batch.column("tokens"), batch.column("counted"), strict=True):
                all_ = tokens_.values.to_numpy()
                line = [(x["c"], x["token"]) for x in counted_.as_py() or []]
                keys.append(_hashed(combos(n, own, line, all_, percent)))
                bits = np.bincount((all_.view(np.uint64) % np.uint64(64 * PARITY)).astype(np.int64), minlength=64 * PARITY) & 1
                parity.append(np.packbits(bits.astype(bool), bitorder="little").view("<i8"))
            sizes = np.array([len(k) for k in keys], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("n"), _lists(np.concatenate(parity), np.full(len(keys), PARITY)),
                 _lists(np.concatenate(keys), sizes)], names=["node", "n", "parity", "keys"])

    both = held.join(counted, F.col("node") == F.col("l_node"), "left").select("node", "n", "own", "tokens", "counted")
    return stored(both.mapInArrow(run, "node bigint, n bigint, parity array<bigint>, keys array<bigint>"), "jaccard-index")


def _may_link(n: Column, parity: Column, o_n: Column, o_parity: Column, percent: int) -> Column:
    """False only where the sizes or the parities rule a link out: unequal bits are tokens of one side alone."""
    apart = sum((F.bit_count(parity[i].bitwiseXOR(o_parity[i])) for i in range(PARITY)), F.lit(0))
    return ((100 * F.least(n, o_n) >= percent * F.greatest(n, o_n))
            & (apart * (100 + percent) <= (n + o_n) * (100 - percent)))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link, stored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"), strict=True)):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                both = len(np.intersect1d(x, y, assume_unique=True))
                good[i] = 100 * both >= percent * (len(x) + len(y) - both)
            kept = pa.array(good)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(kept), batch.column("b").filter(kept)],
                                             names=["a", "b"])

    left = pairs.join(sets.select(F.col("node").alias("x_node"), F.col("tokens").alias("x")), F.col("a") == F.col("x_node"))
    both = left.join(sets.select(F.col("node").alias("y_node"), F.col("tokens").alias("y")), F.col("b") == F.col("y_node"))
    return stored(both.select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint"), "jaccard-links")


def _links(index: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links whose components are those of all links between sets that share a key, stored."""
    places = index.select("node", F.explode("keys").alias("key"))
    shared = places.groupBy(F.col("key").alias("s_key")).agg(F.count("*").alias("size")).where("size > 1")
    members = stored(places.join(shared, F.col("key") == F.col("s_key")).drop("s_key"), "jaccard-members")
    central = members.groupBy(F.col("node").alias("c_node")).agg(F.sum("size").alias("centre"))
    pivots = stored(members.join(central, F.col("node") == F.col("c_node")).groupBy(F.col("key").alias("p_key")).agg(
        F.max(F.struct("centre", "node")).alias("p")).select("p_key", F.col("p.node").alias("pivot")), "jaccard-pivots")
    placed = stored(members.join(pivots, F.col("key") == F.col("p_key")).select("key", "node", "pivot"), "jaccard-placed")

    size = lambda side: index.select(F.col("node").alias(f"{side}_node"), F.col("n").alias(f"{side}_n"),
                                     F.col("parity").alias(f"{side}_parity"))
    may = _may_link(F.col("a_n"), F.col("a_parity"), F.col("b_n"), F.col("b_parity"), percent)
    pairs = stored(placed.where("node <> pivot").select(
        F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct(), "jaccard-pairs")
    possible = pairs.join(size("a"), F.col("a") == F.col("a_node")).join(
        size("b"), F.col("b") == F.col("b_node")).where(may).select("a", "b")
    links = _verified(possible, sets, percent)

    label = components(links)
    own = label.select(F.col("row").alias("o_row"), F.col("label").alias("o_label"))
    main = label.select(F.col("row").alias("m_row"), F.col("label").alias("m_label"))
    labelled = stored(placed.join(own, F.col("node") == F.col("o_row"), "left").join(
        main, F.col("pivot") == F.col("m_row"), "left").select(
            "key", "node", "pivot", F.coalesce("o_label", "node").alias("own"),
            F.coalesce("m_label", "pivot").alias("main")), "jaccard-labelled")
    outside = labelled.where("own <> main").select(
        F.col("key").alias("a_key"), F.col("node").alias("a"), F.col("own").alias("a_own"))
    # the pivot was compared with all before
    other = labelled.where("node <> pivot").join(
        outside.select("a_key").distinct(), F.col("key") == F.col("a_key"), "left_semi").select(
            F.col("key").alias("b_key"), F.col("node").alias("b"), F.col("own").alias("b_own"),
            (F.col("own") == F.col("main")).alias("b_inside"))
    outside = outside.join(size("a"), F.col("a") == F.col("a_node")).drop("a_node")
    other = other.join(size("b"), F.col("b") == F.col("b_node")).drop("b_node")
    met = outside.join(other, (F.col("a_key") == F.col("b_key")) & (F.col("a_own") != F.col("b_own"))
                       & (F.col("b_inside") | (F.col("a") < F.col("b"))) & may)
    more = stored(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "jaccard-more")
    return links.unionByName(_verified(more, sets, percent))


def linked(docs: DataFrame, words: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id.

    Two documents link when the intersection of their sets of runs of
    ``words`` words is at least ``percent`` % of the union; ``component_id`` is
    the smallest id reachable over links, itself included (NULL if none of
    them has an id). Texts of fewer words are one run of them all; NULL, empty
    and wordless texts have an empty set and link with nothing. Repeated rows
    have equal sets and link; so do rows with repeated or NULL ids. Texts of any length are
    used whole, other columns play no part, an empty table gives no rows.
    Equal sets are told by 128-bit hashes, tokens by 64-bit ones.
    """
    if not 90 <= percent < 100:
        raise ValueError("percent must be from 90 to 99: below, a small set's groups may hold too few tokens")
    ship(docs.sparkSession)
    keyed = _keyed(docs, id_col, text_col)
    found = features(keyed, words)
    # a smaller set has no partner but its equal: n / (n + 1) is below the threshold
    large = found.where(F.col("n") * (100 - percent) >= percent)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h")).alias("f")
    own = _own_tokens(large, "set_a", "quarter")
    able = large.groupBy("set_a", "set_b").agg(F.max("n").alias("n"), first).join(
        own, F.col("set_a") == F.col("owner"), "left").where(
            F.coalesce("own", F.lit(0)) <= _slack(F.col("n"), percent))
    nodes = stored(able.select(
        "set_a", "set_b", "n", F.col("f.doc_id").alias("f_id"), F.col("f.h").alias("f_h"),
        F.monotonically_increasing_id().alias("node")), "jaccard-nodes")  # the number is a column of the files
    sets = _sets(keyed, nodes, words)
    own = _own_tokens(sets, "node", "tokens")
    kept = nodes.select("node", "n").join(own, F.col("node") == F.col("owner"), "left").select(
        "node", "n", F.coalesce("own", F.lit(0)).alias("own")).where(F.col("own") <= _slack(F.col("n"), percent))
    index = _index(kept, sets, percent)
    label = components(_links(index, sets, percent))

    # components of sets, named by the label node's number; other sets by their own hash
    of = nodes.join(label, F.col("node") == F.col("row")).select(
        F.col("set_a").alias("l_a"), F.col("set_b").alias("l_b"), "label")
    smallest = found.where("n > 0").groupBy("set_a", "set_b").agg(F.min("doc_id").alias("least"))
    placed = smallest.join(of, (F.col("set_a") == F.col("l_a")) & (F.col("set_b") == F.col("l_b")), "left").select(
        "set_a", "set_b", "least", "label")
    joined = stored(placed.where("label IS NOT NULL"), "jaccard-joined")
    least = joined.groupBy(F.col("label").alias("g_label")).agg(F.min("least").alias("of_all"))
    moved = stored(joined.join(least, F.col("label") == F.col("g_label")).select("set_a", "set_b", "of_all"), "jaccard-moved")
    ids = placed.where("label IS NULL").select("set_a", "set_b", "least").unionByName(
        moved.withColumnRenamed("of_all", "least"))
    ids = stored(ids.select(F.col("set_a").alias("i_a"), F.col("set_b").alias("i_b"), "least"), "jaccard-ids")
    return found.join(ids, (F.col("set_a") == F.col("i_a")) & (F.col("set_b") == F.col("i_b")) & (F.col("n") > 0),
                      "left").select("doc_id", F.col("n").alias("n_shingles"),
                                     F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))
