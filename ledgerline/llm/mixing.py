"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Each source's documents are laid out once in a hash-permuted order, a line of
words; further epochs repeat the line. The source's target cuts the line, and
the part before the cut is divided into blocks of equal words. The tree deals
these blocks to output shards: a node holds one exact block count per source;
its left child gets a multivariate-hypergeometric draw of half of them, the
right child the rest, so at the leaves every shard has its exact size and
every source its exact total. A shard's blocks of a source are a run of the
permuted line, so runs of different shards are disjoint. Documents are then
ordered by hash inside their shard.

Everything is DataFrame and SQL expressions; draws come from hashes of (seed,
node, source), so a rerun gives the same mixture.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import free_name, numbered, stored, word_count

#: Documents per permutation bucket: what one window task sorts, whatever the source's size.
BUCKET_ROWS = 2_000
#: Buckets per group: prefix sums run inside groups, then over groups.
GROUP_BUCKETS = 1_024
#: Words meant for an output shard; levels of the tree built between two stored tables.
SHARD_WORDS, STORED_LEVELS = 8_000_000, 8


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Sources with their size and target: source, source_size, ord, weight, target.

    ``sizes``: (source, size). Sources in code-point order, NULL last, take the
    weights in turn and share 100 % of all words; a target stops at ``most``
    times its source's size and the excess is shared by weight among the rest.
    That has a closed form: target = least(most * size, level * weight), where
    the level follows from running sums in the order of most * size / weight.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = totals.withColumn("ord", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = ordered.withColumn("weight", F.get(cycle, F.col("ord") % len(weights)))
    ranked = ranked.withColumn("cap", F.col("source_size") * most).withColumn("ratio", F.col("cap") / F.col("weight"))
    line, whole = Window.orderBy("ratio", "ord"), Window.partitionBy()
    capped = F.coalesce(F.sum("cap").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("weight").over(line.rowsBetween(0, Window.unboundedFollowing))
    level = (F.sum("source_size").over(whole) - capped) / open_weight
    ranked = ranked.withColumn("level", level)
    first = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "ord", "level"))).over(whole)
    return ranked.withColumn("first", first).select(
        "source", "source_size", F.col("ord").cast("int").alias("ord"), "weight",
        F.least(F.col("cap").cast("double"),
                F.coalesce(F.col("first.level"), F.lit(0.0)) * F.col("weight")).alias("target"))


def _ln_factorial(x: str) -> str:
    """ln x! for x >= 0: Stirling's series at x + 9, shifted down."""
    z = f"({x} + 9D)"
    product = " * ".join(f"({x} + {i}D)" for i in range(1, 9))
    return (f"(({z} - 0.5D) * ln({z}) - {z} + 0.918938533204672742D + 1D / (12D * {z}) - 1D / (360D * pow({z}, 3))"
            f" + 1D / (1260D * pow({z}, 5)) - ln({product}))")


def hypergeometric(u: str, total: str, marked: str, drawn: str) -> str:
    """SQL for a hypergeometric draw: marked ones among ``drawn`` of ``total``, from u in [0, 1).

    Inversion outward from the mode: outcomes are visited mode, +1, -1, +2, ...
    with probabilities from the ratio of neighbours, until their sum passes u.
    The visit ends after 40 standard deviations at most, where the rest is far
    below the resolution of u.
    """
    lo, hi = f"greatest(0D, {drawn} - ({total} - {marked}))", f"least({marked}, {drawn})"
    mode = f"floor(({drawn} + 1D) * ({marked} + 1D) / ({total} + 2D))"
    choose = lambda n, k: f"({_ln_factorial(n)} - {_ln_factorial(k)} - {_ln_factorial(f'({n} - {k})')})"
    start = (f"transform(array(named_struct('n', {total}, 'k', {marked}, 'd', {drawn}, 'm', "
             f"least({hi}, greatest({lo}, cast({mode} AS double))))), s -> named_struct('n', s.n, 'k', s.k, 'd', s.d, "
             f"'up', s.m, 'down', s.m, 'x', s.m, 'left', {u} - "
             f"{{p}}, 'pu', {{p}}, 'pd', {{p}}))[0]").format(
        p=f"exp({choose('s.k', 's.m')} + {choose('(s.n - s.k)', '(s.d - s.m)')} - {choose('s.n', 's.d')})")
    up = "(h.pu * (h.k - h.up) * (h.d - h.up) / ((h.up + 1D) * (h.n - h.k - h.d + h.up + 1D)))"
    down = "(h.pd * h.down * (h.n - h.k - h.d + h.down) / ((h.k - h.down + 1D) * (h.d - h.down + 1D)))"
    step = (
        "CASE WHEN h.left < 0D THEN h WHEN i % 2 = 0 THEN named_struct('n', h.n, 'k', h.k, 'd', h.d, "
        "'up', if(h.up < least(h.k, h.d), h.up + 1D, h.up), 'down', h.down, "
        "'x', if(h.up < least(h.k, h.d), h.up + 1D, h.x), "
        f"'left', if(h.up < least(h.k, h.d), h.left - {up}, h.left), "
        f"'pu', if(h.up < least(h.k, h.d), {up}, 0D), 'pd', h.pd) "
        "ELSE named_struct('n', h.n, 'k', h.k, 'd', h.d, 'up', h.up, "
        "'down', if(h.down > greatest(0D, h.d - h.n + h.k), h.down - 1D, h.down), "
        "'x', if(h.down > greatest(0D, h.d - h.n + h.k), h.down - 1D, h.x), "
        f"'left', if(h.down > greatest(0D, h.d - h.n + h.k), h.left - {down}, h.left), "
        f"'pu', h.pu, 'pd', if(h.down > greatest(0D, h.d - h.n + h.k), {down}, 0D)) END")
    deviation = f"sqrt({drawn} * {marked} / greatest(1D, {total}))"
    steps = f"cast(least(2D * ({hi} - {lo}), 80D * {deviation} + 80D) AS int)"
    return f"aggregate(sequence(0, {steps}), {start}, (h, i) -> {step}, h -> h.x)"


def split_quotas(quotas: DataFrame, levels: int, seed: int) -> DataFrame:
    """The splitting tree: ``quotas`` (ord, blocks) to rows (shard, ord, blocks) of 2^levels shards.

    The table of quotas has a row per source; a node of the tree is one row
    with the counts of all sources as an array.
    """
    node = quotas.agg(F.sort_array(F.collect_list(F.struct("ord", "blocks"))).alias("q")).select(
        F.lit(0).cast("bigint").alias("node"), F.expr("transform(q, x -> cast(x.blocks AS double))").alias("counts"),
        F.expr("transform(q, x -> x.ord)").alias("ords"))
    for level in range(levels):
        u = f"shiftrightunsigned(xxhash64({seed}, {level}, node, i), 11) / 9007199254740992D"
        count = "element_at(counts, i + 1)"
        draw = hypergeometric(f"({u})", "a.rest", count, "(a.open - a.x)")
        total = "aggregate(counts, 0D, (t, c) -> t + c)"
        flip = f"shiftrightunsigned(xxhash64({seed}, {level}, node), 63)"
        left = (f"aggregate(sequence(0, size(counts) - 1), named_struct('out', cast(array() AS array<double>), "
                f"'rest', {total}, 'open', floor(({total} + {flip}) / 2D) + 0D, 'x', 0D), (a, i) -> named_struct("
                f"'out', concat(a.out, array(a.x)), 'rest', a.rest - {count}, 'open', a.open - a.x, 'x', {draw}), "
                "a -> concat(slice(a.out, 2, size(a.out)), array(a.x)))")
        both = ("explode(array(named_struct('node', 2 * node, 'counts', lefts), named_struct('node', 2 * node + 1, "
                "'counts', zip_with(counts, lefts, (c, l) -> c - l))))")
        node = node.where("size(counts) > 0").selectExpr("node", "counts", "ords", f"{left} AS lefts").selectExpr(
            "ords", f"{both} AS child").selectExpr("child.node AS node", "child.counts AS counts", "ords")
        if level % STORED_LEVELS == STORED_LEVELS - 1:  # the next levels grow from many tasks
            node = stored(node.repartition("node"), "mix-nodes")
    return node.selectExpr("node AS shard", "explode(arrays_zip(ords, counts)) AS c").selectExpr(
        "cast(shard AS int) AS shard", "c.ords AS ord", "cast(c.counts AS bigint) AS blocks")


def _before(sums: DataFrame, *keys: str) -> DataFrame:
    """The sums (ord, keys..., bucket, words) with ``before``, the words of all earlier rows of their ``ord``.

    Prefix sums in two steps, so no task holds more of a source than a group of buckets or the groups.
    """
    grouped = sums.withColumn("part", F.floor(F.col("bucket") / GROUP_BUCKETS))
    wholes = grouped.groupBy("ord", *keys, "part").agg(F.sum("words").alias("whole"))
    line = Window.partitionBy("ord").orderBy(*keys, "part").rowsBetween(Window.unboundedPreceding, -1)
    wholes = wholes.withColumn("earlier", F.coalesce(F.sum("whole").over(line), F.lit(0))).drop("whole")
    inside = Window.partitionBy("ord", *keys, "part").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    within = grouped.withColumn("within", F.coalesce(F.sum("words").over(inside), F.lit(0)))
    return within.join(wholes, ["ord", *keys, "part"]).withColumn("before", F.col("earlier") + F.col("within"))


def tree_levels(words: int) -> int:
    """Levels of the tree: shards of about ``SHARD_WORDS`` words of all the documents have."""
    return max(0, math.ceil(math.log2(max(1, words) / SHARD_WORDS)))


def mixture(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, levels: int | None = None,
            block_words: int = 4096, seed: int = 17, id_col: str = "doc_id", text_col: str = "text",
            source_col: str = "source", row_col: str | None = None) -> DataFrame:
    """One row per input row: row, doc_id, size, source, source_size, target, copies.

    ``copies`` is an array of (epoch, shard, place), one entry for every time the mix
    takes the document (at most ``most``; empty: not taken); ``place`` orders a
    shard's documents. Documents are taken whole. Where the cut falls into one, the
    line goes on with those that fit: what a source then misses of its target is
    less than any document it could still take. Documents without words
    are never taken. NULL ids, repeated ids and repeated rows are documents of
    their own, told apart by ``row`` (``row_col`` of a stored table, or else their
    reading order); a NULL source is a source; an empty table gives no rows.
    """
    sized = stored(docs.select(
        (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row"), F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        F.xxhash64(F.lit(seed), F.col(id_col), F.col(source_col), F.col(text_col)).alias("h")), "mix-sizes")
    total = sized.agg(F.count("*").alias("n"), F.sum("size").alias("words")).first()
    buckets = max(1, -(-total["n"] // BUCKET_ROWS))
    levels = tree_levels(total["words"] or 0) if levels is None else levels
    targets = stored(source_targets(sized, weights, most), "mix-targets")
    target = F.broadcast(targets) if targets.count() <= 10_000 else targets  # a row of some 60 bytes per source
    target = target.withColumnRenamed("source", "t_source")
    lined = sized.join(target, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source", "weight")
    lined = stored(lined.withColumn("bucket", F.pmod(F.col("h"), F.lit(buckets))), "mix-lined")

    sums = lined.groupBy("ord", "bucket").agg(F.sum("size").alias("words"))
    sums = stored(_before(sums).select(F.col("ord").alias("b_ord"), F.col("bucket").alias("b_bucket"), "before"),
                  "mix-buckets")
    inside = Window.partitionBy("ord", "bucket").orderBy("h", "row").rowsBetween(Window.unboundedPreceding, 0)
    lined = lined.withColumn("upto", F.sum("size").over(inside)).join(
        sums, (F.col("ord") == F.col("b_ord")) & (F.col("bucket") == F.col("b_bucket")))
    start = F.col("before") + F.col("upto") - F.col("size")
    epochs = F.sequence(F.lit(0), F.lit(most - 1))
    fits = F.filter(epochs, lambda e: (F.col("size") > 0)
                    & (e * F.col("source_size") + start + F.col("size") <= F.round(F.col("target"))))
    places = F.transform(fits, lambda e: e * F.col("source_size") + start)
    lined = stored(lined.select("row", "doc_id", "size", "source", "source_size", "ord", "target", "h", "bucket",
                                places.alias("places")), "mix-places")
    lined = _fill_gaps(lined, most)

    block = lambda p: F.floor(p / block_words)
    quotas = lined.where(F.size("places") > 0).groupBy("ord").agg(
        (F.max(block(F.array_max("places"))) + 1).alias("blocks"))
    leaves = split_quotas(quotas, levels, seed)
    upto = F.sum("blocks").over(Window.partitionBy("ord").orderBy("shard"))
    runs = leaves.withColumn("upto", upto).where("blocks > 0").select(
        "shard", F.col("ord").alias("r_ord"),
        F.explode(F.sequence(F.col("upto") - F.col("blocks"), F.col("upto") - 1)).alias("r_block"))
    runs = stored(runs, "mix-runs")
    taken = lined.select("row", "h", "ord", F.posexplode("places").alias("epoch", "place")).withColumn(
        "block", block(F.col("place")).cast("bigint"))
    order = F.xxhash64(F.lit(seed + 1), "h", "epoch")
    dealt = taken.join(runs, (F.col("ord") == F.col("r_ord")) & (F.col("block") == F.col("r_block"))).groupBy(
        F.col("row").alias("d_row")).agg(F.sort_array(F.collect_list(
            F.struct("epoch", "shard", order.alias("place")))).alias("copies"))
    dealt = stored(dealt, "mix-copies")
    none = F.expr("cast(array() AS array<struct<epoch: int, shard: int, place: bigint>>)")
    return lined.join(dealt, F.col("row") == F.col("d_row"), "left").select(
        "row", "doc_id", "size", "source", "source_size", "target", F.coalesce("copies", none).alias("copies"))


def _fill_gaps(lined: DataFrame, most: int) -> DataFrame:
    """The line goes on behind the cut, over documents that fit what is left, until none does.

    A round leaves out the documents longer than their source's gap, and takes
    the others in the order of (copies so far, line) up to the gap; what is left
    then is shorter than the document the round ended at. A round that has
    documents takes one at least. Last, a source takes one document beyond its
    target where that is nearer.
    """
    used = F.coalesce(F.sum(F.col("size") * F.size("places")), F.lit(0))
    gaps = stored(lined.groupBy(F.col("ord").alias("g_ord")).agg(
        F.round(F.first("target")).cast("bigint").alias("goal"), used.cast("bigint").alias("used")), "mix-gaps")
    pool = lined.where("size > 0").select("row", "ord", "size", "h", "bucket", F.size("places").alias("n"))
    added = None
    while True:
        gap = F.col("goal") - F.col("used")
        room = pool.join(gaps, F.col("ord") == F.col("g_ord")).where((F.col("n") < most) & (F.col("size") <= gap))
        sums = room.groupBy("ord", "n", "bucket").agg(F.sum("size").alias("words"))
        sums = stored(_before(sums, "n").select(
            F.col("ord").alias("b_ord"), F.col("n").alias("b_n"), F.col("bucket").alias("b_bucket"), "before"),
            "mix-buckets")
        if sums.isEmpty():
            break
        inside = Window.partitionBy("ord", "n", "bucket").orderBy("h", "row").rowsBetween(Window.unboundedPreceding, 0)
        room = room.withColumn("upto", F.sum("size").over(inside)).join(
            sums, (F.col("ord") == F.col("b_ord")) & (F.col("n") == F.col("b_n")) & (F.col("bucket") == F.col("b_bucket")))
        end = F.col("before") + F.col("upto")
        room = stored(room.select("row", "ord", "size", "h", "bucket", "n", (end <= gap).alias("fits"),
                                  (F.col("used") + end - F.col("size")).alias("place")), "mix-room")
        taken = room.where("fits").select("row", "place")
        added = taken if added is None else added.unionByName(taken)
        more = room.where("fits").groupBy("ord").agg(F.sum("size").alias("more"))
        gaps = stored(gaps.join(more, F.col("g_ord") == F.col("ord"), "left").select(
            "g_ord", "goal", (F.col("used") + F.coalesce("more", F.lit(0))).alias("used")), "mix-gaps")
        pool = room.select("row", "ord", "size", "h", "bucket", (F.col("n") + F.col("fits").cast("int")).alias("n"))
    if added is not None:
        lined = _with_places(lined, added)

    gap = F.col("goal") - F.col("used")
    gained = gap - F.abs(gap - F.col("size"))
    room = lined.join(gaps, F.col("ord") == F.col("g_ord")).where(
        (F.size("places") < most) & (F.col("size") > 0) & (gained > 0))
    best = stored(room.groupBy("g_ord").agg(
        F.max(F.struct(gained.alias("gained"), "h", "row")).alias("best"), F.first("used").alias("place")).select(
            F.col("best.row").alias("row"), "place"), "mix-best")
    return lined if best.isEmpty() else _with_places(lined, best)


def _with_places(lined: DataFrame, added: DataFrame) -> DataFrame:
    """The lines with the places of ``added`` (row, place) behind their own, stored."""
    more = added.groupBy(F.col("row").alias("a_row")).agg(F.sort_array(F.collect_list("place")).alias("more"))
    return stored(lined.join(more, F.col("row") == F.col("a_row"), "left").withColumn(
        "places", F.when(F.col("more").isNull(), F.col("places")).otherwise(F.concat("places", "more"))).drop(
            "a_row", "more"), "mix-filled")


def draw(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents themselves, with the columns of ``docs``: each row as often as the mix takes it.

    Rows come out ordered by place inside each shard's partitions.
    """
    here = free_name(docs, "_row_here")
    rows = numbered(docs, here)
    row, copy = free_name(rows, "_row"), free_name(rows, "_copy")
    plan = mixture(rows, row_col=here, **options).where(F.size("copies") > 0).select(
        F.col("row").alias(row), F.explode("copies").alias(copy))
    mixed = rows.join(plan, F.col(here) == F.col(row))
    return mixed.sortWithinPartitions(f"{copy}.shard", f"{copy}.place").select(*[F.col(f"`{c}`") for c in docs.columns])


def taken_words(copies: Column, size: Column) -> Column:
    return (F.size(copies) * size).cast("bigint")
