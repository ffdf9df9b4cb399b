"""The Jaccard join against all pairs in plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from ledgerline.llm import jaccard
from ledgerline.llm.queries import LLM_QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, node bigint, n int, label string, key string, h int"


def shingles(text, words=3):
    w = [x for x in re.split("[\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or "")) if x]
    return {tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def plain(rows, percent=90, words=3):
    sets = [frozenset(shingles(t, words)) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    order = sorted(range(len(rows)), key=lambda i: len(sets[i]))
    for k, i in enumerate(order):
        for j in order[k + 1:]:
            if len(sets[i]) * 100 < percent * len(sets[j]):
                break
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return sorted(((key, len(s), least.get(find(i))) for i, ((key, _), s) in enumerate(zip(rows, sets))), key=repr)


def run(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, 1, 2, "x", "y", 3) for i, t in rows], SCHEMA)
    return sorted((tuple(r) for r in jaccard.linked(docs, **options).collect()), key=repr)


def text(r, n, letters="abcdefghij"):
    return " ".join("".join(r.choice(letters) for _ in range(r.randint(2, 6))) for _ in range(n))


def edited(r, base, share):
    w = base.split(" ")
    for i in r.sample(range(len(w)), int(share * len(w))):
        w[i] = "".join(r.choice("klmnop") for _ in range(6))
    return " ".join(w)


def family(seed, groups=12):
    """Texts around the threshold: edits, cuts and additions of every size, over a passage that all share."""
    r = random.Random(seed)
    common, rows = text(r, 40), []
    for _ in range(groups):
        base = text(r, r.choice([9, 11, 12, 14, 21, 40, 90, 250, 700])) + r.choice(["", " " + common])
        n = len(base.split(" "))
        for _ in range(r.randint(3, 9)):
            kind = r.random()
            if kind < 0.5:
                rows.append(edited(r, base, r.choice([0, 0.005, 0.01, 0.015, 0.02, 0.03])))
            elif kind < 0.75:
                rows.append(" ".join(base.split(" ")[r.randint(0, max(1, n // 9)):]))
            else:
                rows.append(base + " " + text(r, r.randint(1, max(1, n // 9))))
    return [(i, t) for i, t in enumerate(r.sample(rows, len(rows)))]


@pytest.mark.parametrize("limits", [(8, 256), (1, 3), (2, 2)])
def test_components_equal_all_pairs(spark, monkeypatch, limits):
    # low limits make pairs and triples of nearly all tokens of a small table
    monkeypatch.setattr(jaccard, "SINGLE_UPTO", limits[0])
    monkeypatch.setattr(jaccard, "PAIRS_UPTO", limits[1])
    rows = family(limits[1], 40)
    expected = plain(rows)
    assert len({c for _, _, c in expected}) < 0.8 * len(rows)
    assert run(spark, rows) == expected


def test_exactly_at_the_threshold(spark):
    r = random.Random(9)
    rows = []
    for n in (9, 10, 18, 19, 27, 38, 90, 91, 189, 190):  # n of n + k tokens: 9 of 10 links, 8 of 9 does not
        base = text(r, n + 2, "abcdefghijklmnopqrstuvwxyz")
        rows += [(len(rows), base), (len(rows) + 1, base + " " + text(r, -(-n // 9), "uvwxyz")),
                 (len(rows) + 2, base + " " + text(r, n // 9 + 1, "uvwxyz"))]
    expected = plain(rows)
    assert run(spark, rows) == expected


def test_edges(spark):
    long = text(random.Random(1), 20_000)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "oNE  two"), (6, "one two three"), (7, "one"), (8, long),
            (9, long + " more"), (None, long), (None, None), (None, "only here, once"), (6, "one two three"), (8, long),
            (-3, "one"), (10, "ÄÖ Ü 漢字"), (11, "äö ü 漢字")]
    assert run(spark, rows) == plain(rows)
    assert run(spark, []) == [] and run(spark, [(1, None)]) == [(1, 0, 1)]
    with pytest.raises(ValueError):
        run(spark, [], percent=50)


def test_one_large_group_of_near_copies(spark):
    r = random.Random(7)
    base = text(r, 200)
    rows = [(i, edited(r, base, r.choice([0.005, 0.01, 0.02]))) for i in range(250)] + [(900 + i, base) for i in range(50)]
    assert run(spark, rows) == plain(rows)


def test_tokens_are_the_distinct_runs():
    texts = ["a b c a b c a", "A b\tC", "a b", "", "x y z w", " a  b "]
    token, owner = jaccard.tokens(pa.array(texts), 3)
    assert np.bincount(owner, minlength=6).tolist() == [len(shingles(t)) for t in texts]
    of = [set(token[owner == i].tolist()) for i in range(6)]
    assert of[1] <= of[0] and of[2] == of[5] and not of[2] & of[0] and not of[4] & of[0]
    again, _ = jaccard.tokens(pa.array(["q", *texts]).slice(1), 3)
    assert again.tolist() == token.tolist()


@pytest.mark.parametrize("seed", range(4))
def test_linked_sets_share_a_key(seed):
    """Any order and classes: sets at the threshold have a key in common, the quarter being enough or not."""
    r = random.Random(seed)
    for _ in range(150):
        n = r.choice([9, 10, 12, 17, 31, 32, 33, 60, 129, 300, 900])
        pool = [r.getrandbits(63) - (r.getrandbits(1) << 63) for _ in range(n + n // 9 + 2)]
        x = set(pool[:n])
        y = set(pool[:n])
        for _ in range(n):  # change y as long as the two link
            z = set(y)
            z.discard(r.choice(sorted(z))) if r.random() < 0.5 else z.add(r.choice(pool))
            if 100 * len(x & z) < 90 * len(x | z):
                continue
            y = z
        counts = {t: r.choice([2, 5, 9, 40, 300, 5000]) for t in x | y}
        keys = []
        for s in (x, y):
            held = np.array(sorted(s), np.int64)
            early = [t for t in s if t & jaccard.QUARTER == 0]
            own = len(s - (x & y))
            line = [(counts[t], t) for t in early if t in x and t in y]
            keys.append(set(jaccard.combos(len(s), own, line, held, 90)))
            assert own <= len(s) // 10
        assert keys[0] & keys[1]


def test_query_equals_all_pairs_over_the_whole_table(spark):
    t = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    found = sorted((tuple(r) for r in LLM_QUERIES["op13_combination_jaccard"](spark, SF).select(
        "doc_id", "n_shingles", "component_id").collect()), key=repr)
    assert found == plain(list(zip(t["doc_id"], t["text"])))
