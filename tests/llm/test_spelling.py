"""Spelling variants against plain Python."""

import random
import re
import zlib
from collections import Counter

import pyarrow.parquet as pq
import pytest

from ledgerline.llm import spelling
from ledgerline.llm.queries import LLM_QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, word string, n int, form string, near string"


def plain_counts(rows, slip_every=None, least_length=6, least_count=5):
    out = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in run)
            if slip_every:
                h = zlib.crc32(f"{'' if key is None else key}:{word}".encode())
                if h % slip_every == 0:
                    word = word[:h % len(word)] + word[h % len(word) + 1:]
            out[word] += 1
    return {w: n for w, n in out.items() if len(w) >= least_length and n >= least_count}


def one_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]


def plain(rows, ratio=5, **options):
    n = plain_counts(rows, **options)
    forms, near = {}, {}
    for w in n:
        others = [o for o in n if one_apart(w, o)]
        near[w] = len(others)
        best = min(others, key=lambda o: (-n[o], o), default=None)
        if best is not None and n[best] >= ratio * n[w]:
            forms[w] = best
    out = []
    for w in n:
        root = w
        while root in forms:
            root = forms[root]
        out.append((w, forms.get(w), root, n[w], near[w], n[forms[w]] if w in forms else None))
    return sorted(out, key=repr)


def run(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, "x", 1, "y", "z") for i, t in rows], SCHEMA)
    return sorted((tuple(r) for r in spelling.variants(docs, **options).collect()), key=repr)


def test_near_words_are_all_pairs_one_apart(spark):
    r = random.Random(3)
    pool = {"".join(r.choice("ab") for _ in range(r.randint(6, 9))) for _ in range(260)}  # few bigrams, many repeats
    pool |= {"".join(r.choice("abcdeé÷") for _ in range(r.randint(6, 8))) for _ in range(150)}
    for word in r.sample(sorted(pool), 120):  # slips at every place, the ends included
        i = r.randrange(len(word))
        pool |= {word[:i] + word[i + 1:], word[:i] + r.choice("xyz") + word[i:], word[:i] + "q" + word[i + 1:], word + "w"}
    pool = {w for w in pool if len(w) >= 6}
    found = spelling.near_words(spark.createDataFrame([(w,) for w in pool], "word string"))
    assert {tuple(x) for x in found.collect()} == {(a, b) for a in pool for b in pool if one_apart(a, b)}


def test_pivots_are_the_lightest_disjoint_pair():
    r = random.Random(4)
    for _ in range(500):
        word = "".join(r.choice("abcd") for _ in range(r.randint(5, 12)))
        grams = sorted({word[i:i + 2] for i in range(len(word) - 1)}, key=lambda g: r.random())
        order = {g: k for k, g in enumerate(grams)}
        weight = sorted(r.randint(1, 50) for _ in grams)
        pre = spelling.prefix(word, order)
        p, q = spelling.pivots(pre, weight)
        rank = {at: g for g, at in pre}
        assert q >= p + 2 and len(pre) >= 3
        assert weight[rank[p]] + weight[rank[q]] == min(
            weight[a] + weight[b] for a, i in pre for b, j in pre if j >= i + 2)


def test_variants_equal_plain_python(spark):
    r = random.Random(5)
    base = ["colour", "harbour", "ledgers", "Straße", "naïveté", "zzzzzz"]
    rows = []
    for i in range(300):
        words = []
        for _ in range(30):
            w = r.choice(base)
            if r.random() < 0.25:
                k = r.randrange(len(w))
                w = w[:k] + r.choice(["", "x", w[k] * 2, "É"]) + w[k + 1:]
            words.append(w.upper() if r.random() < 0.1 else w)
        rows.append((i % 250, r.choice([" ", "-", "9", "\n"]).join(words)))
    rows += [(None, "colour colours " * 40), (900, None), (901, ""), (902, " 12 \t"), (903, "harbour " * 20000), (5, rows[5][1])]
    for options in ({}, {"slip_every": 7}, {"slip_every": 7, "ratio": 2}):
        assert run(spark, rows, **options) == plain(rows, **options)
    chain = [(1, "aaaaaa " * 5 + "aaaaab " * 25 + "aaaabb " * 125 + "aaabbb " * 625 + "aabbbb " * 3125)]
    found = run(spark, chain)
    assert found == plain(chain) and {x[2] for x in found} == {"aabbbb"}


def test_counts_do_not_depend_on_how_words_are_held(spark, monkeypatch):
    rows = [(i, "repeated repeated wording") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    monkeypatch.setattr(spelling, "HELD_WORDS", 1)
    assert {tuple(r) for r in spelling.word_counts(docs).collect()} == {("repeated", 80), ("wording", 40)}


def test_empty_tables(spark):
    assert run(spark, []) == [] and run(spark, [(1, None), (2, "short words")]) == []
    with pytest.raises(ValueError):
        run(spark, [], ratio=1)


def test_query_equals_plain_python_over_the_whole_table(spark):
    t = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    found = sorted((tuple(r) for r in LLM_QUERIES["op12_pivotal_spelling"](spark, SF).select(
        "word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)
    assert found == plain(list(zip(t["doc_id"], t["text"])), slip_every=199) and len(found) > 500
