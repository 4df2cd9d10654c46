from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest

from shelfcast.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    said = [(i, terms(t)) for i, t in docs]
    n_docs, n_terms = sum(bool(t) for _, t in said), sum(len(t) for _, t in said)
    out = []
    for item, text in items:
        scores = {}
        for term in set(terms(text)):
            tfs = [t.count(term) for _, t in said]
            df = sum(tf > 0 for tf in tfs)
            w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
            for at, tf in enumerate(tfs):
                if tf:
                    m = 50 + (50 * len(said[at][1]) * n_docs) // n_terms
                    scores[at] = scores.get(at, 0) + w * ((10**9 * tf) // (1000 * tf + 20 * m))
        ranked = sorted((-s, said[at][0] is None, said[at][0] or 0, at) for at, s in scores.items() if s > 0)[:k]
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i, _) in enumerate(ranked)]
    return sorted(out, key=str)


def answer(spark, docs, items, k=50):
    d = spark.createDataFrame([(i, t, "r", 1, "w") for i, t in docs], "doc_id long, text string, row string, n int, word string")
    q = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, id string")
    got = lexical.rank(d, q, k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def corpus(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(200)]
    weights = [1 / (i + 1) for i in range(200)]
    return [(i, " ".join(rng.choices(words, weights, k=rng.randint(0, 60)))) for i in range(n)]


@pytest.mark.parametrize("slice_rows", [1_000_000, 500])
def test_equals_brute_force(spark, monkeypatch, slice_rows):
    monkeypatch.setattr(lexical, "SLICE", slice_rows)
    monkeypatch.setattr(lexical, "WINDOW", 16)
    docs = corpus(400, 1)
    items = [(i, t) for i, t in corpus(30, 2)]
    assert answer(spark, docs, items, 7) == brute(docs, items, 7)


def test_groups_of_items_and_shuffled_joins(spark, monkeypatch):
    monkeypatch.setattr(lexical, "GROUP_TERMS", 40)
    monkeypatch.setattr(lexical, "BROADCAST_ROWS", 0)
    docs, items = corpus(150, 3), corpus(20, 4)
    assert answer(spark, docs, items, 5) == brute(docs, items, 5)


def test_nulls_ties_repeats_and_long_texts(spark):
    docs = [(1, "Red fox"), (1, "Red fox"), (None, "red FOX"), (2, None), (3, ""), (4, "... !"), (5, "Straße ÉTÉ fox"), (6, "fox " * 200_000)]
    docs += [(i, "red fox again") for i in range(100, 200)]
    items = [(1, "fox!"), (2, "été ÉTÉ straße"), (2, "red red"), (None, "again"), (3, None), (4, ""), (5, "absent")]
    assert answer(spark, docs, items, 5) == brute(docs, items, 5)


def test_empty_tables(spark):
    assert answer(spark, [], [(1, "a")]) == []
    assert answer(spark, [(1, "a")], []) == []
    assert answer(spark, [(1, None)], [(1, "a")]) == []


def test_hybrid_equals_full_sums():
    rng = np.random.default_rng(5)
    for _ in range(200):
        n = int(rng.integers(1, 3000))
        lists = []
        for _ in range(int(rng.integers(1, 12))):
            docs = np.flatnonzero(rng.random(n) < rng.random() ** 3)
            lists.append((docs, rng.integers(1, int(rng.integers(2, 1000)), size=len(docs))))
        whole = np.zeros(n, dtype=np.int64)
        for docs, parts in lists:
            whole[docs] += parts
        k = int(rng.integers(1, 60))
        order = sorted((-s, d) for d, s in enumerate(whole) if s > 0)[:k]
        found, scores = lexical.hybrid(lists, k)
        assert [(-s, d) for s, d in zip(scores, found)] == order


def test_long_lists_are_skipped(monkeypatch):
    """A rare term with a large part settles the result; the long list proposes nothing after that."""
    summed = []
    plain = lexical._sum
    monkeypatch.setattr(lexical, "_sum", lambda docs, parts: summed.append(len(docs)) or plain(docs, parts))
    rare = (np.arange(0, 100_000, 1000), np.full(100, 1000))
    common = (np.arange(100_000), np.full(100_000, 3))
    docs, scores = lexical.hybrid([rare, common], 10)
    assert docs.tolist() == list(range(0, 10_000, 1000)) and set(scores) == {1003}
    assert sum(summed) < 1000
