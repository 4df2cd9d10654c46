from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from shelfcast.llm import simhash
from shelfcast.llm.components import components


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def slow_components(values):
    """The least value reachable over links of at most two bits."""
    values = sorted(values)
    root = {v: v for v in values}
    changed = True
    near = [(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if ((a ^ b) & (2**64 - 1)).bit_count() <= 2]
    while changed:
        changed = False
        for a, b in near:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                changed = True
    return {v: r for v, r in root.items() if any(v in pair for pair in near)}


@pytest.fixture(scope="module")
def clustered():
    """Chains and balls of fingerprints a bit or a few apart, and lone ones."""
    dice = random.Random(5)
    values = {dice.getrandbits(64) for _ in range(150)}
    for centre in list(values)[:12]:
        x = centre
        for _ in range(12):
            x ^= 1 << dice.randrange(64)
            values.add(x)
            values.add(centre ^ (1 << dice.randrange(64)) ^ (1 << dice.randrange(64)) ^ (1 << dice.randrange(64)))
    return [simhash._signed(v) for v in values]


def test_fingerprints_match_the_definition():
    texts = [None, "", " \n", "One", "one TWO", "a b c", "Ünï ÀB\x0bc d e f g", "x " * 50, "a b c d " * 30 + "É"]
    assert [simhash.fingerprint(t) for t in texts] == [slow_fingerprint(t) for t in texts]


def test_index_finds_all_pairs(clustered):
    prints = np.array(sorted(clustered), dtype=np.int64).view(np.uint64)
    rank = prints.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    prints = prints[np.argsort(rank)]
    got = {(int(a), int(b)) for i, j in simhash.linked_pairs(prints) for a, b in zip(i, j)}
    want = {
        (a, b)
        for a in range(len(prints))
        for b in range(a + 1, len(prints))
        if (int(prints[a]) ^ int(prints[b])).bit_count() <= 2
    }
    assert got == want and want


@pytest.mark.parametrize("max_members", [10_000, 1])
def test_links_keep_components_whole(spark, clustered, max_members):
    frame = spark.createDataFrame([(v,) for v in clustered], "print long")
    got = {r.node: r.component for r in components(simhash.links(frame, max_members)).collect()}
    assert got == slow_components(clustered)


def test_rows_of_every_kind(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    text = "the quick brown fox jumps over the lazy dog and runs away from there"
    rows = [(5, text), (3, text), (3, text), (None, text), (9, None), (8, ""), (1, long), (None, "alone it stands here now")]
    frame = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, print int, component string")
    got = sorted(map(tuple, simhash.near_duplicates(frame).collect()), key=str)
    zero = "0" * 16
    hexed = lambda t: f"{slow_fingerprint(t):016x}"
    want = [(i, hexed(text), 3) for i in (5, 3, 3, None)] + [(9, zero, 8), (8, zero, 8), (1, hexed(long), 1)]
    want.append((None, hexed("alone it stands here now"), None))
    assert got == sorted(want, key=str)
    kept = simhash.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id, r.text) for r in kept.where("doc_id IS NOT NULL").collect()) == [(1, long), (3, text), (8, "")]
    assert kept.count() == 4


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(frame).collect() == []
    assert simhash.keep_one(frame).collect() == []


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 30)]
    frame = spark.createDataFrame(path + star + [(7, 7)], "a long, b long")
    got = {r.node: r.component for r in components(frame).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}
    assert components(frame.where("a = b")).collect() == []
