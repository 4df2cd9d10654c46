from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import topk
from shelfcast.llm.vectors import fixed_point

SCHEMA = "vec_id long, embedding array<float>, row string, id string, x int"


def brute(rows, k, scale=256, every=50):
    """Rows are (id, vector); the answer of every query row as a list of (id, rank, other id, score)."""
    whole = [(i, [math.floor(scale * float(np.float32(c))) for c in v]) for i, v in rows]
    out = []
    for at, (i, q) in enumerate(whole):
        if i is None or i % every:
            continue
        scores = [(-sum(a * b for a, b in zip(q, x)), j is None, j or 0, place) for place, (j, x) in enumerate(whole) if place != at]
        out += [(i, r + 1, None if none else j, -s) for r, (s, none, j, _) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], "r", "i", 3) for i, v in rows], SCHEMA)


def answer(spark, rows, **options):
    got = topk.top_k(frame(spark, rows), F.col("vec_id") % 50 == 0, **options)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("spread", [0.0, 2.0])
def test_equals_brute_force(spark, spread):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=12) * np.exp(spread * rng.normal())) for i in range(600)]
    assert answer(spark, rows) == brute(rows, 5)


def test_groups_and_slices_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6) * (1 + i % 7)) for i in range(500)]
    monkeypatch.setattr(topk, "GROUP_BYTES", 3 * 6 * 8)  # three queries a group
    monkeypatch.setattr(topk, "SLICE_ROWS", 40)
    monkeypatch.setattr(topk, "SEEDS", 8)
    assert answer(spark, rows, k=3) == brute(rows, 3)


def test_ties_copies_and_few_rows(spark):
    rng = np.random.default_rng(3)
    few = rng.normal(size=(3, 4))
    rows = [(i, few[0] if i % 3 else few[i % 2]) for i in range(300)]  # a very common vector
    rows += [(50, few[2]), (50, few[2]), (None, few[2])]
    assert answer(spark, rows) == brute(rows, 5)
    assert answer(spark, [(0, [1.0, 2.0]), (1, [0.5, 0.0])]) == [(0, 1, 1, 128 * 256)]
    assert answer(spark, [(0, [1.0, 2.0])]) == []


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1, 1]), (1, None), (2, [1, None]), (3, [1, float("nan")]), (4, [float("inf"), 1]), (5, [1]), (6, []), (7, [0, 1]), (50, [3e38, 1])]
    assert answer(spark, rows) == [(0, 1, 7, 65536)]
    assert answer(spark, [(0, None), (1, [])]) == []
    assert answer(spark, []) == []


def test_large_scores_are_exact(spark):
    rows = [(0, [2.0**40, 1.0]), (1, [2.0**4, 1.0]), (2, [2.0**40, 3.0]), (3, [-(2.0**40), 0.0])]
    got = answer(spark, rows)
    assert got == [(0, 1, 2, 2**63 - 1), (0, 2, 1, 2**48 * 2**12 + 65536), (0, 3, 3, -(2**63))]


def test_search_prunes_by_length():
    """Rows behind the first chunk are not looked at once no query can use them."""
    rng = np.random.default_rng(4)
    rows = rng.integers(-50, 50, size=(4 * topk.CHUNK, 8))
    rows[: topk.CHUNK] *= 1000
    seen = []
    query = rows[:1]

    def same(i, j):
        seen.extend(j)
        return j == 0

    best = topk.search(query, np.full(1, -np.inf), rows, same, np.eye(8), 5)
    scores = rows @ query[0]
    want = sorted((-s, j) for j, s in enumerate(scores) if j)[:5]
    assert [(-s, j) for s, j in zip(best.score, best.place)] == want
    assert max(seen) < topk.CHUNK


def test_fixed_point_floors():
    import pyarrow as pa

    at, x = fixed_point(pa.array([[0.5, -0.001], None, [1.0, 2.0]], pa.list_(pa.float32())), 2, 256)
    assert at.tolist() == [0, 2] and x.tolist() == [[128, -1], [256, 512]]
