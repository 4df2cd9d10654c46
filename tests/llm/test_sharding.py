from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import sharding


def spread(sizes, labels, parts):
    sums = np.bincount(labels, weights=sizes, minlength=parts)
    return sums.max() - sums.min()


def test_differencing_balances():
    dice = np.random.default_rng(1)
    for n, parts in ((1, 3), (2, 2), (5, 8), (400, 7), (2000, 40)):
        sizes = dice.lognormal(6, 1.5, n).astype(np.int64)
        labels = sharding.difference(sizes, parts)
        assert labels.min() >= 0 and labels.max() < parts
        if n >= 400:
            greedy = np.zeros(parts)
            for s in sorted(sizes, reverse=True):
                greedy[greedy.argmin()] += s
            assert spread(sizes, labels, parts) <= greedy.max() - greedy.min()
    # The textbook case: 8 7 6 5 4 in two parts differ by 2 after differencing.
    assert spread(np.array([8, 7, 6, 5, 4]), sharding.difference(np.array([8, 7, 6, 5, 4]), 2), 2) == 2
    assert len(sharding.difference(np.zeros(0, dtype=np.int64), 4)) == 0


def plain_difference(sizes, parts):
    """Differencing on whole lists of parts, each with the places of its items."""
    heap = [(-s, i, [(s, [i])] + [(0, [])] * (parts - 1)) for i, s in enumerate(map(int, sizes))]
    number = len(heap)
    while len(heap) > 1:
        heap.sort(key=lambda h: h[:2])
        (_, _, a), (_, _, b), *heap = heap
        merged = sorted(((x + y, p + q) for (x, p), (y, q) in zip(a, b[::-1])), key=lambda t: -t[0])
        heap.append((merged[-1][0] - merged[0][0], number, merged))
        number += 1
    out = [0] * len(sizes)
    for part, (_, places) in enumerate(heap[0][2]):
        for place in places:
            out[place] = part
    return out


def test_differencing_equals_the_plain_form():
    dice = np.random.default_rng(2)
    for n, parts in ((1, 1), (3, 1), (6, 2), (9, 4), (30, 7), (30, 50), (60, 16)):
        sizes = dice.integers(1, 40, n)
        assert sharding.difference(sizes, parts).tolist() == plain_difference(sizes, parts)


def test_many_shards(spark):
    sizes = F.expr("CAST(16 + pmod(xxhash64(id), 5000) AS LONG)")
    groups = spark.range(20_000).select(F.col("id").cast("string").alias("item"), sizes.alias("bytes"))
    for parts in (5000, 2500):
        rows = sharding.assign_groups(groups, parts, 500).join(groups, "item").toPandas()
        assert len(rows) == 20_000 and rows["item"].is_unique and rows["shard"].between(0, parts - 1).all()
        sums = rows.groupby("shard")["bytes"].sum()
        assert len(sums) == parts and sums.max() < 2 * sums.mean()


@pytest.mark.parametrize("cell_items", [4000, 600])
def test_groups_over_cells(spark, cell_items):
    sizes = F.expr("CAST(16 + pmod(xxhash64(id), 5000) AS LONG)")
    groups = spark.range(3000).select(F.col("id").cast("string").alias("item"), sizes.alias("bytes"))
    heavy = spark.createDataFrame([("heavy", 2_000_000)], "item string, bytes long")
    rows = sharding.assign_groups(groups.unionByName(heavy), 16, cell_items).join(groups.unionByName(heavy), "item").toPandas()
    assert len(rows) == 3001 and rows["item"].is_unique
    sums = rows.groupby("shard")["bytes"].sum().sort_values()
    assert len(sums) == 16 and sums.iloc[-1] == 2_000_000  # the heavy group stands alone
    assert sums.iloc[-2] - sums.iloc[0] <= 0.01 * sums.iloc[0]


def test_rows_of_every_kind(spark):
    texts = ["same"] * 40 + [None, None, "", "", "é" * 10, "x" * 200_000] + [f"t{i}" * (i % 9) for i in range(60)]
    frame = spark.createDataFrame([(i // 2 if i else None, t, 5) for i, t in enumerate(texts)], "doc_id long, text string, shard int")
    rows = sharding.shard(frame, 8, rows_per_slot_run=5).toPandas()
    assert len(rows) == len(texts)
    sizes = sorted(len((t or "").encode()) + 16 for t in texts)
    assert sorted(rows["size"]) == sizes
    assert sorted(rows.text_crc32) == sorted(zlib.crc32((t or "").encode()) for t in texts)
    for _, own in rows.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))
    same = rows[rows.text_crc32 == zlib.crc32(b"same")]
    assert same.shard.nunique() == 1 and len(same) == 40
    assert set(rows.law) == {"bytes"} and rows.grown_shard.isna().all() and set(rows.shard) <= set(range(8))


def test_empty_table(spark):
    assert sharding.shard(spark.createDataFrame([], "doc_id long, text string")).collect() == []
