from __future__ import annotations

import numpy as np
import pytest

from shelfcast.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, n long, at string, part int"


def table(spark, rows, parts=3):
    data = [(i, None if v is None else [None if c is None else float(c) for c in v], 1, "a", 2) for i, v in rows]
    return spark.createDataFrame(data, SCHEMA).repartition(parts)


def check(spark, rows, taking, components=8, **options):
    got = whitening.whiten(table(spark, rows), components, **options).toPandas().sort_values(["component", "vec_id"])
    x = np.floor(1024 * np.array([v for _, v in taking], dtype=np.float32).astype(float)).astype(np.int64) + 100_000
    ids = [i for i, _ in taking]
    n, width = len(x), min(components, x.shape[1])
    assert got.vec_id.tolist() == ids * width and (got.n == n).all()
    moved = n * x - x.sum(axis=0)
    assert got.deviation.tolist() == [int(d) for d in (moved.astype(object) ** 2).sum(axis=1)] * width
    centred = moved / n
    v = centred.T @ centred / n
    values, axes = np.linalg.eigh(v)
    for c in range(width):
        rows_of = got[got.component == c + 1]
        want = centred @ axes[:, -1 - c] / np.sqrt(values[-1 - c])
        found = rows_of.whitened.to_numpy()
        assert np.allclose(found * np.sign(found @ want), want, atol=1e-9)
        assert rows_of.explained.iloc[0] == pytest.approx(values[-1 - c] / np.trace(v), rel=1e-9)
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9


@pytest.mark.parametrize("n,block", [(300, 32), (90, 1024)])
def test_equals_dense_algebra(spark, monkeypatch, n, block):
    monkeypatch.setattr(whitening, "BLOCK", block)
    rng = np.random.default_rng(1)
    mix = rng.normal(size=(12, 12))
    rows = [(i, rng.normal(size=12) @ mix) for i in range(n)]
    check(spark, rows, rows)


def test_fewer_entries_than_components_and_rows_left_out(spark):
    rng = np.random.default_rng(2)
    good = [(i, rng.normal(size=3)) for i in range(40)]
    bad = [(100, None), (101, [1, None, 2]), (102, [float("nan"), 1, 2]), (103, [1, float("-inf"), 2]), (104, [1, 2]), (105, []), (106, [3e38, 0, 0])]
    check(spark, good + bad, good)


def test_repeated_rows_and_null_ids(spark):
    rng = np.random.default_rng(3)
    rows = [(7, rng.normal(size=4))] * 5 + [(i, rng.normal(size=4)) for i in range(10)] + [(None, rng.normal(size=4))]
    got = whitening.whiten(table(spark, rows)).toPandas()
    assert len(got) == 16 * 4 and got.vec_id.isna().sum() == 4
    same = got[(got.vec_id == 7) & (got.component == 1)].whitened.round(9)
    assert sorted(same.value_counts()) == [1, 5]


def test_no_variance(spark):
    got = whitening.whiten(table(spark, [(1, [1, 2]), (2, [1, 2])])).toPandas()
    assert len(got) == 4 and got.whitened.isna().all() and got.explained.isna().all()
    assert (got.deviation == 0).all() and (got.identity_error == 0).all()
    line = whitening.whiten(table(spark, [(i, [float(i), 5.0]) for i in range(9)])).toPandas()
    assert line[line.component == 2].whitened.isna().all() and line[line.component == 1].whitened.notna().all()
    assert line.identity_error.max() < 1e-9


def test_empty(spark):
    for rows in ([], [(1, None)], [(1, [])]):
        got = whitening.whiten(table(spark, rows))
        assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert got.count() == 0
