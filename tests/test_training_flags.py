"""Models of the registered queries are fitted on the true range flags of their history."""

from __future__ import annotations

import importlib
import os

import pytest
from pyspark.sql import functions as F

from shelfcast import standins as fx
from shelfcast.functions.dates import parse_ymd
from shelfcast.operators import models, scoring

# The package has a function of the same name.
catalog = importlib.import_module("shelfcast.catalog.queries")
SF = os.environ.get("SHELFCAST_TEST_SF", "/root/testdata/sf0.001")


class Fitted(Exception):
    pass


def flags(table):
    return tuple(table.agg(F.sum("out_of_range"), F.count("*")).first())


def test_history_keeps_its_range_flag(spark, monkeypatch):
    seen = {}

    def each(parts, *args, **options):
        seen["clusters"] = [flags(part) for part in parts.values()]
        raise Fitted

    def one(history, *args, **options):
        seen["one"] = flags(history)
        raise Fitted

    monkeypatch.setattr(models, "train_each", each)
    monkeypatch.setattr(models, "train", one)
    with pytest.raises(Fitted):
        catalog.score_by_cluster(spark, SF)
    with pytest.raises(Fitted):
        catalog.compare_fitted(spark, SF)
    table = catalog._training_table(spark, SF).select("t_date", "cluster", "out_of_range")
    before = lambda day: F.col("t_date") < F.lit(parse_ymd(day))
    want = flags(table.where(before(fx.SCORING_AS_OF) & F.col("cluster").isin(*scoring.CLUSTERS)))
    assert tuple(map(sum, zip(*seen["clusters"]))) == want and want[0] > 0
    assert seen["one"] == flags(table.where(before(fx.TRAIN_END)))
