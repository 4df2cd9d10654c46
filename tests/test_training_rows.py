"""Training queries store what they read and nothing else; their rows are those made of the whole tables."""

from __future__ import annotations

import importlib

from shelfcast import standins as fx
from shelfcast.operators import checks, models, outliers
from shelfcast.plans import pipeline
from shelfcast.sources.schemas import CLUSTER_MODEL_COLUMNS, TRAINING_COLUMNS
from tests.test_training_flags import SF

catalog = importlib.import_module("shelfcast.catalog.queries")


def rows(table):
    return sorted(map(str, table.collect()))


def test_a_fit_gets_the_rows_of_the_whole_table(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(models, "train", lambda table, *args, **options: seen.append(table))
    monkeypatch.setattr(models, "feature_importances", lambda model, spark: None)
    catalog.train_model(spark, SF)
    wanted = [*CLUSTER_MODEL_COLUMNS, "new_qty"]
    assert seen[0].columns == wanted
    whole = checks.project(catalog._split(catalog._training_table(spark, SF))[0], wanted)
    assert rows(seen[0]) == rows(whole) and whole.count() > 0


def test_an_evaluation_gets_the_columns_that_it_carries(spark, monkeypatch):
    seen, train_cluster = [], pipeline.train_cluster

    def watched(flagged, sites, coded, holidays, **options):
        seen.append((flagged, sites, coded, holidays))
        return train_cluster(flagged, sites, coded, holidays, **options)

    monkeypatch.setattr(pipeline, "train_cluster", watched)
    monkeypatch.setattr(models, "train_and_evaluate", lambda table, *args, **options: models.Evaluation(None, table, None))
    table = catalog.train_and_evaluate(spark, SF)
    flagged, *rest = seen[0]
    assert not {"days_sold_range", "sales_vol_percent", "description"} & set(flagged.columns)
    sold = pipeline.training_sales(
        fx.daily_sales(spark, SF), fx.clusters(spark, SF), catalog._quarters(spark, SF), fx.TRAIN_START, fx.TEST_END
    )
    whole = pipeline.training_table(outliers.flag_outliers(sold), *rest)
    carried = [name for name in TRAINING_COLUMNS if name in whole.columns]
    assert [name for name in TRAINING_COLUMNS if name in table.columns] == carried and "in_range_mean" in carried
    assert rows(checks.project(table, carried)) == rows(checks.project(whole, carried))
