"""Every registered query with a SQL counterpart, on the smallest test data."""

from __future__ import annotations

import os

import pytest

from shelfcast.catalog import oracle_sql, queries
from tests.compare import connect, differences

SF = os.environ.get("SHELFCAST_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    got = queries()[name](spark, SF).toPandas()
    assert differences(got, duck.sql(oracle_sql()[name]).df()) is None
    assert len(got) > 0


def test_fitted_models_beat_the_mean(spark):
    """The registered training run as it is: R2 on the test rows, and the scores from the predictions."""
    rows = queries()["train_and_evaluate"](spark, SF).toPandas()
    assert len(rows) > 0 and rows.predictions.notna().all()
    error = ((rows.new_qty - rows.predictions) ** 2).sum()
    assert error < ((rows.new_qty - rows.new_qty.mean()) ** 2).sum()
    assert (rows.MAPE - (rows.new_qty - rows.predictions).abs() / rows.new_qty).abs().max() < 1e-9


def test_importances_add_up(spark):
    found = queries()["train_model"](spark, SF).toPandas()
    assert found.feature.is_unique and abs(found.importance.sum() - 1) < 1e-6


def test_two_fitted_models(spark):
    rows = queries()["compare_fitted"](spark, SF).toPandas()
    assert len(rows) == queries()["feature_table"](spark, SF).count()
    assert rows[["first_prediction", "second_prediction"]].notna().all().all()
