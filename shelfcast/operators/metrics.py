"""Scores of predictions against sales."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from shelfcast.functions.rules import accuracy_flag, ape, round_pred


def add_scores(
    df: DataFrame, target: str, predicted: str = "predictions", *, round_values: bool = True
) -> DataFrame:
    """Rounded prediction with its ``MAPE`` (per row) and ``Accuracy``."""
    scored = df.withColumn(predicted, round_pred(predicted)) if round_values else df
    return scored.withColumns({"MAPE": ape(target, predicted), "Accuracy": accuracy_flag(target, predicted)})


def r_squared(target: Column | str, predicted: Column | str) -> Column:
    """Aggregate R2; total variation comes from the variance, which merges without cancellation."""
    y = F.col(target) if isinstance(target, str) else target
    p = F.col(predicted) if isinstance(predicted, str) else predicted
    both = y.isNotNull() & p.isNotNull()
    residual = F.sum(F.when(both, (y - p) * (y - p)))
    y = F.when(both, y)
    return F.lit(1.0) - F.try_divide(residual, F.var_pop(y) * F.count(y))


def forecast_r2(df: DataFrame, target: str, predicted: str) -> DataFrame:
    """R2 of the predictions as they are, unrounded."""
    return df.agg(r_squared(target, predicted).alias("r2"))


def forecast_metrics(
    df: DataFrame,
    target: str,
    predicted: str = "predictions",
    *,
    qty: str = "qty",
    min_qty: float = 3,
    round_values: bool = True,
) -> DataFrame:
    """MAPE and accuracy of rounded predictions over rows selling at least ``min_qty``, and R2.

    One pass; every figure is combined before the shuffle. R2 takes all rows, unrounded.
    """
    rounded = round_pred(predicted) if round_values else F.col(predicted)
    counted = F.col(qty) >= min_qty
    return df.agg(
        F.avg(F.when(counted, ape(target, rounded))).alias("MAPE_score"),
        F.avg(F.when(counted, accuracy_flag(target, rounded))).alias("Accuracy_score"),
        r_squared(target, predicted).alias("r2"),
    )


def accuracy_by_group(
    df: DataFrame, by: str, columns: Sequence[str], *, qty: str = "qty", above: float = 2
) -> DataFrame:
    """Mean of each accuracy column per group over rows selling more than ``above``."""
    kept = df.where((F.col(qty) > above) & F.col(by).isNotNull())
    return kept.groupBy(by).agg(*[F.avg(name).alias(name) for name in columns])


def inf_to_null(df: DataFrame) -> DataFrame:
    """Positive infinity becomes missing in every floating-point column."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns(
        {name: F.when(F.col(f"`{name}`") != float("inf"), F.col(f"`{name}`")) for name in names}
    )


def compare_models(
    df: DataFrame, predictions: Mapping[str, str], *, target: str = "new_qty", qty: str = "qty"
) -> DataFrame:
    """Detail rows with rounded predictions, ``<name>_MAPE`` and ``<name>_acc`` per model.

    ``predictions`` maps a model's name to its prediction column. The error is taken on
    ``target``, the accuracy on the raw quantity, as in the original comparison.
    """
    rounded = df.withColumns({column: round_pred(column) for column in predictions.values()})
    errors = inf_to_null(
        rounded.withColumns({f"{name}_MAPE": ape(target, column) for name, column in predictions.items()})
    )
    return errors.withColumns(
        {f"{name}_acc": accuracy_flag(qty, column) for name, column in predictions.items()}
    )


def comparison_means(compared: DataFrame, names: Sequence[str]) -> DataFrame:
    """Overall mean error and accuracy of each model, over all rows."""
    return compared.agg(
        *[F.avg(f"{name}_MAPE").alias(f"{name}_MAPE") for name in names],
        *[F.avg(f"{name}_acc").alias(f"{name}_acc") for name in names],
    )
