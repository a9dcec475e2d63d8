"""Ranking of predictions and comparison with the market."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickfold.config import TARGET
from tickfold.functions.columns import running_product


def rank_predictions(predictions: DataFrame, n: int) -> DataFrame:
    """The ``n`` best predictions per date with their ``rank``; equal predictions by ticker.

    Spark keeps only ``n`` rows per date and task before the shuffle, so a month with any number of names is cheap.
    """
    best = Window.partitionBy("date").orderBy(F.col("predictions").desc_nulls_last(), F.col("ticker"))
    return predictions.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n)


def top_predictions(predictions: DataFrame, n: int) -> DataFrame:
    return rank_predictions(predictions, n).drop("rank")


def mean_returns(predictions: DataFrame, n: int, target: str = TARGET) -> DataFrame:
    """Equal-weighted mean return per date, of the whole market and of the top ``n``.

    Two grouped averages joined on the date: a window over a whole date would pull its rows into one task.
    """
    market = predictions.groupBy("date").agg(F.avg(target).alias(target))
    top = top_predictions(predictions, n).groupBy("date").agg(F.avg(target).alias("top_preds_returns"))
    return market.join(top, "date", "left")


def performance_summary(predictions: DataFrame, n: int, target: str = TARGET) -> DataFrame:
    """Mean returns with their compounded products over time. The ordered window sees one row per date."""
    by_date = Window.orderBy("date")
    return mean_returns(predictions, n, target).withColumns(
        {
            "market_rolling_return": running_product(target, by_date),
            "top_preds_rolling_return": running_product("top_preds_returns", by_date),
        }
    )


def error_columns(prediction: str = "predictions", truth: str = TARGET) -> dict[str, Column]:
    """Aggregates by name: root mean squared error and mean absolute percentage error; rows without truth are left out."""
    error = F.col(truth) - F.col(prediction)
    floor = F.lit(2.220446049250313e-16)  # machine epsilon, for a zero truth
    return {"rmse": F.sqrt(F.avg(error * error)), "mape": F.avg(F.abs(error) / F.greatest(F.abs(F.col(truth)), floor))}


def error_metrics(scored: DataFrame, truth: str = TARGET, prediction: str = "predictions") -> DataFrame:
    """Both errors in one row."""
    known = scored.filter(F.col(truth).isNotNull())
    return known.agg(*[value.alias(name) for name, value in error_columns(prediction, truth).items()])
