"""Time-ordered train, test and holdout sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickfold.config import TARGET, Fold
from tickfold.functions.scaling import ZScore, double_columns


def _date(value: str) -> Column:
    return F.lit(value).cast("date")


def holdout_set(modeling: DataFrame, modeling_data_date: str) -> DataFrame:
    return modeling.filter(F.col("date") >= _date(modeling_data_date))


def train_set(modeling: DataFrame, before: str) -> DataFrame:
    return modeling.filter(F.col("date") < _date(before))


def slice_between(modeling: DataFrame, start: str, end: str) -> DataFrame:
    """Rows with start <= date < end."""
    return modeling.filter((F.col("date") >= _date(start)) & (F.col("date") < _date(end)))


def train_val_x(modeling: DataFrame, modeling_data_date: str, target: str = TARGET) -> DataFrame:
    """Scaled features of the train slice, without the target; date and ticker stay as keys.

    The scaler is fitted on the whole train slice, so it also sees the later test folds.
    """
    train = train_set(modeling, modeling_data_date)
    scaler = ZScore.fit(train, double_columns(train, skip=(target,)))
    return scaler.transform(train.drop(target))


def train_val_y(modeling: DataFrame, modeling_data_date: str, target: str = TARGET) -> DataFrame:
    return train_set(modeling, modeling_data_date).select("date", "ticker", target)


def fold_flags(folds: Sequence[Fold]) -> list[tuple[int, str, Column]]:
    """(fold, role, condition on date) for every fold."""
    flags = []
    for number, fold in enumerate(folds, start=1):
        flags.append((number, "train", F.col("date") < _date(fold.train_before)))
        flags.append((number, "test", (F.col("date") >= _date(fold.test_from)) & (F.col("date") < _date(fold.test_to))))
    return flags


def time_series_split(modeling: DataFrame, modeling_data_date: str, folds: Sequence[Fold]) -> DataFrame:
    """Expanding train windows with a gap before each test window: (fold, role, date, ticker).

    Each row carries the few folds it belongs to and is exploded in place; nothing is joined or shuffled.
    """
    member = F.array(
        *[
            F.when(condition, F.struct(F.lit(number).alias("fold"), F.lit(role).alias("role")))
            for number, role, condition in fold_flags(folds)
        ]
    )
    return (
        train_set(modeling, modeling_data_date)
        .select("date", "ticker", F.explode(F.array_compact(member)).alias("m"))
        .select("m.fold", "m.role", "date", "ticker")
    )
