"""Row-level scores and their aggregates. Booleans count as 0/1; NULL stays NULL."""

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: probabilities are kept this far from 0 and 1 before taking logs.
PROBABILITY_EPSILON = 1e-15


def clip_probability(p: Column) -> Column:
    return F.when(
        p.isNotNull(),
        F.greatest(F.lit(PROBABILITY_EPSILON), F.least(F.lit(1.0 - PROBABILITY_EPSILON), p)),
    )


def log_loss(p: Column, actual: Column) -> Column:
    p = clip_probability(p)
    return -(actual * F.log(p) + (1 - actual) * F.log(1 - p))


def brier(p: Column, actual: Column) -> Column:
    return (p - actual) * (p - actual)


def picked_home(p: Column) -> Column:
    return (p >= 0.5).cast("int")


def classification_summary(p: Column, actual: Column) -> Mapping[str, Column]:
    """n, accuracy, log-loss and Brier as aggregate expressions."""
    return {
        "n": F.count(F.lit(1)),
        "accuracy": F.avg((picked_home(p) == actual).cast("int")),
        "log_loss": F.avg(log_loss(p, actual)),
        "brier": F.avg(brier(p, actual)),
    }


def regression_summary(predicted: Column, actual: Column) -> Mapping[str, Column]:
    """n, MAE, RMSE and the shares within one and two units as aggregate expressions."""
    error = F.abs(actual - predicted)
    return {
        "n": F.count(F.lit(1)),
        "mae": F.avg(error),
        "rmse": F.sqrt(F.avg(error * error)),
        "within_1": F.avg((error <= 1).cast("int")),
        "within_2": F.avg((error <= 2).cast("int")),
    }


def named(aggregates: Mapping[str, Column]) -> list[Column]:
    return [expr.alias(name) for name, expr in aggregates.items()]
