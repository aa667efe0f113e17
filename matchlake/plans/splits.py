"""Time-based splits, baselines and metric tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.functions.scoring import classification_summary, named, regression_summary
from matchlake.plans.gold import RUNS_TARGET, WINNER_TARGET

SPLITS = ("train", "val", "test")


def split_by_season(
    features: DataFrame, train: Sequence[int], val: Sequence[int], test: Sequence[int]
) -> DataFrame:
    """Labelled rows of the listed seasons with a `split` column. Seasons must not overlap."""
    if len({*train, *val, *test}) != len(train) + len(val) + len(test):
        raise ValueError("a season belongs to one split only")
    season = F.col("season")
    split = (
        F.when(season.isin(list(train)), "train")
        .when(season.isin(list(val)), "val")
        .when(season.isin(list(test)), "test")
    )
    labelled = features.filter(F.col(WINNER_TARGET).isNotNull())
    return labelled.withColumn("split", split).filter(F.col("split").isNotNull())


def require_train(means: DataFrame) -> DataFrame:
    """Fail when the one-row training summary is empty rather than predict NULL."""
    return means.withColumn(
        "n_train",
        F.when(F.col("n_train") > 0, F.col("n_train")).otherwise(
            F.raise_error(F.lit("no training rows: the baseline was not fitted"))
        ),
    )


def with_baselines(split: DataFrame) -> DataFrame:
    """The training means of both targets as constant predictions on every split."""
    train = split.filter(F.col("split") == "train").agg(
        F.count(F.lit(1)).alias("n_train"),
        F.avg(F.col(WINNER_TARGET).cast("double")).alias("p"),
        F.avg(RUNS_TARGET).alias("runs"),
    )
    fitted = require_train(train).select(
        F.struct(
            F.when(F.col("n_train") > 0, F.col("p")).alias("p"), F.col("runs").alias("runs")
        ).alias("fitted")
    )
    constants = split.withColumn("_fitted", fitted.scalar())
    return constants.withColumns(
        {
            "predicted_home_win_prob": F.col("_fitted.p"),
            "predicted_total_runs": F.col("_fitted.runs"),
        }
    ).drop("_fitted")


def classification_metrics(scored: DataFrame, *by: str, target: str = WINNER_TARGET) -> DataFrame:
    """n, accuracy, log-loss and Brier per group; groups without rows give none."""
    summary = classification_summary(F.col("predicted_home_win_prob"), F.col(target).cast("int"))
    return scored.groupBy(*by).agg(*named(summary)).filter("n > 0")


def regression_metrics(scored: DataFrame, *by: str, target: str = RUNS_TARGET) -> DataFrame:
    """n, MAE, RMSE and shares within one and two runs per group."""
    summary = regression_summary(F.col("predicted_total_runs"), F.col(target).cast("double"))
    return scored.groupBy(*by).agg(*named(summary)).filter("n > 0")


def model_comparison(metrics: Mapping[str, DataFrame]) -> DataFrame:
    """Metric tables of several models under one another."""
    named_tables = [df.withColumn("model", F.lit(name)) for name, df in metrics.items()]
    return reduce(DataFrame.unionByName, named_tables)


def metric_entries(metrics: DataFrame, names: Sequence[str]) -> DataFrame:
    """Per-split metric columns as rows of `train_accuracy`-style names and values."""
    long = metrics.select("split", *[F.col(n).cast("double").alias(n) for n in names]).unpivot(
        ["split"], list(names), "metric", "value"
    )
    return long.select(F.concat_ws("_", "split", "metric").alias("name"), "value")


CLASSIFICATION = ("n", "accuracy", "log_loss", "brier")
REGRESSION = ("n", "mae", "rmse", "within_1", "within_2")


def evaluated(winner_models: Mapping[str, DataFrame], runs_models: Mapping[str, DataFrame]) -> DataFrame:
    """(target, model, split, metric, value) of scored frames by model: every metric on every split."""
    tables = []
    for target, models, metrics, names in (
        ("winner", winner_models, classification_metrics, CLASSIFICATION),
        ("runs", runs_models, regression_metrics, REGRESSION),
    ):
        compared = model_comparison({name: metrics(scored, "split") for name, scored in models.items()})
        values = [F.col(name).cast("double").alias(name) for name in names]
        long = compared.select("model", "split", *values).unpivot(["model", "split"], list(names), "metric", "value")
        tables.append(long.select(F.lit(target).alias("target"), "model", "split", "metric", "value"))
    return tables[0].unionByName(tables[1])
