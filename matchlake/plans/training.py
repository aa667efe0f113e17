"""Model fitting and batch scoring on the feature table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.operators.quantiles import exact_medians
from matchlake.plans.boosting import LOGISTIC as LOGISTIC_LOSS
from matchlake.plans.boosting import SQUARED as SQUARED_LOSS
from matchlake.plans.boosting import BoostedTrees, fit_boosted
from matchlake.plans.gold import FEATURES, RUNS_TARGET, WINNER_TARGET
from matchlake.plans.grading import PREDICTION_COLUMNS

# Training settings.
LOGISTIC = {"C": 1.0, "max_iter": 1000}
RIDGE = {"alpha": 1.0}
WINNER_TREES = {
    "trees": 150, "depth": 3, "rate": 0.05, "min_child_weight": 8, "rows": 0.8, "columns": 0.8, "reg_lambda": 1.0, "seed": 42,
}
RUNS_TREES = {
    "trees": 300, "depth": 4, "rate": 0.05, "min_child_weight": 5, "rows": 0.8, "columns": 0.8, "reg_lambda": 1.0, "seed": 42,
}


@dataclass(frozen=True)
class Preparation:
    """Training medians, means and population deviations per usable feature."""

    medians: dict[str, float]
    means: dict[str, float] = field(default_factory=dict)
    deviations: dict[str, float] = field(default_factory=dict)

    @property
    def features(self) -> list[str]:
        return list(self.medians)

    def imputed(self, name: str) -> Column:
        return F.coalesce(F.col(name).cast("double"), F.lit(float(self.medians[name])))

    def scaled(self, name: str) -> Column:
        return (self.imputed(name) - self.means[name]) / self.deviations[name]


def fit_preparation(
    train: DataFrame, features: Sequence[str] = FEATURES, scale: bool = True
) -> Preparation:
    """Medians on the training rows, then means and deviations of the imputed features.

    A feature without any training value is left out; a constant one is divided by 1.
    """
    numbers = train.select(
        *[
            F.col(c).cast("int").alias(c) if kind == "boolean" else F.col(c)
            for c, kind in train.select(*features).dtypes
        ]
    )
    medians = {c: m for c, m in exact_medians(numbers, features).items() if m is not None}
    if not medians:
        raise ValueError("no training rows")
    prepared = Preparation(medians)
    if not scale:
        return prepared
    row = numbers.agg(
        *[F.avg(prepared.imputed(c)).alias(f"mean_{c}") for c in medians],
        *[F.stddev_pop(prepared.imputed(c)).alias(f"dev_{c}") for c in medians],
    ).first()
    means = {c: row[f"mean_{c}"] for c in medians}
    deviations = {c: row[f"dev_{c}"] or 1.0 for c in medians}
    return Preparation(medians, means, deviations)


def matrix(df: DataFrame, prepared: Preparation, scaled: bool) -> DataFrame:
    """Append the `features` vector."""
    value = prepared.scaled if scaled else prepared.imputed
    inputs = {f"_x_{c}": value(c) for c in prepared.features}
    assembler = VectorAssembler(inputCols=list(inputs), outputCol="features", handleInvalid="keep")
    return assembler.transform(df.withColumns(inputs)).drop(*inputs)


@dataclass(frozen=True)
class Fitted:
    """A model with the preparation of its inputs; boosted trees take their inputs as they are."""

    model: object
    prepared: Preparation | None = None
    scaled: bool = False

    @property
    def features(self) -> list[str]:
        return self.prepared.features if self.prepared else self.model.features

    def score(self, df: DataFrame, column: str) -> DataFrame:
        """Append the home-win probability of a classifier or the prediction of a regressor."""
        if isinstance(self.model, BoostedTrees):
            return self.model.score(df, column)
        scored = self.model.transform(matrix(df, self.prepared, self.scaled))
        if isinstance(self.model, LogisticRegressionModel):
            value = vector_to_array("probability")[1]
        else:
            value = F.col("prediction")
        return scored.withColumn(column, value).select(*df.columns, column)

    def importances(self) -> list[tuple[str, float]]:
        return self.model.importances()


def _training(split: DataFrame, target: str) -> DataFrame:
    train = split.filter(F.col("split") == "train") if "split" in split.columns else split
    return train.withColumn("label", F.col(target).cast("int").cast("double"))


def fit_logistic(
    split: DataFrame, C: float = LOGISTIC["C"], max_iter: int = LOGISTIC["max_iter"]
) -> Fitted:
    """L2-penalised logistic regression; the penalty is per row, hence the division by n."""
    train = _training(split, WINNER_TARGET)
    prepared = fit_preparation(train)
    estimator = LogisticRegression(
        regParam=1.0 / (C * train.count()),
        elasticNetParam=0.0,
        maxIter=max_iter,
        standardization=False,
    )
    return Fitted(estimator.fit(matrix(train, prepared, True)), prepared, True)


def fit_ridge(split: DataFrame, alpha: float = RIDGE["alpha"]) -> Fitted:
    """Ridge regression by normal equations, the penalty restated for label-scaled fitting."""
    train = _training(split, RUNS_TARGET)
    prepared = fit_preparation(train)
    spread, n = train.agg(F.stddev_pop("label"), F.count(F.lit(1))).first()
    estimator = LinearRegression(
        regParam=alpha * spread / n, elasticNetParam=0.0, solver="normal", standardization=False
    )
    return Fitted(estimator.fit(matrix(train, prepared, True)), prepared, True)


def fit_winner_trees(split: DataFrame, **settings) -> Fitted:
    train = _training(split, WINNER_TARGET)
    return Fitted(fit_boosted(train, FEATURES, WINNER_TARGET, LOGISTIC_LOSS, **{**WINNER_TREES, **settings}))


def fit_runs_trees(split: DataFrame, **settings) -> Fitted:
    train = _training(split, RUNS_TARGET)
    return Fitted(fit_boosted(train, FEATURES, RUNS_TARGET, SQUARED_LOSS, **{**RUNS_TREES, **settings}))


def feature_importance(spark: SparkSession, fitted: Fitted) -> DataFrame:
    """Features by falling importance."""
    rows = spark.createDataFrame(fitted.importances(), "feature string, importance double")
    return rows.orderBy(F.desc("importance"), "feature")


def predict_day(
    features: DataFrame,
    day: Column,
    winner: Fitted,
    runs: Fitted,
    winner_run_id: str,
    runs_run_id: str,
    predicted_at: Column,
) -> DataFrame:
    """Prediction rows for every match of a day, with the runs that made them."""
    todays = features.filter(F.col("game_date") == day)
    scored = runs.score(
        winner.score(todays, "predicted_home_win_prob"), "predicted_total_runs"
    )
    return scored.withColumns(
        {
            "game_date": F.col("game_date").cast("string"),
            "winner_model_run_id": F.lit(winner_run_id),
            "runs_model_run_id": F.lit(runs_run_id),
            "predicted_at": predicted_at.cast("timestamp"),
        }
    ).select(*PREDICTION_COLUMNS)
