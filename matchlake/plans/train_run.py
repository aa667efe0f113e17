"""A full training run: fit all models, compare them, register and gate the served ones."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame

from matchlake.plans import registry, splits, training
from matchlake.plans.daily import runs_path, save_model
from matchlake.schemas import RUNS
from matchlake.session import materialise
from matchlake.sources.lake import Lake, read_or_empty, write_csv

def flat_metrics(metrics: DataFrame, names: Sequence[str]) -> dict[str, float]:
    """At most one row per split and metric: small enough to hold as a dict."""
    return {r["name"]: r["value"] for r in splits.metric_entries(metrics, names).collect()}


def train_all(
    lake: Lake,
    train: Sequence[int],
    val: Sequence[int],
    test: Sequence[int],
    started: datetime,
    winner_settings: dict | None = None,
    runs_settings: dict | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Comparison tables of the winner and the total-runs models."""
    split = materialise(splits.split_by_season(lake.gold("features"), train, val, test))
    based = splits.with_baselines(split)
    winner_tables = {"baseline": splits.classification_metrics(based, "split")}
    runs_tables = {"baseline": splits.regression_metrics(based, "split")}

    fits = [
        (registry.WINNER_EXPERIMENT, "logistic_regression", training.fit_logistic(split), training.LOGISTIC),
        (registry.WINNER_EXPERIMENT, registry.SERVED_FAMILY,
         training.fit_winner_trees(split, **(winner_settings or {})),
         {**training.WINNER_TREES, **(winner_settings or {})}),
        (registry.RUNS_EXPERIMENT, "ridge_regression", training.fit_ridge(split), training.RIDGE),
        (registry.RUNS_EXPERIMENT, registry.SERVED_FAMILY,
         training.fit_runs_trees(split, **(runs_settings or {})),
         {**training.RUNS_TREES, **(runs_settings or {})}),
    ]
    for experiment, family, fitted, params in fits:
        is_winner = experiment == registry.WINNER_EXPERIMENT
        column = "predicted_home_win_prob" if is_winner else "predicted_total_runs"
        scored = fitted.score(split, column)
        table = (splits.classification_metrics if is_winner else splits.regression_metrics)(
            scored, "split"
        )
        (winner_tables if is_winner else runs_tables)[family] = table
        _register(lake, experiment, family, fitted, params, table, started)
    return splits.model_comparison(winner_tables), splits.model_comparison(runs_tables)


def _register(lake, experiment, family, fitted, params, table, started: datetime) -> None:
    is_winner = experiment == registry.WINNER_EXPERIMENT
    metrics = flat_metrics(table, splits.CLASSIFICATION if is_winner else splits.REGRESSION)
    run_id = f"{experiment}-{family}-{started:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
    tags: dict[str, str] = {}
    gated = "val_log_loss" if is_winner else "val_mae"
    if family == registry.SERVED_FAMILY:
        save_model(lake, run_id, fitted)
        importance = training.feature_importance(lake.spark, fitted)
        write_csv(importance, lake.path("gold", f"importance/{run_id}"))
        if gated in metrics:
            runs = read_or_empty(lake.spark, runs_path(lake), RUNS)
            promoted = registry.promote(
                lake.spark, lake.path("gold", "promotions"), run_id, metrics[gated], runs, experiment, gated
            )
            tags[registry.PROMOTED] = str(promoted).lower()
            metrics["promoted"] = float(promoted)
    row = registry.run_row(lake.spark, run_id, experiment, family, started, params, metrics, tags)
    registry.append_run(row, runs_path(lake))
