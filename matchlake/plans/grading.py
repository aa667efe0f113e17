"""Grading stored predictions against results and the market."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.functions import scoring
from matchlake.operators.latest import latest_wins

PREDICTION_COLUMNS = [
    "game_pk", "game_date", "predicted_home_win_prob", "predicted_total_runs",
    "winner_model_run_id", "runs_model_run_id", "predicted_at",
]


def grade_predictions(
    predictions: DataFrame, games: DataFrame, odds: DataFrame | None = None
) -> DataFrame:
    """One row per match and winner model run, from the run's freshest prediction.

    Matches that are not Final, and ties, have no outcome. The market columns are
    always present and NULL where no line is known.
    """
    freshest = latest_wins(
        predictions.select(*PREDICTION_COLUMNS),
        ["game_pk", "winner_model_run_id"],
        "predicted_at",
        ["predicted_home_win_prob", "predicted_total_runs", "runs_model_run_id"],
    )
    results = games.filter((F.col("status") == "Final") & F.col("home_win").isNotNull()).select(
        "game_pk",
        F.col("home_win").cast("int").alias("actual_home_win"),
        F.col("total_runs").alias("actual_total_runs"),
    )
    graded = freshest.join(results, "game_pk")
    p, won = F.col("predicted_home_win_prob"), F.col("actual_home_win")
    runs, total = F.col("predicted_total_runs"), F.col("actual_total_runs")
    graded = graded.withColumns(
        {
            "winner_correct": scoring.picked_home(p) == won,
            "winner_log_loss": scoring.log_loss(p, won),
            "winner_brier": scoring.brier(p, won),
            "runs_abs_error": F.abs(runs - total),
            "runs_squared_error": (runs - total) * (runs - total),
        }
    )
    if odds is None:
        lines = {"market_home_win_prob": F.lit(None), "market_total_line": F.lit(None)}
        graded = graded.withColumns({c: v.cast("double") for c, v in lines.items()})
    else:
        graded = graded.join(market_lines(odds), "game_pk", "left")
    return graded.withColumns(
        {
            "market_winner_brier": scoring.brier(F.col("market_home_win_prob"), won),
            "market_runs_abs_error": F.abs(F.col("market_total_line") - total),
        }
    )


def market_lines(odds: DataFrame) -> DataFrame:
    """One market line per match; of several, the one fetched last."""
    known = odds.filter(F.col("game_pk").isNotNull())
    columns = ["game_pk", "market_home_win_prob", "market_total_line"]
    if "fetched_at" not in odds.columns:
        return known.select(*columns)
    ties = ["odds_date", "market_home_win_prob", "market_total_line"]
    return latest_wins(known, ["game_pk"], "fetched_at", ties).select(*columns)
