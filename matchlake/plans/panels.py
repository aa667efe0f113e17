"""Read queries over matches, predictions and graded outcomes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.functions import display, scoring
from matchlake.operators.bins import equal_width_bin, ladder
from matchlake.operators.reshape import comparison_rows, melt

# Confidence tiers, upper edges included.
TIER_EDGES = [0.55, 0.60, 0.65, 0.70]
TIER_LABELS = ["50–55%", "55–60%", "60–65%", "65–70%", "70%+"]
# Labels of the comparison tables.
ACCURACY, LOG_LOSS, BRIER = "Accuracy", "Log loss", "Brier"
MAE_RUNS, RMSE_RUNS = "MAE (runs)", "RMSE (runs)"

ROLLING_WINDOW_DAYS = 30
MAX_WINDOW_DAYS = 365
TREND_ROWS = 7
CALIBRATION_BINS = 10


def by_keys(df: DataFrame, column: str, keys: Sequence | DataFrame) -> DataFrame:
    """Rows whose key is in a list, or in a one-column frame."""
    if isinstance(keys, DataFrame):
        return df.join(keys.select(F.col(keys.columns[0]).alias(column)), column, "left_semi")
    listed = df.sparkSession.createDataFrame([(k,) for k in keys], f"`{column}` {df.schema[column].dataType.simpleString()}")
    return df.join(listed, column, "left_semi")


def games_on(games: DataFrame, predictions: DataFrame, day: Column) -> DataFrame:
    """A day's matches with their predictions, if any, in order of start time."""
    shown = predictions.filter(F.col("game_date").cast("date") == day).select(
        "game_pk", "predicted_home_win_prob", "predicted_total_runs"
    )
    order = ["game_datetime_utc"] if "game_datetime_utc" in games.columns else []
    return (
        games.filter(F.col("game_date") == day)
        .join(shown, "game_pk", "left")
        .orderBy(*order, "game_pk")
    )


def game_cards(todays: DataFrame) -> DataFrame:
    """What a match card shows: pitchers, favourite with its chance, and the result."""
    home, away = F.col("home_team_name"), F.col("away_team_name")
    p = F.col("predicted_home_win_prob")
    winner = display.winner(F.col("status"), F.col("home_win"), home, away)
    home_first = F.coalesce(F.col("home_win"), F.lit(False))
    return todays.select(
        "game_pk",
        display.matchup(away, home).alias("matchup"),
        F.concat(
            F.lit("SP: "),
            display.pitcher_name(F.col("away_probable_pitcher_name")),
            F.lit(" vs "),
            display.pitcher_name(F.col("home_probable_pitcher_name")),
        ).alias("starters"),
        display.favoured_team(p, home, away).alias("favoured"),
        display.percent(display.favoured_probability(p), 0).alias("favoured_chance"),
        F.format_string("%.1f", F.col("predicted_total_runs")).alias("total_runs_shown"),
        winner.alias("winner"),
        F.when(
            winner.isNotNull(),
            display.score(
                F.when(home_first, F.col("home_score")).otherwise(F.col("away_score")),
                F.when(home_first, F.col("away_score")).otherwise(F.col("home_score")),
            ),
        ).alias("final_score"),
    )


def history(outcomes: DataFrame, games: DataFrame) -> DataFrame:
    """Graded predictions with team names and scores, newest first."""
    names = games.select(
        "game_pk", "home_team_name", "away_team_name", "home_score", "away_score", "status"
    )
    dated = outcomes.withColumn("game_date", F.to_date("game_date"))
    return dated.join(names, "game_pk", "left").orderBy(F.desc("game_date"), "game_pk")


def history_teams(history: DataFrame) -> DataFrame:
    """All team names of the history, sorted."""
    named = history.select(F.explode(F.array("home_team_name", "away_team_name")).alias("team"))
    return named.dropna().distinct().orderBy("team")


def explore_history(
    history: DataFrame, start: Column, end: Column, teams: Sequence[str] = ()
) -> DataFrame:
    """History rows of a date range and, if given, of teams on either side."""
    chosen = history.filter(F.col("game_date").between(start, end))
    if teams:
        chosen = chosen.filter(
            F.col("home_team_name").isin(list(teams)) | F.col("away_team_name").isin(list(teams))
        )
    return chosen


def history_rows(history: DataFrame) -> DataFrame:
    """The history as shown to readers."""
    return history.select(
        "game_pk",
        "winner_model_run_id",
        "game_date",
        display.matchup(F.col("away_team_name"), F.col("home_team_name")).alias("matchup"),
        display.percent(F.col("predicted_home_win_prob")).alias("home_win_prob"),
        F.when(F.col("actual_home_win") == 1, display.HOME_WON)
        .when(F.col("actual_home_win") == 0, display.AWAY_WON)
        .alias("actual"),
        display.hit_mark(F.col("winner_correct")).alias("hit"),
        F.round("predicted_total_runs", 1).alias("pred_runs"),
        F.col("actual_total_runs").alias("actual_runs"),
        F.round("runs_abs_error", 2).alias("runs_error"),
        display.score(F.col("away_score"), F.col("home_score")).alias("score"),
    )


def _mean(column: str) -> Column:
    return F.avg(F.col(column).cast("double"))


def rolling_performance(outcomes: DataFrame, window_days: int = ROLLING_WINDOW_DAYS) -> DataFrame:
    """Headline metrics of the last days before the newest outcome; no rows without outcomes."""
    if not 1 <= window_days <= MAX_WINDOW_DAYS:
        raise ValueError(f"window_days must be between 1 and {MAX_WINDOW_DAYS}")
    dated = outcomes.withColumn("game_date", F.to_date("game_date"))
    newest = dated.agg(F.max("game_date")).scalar()
    recent = dated.filter(F.col("game_date") > F.date_sub(newest, window_days))
    return recent.agg(
        F.count(F.lit(1)).alias("n_games"),
        _mean("winner_correct").alias("accuracy"),
        _mean("winner_log_loss").alias("log_loss"),
        _mean("winner_brier").alias("brier"),
        _mean("runs_abs_error").alias("mae"),
        F.sqrt(F.avg("runs_squared_error")).alias("rmse"),
    ).filter("n_games > 0")


def baseline_comparison(outcomes: DataFrame) -> DataFrame:
    """The model next to always predicting the observed means, on the same matches.

    The baseline is a constant, so its metrics follow from sums: with win share p the
    log-loss is p's entropy and the Brier score p(1-p). Only the absolute error needs a
    second look at the rows.
    """
    mean_runs = outcomes.agg(F.avg("actual_total_runs")).scalar()
    runs_error = F.col("actual_total_runs") - mean_runs
    p = F.avg(F.col("actual_home_win").cast("double"))
    summary = (
        outcomes.agg(
            F.count(F.lit(1)).alias("n"),
            p.alias("p"),
            F.avg(F.abs(runs_error)).alias("b_mae"),
            F.sqrt(F.avg(runs_error * runs_error)).alias("b_rmse"),
            _mean("winner_correct").alias("m_accuracy"),
            _mean("winner_log_loss").alias("m_log_loss"),
            _mean("winner_brier").alias("m_brier"),
            _mean("runs_abs_error").alias("m_mae"),
            F.sqrt(F.avg("runs_squared_error")).alias("m_rmse"),
        )
        .filter("n > 0")
        .withColumns(
            {
                "b_accuracy": F.when(F.col("p") >= 0.5, F.col("p")).otherwise(1 - F.col("p")),
                "b_log_loss": scoring.log_loss(F.col("p"), F.col("p")),
                "b_brier": F.col("p") * (1 - F.col("p")),
            }
        )
    )
    metrics = {
        ACCURACY: ("m_accuracy", "b_accuracy"),
        LOG_LOSS: ("m_log_loss", "b_log_loss"),
        BRIER: ("m_brier", "b_brier"),
        MAE_RUNS: ("m_mae", "b_mae"),
        RMSE_RUNS: ("m_rmse", "b_rmse"),
    }
    return comparison_rows(summary, metrics, "model", "baseline")


def market_comparison(outcomes: DataFrame) -> DataFrame:
    """The model next to the market on matches that have both; no rows without such matches."""
    won = F.col("actual_home_win")
    summary = (
        outcomes.dropna(subset=["market_home_win_prob", "market_total_line"])
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(scoring.log_loss(F.col("predicted_home_win_prob"), won)).alias("m_log_loss"),
            F.avg(scoring.log_loss(F.col("market_home_win_prob"), won)).alias("k_log_loss"),
            F.avg("winner_brier").alias("m_brier"),
            F.avg("market_winner_brier").alias("k_brier"),
            F.avg("runs_abs_error").alias("m_mae"),
            F.avg("market_runs_abs_error").alias("k_mae"),
        )
        .filter("n > 0")
    )
    metrics = {
        LOG_LOSS: ("m_log_loss", "k_log_loss"),
        BRIER: ("m_brier", "k_brier"),
        MAE_RUNS: ("m_mae", "k_mae"),
    }
    return comparison_rows(summary, metrics, "model", "market")


def runs_scatter(outcomes: DataFrame) -> DataFrame:
    return outcomes.select("game_pk", "predicted_total_runs", "actual_total_runs")


def confidence_tiers(outcomes: DataFrame) -> DataFrame:
    """Matches and accuracy per tier of confidence in the favoured side."""
    p = F.col("predicted_home_win_prob")
    confidence = F.greatest(p, 1 - p)
    return (
        outcomes.withColumn("tier", ladder(confidence, TIER_EDGES, TIER_LABELS))
        .filter(F.col("tier").isNotNull())
        .groupBy("tier")
        .agg(F.count("winner_correct").alias("n"), _mean("winner_correct").alias("accuracy"))
        .orderBy("tier")
    )


def daily_trend(outcomes: DataFrame, rolling_rows: int = TREND_ROWS) -> DataFrame:
    """Metrics per day with means over the latest days that had matches.

    The window runs over the daily table, whose size the calendar bounds.
    """
    daily = outcomes.groupBy(F.to_date("game_date").alias("game_date")).agg(
        F.count("winner_correct").alias("n"),
        _mean("winner_correct").alias("accuracy"),
        _mean("winner_log_loss").alias("log_loss"),
        _mean("runs_abs_error").alias("mae"),
    )
    latest = Window.orderBy("game_date").rowsBetween(1 - rolling_rows, Window.currentRow)
    return daily.withColumns(
        {
            "accuracy_rolling": F.avg("accuracy").over(latest),
            "log_loss_rolling": F.avg("log_loss").over(latest),
        }
    ).orderBy("game_date")


def trend_long(trend: DataFrame) -> DataFrame:
    return melt(trend, ["game_date"], ["accuracy", "accuracy_rolling"], "series", "value")


def comparison_long(comparison: DataFrame, against: str) -> DataFrame:
    return melt(comparison, ["metric"], ["model", against], "source", "value")


def calibration_bins(outcomes: DataFrame, n_bins: int = CALIBRATION_BINS) -> DataFrame:
    """Predicted and observed home-win rate per bin of predicted probability."""
    binned = equal_width_bin(
        outcomes.filter(F.col("predicted_home_win_prob").isNotNull()),
        "predicted_home_win_prob",
        n_bins,
    )
    return (
        binned.groupBy("bin")
        .agg(
            F.count("actual_home_win").alias("n"),
            F.avg("predicted_home_win_prob").alias("mean_predicted"),
            _mean("actual_home_win").alias("mean_actual"),
        )
        .orderBy("bin")
    )
