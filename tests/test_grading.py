from __future__ import annotations

import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from matchlake.plans import panels
from matchlake.plans.grading import PREDICTION_COLUMNS, grade_predictions

from conftest import OPENING, collected

NOW = datetime(2024, 4, 1, 12)
PREDICTIONS = (
    "game_pk long, game_date string, predicted_home_win_prob double, predicted_total_runs double, "
    "winner_model_run_id string, runs_model_run_id string, predicted_at timestamp"
)


@pytest.fixture(scope="module")
def make_predictions(spark):
    def make(*rows):
        full = [
            (pk, str(OPENING), p, runs, run, "r", NOW + timedelta(hours=hour))
            for pk, p, runs, run, hour in rows
        ]
        return spark.createDataFrame(full, PREDICTIONS)

    return make


def test_grades(make_games, make_predictions):
    games = make_games([{"home_score": 5, "away_score": 3}])
    (row,) = collected(grade_predictions(make_predictions((1000, 0.6, 10.0, "w", 0)), games), "game_pk")
    assert row["winner_correct"] is True and row["actual_home_win"] == 1
    assert row["winner_log_loss"] == pytest.approx(-math.log(0.6))
    assert row["winner_brier"] == pytest.approx(0.16)
    assert (row["runs_abs_error"], row["runs_squared_error"]) == (2.0, 4.0)
    assert row["market_home_win_prob"] is None and row["market_winner_brier"] is None


def test_unfinished_and_tied_matches_have_no_outcome(make_games, make_predictions):
    games = make_games([{"status": "Scheduled"}, {"home_score": 2, "away_score": 2}])
    predictions = make_predictions((1000, 0.6, 1.0, "w", 0), (1001, 0.6, 1.0, "w", 0))
    assert grade_predictions(predictions, games).count() == 0


def test_freshest_prediction_per_run(make_games, make_predictions):
    predictions = make_predictions(
        (1000, 0.9, 1.0, "w1", 2), (1000, 0.1, 1.0, "w1", 0), (1000, 0.3, 1.0, "w2", 1)
    )
    rows = collected(grade_predictions(predictions, make_games([{}])), "winner_model_run_id")
    assert [(r["winner_model_run_id"], r["predicted_home_win_prob"]) for r in rows] == [("w1", 0.9), ("w2", 0.3)]


def test_market_columns(spark, make_games, make_predictions):
    odds = spark.createDataFrame(
        [(1000, 0.7, 9.0, "d", NOW), (1000, 0.5, 8.0, "d", NOW - timedelta(hours=1)), (None, 0.2, 7.0, "d", NOW)],
        "game_pk long, market_home_win_prob double, market_total_line double, odds_date string, fetched_at timestamp",
    )
    predictions = make_predictions((1000, 0.6, 1.0, "w", 0), (1001, 0.6, 1.0, "w", 0))
    first, second = collected(grade_predictions(predictions, make_games([{}, {}]), odds), "game_pk")
    assert first["market_winner_brier"] == pytest.approx(0.09) and first["market_runs_abs_error"] == 8.0
    assert second["market_winner_brier"] is None and second["market_runs_abs_error"] is None


OUTCOMES = (
    "game_pk long, game_date string, predicted_home_win_prob double, predicted_total_runs double, "
    "winner_model_run_id string, actual_home_win int, actual_total_runs int, winner_correct boolean, "
    "winner_log_loss double, winner_brier double, runs_abs_error double, runs_squared_error double, "
    "market_home_win_prob double, market_total_line double, market_winner_brier double, "
    "market_runs_abs_error double"
)


@pytest.fixture(scope="module")
def make_outcomes(spark):
    def make(*rows):
        """Rows of (day offset, p, won, predicted runs, runs, market p or None)."""
        full = []
        for i, (day, p, won, predicted, runs, market) in enumerate(rows):
            c = min(max(p, 1e-15), 1 - 1e-15)
            full.append((
                1000 + i, str(OPENING + timedelta(days=day)), p, float(predicted), "w", won, runs,
                (p >= 0.5) == bool(won), -math.log(c if won else 1 - c), float((p - won) ** 2),
                float(abs(predicted - runs)), float((predicted - runs) ** 2), market,
                None if market is None else 8.0, None if market is None else (market - won) ** 2,
                None if market is None else abs(8.0 - runs),
            ))
        return spark.createDataFrame(full, OUTCOMES)

    return make


def test_rolling_window_is_strict(make_outcomes):
    outcomes = make_outcomes((0, 0.9, 1, 8, 8, None), (1, 0.9, 0, 8, 4, None), (30, 0.6, 1, 8, 11, None))
    row = panels.rolling_performance(outcomes, 30).first()
    assert row["n_games"] == 2 and row["accuracy"] == 0.5
    assert row["mae"] == 3.5 and row["rmse"] == pytest.approx(math.sqrt(12.5))
    assert panels.rolling_performance(outcomes, 365).first()["n_games"] == 3


@pytest.mark.parametrize("days", [0, 366])
def test_rolling_window_length_is_checked(make_outcomes, days):
    with pytest.raises(ValueError):
        panels.rolling_performance(make_outcomes(), days)


def test_baseline_comparison(make_outcomes):
    rows = [(0, 0.9, 1, 8, 10, None), (0, 0.8, 1, 8, 6, None), (0, 0.2, 0, 8, 8, None)]
    got = {r["metric"]: (r["model"], r["baseline"]) for r in panels.baseline_comparison(make_outcomes(*rows)).collect()}
    p = 2 / 3
    entropy = -(p * math.log(p) + (1 - p) * math.log(1 - p))
    assert got["Accuracy"] == (1.0, pytest.approx(p))
    assert got["Log loss"][1] == pytest.approx(entropy)
    assert got["Brier"][1] == pytest.approx(sum((p - w) ** 2 for _, _, w, *_ in rows) / 3)
    assert got["MAE (runs)"] == (pytest.approx(4 / 3), pytest.approx(4 / 3))
    assert got["RMSE (runs)"][1] == pytest.approx(math.sqrt(8 / 3))


def test_market_comparison_uses_rows_with_both(make_outcomes):
    outcomes = make_outcomes((0, 0.9, 1, 8, 10, 0.6), (0, 0.1, 1, 8, 6, None))
    got = {r["metric"]: (r["model"], r["market"]) for r in panels.market_comparison(outcomes).collect()}
    assert got["Log loss"] == (pytest.approx(-math.log(0.9)), pytest.approx(-math.log(0.6)))
    assert got["MAE (runs)"] == (2.0, 2.0)
    assert panels.market_comparison(make_outcomes((0, 0.9, 1, 8, 10, None))).count() == 0


def test_confidence_tiers_include_their_upper_edge(make_outcomes):
    outcomes = make_outcomes(*[(0, p, 1, 8, 8, None) for p in (0.5, 0.55, 0.45, 0.551, 0.7, 0.0, 1.0)])
    got = {r["tier"]: (r["n"], r["accuracy"]) for r in panels.confidence_tiers(outcomes).collect()}
    assert got == {
        "50–55%": (3, pytest.approx(2 / 3)), "55–60%": (1, 1.0), "65–70%": (1, 1.0), "70%+": (2, 0.5),
    }


def test_daily_trend_averages_the_latest_days(make_outcomes):
    outcomes = make_outcomes(*[(d, 0.9, int(d % 2 == 0), 8, 8, None) for d in range(0, 20, 2)], (0, 0.9, 0, 8, 8, None))
    rows = panels.daily_trend(outcomes).collect()
    assert rows[0]["n"] == 2 and rows[0]["accuracy"] == 0.5
    assert rows[6]["accuracy_rolling"] == pytest.approx(6.5 / 7) and rows[7]["accuracy_rolling"] == 1.0
    assert panels.trend_long(panels.daily_trend(outcomes)).count() == 20


def test_calibration(make_outcomes):
    outcomes = make_outcomes((0, 0.0, 0, 8, 8, None), (0, 0.05, 1, 8, 8, None), (0, 1.0, 1, 8, 8, None))
    rows = [tuple(r) for r in panels.calibration_bins(outcomes).collect()]
    assert rows == [(0, 2, 0.025, 0.5), (9, 1, 1.0, 1.0)]
    alike = make_outcomes((0, 0.4, 1, 8, 8, None), (0, 0.4, 0, 8, 8, None))
    assert [r["bin"] for r in panels.calibration_bins(alike).collect()] == [4]


def test_empty_outcomes_give_empty_results(make_outcomes):
    empty = make_outcomes()
    for query in (
        panels.rolling_performance, panels.baseline_comparison, panels.market_comparison,
        panels.confidence_tiers, panels.daily_trend, panels.calibration_bins, panels.runs_scatter,
    ):
        assert query(empty).count() == 0, query


def test_history(make_games, make_outcomes):
    games = make_games([{"home_team_name": "Reds"}, {"away_team_name": None}])
    history = panels.history(make_outcomes((0, 0.613, 1, 8.26, 1, None), (3, 0.4, 1, 8, 1, None)), games)
    assert [str(r["game_date"]) for r in history.collect()] == ["2024-04-04", "2024-04-01"]
    assert [r["team"] for r in panels.history_teams(history).collect()] == ["Away", "Home", "Reds"]
    day = F.lit(str(OPENING)).cast("date")
    (row,) = panels.history_rows(panels.explore_history(history, day, day, ["Reds"])).collect()
    assert (row["matchup"], row["home_win_prob"], row["actual"], row["hit"]) == ("Away @ Reds", "61.3%", "home won", "✓")
    assert (row["pred_runs"], row["runs_error"], row["score"]) == (8.3, 7.26, "0–1")
    assert panels.explore_history(history, day, day, ["Nobody"]).count() == 0


def test_games_on_a_day(make_games, make_predictions):
    games = make_games([{}, {"game_date": OPENING}, {}])
    shown = panels.games_on(games, make_predictions((1000, 0.6, 8.0, "w", 0)), F.lit(OPENING))
    rows = shown.collect()
    assert [(r["game_pk"], r["predicted_home_win_prob"]) for r in rows] == [(1000, 0.6), (1001, None)]
    cards = panels.game_cards(
        shown.withColumns({f"{s}_probable_pitcher_name": F.lit(None).cast("string") for s in ("home", "away")})
    ).collect()
    assert (cards[0]["favoured"], cards[0]["favoured_chance"], cards[0]["winner"]) == ("Home", "60%", "Home")
    assert cards[0]["starters"] == "SP: (TBD) vs (TBD)" and cards[0]["final_score"] == "1–0"
    assert cards[1]["favoured"] is None


def test_key_lists(make_games):
    games = make_games([{}, {}, {}])
    assert panels.by_keys(games, "game_pk", [1000, 1002]).count() == 2
    assert panels.by_keys(games, "game_pk", games.select("game_pk").limit(1)).count() == 1
    assert panels.by_keys(games, "game_pk", []).count() == 0
    assert panels.by_keys(games, "game_pk", [1002, *range(5000)]).count() == 3


def test_prediction_columns_are_complete():
    assert len(PREDICTION_COLUMNS) == 7
