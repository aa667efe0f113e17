from __future__ import annotations

from datetime import date, timedelta

import pytest

from matchlake.plans import gold
from matchlake.operators.trailing import Strategy

from conftest import OPENING, collected

STRATEGIES = [Strategy("plain"), Strategy("blocks", 100)]


def _team(games, team=100, **kwargs):
    return [r for r in collected(gold.team_rolling(games, **kwargs), "game_pk") if r["team_id"] == team]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_rolling_means(make_games, strategy):
    games = make_games([{"home_score": i, "away_score": 20} for i in range(1, 12)])
    rows = _team(games, strategy=strategy)
    assert rows[0]["runs_scored_l10"] is None and rows[0]["n_prior_games"] == 0
    assert rows[0]["days_rest"] is None and rows[1]["days_rest"] == 1
    assert rows[3]["runs_scored_l10"] == 2.0
    assert rows[10]["runs_scored_l10"] == 5.5 and rows[10]["n_prior_games"] == 10
    assert rows[10]["runs_allowed_l10"] == 20.0 and rows[10]["win_pct_l10"] == 0.0
    away = _team(games, 200, strategy=strategy)
    assert away[10]["runs_scored_l10"] == 20.0 and away[10]["win_pct_l10"] == 1.0


def test_extreme_current_match_does_not_leak(make_games):
    games = make_games([{"home_score": 0}] * 10 + [{"home_score": 999}])
    assert _team(games)[10]["runs_scored_l10"] == 0.0


def test_scheduled_zero_zero_rows_take_a_slot_and_add_nothing(make_games):
    rows = [{"home_score": 8}] + [{"status": "Scheduled", "home_score": 0, "away_score": 0}] * 3
    team = _team(make_games(rows))
    assert [r["runs_scored_l10"] for r in team] == [None, 8.0, 8.0, 8.0]
    assert [r["n_prior_games"] for r in team] == [0, 1, 1, 1]
    unguarded = _team(make_games(rows), guard_status=False)
    assert unguarded[3]["runs_scored_l10"] == pytest.approx(8 / 3)
    pushed_out = _team(make_games([{"home_score": 8}] + rows[1:2] * 11))
    assert pushed_out[11]["runs_scored_l10"] is None


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_pitcher_form_is_cumulative(make_games, make_pitchers, strategy):
    lines = [(6.0, 2, 6), (3.0, 4, 3), (0.0, 1, 0), (6.0, 0, 9)]
    games = make_games([{"game_date": OPENING + timedelta(days=5 * i)} for i in range(4)])
    starts = make_pitchers([(1000 + i, 100, 7, True, *line) for i, line in enumerate(lines)]
                           + [(1000, 100, 8, False, 3.0, 9, 9)])
    rows = collected(gold.pitcher_form(games, starts, strategy), "game_pk")
    assert len(rows) == 4 and rows[0]["era_l5"] is None and rows[0]["n_prior_starts"] == 0
    assert rows[2]["era_l5"] == pytest.approx(6 * 9 / 9) and rows[2]["k_per_9_l5"] == pytest.approx(9.0)
    assert rows[3]["era_l5"] == pytest.approx(7 * 9 / 9) and rows[3]["days_rest"] == 5


def test_only_zero_innings_give_no_rate(make_games, make_pitchers):
    starts = make_pitchers([(1000 + i, 100, 7, True, 0.0, 3, 0) for i in range(2)])
    assert collected(gold.pitcher_form(make_games([{}, {}]), starts), "game_pk")[1]["era_l5"] is None


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_bullpen(make_games, make_pitchers, strategy):
    games = make_games([{}, {}, {}, {}, {"status": "Scheduled"}])
    relief = make_pitchers(
        [(1000 + i, 100, 20 + j, False, 1.5, 1, 1) for i in range(4) for j in range(2)]
        + [(1004, 100, 20, False, 50.0, 50, 0)] + [(1000, 100, 9, True, 5.0, 9, 9)]
    )
    rows = [r for r in collected(gold.bullpen_form(games, relief, strategy), "game_pk") if r["team_id"] == 100]
    assert [r["bullpen_prior_games"] for r in rows] == [0, 1, 2, 3, 4]
    assert rows[4]["bullpen_ip_l3"] == 9.0 and rows[4]["bullpen_era_l10"] == pytest.approx(8 * 9 / 12)
    away = [r for r in collected(gold.bullpen_form(games, relief, strategy), "game_pk") if r["team_id"] == 200]
    assert away[4]["bullpen_era_l10"] is None and away[4]["bullpen_prior_games"] == 0


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_park_factors(make_games, strategy):
    games = make_games([
        {"venue_id": 1, "home_score": 10, "away_score": 0}, {"venue_id": 2, "home_score": 2, "away_score": 0},
        {"venue_id": 1, "home_score": 99, "away_score": 0}, {"venue_id": 1, "status": "Scheduled"},
    ])
    rows = collected(gold.park_factors(games, strategy), "game_pk")
    assert [r["game_pk"] for r in rows] == [1000, 1001, 1002]
    assert rows[0]["venue_park_factor_runs"] is None
    assert rows[2]["venue_avg_runs"] == 10.0 and rows[2]["league_avg_runs"] == 6.0
    assert rows[2]["venue_park_factor_runs"] == pytest.approx(10 / 6) and rows[2]["n_prior_venue_games"] == 1


def test_scoreless_league_gives_no_factor(make_games):
    rows = collected(gold.park_factors(make_games([{"home_score": 0, "away_score": 0}] * 3)), "game_pk")
    assert rows[2]["venue_avg_runs"] == 0.0 and rows[2]["venue_park_factor_runs"] is None


def test_roster_activity(make_games, make_transactions):
    days = [OPENING, OPENING + timedelta(days=10), OPENING + timedelta(days=30), OPENING + timedelta(days=45)]
    games = make_games([{"game_date": d} for d in days] + [{"game_date": days[0]}])
    moves = make_transactions([
        (1, days[0], "IL10", 100, None, True), (2, days[0], "IL10", None, 100, True),
        (3, days[0], "TR", 100, None, False), (4, days[1], "DFA", 100, 200, True),
        (5, OPENING + timedelta(days=3), "IL10", 100, None, True), (6, days[1], "IL10", None, None, True),
    ])
    rows = [r for r in collected(gold.roster_activity(games, moves), "team_id", "game_date") if r["team_id"] == 100]
    # Two matches on the first day make one row; the move on day 3 falls on no match day.
    assert [(r["game_date"], r["il_events_l30"]) for r in rows] == [
        (days[0], None), (days[1], 2), (days[2], 3), (days[3], 0),
    ]


def test_feature_assembly(make_games, make_pitchers, make_transactions):
    games = make_games([
        {"home_score": 4, "home_probable_pitcher_id": 7}, {"home_score": 6, "home_probable_pitcher_id": 7},
        {"game_date": date(2024, 5, 6), "status": "Scheduled", "home_score": None, "away_score": None,
         "home_probable_pitcher_id": 7, "day_night": "day"},
    ])
    starts = make_pitchers([(1000, 100, 7, True, 6.0, 2, 6), (1001, 100, 7, True, 6.0, 6, 6)])
    features = gold.build_features(games, starts, make_transactions([]))
    assert [c for c in features.columns if c in gold.FEATURES] == gold.FEATURES
    rows = collected(features, "game_pk")
    assert len(rows) == 3
    upcoming = rows[2]
    # The scheduled match inherits the form and park factor stored with the last played one.
    assert upcoming["home_sp_era_l5"] == pytest.approx(3.0) and upcoming["home_sp_days_rest"] == 1
    assert upcoming["venue_park_factor_runs"] == pytest.approx(1.0)
    assert upcoming["away_sp_era_l5"] is None
    assert upcoming["home_runs_scored_l10"] == 5.0 and upcoming["away_runs_allowed_l10"] == 5.0
    assert upcoming["target_home_win"] is None and upcoming["is_day_game"] and upcoming["month"] == 5
    assert rows[0]["target_home_win"] is True and rows[0]["target_total_runs"] == 4


def test_doubleheader_takes_the_form_of_the_higher_key(make_games, make_pitchers, make_transactions):
    later = OPENING + timedelta(days=5)
    games = make_games([
        {}, {"game_date": later}, {"game_date": later},
        {"game_date": later + timedelta(days=1), "home_probable_pitcher_id": 7},
    ])
    starts = make_pitchers([(1000, 100, 7, True, 9.0, 1, 0), (1001, 100, 7, True, 9.0, 3, 0), (1002, 100, 7, True, 9.0, 8, 0)])
    rows = collected(gold.build_features(games, starts, make_transactions([])), "game_pk")
    assert rows[3]["home_sp_era_l5"] == pytest.approx(2.0) and rows[3]["home_sp_days_rest"] == 0


def test_team_and_relief_form_take_one_pass(make_games, make_pitchers, make_transactions):
    """As of the separate tables, but the sides of matches are dealt by match and team once, not five times over."""
    games = make_games([
        {"game_date": OPENING + timedelta(days=i), "home_score": 3 + i, "home_probable_pitcher_id": 7,
         "home_team_id": None if i == 3 else 100, "status": "Postponed" if i == 1 else "Final"}
        for i in range(6)
    ])
    lines = make_pitchers([
        row for i in range(6) for row in [
            (1000 + i, 100, 7, True, 6.0, i, 6), (1000 + i, 100, 8, False, 3.0, i % 3, 1), (1000 + i, 200, 9, True, 5.0, 1, 2),
        ]
    ])
    moves = make_transactions([(1, OPENING, "IL10", 100, None, True)])
    features = gold.build_features(games, lines, moves)
    plan = features._jdf.queryExecution().executedPlan().toString()
    assert len([line for line in plan.splitlines() if "hashpartitioning(game_pk" in line and "team_id" in line]) <= 2
    apart = gold.assemble_features(
        games, gold.team_rolling(games), gold.pitcher_form(games, lines), gold.bullpen_form(games, lines),
        gold.roster_activity(games, moves), gold.park_factors(games),
    )
    rows = collected(features, "game_pk")
    assert rows == collected(apart, "game_pk")
    assert rows[5]["home_bullpen_era_l10"] is not None and rows[3]["home_runs_scored_l10"] is None
