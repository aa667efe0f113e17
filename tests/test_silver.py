from __future__ import annotations

import copy
import json
from datetime import date, datetime
from itertools import permutations

import pytest

from matchlake.plans import market, silver

from conftest import collected

NOON, LATER = datetime(2026, 7, 23, 12), datetime(2026, 7, 24, 12)
RAW_GAMES = "game_pk long, game_date string, payload string, ingested_at timestamp"
RAW_BOX = "game_pk long, payload string, ingested_at timestamp"
RAW_MOVES = "transaction_id long, date string, payload string, ingested_at timestamp"
RAW_ODDS = (
    "odds_event_id string, date string, commence_time string, home_team string, "
    "away_team string, payload string, fetched_at timestamp"
)

HERONS, LARKS = {"id": 41, "name": "Herons"}, {"id": 58, "name": "Larks"}


def _match(home_runs, away_runs, status="Final", starts="2019-05-04T17:40:00Z", starter=None, **other):
    """A schedule entry of an afternoon match in the postseason; `starter` is the away side's."""
    home, away = {"team": HERONS, "score": home_runs}, {"team": LARKS, "score": away_runs}
    if starter:
        away["probablePitcher"] = starter
    entry = {
        "gamePk": 3120, "gameDate": starts, "season": "2019", "gameType": "P", "dayNight": "day",
        "status": {"detailedState": status}, "teams": {"home": home, "away": away}, "venue": {"id": 604, "name": "Lakeside"},
    }
    return {**entry, **other}


def _games(spark, *landings):
    """The typed rows of (entry, time of landing) pairs."""
    rows = [(entry["gamePk"], entry["gameDate"][:10], json.dumps(entry), at) for entry, at in landings]
    return collected(silver.games(spark.createDataFrame(rows, RAW_GAMES)), "game_pk")


def test_every_field_of_an_entry_gets_its_column(spark):
    starter = {"id": 977, "fullName": "Ida Okoro"}
    (row,) = _games(spark, (_match(2, 11, starter=starter), NOON))
    expected = {
        "game_pk": 3120, "game_date": date(2019, 5, 4), "game_datetime_utc": datetime(2019, 5, 4, 17, 40), "season": 2019,
        "game_type": "P", "status": "Final", "home_team_id": 41, "home_team_name": "Herons", "away_team_id": 58,
        "away_team_name": "Larks", "home_score": 2, "away_score": 11, "total_runs": 13, "home_win": False,
        "venue_id": 604, "day_night": "day", "home_probable_pitcher_id": None, "away_probable_pitcher_id": 977,
        "away_probable_pitcher_name": "Ida Okoro",
    }
    assert {name: row[name] for name in expected} == expected


@pytest.mark.parametrize("home", [0, 1, 6])
@pytest.mark.parametrize("away", [0, 1, 6])
@pytest.mark.parametrize("status", ["Final", "Postponed"])
def test_targets_follow_the_score_of_a_final_match(spark, home, away, status):
    (row,) = _games(spark, (_match(home, away, status), NOON))
    final = status == "Final"
    assert row["total_runs"] == (home + away if final else None)
    assert row["home_win"] == (home > away if final and home != away else None)


def test_a_corrected_score_replaces_the_first_one(spark):
    first, corrected = _match(3, 4), _match(5, 4)
    for landings in ([(first, NOON), (corrected, LATER)], [(corrected, LATER), (first, NOON)]):
        (row,) = _games(spark, *landings)
        assert (row["home_score"], row["home_win"]) == (5, True)


def test_two_versions_landed_at_once_give_one_row_in_any_order(spark):
    versions = [(_match(runs, 9), NOON) for runs in (1, 2, 7)]
    found = {str(_games(spark, *order)) for order in permutations(versions)}
    assert len(found) == 1


@pytest.mark.parametrize("odd", ["", "n/a", "7.5x"])
def test_a_field_that_is_no_number_is_null_and_stops_nothing(spark, odd):
    (row,) = _games(spark, (_match(odd, 4), NOON))
    assert (row["home_score"], row["away_score"], row["total_runs"]) == (None, 4, None)


def _line(person, ip=None, **numbers):
    """A player: of the pitching line if innings are given, else one who only batted."""
    stats = {"batting": {"hits": 1}} if ip is None else {"pitching": {"inningsPitched": ip, **numbers}}
    return {f"ID{person}": {"person": {"id": person, "fullName": f"Player {person}"}, "stats": stats}}


def _box(**home_batting):
    """The home side used three pitchers, listed in the order they came in; the away side's are unknown."""
    home = {
        "team": HERONS,
        "teamStats": {"batting": {"runs": 12, "hits": 15, **home_batting}, "fielding": {"errors": 3}},
        "pitchers": [640, 310, 825],
        "players": {
            **_line(310, "0.0", earnedRuns=2, numberOfPitches=14),
            **_line(77),
            **_line(640, "7.1", strikeOuts=8, earnedRuns=1),
            **_line(825, "1.2", strikeOuts=2),
        },
    }
    away = {"team": LARKS, "teamStats": {"batting": {"runs": 3}, "fielding": {}}, "pitchers": [], "players": {}}
    return {"teams": {"home": home, "away": away}}


def _raw_box(spark, *landings):
    return spark.createDataFrame([(3120, json.dumps(box), at) for box, at in landings], RAW_BOX)


def test_each_side_has_a_line(spark):
    home, away = collected(silver.team_game_stats(_raw_box(spark, (_box(), NOON))), "team_id")
    assert [home[c] for c in ("team_id", "is_home", "runs", "hits", "errors")] == [41, True, 12, 15, 3]
    assert [away[c] for c in ("team_id", "is_home", "runs", "hits", "errors")] == [58, False, 3, None, None]


def test_the_first_pitcher_listed_is_the_starter(spark):
    rows = collected(silver.pitcher_game_stats(_raw_box(spark, (_box(), NOON))), "pitcher_id")
    by_id = {row["pitcher_id"]: row for row in rows}
    assert sorted(by_id) == [310, 640, 825]
    assert [i for i, row in by_id.items() if row["is_starter"]] == [640]
    assert {i: round(row["innings_pitched"] * 3) for i, row in by_id.items()} == {640: 22, 310: 0, 825: 5}
    assert (by_id[310]["earned_runs"], by_id[310]["pitches_thrown"], by_id[310]["strikeouts"]) == (2, 14, None)


def test_a_corrected_boxscore_replaces_all_lines_of_the_first(spark):
    corrected = copy.deepcopy(_box(runs=13))
    corrected["teams"]["home"]["players"].update(_line(825, "1.2", strikeOuts=3))
    raw = _raw_box(spark, (corrected, LATER), (_box(), NOON))
    assert [row["runs"] for row in collected(silver.team_game_stats(raw), "team_id")] == [13, 3]
    pitchers = collected(silver.pitcher_game_stats(raw), "pitcher_id")
    assert [(p["pitcher_id"], p["strikeouts"]) for p in pitchers] == [(310, None), (640, 8), (825, 3)]


def test_transactions(spark):
    def move(code):
        return json.dumps({"typeCode": code, "person": {"id": 5, "fullName": "Bo"}, "toTeam": {"id": 3, "name": "C"}})

    raw = spark.createDataFrame(
        [(1, "2026-07-01", move("IL10"), NOON), (2, "2026-07-01", move("TR"), NOON),
         (3, "2026-07-02", move(None), NOON), (1, "2026-07-01", move("DFA"), LATER)],
        RAW_MOVES,
    )
    rows = collected(silver.transactions(raw), "transaction_id")
    assert [r["affects_availability"] for r in rows] == [True, False, None]
    assert rows[0]["type_code"] == "DFA"
    assert (rows[0]["to_team_id"], rows[0]["from_team_id"], rows[0]["person_name"]) == (3, None, "Bo")


def _odds(spark, games, *events):
    rows = []
    for i, (home, away, price, at) in enumerate(events):
        payload = {"home_team": home, "away_team": away, "bookmakers": [{"markets": [{"key": "h2h", "outcomes": [
            {"name": home, "price": price}, {"name": away, "price": 100}]}]}]}
        rows.append((f"e{i}", "2024-04-01", "t", home, away, json.dumps(payload), at))
    return collected(market.odds(spark.createDataFrame(rows, RAW_ODDS), games), "home_team", "game_pk")


def test_odds_join_by_names_and_date(spark, make_games):
    games = make_games([{}])
    unmatched, matched = sorted(
        _odds(spark, games, ("Home", "Away", 100, NOON), ("Elsewhere", "Away", 100, NOON)),
        key=lambda r: r["game_pk"] is not None,
    )
    assert matched["game_pk"] == 1000 and matched["game_date"] == "2024-04-01"
    assert unmatched["game_pk"] is None and unmatched["market_home_win_prob"] == 0.5


def test_latest_odds_win_and_doubleheaders_get_them_twice(spark, make_games):
    games = make_games([{}, {"game_date": date(2024, 4, 1)}])
    rows = _odds(spark, games, ("Home", "Away", 300, LATER), ("Home", "Away", 100, NOON))
    assert [(r["game_pk"], r["market_home_win_prob"]) for r in rows] == [
        (1000, rows[0]["market_home_win_prob"]), (1001, rows[0]["market_home_win_prob"]),
    ]
    assert rows[0]["market_home_win_prob"] < 0.5
