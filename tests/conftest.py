from __future__ import annotations

import sys
from datetime import date, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from matchlake.plans.silver import with_targets  # noqa: E402
from matchlake.session import build_session  # noqa: E402

GAMES = (
    "game_pk long, game_date date, season int, game_type string, status string, "
    "home_team_id int, away_team_id int, home_team_name string, away_team_name string, "
    "home_score int, away_score int, venue_id int, day_night string, "
    "home_probable_pitcher_id int, away_probable_pitcher_id int"
)
PITCHERS = (
    "game_pk long, team_id int, pitcher_id int, is_starter boolean, innings_pitched double, "
    "earned_runs int, strikeouts int"
)
TRANSACTIONS = (
    "transaction_id long, transaction_date date, type_code string, from_team_id int, "
    "to_team_id int, affects_availability boolean"
)
OPENING = date(2024, 4, 1)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    return session


@pytest.fixture(scope="session")
def make_games(spark):
    """Games from dicts; what a dict leaves out gets a default."""

    def make(rows):
        full = []
        for i, row in enumerate(rows):
            base = {
                "game_pk": 1000 + i, "game_date": OPENING + timedelta(days=i), "season": 2024,
                "game_type": "R", "status": "Final", "home_team_id": 100, "away_team_id": 200,
                "home_team_name": "Home", "away_team_name": "Away", "home_score": 1,
                "away_score": 0, "venue_id": 100, "day_night": "night",
                "home_probable_pitcher_id": None, "away_probable_pitcher_id": None,
            }
            base.update(row)
            full.append(tuple(base.values()))
        return with_targets(spark.createDataFrame(full, GAMES))

    return make


@pytest.fixture(scope="session")
def make_pitchers(spark):
    return lambda rows: spark.createDataFrame(rows, PITCHERS)


@pytest.fixture(scope="session")
def make_transactions(spark):
    return lambda rows: spark.createDataFrame(rows, TRANSACTIONS)


def collected(df, *order):
    rows = [r.asDict(recursive=True) for r in df.collect()]
    return sorted(rows, key=lambda r: tuple((r[c] is not None, r[c]) for c in order))
