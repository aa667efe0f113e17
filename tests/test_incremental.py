"""The refresh of what changed against a whole rebuild of the same raw rows."""

from __future__ import annotations

import json
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from matchlake.plans import incremental
from matchlake.plans.incremental import MONTH, TYPED_KEYS, feature_table, typed_table
from matchlake.schemas import BRONZE, GOLD, SILVER
from matchlake.session import materialise
from matchlake.sources.lake import Lake, replace_partitions

FIRST = date(2024, 2, 1)
TABLES = [("silver", name) for name in [*TYPED_KEYS, "odds"]] + [
    ("gold", name) for name in ("team_rolling", "pitcher_form", "bullpen_form", "park_factors", "roster_activity", "features")
]


def match(draw, pk, final):
    home, away = draw.sample(range(1, 7), 2)

    def side(team):
        return {
            "team": {"id": team, "name": f"T{team}"}, "score": draw.randint(0, 9) if final else None,
            "probablePitcher": {"id": 10 * team + draw.randint(0, 3), "fullName": "P"},
        }

    return {
        "gamePk": pk, "season": 2024, "gameType": "R", "status": {"detailedState": "Final" if final else "Scheduled"},
        "teams": {"home": side(home), "away": side(away)}, "venue": {"id": home, "name": "V"}, "dayNight": "day",
    }


def boxscore(draw, game):
    def side(name):
        team, starter = game["teams"][name]["team"], game["teams"][name]["probablePitcher"]["id"]
        ids = [starter, 1000 + starter]
        return {
            "team": team, "teamStats": {"batting": {"runs": 1}, "fielding": {"errors": 0}}, "pitchers": ids,
            "players": {f"ID{i}": {"person": {"id": i, "fullName": f"P{i}"}, "stats": {"pitching": {
                "inningsPitched": f"{draw.randint(1, 6)}.1", "earnedRuns": draw.randint(0, 5), "strikeOuts": 4}}} for i in ids},
        }

    return {"teams": {"home": side("home"), "away": side("away")}}


def land(lake, world, days, stamp):
    """Write the raw partitions of some days, as landing does."""
    rows = {"schedule": [], "boxscores": [], "transactions": [], "odds": []}
    for day in days:
        for game, box in world[day]:
            rows["schedule"].append((game["gamePk"], str(day), json.dumps(game), stamp, str(day)))
            if box:
                rows["boxscores"].append((game["gamePk"], json.dumps(box), stamp, str(day)))
        n = (day - FIRST).days
        move = {"typeCode": "IL10", "person": {"id": 1}, "toTeam": {"id": 1 + n % 6}}
        rows["transactions"].append((n, json.dumps(move), stamp, str(day)))
        teams = [world[day][0][0]["teams"][side]["team"]["name"] for side in ("home", "away")] if world[day] else ["x", "y"]
        rows["odds"].append((f"o{n}", "t", *teams, '{"bookmakers": []}', stamp, str(day)))
    for table, found in rows.items():
        path = lake.path("bronze", table)
        for day in days:  # a day without rows loses its partition
            folder = lake.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/date={day}")
            folder.getFileSystem(lake.spark._jsc.hadoopConfiguration()).delete(folder, True)
        replace_partitions(lake.spark.createDataFrame(found, BRONZE[table]), path)


def contents(lake):
    found = {}
    for layer, name in TABLES:
        schema = (SILVER if layer == "silver" else GOLD)[name]
        columns = [c.split()[0] for c in schema.split(", ")]
        rows = (lake.silver if layer == "silver" else lake.gold)(name).select(*columns).collect()
        plain = [tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in rows]
        found[name] = sorted(plain, key=repr)
    return found


def rebuilt(lake):
    incremental.rebuild_typed(lake)
    incremental.rebuild_features(lake)
    return contents(lake)


@pytest.fixture(scope="module")
def world():
    draw = random.Random(3)
    days = [FIRST + timedelta(days=i) for i in range(44)]
    found = {}
    for i, day in enumerate(days):
        games = [match(draw, 100 * i + k, i < 40) for k in range(0 if i == 20 else 3)]
        found[day] = [(game, boxscore(draw, game) if i < 40 else None) for game in games]
    return found


def changed_world(world, day, draw):
    """The day's matches are played, one of them is put off by two days, and a score and a line of the day before change."""
    world = {d: list(games) for d, games in world.items()}
    played = []
    for game, _ in world[day]:
        final = match(draw, game["gamePk"], True)
        played.append((final, boxscore(draw, final)))
    (late, _), *rest = played
    world[day] = rest
    world[day + timedelta(days=2)].append(({**late, "status": {"detailedState": "Postponed"}}, None))
    before = world[day - timedelta(days=1)]
    if before and before[-1][1]:
        game, _ = before[-1]
        again = match(draw, game["gamePk"], True)
        box = boxscore(draw, again)
        del box["teams"]["home"]["players"][f"ID{box['teams']['home']['pitchers'][1]}"]
        before[-1] = (again, box)
    return world


def test_days_that_are_landed_give_what_a_rebuild_gives(spark, tmp_path, world):
    lake, draw = Lake(spark, str(tmp_path / "lake")), random.Random(4)
    days = list(world)
    land(lake, world, days[:42], datetime(2024, 3, 11))
    assert incremental.refresh(lake, [str(d) for d in days[37:40]]) is None  # nothing was there
    assert contents(lake) == rebuilt(lake)
    for n in (40, 41):
        world = changed_world(world, days[n], draw)
        again = days[n - 2 : n + 3]
        before = {name: feature_table(lake, name).snapshot().parts for name in ("features", "team_rolling")}
        typed = typed_table(lake, "games").snapshot().parts
        land(lake, world, again, datetime(2024, 3, 12 + n - 40))
        first = incremental.refresh(lake, [str(d) for d in again])
        assert first is not None and first >= days[n - 3]
        after = {name: feature_table(lake, name).snapshot().parts for name in before}
        for name in before:
            assert before[name]["2024-02"] == after[name]["2024-02"] and before[name]["2024-03"] != after[name]["2024-03"]
        assert typed["2024-02"] == typed_table(lake, "games").snapshot().parts["2024-02"]
        refreshed = contents(lake)
        assert refreshed["features"] and refreshed == rebuilt(lake)
    # Nothing new in the raw rows: nothing changes.
    assert incremental.refresh(lake, [str(days[41])]) is not None
    assert contents(lake) == refreshed


def test_what_is_read_does_not_grow_with_history(spark, tmp_path, world):
    lake = Lake(spark, str(tmp_path / "lake"))
    days = list(world)
    land(lake, world, days[:42], datetime(2024, 3, 11))
    incremental.refresh(lake, [str(d) for d in days[37:40]])
    recent = incremental._from(typed_table(lake, "games"), "2024-03")
    every = typed_table(lake, "games").read()
    assert 0 < len(recent.inputFiles()) < len(every.inputFiles())
    assert not any("2024-02" in path for path in recent.inputFiles())
    assert recent.count() == every.filter(F.col(MONTH) == "2024-03").count()


def test_a_change_before_the_tails_rebuilds_everything(spark, tmp_path, world):
    lake, draw = Lake(spark, str(tmp_path / "lake")), random.Random(5)
    days = list(world)
    land(lake, world, days[:42], datetime(2024, 3, 11))
    incremental.refresh(lake, [str(d) for d in days[37:40]])
    world = changed_world(world, days[10], draw)
    land(lake, world, days[9:13], datetime(2024, 3, 12))
    assert incremental.refresh(lake, [str(d) for d in days[9:13]]) is None
    refreshed = contents(lake)
    assert refreshed == rebuilt(lake)


def test_a_rebuild_stores_the_sides_of_the_matches_once(spark, tmp_path, world, monkeypatch):
    """Both kinds of team form and the features come from one pass over them."""
    lake = Lake(spark, str(tmp_path / "lake"))
    days = list(world)
    land(lake, world, days[:42], datetime(2024, 3, 11))
    incremental.rebuild_typed(lake)
    stored = []

    def counted(df):
        found = materialise(df)
        stored.append((set(found.columns), found.count()))
        return found

    monkeypatch.setattr(incremental, "materialise", counted)
    incremental.rebuild_features(lake, days[38])
    matches = lake.silver("games").count()
    assert [n for columns, n in stored if "team_id" in columns and n > matches] == [2 * matches]


def test_the_last_rows_are_found_on_the_last_days(spark):
    rows = [(i, FIRST + timedelta(days=i // 5), None if i % 3 == 2 else i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "game_pk long, game_date date, team_id int")
    near = incremental._on_last_days(df, "team_id", 4)
    assert near.count() < 20

    def keys(frame):
        return sorted(row.game_pk for row in incremental._last(frame, ["team_id"], 4).collect())

    assert keys(near) == keys(df) and len(keys(df)) == 12
