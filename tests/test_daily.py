"""The whole batch on landed files: land, type, derive, train, score, grade, land again."""

from __future__ import annotations

import json
from datetime import date, datetime, timedelta

import pytest

from matchlake.plans import daily, registry
from matchlake.plans.train_run import train_all
from matchlake.sources.lake import Lake
from matchlake.sources import landing
from matchlake.streaming.landed import land_new_files

FIRST = date(2024, 4, 1)
NOW = datetime(2024, 4, 12, 7)
N_DAYS, PER_DAY = 12, 3


def _write(root, table, day, name, document):
    folder = root / table / f"date={day}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.json").write_text(document if isinstance(document, str) else json.dumps(document))


def _land(root, day, final=True):
    index = (day - FIRST).days
    games = []
    for k in range(PER_DAY):
        pk = 1000 + index * 10 + k
        home, away = 1 + k, 4 + (index + k) % 3
        games.append({
            "gamePk": pk, "gameDate": f"{day}T18:20:00Z", "season": 2024 + index % 3, "gameType": "R",
            "status": {"detailedState": "Final" if final else "Scheduled"},
            "teams": {
                "home": {"team": {"id": home, "name": f"T{home}"}, "score": (pk * 7) % 9 + 1,
                         "probablePitcher": {"id": 10 * home, "fullName": f"P{home}"}},
                "away": {"team": {"id": away, "name": f"T{away}"}, "score": (pk * 5) % 9},
            },
            "venue": {"id": home, "name": "V"}, "dayNight": "day" if k else "night",
        })

        def side(team, runs):
            return {
                "team": {"id": team, "name": f"T{team}"},
                "teamStats": {"batting": {"runs": runs}, "fielding": {"errors": 0}},
                "pitchers": [10 * team, 10 * team + 1],
                "players": {f"ID{i}": {"person": {"id": i, "fullName": f"P{i}"}, "stats": {"pitching": {
                    "inningsPitched": "5.1", "earnedRuns": 2, "strikeOuts": 4}}}
                    for i in (10 * team, 10 * team + 1)},
            }

        _write(root, "boxscores", day, pk, {"teams": {"home": side(home, 1), "away": side(away, 0)}})
        _write(root, "plays", day, pk, {"allPlays": []})
    _write(root, "schedule", day, "schedule", {"dates": [{"date": str(day), "games": games}]})
    _write(root, "boxscores", day, 999_999, {"teams": {}})  # not on the schedule
    _write(root, "transactions", day, "transactions", {"transactions": [
        {"id": index, "typeCode": "IL10", "person": {"id": 1, "fullName": "X"}, "toTeam": {"id": 1, "name": "T1"}}]})
    _write(root, "odds", day, "odds", [{
        "id": f"o{index}", "commence_time": "t", "home_team": "T1", "away_team": f"T{4 + index % 3}",
        "bookmakers": [{"key": "b", "markets": [{"key": "h2h", "outcomes": [
            {"name": "T1", "price": -120}, {"name": f"T{4 + index % 3}", "price": 110}]},
            {"key": "totals", "outcomes": [{"name": "Over", "point": 8.5}]}]}]}])


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("world")
    landing_root = root / "landing"
    last = FIRST + timedelta(days=N_DAYS - 1)
    for i in range(N_DAYS):
        day = FIRST + timedelta(days=i)
        _land(landing_root, day, final=day != last)
    _write(landing_root, "schedule", last, "broken", '{"dates": [')
    lake = Lake(spark, str(root / "lake"))
    daily.land_days(lake, str(landing_root), daily.days_before(last, N_DAYS), NOW)
    daily.build_silver(lake)
    daily.build_gold(lake)
    return lake, landing_root, last


def test_landed_rows(world):
    lake, _, last = world
    assert lake.bronze("schedule").count() == N_DAYS * PER_DAY
    assert lake.bronze("boxscores").count() == N_DAYS * PER_DAY
    assert lake.bronze("plays").count() == N_DAYS * PER_DAY
    rejected = lake.spark.read.parquet(lake.path("bronze", "_rejects/schedule")).collect()
    assert [(r["name"], str(r["date"])) for r in rejected] == [("broken", str(last))]


def test_only_the_wanted_folders_are_read(world):
    lake, landing_root, last = world
    assert daily.days_before(date(2024, 3, 1)) == ["2024-02-28", "2024-02-29", "2024-03-01"]
    wanted = landing.read_documents(lake.spark, f"{landing_root}/schedule", [str(last), "1999-01-01"])
    assert wanted.count() == 2
    assert {path.split("/")[-2] for path in wanted.inputFiles()} == {f"date={last}"}
    assert "InMemoryFileIndex(1 paths)" in wanted._jdf.queryExecution().executedPlan().toString()
    assert landing.read_documents(lake.spark, f"{landing_root}/schedule", ["1999-01-01"]).count() == 0


def _rejects(lake, table):
    rows = lake.spark.read.parquet(lake.path("bronze", f"_rejects/{table}")).collect()
    return sorted((r["name"], str(r["date"])) for r in rows)


def test_odd_files_stop_nothing(spark, tmp_path):
    lake, root, day = Lake(spark, str(tmp_path / "lake")), tmp_path / "landing", date(2021, 8, 30)
    _land(root, day)
    repeated = '{"copyright": 1, "dates": [{"date": "d", "games": [{"gamePk": 77, "gameType": "R"}, {"gamePk": "?"}]}], "copyright": 2}'
    _write(root, "schedule", day, "repeated", repeated)
    _write(root, "boxscores", day, "index", {"teams": {}})
    _write(root, "boxscores", day, 77, {"teams": {}, "filler": "x" * 25_000_000})
    match = lambda day: 1000 + (day - FIRST).days * 10
    _write(root, "plays", day, match(day), '{"allPlays": [')
    daily.land_days(lake, str(root), [str(day)], NOW)
    assert lake.bronze("schedule").filter("game_pk = 77").count() == 1
    assert lake.bronze("boxscores").filter("game_pk = 77 AND length(payload) > 25000000").count() == 1
    assert lake.spark.read.parquet(lake.path("bronze", "_rejects/schedule")).select("document").first()[0] == '{"gamePk":"?"}'
    assert _rejects(lake, "boxscores") == [("index", str(day))]
    assert _rejects(lake, "plays") == [(str(match(day)), str(day))]
    _write(root, "plays", day, match(day), '{"allPlays": []}')
    other = day + timedelta(days=1)
    _write(root, "plays", other, match(other), "{")
    daily.land_days(lake, str(root), [str(day), str(other)], NOW)
    assert _rejects(lake, "plays") == [(str(match(other)), str(other))]


def test_backfill_goes_on_where_it_stopped(spark, tmp_path):
    lake, root = Lake(spark, str(tmp_path / "lake")), tmp_path / "landing"
    days = [date(2018, 9, 28), date(2018, 9, 30), date(2019, 4, 2)]
    for day in days:
        _land(root, day)
        folder = root / "seasons" / f"season={day.year}"
        folder.mkdir(parents=True, exist_ok=True)
        dates = [{"date": str(d), "games": [{"gamePk": 1, "gameType": "R"}]} for d in days if d.year == day.year]
        dates.append({"date": f"{day.year}-02-25", "games": [{"gamePk": 2, "gameType": "S"}]})
        (folder / "schedule.json").write_text(json.dumps({"dates": dates}))
        (folder / "broken.json").write_text("{")
    expected = [str(day) for day in days]
    daily.land_days(lake, str(root), expected[:1], NOW)
    assert daily.backfill(lake, str(root), 2016, 2019, NOW) == expected[1:]
    assert daily.backfill(lake, str(root), 2016, 2019, NOW) == []
    assert daily.backfill(lake, str(root), 2018, 2018, NOW, force=True) == expected[:2]
    assert lake.bronze("schedule").count() == 3 * PER_DAY


def test_typed_and_derived_rows(world):
    lake, _, _ = world
    n = N_DAYS * PER_DAY
    assert lake.silver("games").count() == n and lake.gold("features").count() == n
    assert lake.silver("team_game_stats").count() == 2 * n
    assert lake.silver("pitcher_game_stats").count() == 4 * n
    assert lake.silver("transactions").count() == N_DAYS
    assert lake.silver("odds").filter("game_pk IS NOT NULL").count() == N_DAYS
    assert lake.gold("features").filter("home_sp_era_l5 IS NOT NULL").count() > 0


def test_a_day_of_features_is_read_from_its_month(world):
    lake, _, last = world
    found = daily.features_on(lake, last)
    assert found.columns == lake.gold("features").columns and found.count() == PER_DAY
    assert "PartitionFilters: [isnotnull(game_month" in found._jdf.queryExecution().executedPlan().toString()
    assert daily.features_on(lake, last.replace(year=1990)).count() == 0


def test_checks_append_to_the_report(world):
    lake, _, _ = world
    assert daily.check_silver(lake, NOW).filter("NOT passed").count() == 0
    daily.check_silver(lake, NOW + timedelta(days=1), fail=True)
    assert lake.silver("_quality").count() == 16


def test_train_score_grade_and_land_again(world):
    lake, landing_root, last = world
    few = {"trees": 3, "min_child_weight": 1}
    with pytest.raises(LookupError):
        daily.load_serving(lake)
    winner, runs = train_all(lake, [2024], [2025], [2026], NOW, few, few)
    assert {r["model"] for r in winner.collect()} == {"baseline", "logistic_regression", "boosted_trees"}
    assert {r["model"] for r in runs.collect()} == {"baseline", "ridge_regression", "boosted_trees"}
    stored = lake.spark.read.parquet(daily.runs_path(lake))
    assert stored.count() == 4
    promoted = stored.filter("tags['promoted'] = 'true'")
    assert {r["experiment"] for r in promoted.collect()} == {registry.WINNER_EXPERIMENT, registry.RUNS_EXPERIMENT}

    outcomes = daily.daily_batch(lake, str(landing_root), last, NOW)
    assert lake.gold("predictions").count() == PER_DAY and outcomes.count() == 0
    assert not daily.score_day(lake, last + timedelta(days=9), NOW)
    keys = [row["game_pk"] for row in lake.gold("features").limit(2).collect()]
    explained = daily.explain_games(lake, [*keys, -1]).collect()
    assert {row["game_pk"] for row in explained} == set(keys) and len(explained) == 10
    assert all(row["line"][0] in "↑↓" for row in explained)

    _land(landing_root, last, final=True)
    outcomes = daily.daily_batch(lake, str(landing_root), last + timedelta(days=1), NOW + timedelta(days=1))
    finished = lake.silver("games").filter("status = 'Final' AND home_win IS NOT NULL")
    assert outcomes.count() == finished.filter(f"game_date = '{last}'").count() > 0
    assert lake.bronze("schedule").count() == N_DAYS * PER_DAY
    assert outcomes.filter("market_home_win_prob IS NOT NULL").count() <= 1


def test_stream_lands_the_same_rows(world, tmp_path):
    lake, landing_root, last = world
    streamed = Lake(lake.spark, str(tmp_path / "lake"))
    checkpoint = str(tmp_path / "checkpoint")
    land_new_files(streamed, str(landing_root), checkpoint, NOW).awaitTermination()

    def payloads(of, table):
        return sorted(tuple(r) for r in of.bronze(table).select("payload", "date").collect())

    for table in daily.BRONZE_DOCUMENTS:
        assert payloads(streamed, table) == payloads(lake, table)
    later = last + timedelta(days=1)
    _land(landing_root, later)
    land_new_files(streamed, str(landing_root), checkpoint, NOW).awaitTermination()
    assert streamed.bronze("schedule").filter(f"date = '{later}'").count() == PER_DAY
    assert streamed.bronze("schedule").count() == (N_DAYS + 1) * PER_DAY
