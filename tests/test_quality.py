from __future__ import annotations

import pytest

from matchlake.plans import quality

STATS = "game_pk long, team_id int, runs int"


@pytest.fixture
def good(spark, make_games, make_pitchers):
    games = make_games([{}, {"game_pk": 2000, "status": "Scheduled", "home_score": None}, {"game_pk": 1002}])
    stats = [(g, t, 1) for g in (1000, 1002) for t in (100, 200)]
    pitchers = [(g, t, t, True, 6.0, 1, 1) for g in (1000, 1002) for t in (100, 200)]
    pitchers.append((1000, 100, 9, False, 3.0, 0, 0))
    return games, stats, pitchers


def _report(spark, make_pitchers, games, stats, pitchers):
    report = quality.quality_report(games, spark.createDataFrame(stats, STATS), make_pitchers(pitchers))
    return {r["name"]: (r["passed"], r["details"]) for r in report.collect()}


def test_consistent_tables_pass(spark, make_pitchers, good):
    report = _report(spark, make_pitchers, *good)
    assert len(report) == 8 and all(passed for passed, _ in report.values())
    assert report["games.pk_unique"][1] == "0 duplicate game_pk rows out of 3"


def test_broken_games_fail(spark, make_games, make_pitchers, good):
    from pyspark.sql import functions as F

    _, stats, pitchers = good
    games = make_games([{}, {"game_pk": 1000}, {"game_pk": 1002, "home_score": None}, {"home_team_id": None}])
    report = _report(spark, make_pitchers, games, stats, pitchers)
    assert report["games.pk_unique"] == (False, "1 duplicate game_pk rows out of 4")
    assert report["games.final_has_scores"] == (False, "1 missing scores among 4 Final games")
    assert report["games.total_runs_consistent"][0] is False
    assert "'home_team_id': 1" in report["games.no_null_ids"][1]
    wrong = good[0].withColumn("total_runs", F.col("total_runs") + 1)
    report = _report(spark, make_pitchers, wrong, stats, pitchers)
    assert report["games.total_runs_consistent"][1].startswith("2 rows")


def test_broken_details_fail(spark, make_pitchers, good):
    games, stats, pitchers = good
    report = _report(spark, make_pitchers, games, stats[:1] + stats[:1] + stats[1:2], pitchers[1:2])
    assert report["team_stats.pk_unique"] == (False, "1 duplicate (game_pk, team_id) rows out of 3")
    assert report["team_stats.two_rows_per_final_game"] == (
        False,
        "1 Final games with row-count != 2, 1 Final games with no team_game_stats rows at all",
    )
    assert report["pitcher_stats.two_starters_per_final_game"] == (
        False,
        "1 Final games with != 2 starters, 1 Final games with no starter rows at all",
    )
    assert report["pitcher_stats.pk_unique"][0]


def test_empty_tables_pass(spark, make_games, make_pitchers):
    report = _report(spark, make_pitchers, make_games([]), [], [])
    assert len(report) == 8 and all(passed for passed, _ in report.values())


def test_gate_and_declared_checks(spark, make_games):
    games = make_games([{}, {"game_pk": 1000}])
    report = quality.declared_checks(games, "games", {"game_pk": ["unique", "not_null"]})
    assert {r["name"]: r["passed"] for r in report.collect()} == {
        "games.game_pk.unique": False, "games.game_pk.not_null": True,
    }
    with pytest.raises(quality.QualityError, match="1 duplicate game_pk rows"):
        quality.enforce(report)
    quality.enforce(report.filter("passed"))


def test_order_lines_are_read_and_shuffled_once_for_pitcher_lines(spark):
    from matchlake.harness import tables as t

    sf_dir = "/root/testdata/sf0.001"
    found = t.pitchers(spark, sf_dir)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert len([line for line in plan.splitlines() if "Scan parquet" in line and "l_suppkey" in line]) == 1
    lines = t.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey").distinct().collect()
    first = {}
    for order, supplier in lines:
        first[order, supplier % 2] = min(supplier, first.get((order, supplier % 2), supplier))
    starters = {(r.game_pk, r.pitcher_id) for r in found.collect() if r.is_starter}
    assert starters == {(order, supplier) for (order, _), supplier in first.items()}
