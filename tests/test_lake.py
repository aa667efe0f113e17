from __future__ import annotations

import json
from datetime import datetime

import pytest

from matchlake.schemas import GOLD
from matchlake.sources import landing
from matchlake.sources.lake import (
    Lake, json_records, read_or_empty, replace_partitions, table_counts, write_csv,
)
from pyspark.sql import functions as F

SCHEMA = "v int, date string"


def test_missing_tables_read_as_empty_typed_ones(spark, tmp_path):
    got = read_or_empty(spark, str(tmp_path / "none"), GOLD["features"])
    assert got.count() == 0 and "target_home_win" in got.columns


def test_only_touched_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")

    def rows():
        return sorted((r["date"], r["v"]) for r in spark.read.schema(SCHEMA).parquet(path).collect())

    replace_partitions(spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], SCHEMA), path)
    replace_partitions(spark.createDataFrame([(3, "2024-01-02"), (4, "2024-01-02")], SCHEMA), path)
    assert rows() == [("2024-01-01", 1), ("2024-01-02", 3), ("2024-01-02", 4)]
    replace_partitions(spark.createDataFrame([], SCHEMA), path)
    assert len(rows()) == 3


def test_partition_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "p")
    replace_partitions(spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], SCHEMA), path)
    day = spark.read.schema(SCHEMA).parquet(path).filter("date = '2024-01-02'")
    assert day.count() == 1
    assert "PartitionFilters: [isnotnull(date" in day._jdf.queryExecution().executedPlan().toString()


def test_views_for_stored_tables_only(spark, tmp_path, make_games):
    lake = Lake(spark, str(tmp_path))
    assert lake.register_views("gold") == []
    lake.store(spark.createDataFrame([], GOLD["roster_activity"]), "gold", "roster_activity")
    assert lake.register_views("gold", "gold_") == ["gold_roster_activity"]
    assert spark.sql("SELECT count(*) FROM gold_roster_activity").first()[0] == 0


def test_date_inside_the_files_can_win_over_the_folder(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    inner = spark.createDataFrame(
        [("e", "c", "h", "a", "{}", datetime(2024, 1, 1), "2024-01-05")],
        "odds_event_id string, commence_time string, home_team string, away_team string, payload string, fetched_at timestamp, date string",
    )
    inner.write.parquet(f"{tmp_path}/bronze/odds/date=2024-01-01")
    assert lake.bronze("odds").first()["date"] == "2024-01-01"
    assert lake.bronze("odds", inner_date=True).first()["date"] == "2024-01-05"


def test_json_records(spark):
    df = spark.createDataFrame(
        [(1, float("nan"), None, datetime(2024, 1, 1, 7)), (2, 0.5, "x", None)],
        "a int, b double, c string, d timestamp",
    )
    assert [json.loads(r["record"]) for r in json_records(df).orderBy("record").collect()] == [
        {"a": 1, "b": None, "c": None, "d": "2024-01-01T07:00:00+00:00"},
        {"a": 2, "b": 0.5, "c": "x", "d": None},
    ]


def test_counts_and_csv(spark, tmp_path):
    tables = {"one": spark.range(3), "none": spark.range(0)}
    assert {r["table_name"]: r["n"] for r in table_counts(tables).collect()} == {"one": 3, "none": 0}
    write_csv(spark.createDataFrame([("f", 0.5)], "feature string, importance double"), str(tmp_path / "c"))
    assert spark.read.csv(str(tmp_path / "c"), header=True).first().asDict() == {"feature": "f", "importance": "0.5"}


def test_reingest_days_are_oldest_first(spark):
    (days,) = spark.range(1).select(landing.reingest_days(F.lit("2024-03-01").cast("date"))).first()
    assert [str(d) for d in days] == ["2024-02-28", "2024-02-29", "2024-03-01"]


def test_seasons_and_pending_days(spark):
    assert [r["season"] for r in landing.seasons_between(spark, 2024, 2026).collect()] == [2024, 2025, 2026]
    days = spark.createDataFrame([("a",), ("b",)], "game_date string")
    stored = spark.createDataFrame([("a",)], "game_date string")
    assert [r["game_date"] for r in landing.pending_days(days, stored).collect()] == ["b"]
    assert landing.pending_days(days, stored, force=True).count() == 2


def test_payload_text_is_kept_whole(spark):
    game = {"gamePk": 5, "extra": {"deep": [1, {"x": None}]}, "gameType": "R"}
    document = json.dumps({"dates": [{"date": "d", "games": [game]}, {"date": "e", "games": []}]})
    docs = spark.createDataFrame([("2024-01-01", document)], "date string, document string")
    (row,) = landing.schedule_envelope(docs, F.lit("2024-01-02 00:00:00")).collect()
    assert row["game_pk"] == 5 and row["date"] == row["game_date"] == "2024-01-01"
    assert json.loads(row["payload"]) == game


@pytest.mark.parametrize("text,ok", [("{}", True), ("[1]", True), ('{"a":', False), ("", False), (None, False)])
def test_rejects(spark, text, ok):
    docs = spark.createDataFrame([(text,)], "document string")
    good, bad = landing.split_rejects(docs)
    assert (good.count(), bad.count()) == ((1, 0) if ok else (0, 1))
