"""Stored versions: whole or not at all, two writers, and merges that leave other partitions alone."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from matchlake.operators.latest import latest_wins
from matchlake.sources import versions
from matchlake.sources.lake import Lake
from matchlake.sources.versions import LANDED_IN, Conflict, SnapshotTable, VersionLog, merge_landing

ROWS = "k long, v int"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_a_number_is_taken_once(spark, tmp_path):
    log = VersionLog(spark, str(tmp_path / "log"))
    assert log.newest() == (0, None)
    assert log.put(1, {"a": 1}) and not log.put(1, {"a": 2}) and log.put(2, {"a": 3})
    assert log.newest() == (2, {"a": 3}) and log.get(1) == {"a": 1}


def test_a_file_left_behind_by_a_lost_writer_is_passed_over(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versions, "PATIENCE", 0.2)
    log = VersionLog(spark, str(tmp_path / "log"))
    log.put(1, {"a": 1})
    (tmp_path / "log" / "0000000002.json").write_text('{"a": ')
    assert log.newest() == (2, {"a": 1})
    assert log.put(3, {"a": 3}) and log.newest() == (3, {"a": 3})


def test_a_rebuild_that_fails_leaves_the_old_table(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path))
    old = spark.createDataFrame([(1, 1), (2, 2)], "team_id int, il_events_l30 long").withColumn("game_date", F.lit("2024-01-01").cast("date"))
    lake.store(old, "gold", "roster_activity")
    monkeypatch.setattr(VersionLog, "put", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        lake.store(old.limit(0), "gold", "roster_activity")
    assert lake.gold("roster_activity").count() == 2
    monkeypatch.undo()
    with pytest.raises(Exception, match="broken"):
        lake.store(old.withColumn("team_id", F.raise_error(F.lit("broken")).cast("int")), "gold", "roster_activity")
    assert lake.gold("roster_activity").count() == 2
    lake.store(old.limit(1), "gold", "roster_activity")
    assert lake.gold("roster_activity").count() == 1


def test_old_folders_go_after_some_versions(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), ROWS)
    reader = None
    for n in range(5):
        table.rebuild(spark.createDataFrame([(n, n)], ROWS))
        if n == 3:
            reader = table.read()
    assert rows_of(table.read()) == [(4, 4)] and rows_of(reader) == [(3, 3)]
    assert len(list((tmp_path / "t").glob("_data=*"))) == 2


def test_of_two_writers_one_is_told(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), ROWS, "p")
    df = spark.createDataFrame([(1, 1, "a"), (2, 2, "b")], f"{ROWS}, p string")
    table.rebuild(df)
    base = table.snapshot()
    table.replace(base, ["a"], df.filter("p = 'a'").withColumn("v", F.lit(9)))
    with pytest.raises(Conflict):
        table.replace(base, ["b"], df.filter("p = 'b'").withColumn("v", F.lit(8)))
    assert rows_of(table.read()) == [(1, 9, "a"), (2, 2, "b")]
    with pytest.raises(ValueError):
        table.replace(table.snapshot(), ["a"], df)


def test_partitions_that_stay_keep_their_folders(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), ROWS, "p", ["k"])
    df = spark.range(100).select(F.col("id").alias("k"), F.lit(0).alias("v"), (F.col("id") / 25).cast("int").cast("string").alias("p"))
    before = table.rebuild(df)
    assert before.ranges["3"] == {"k": [75, 99]}
    assert table.holding(before, "k", spark.createDataFrame([(30,), (31,)], "k long")) == {"1"}
    assert table.holding(before, "k", spark.createDataFrame([], "k long")) == set()
    after = table.replace(before, ["2"], df.filter("p = '2'").withColumn("v", F.lit(1)))
    assert {p for p in "0123" if before.parts[p] != after.parts[p]} == {"2"}
    assert table.read().filter("v = 1").count() == 25 and table.read().count() == 100
    assert rows_of(table.read(parts=["2"]).groupBy("p").count()) == [("2", 25)]


def typed(raw):
    newest = latest_wins(raw, ["k"], "ingested_at", ["payload"])
    return newest.select("k", F.col("payload").cast("int").alias("v"), "ingested_at", F.col("date").alias(LANDED_IN), F.col("p"))


@pytest.mark.parametrize("seed", range(4))
def test_merges_equal_parsing_everything(spark, tmp_path, seed, monkeypatch):
    """Landing partitions are rewritten at random: keys change, move, vanish and come back."""
    monkeypatch.setattr(versions, "PUSHED_KEYS", 3 if seed % 2 else 1000)
    draw = random.Random(seed)
    table = SnapshotTable(spark, str(tmp_path / "t"), "k long, v int, ingested_at int", "p", ["k", LANDED_IN])
    fields, raw, untouched = "k long, payload string, ingested_at int, date string, p string", {}, 0
    for step in range(4):
        again = [f"d{i}" for i in (range(6) if step == 0 else draw.sample(range(6), 2))]
        for day in again:
            keys = draw.sample(range(12), draw.randint(0, 5))
            raw[day] = [(k, str(draw.randint(0, 99)), step, day, draw.choice([f"p{k % 5}", f"p{(k + 1) % 5}", None])) for k in keys]
        landed = spark.createDataFrame([row for rows in raw.values() for row in rows], fields)
        before = table.snapshot()
        if step == 0:
            table.rebuild(typed(landed))
        else:
            merge_landing(table, landed, again, typed, ["k"])
            after = table.snapshot()
            untouched += sum(before.parts[p] == after.parts.get(p) for p in before.parts)
        expected = typed(landed)
        assert rows_of(table.read(extra=f"{LANDED_IN} string").select("k", "ingested_at", LANDED_IN).select("k", "ingested_at")) == rows_of(
            expected.select("k", "ingested_at")
        )
    assert untouched > 0
