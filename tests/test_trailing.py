from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from matchlake.operators.trailing import Strategy, running_min, trailing, with_position

from conftest import collected

REACH = 5
SCHEMA = "entity string, day int, pk int, v double"


def _random_rows(seed, n=300):
    """Ties on days, NULL values, a NULL entity, and one entity with a third of the rows."""
    rng = random.Random(seed)
    rows = []
    for pk in range(n):
        entity = "hot" if rng.random() < 1 / 3 else rng.choice(["a", "b", "c", None])
        value = None if rng.random() < 0.1 else float(rng.randint(0, 50))
        rows.append((entity, rng.randint(0, 40), pk, value))
    rng.shuffle(rows)
    return rows


def _measures(frames):
    last = frames.last(REACH)
    return {
        "total": F.sum("v").over(last),
        "n": F.count("v").over(last),
        "previous": F.lag("pk").over(frames.ordered),
    }


def _expected(rows, by_entity=True):
    out = {}
    groups = {}
    for row in sorted(rows, key=lambda r: (r[1], r[2])):
        groups.setdefault(row[0] if by_entity else None, []).append(row)
    for group in groups.values():
        for i, row in enumerate(group):
            window = [r[3] for r in group[max(0, i - REACH):i] if r[3] is not None]
            out[row[2]] = (
                sum(window) if window else None,
                len(window),
                group[i - 1][2] if i else None,
            )
    return out


@pytest.mark.parametrize("seed", range(8))
@pytest.mark.parametrize("strategy", [Strategy("plain"), Strategy("blocks", 7), Strategy("blocks", 5)])
def test_matches_brute_force(spark, seed, strategy):
    rows = _random_rows(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    got = trailing(df, ["entity"], ["day", "pk"], REACH, _measures, strategy)
    assert got.columns == ["entity", "day", "pk", "v", "total", "n", "previous"]
    actual = {r["pk"]: (r["total"], r["n"], r["previous"]) for r in got.collect()}
    assert actual == _expected(rows)


@pytest.mark.parametrize("block_rows", [5, 6, 50, 10_000])
def test_without_entity(spark, block_rows):
    rows = _random_rows(99)
    df = spark.createDataFrame(rows, SCHEMA)
    got = trailing(df, [], ["day", "pk"], REACH, _measures, Strategy("blocks", block_rows))
    actual = {r["pk"]: (r["total"], r["n"], r["previous"]) for r in got.collect()}
    assert actual == _expected(rows, by_entity=False)


@pytest.mark.parametrize("strategy", [Strategy("plain"), Strategy("blocks", 6)])
def test_changing_a_row_never_changes_itself_or_earlier_rows(spark, strategy):
    rows = sorted(_random_rows(3, 60), key=lambda r: (r[1], r[2]))
    changed = rows[30]
    poisoned = [r if r is not changed else (*r[:3], 1e9) for r in rows]

    def run(data):
        df = spark.createDataFrame(data, SCHEMA)
        out = trailing(df, ["entity"], ["day", "pk"], REACH, _measures, strategy)
        return {r["pk"]: (r["total"], r["n"]) for r in out.collect()}

    before, after = run(rows), run(poisoned)
    for row in rows[:31]:
        assert before[row[2]] == after[row[2]]


@pytest.mark.parametrize("strategy", [Strategy("plain"), Strategy("blocks", 7)])
@pytest.mark.parametrize("seed", range(4))
def test_running_min(spark, seed, strategy):
    rows = _random_rows(seed)
    got = running_min(
        spark.createDataFrame(rows, SCHEMA), ["entity"], ["day", "pk"], "v", "best", strategy
    )
    expected, best = {}, {}
    for entity, _, pk, v in sorted(rows, key=lambda r: (r[1], r[2])):
        expected[pk] = best.get(entity)
        if v is not None:
            best[entity] = v if best.get(entity) is None else min(v, best[entity])
    assert {r["pk"]: r["best"] for r in got.collect()} == expected


def test_positions_are_dense_and_ordered(spark):
    rows = _random_rows(5)
    placed = collected(with_position(spark.createDataFrame(rows, SCHEMA), ["day", "pk"]), "_position")
    assert [r["_position"] for r in placed] == list(range(len(rows)))
    assert [r["pk"] for r in placed] == [r[2] for r in sorted(rows, key=lambda r: (r[1], r[2]))]


def test_a_frame_over_the_whole_table_is_in_blocks(spark):
    assert not Strategy().splits(["entity"]) and Strategy().splits([])
    with pytest.raises(ValueError):
        Strategy("other").splits(["entity"])
    df = spark.createDataFrame(_random_rows(1), SCHEMA)
    plan = trailing(df, [], ["day", "pk"], REACH, _measures)._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "SinglePartition, ENSURE_REQUIREMENTS, [plan_id" not in plan.split("Window", 1)[1].split("_part")[0]
