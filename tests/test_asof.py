from __future__ import annotations

import random
from datetime import date, timedelta

import pytest

from matchlake.operators.asof import asof_join

DAY = date(2024, 1, 1)
LEFT = "id int, k int, d date"
RIGHT = "rk int, rd date, pk int, a int, b int"


def _join(spark, left, right):
    joined = asof_join(
        spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT),
        "k", "rk", "d", "rd", {"a": "out_a", "b": "b"}, tiebreak="pk",
    )
    assert joined.columns == ["id", "k", "d", "out_a", "b"]
    return {r["id"]: (r["out_a"], r["b"]) for r in joined.collect()}


def _brute(left, right):
    out = {}
    for id_, k, d in left:
        hits = [
            r for r in right
            if k is not None and d is not None and r[0] == k and r[1] is not None and r[1] <= d
        ]
        best = max(hits, key=lambda r: (r[1], r[2]), default=None)
        out[id_] = (best[3], best[4]) if best else (None, None)
    return out


@pytest.mark.parametrize("seed", range(12))
def test_matches_brute_force(spark, seed):
    rng = random.Random(seed)

    def some_day():
        return None if rng.random() < 0.05 else DAY + timedelta(days=rng.randint(0, 25))

    def some_key():
        return None if rng.random() < 0.1 else (7 if rng.random() < 0.35 else rng.randint(0, 4))

    left = [(i, some_key(), some_day()) for i in range(120)]
    right = [
        (some_key(), some_day(), pk, rng.choice([None, rng.randint(0, 9)]), rng.randint(0, 9))
        for pk in range(80)
    ]
    assert _join(spark, left, right) == _brute(left, right)


def test_empty_right_side(spark):
    assert _join(spark, [(1, 1, DAY)], []) == {1: (None, None)}


def test_a_matched_row_with_null_values_hides_older_ones(spark):
    right = [(1, DAY, 1, 5, 5), (1, DAY + timedelta(days=1), 2, None, None)]
    assert _join(spark, [(1, 1, DAY + timedelta(days=2))], right) == {1: (None, None)}


def test_same_day_counts_and_later_does_not(spark):
    right = [(1, DAY, 1, 5, 5), (1, DAY + timedelta(days=1), 2, 6, 6)]
    assert _join(spark, [(1, 1, DAY)], right) == {1: (5, 5)}


def test_requires_dates(spark):
    stamped = spark.createDataFrame([], "k int, d timestamp")
    with pytest.raises(TypeError):
        asof_join(stamped, spark.createDataFrame([], RIGHT), "k", "rk", "d", "rd", {"a": "a"}, "pk")
