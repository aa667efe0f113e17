from __future__ import annotations

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchlake.operators.quantiles import exact_medians
from matchlake.operators.trailing import Strategy
from matchlake.plans import attribution, registry, splits, training
from matchlake.plans.gold import FEATURES, RUNS_TARGET, WINNER_TARGET
from matchlake.schemas import RUNS

BOOLEAN = "is_day_game"
SCHEMA = (
    "game_pk long, season int, "
    + ", ".join(f"{c} {'boolean' if c == BOOLEAN else 'double'}" for c in FEATURES)
    + f", {WINNER_TARGET} boolean, {RUNS_TARGET} int"
)


def _matrix_rows(n, seed=0):
    """Gaussian features with holes; both targets follow the first two."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        x = rng.normal(size=len(FEATURES))
        signal = x[0] - 0.5 * x[1] + 0.3 * rng.normal()
        values = [
            bool(v > 0) if c == BOOLEAN else (None if rng.random() < 0.05 else float(v))
            for c, v in zip(FEATURES, x)
        ]
        season = 2024 + (i % 5 == 3) + 2 * (i % 5 == 4)
        rows.append((i, int(season), *values, bool(signal > 0), int(round(9 + 2 * signal))))
    return rows


@pytest.fixture(scope="module")
def split(spark):
    df = spark.createDataFrame(_matrix_rows(400), SCHEMA)
    return splits.split_by_season(df, [2024], [2025], [2026]).cache()


def _numpy(split, fitted):
    train = split.filter("split = 'train'").orderBy("game_pk")
    x = np.array([list(r) for r in train.select(*[fitted.prepared.scaled(c) for c in fitted.prepared.features]).collect()])
    won = np.array([float(r[0]) for r in train.select(WINNER_TARGET).collect()])
    runs = np.array([float(r[0]) for r in train.select(RUNS_TARGET).collect()])
    return x, won, runs


def test_split_keeps_labelled_rows_of_listed_seasons(spark, split):
    assert {r["split"]: r["count"] for r in split.groupBy("split").count().collect()} == {
        "train": 240, "val": 80, "test": 80,
    }
    with pytest.raises(ValueError):
        splits.split_by_season(split.drop("split"), [2024], [2024], [])
    unlabelled = split.drop("split").withColumn(WINNER_TARGET, F.lit(None).cast("boolean"))
    assert splits.split_by_season(unlabelled, [2024], [], []).count() == 0


def test_metrics_closed_form(spark):
    df = spark.createDataFrame(
        [("a", True, 0.5, 10, 8.0), ("a", False, 0.5, 10, 9.0), ("b", True, 1.0, 3, 3.0)],
        f"split string, {WINNER_TARGET} boolean, predicted_home_win_prob double, {RUNS_TARGET} int, predicted_total_runs double",
    )
    a, b = splits.classification_metrics(df, "split").orderBy("split").collect()
    assert (a["n"], a["accuracy"], a["brier"]) == (2, 0.5, 0.25) and a["log_loss"] == pytest.approx(math.log(2))
    assert b["log_loss"] == pytest.approx(0.0, abs=1e-12)
    a, _ = splits.regression_metrics(df, "split").orderBy("split").collect()
    assert (a["mae"], a["within_1"], a["within_2"]) == (1.5, 0.5, 1.0) and a["rmse"] == pytest.approx(math.sqrt(2.5))
    assert splits.regression_metrics(df.limit(0), "split").count() == 0


def test_baselines_use_training_means(split):
    scored = splits.with_baselines(split)
    train = split.filter("split = 'train'").agg(F.avg(F.col(WINNER_TARGET).cast("int")), F.avg(RUNS_TARGET)).first()
    got = scored.select("predicted_home_win_prob", "predicted_total_runs").distinct().collect()
    assert len(got) == 1 and tuple(got[0]) == pytest.approx(tuple(train))


def test_baselines_need_training_rows(split):
    with pytest.raises(Exception, match="no training rows"):
        splits.with_baselines(split.filter("split = 'val'")).collect()


@pytest.mark.parametrize("seed", range(5))
@pytest.mark.parametrize("direct", [1, 3, 10_000])
def test_exact_medians(spark, seed, direct):
    rng = random.Random(seed)
    n = rng.choice([40, 41])
    rows = [
        (rng.random(), float(rng.randint(0, 2)), None if rng.random() < 0.5 else rng.gauss(0, 9), None, 5.0)
        for _ in range(n)
    ]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double")
    expected = {
        name: (float(np.median(v)) if (v := [r[i] for r in rows if r[i] is not None]) else None)
        for i, name in enumerate("abcde")
    }
    assert exact_medians(df, list("abcde"), direct) == expected


@pytest.mark.parametrize("rest_rows", [1, 2, 5, 10_000])
def test_medians_of_odd_values_do_not_depend_on_the_size(spark, rest_rows):
    inf, nan = float("inf"), float("nan")
    columns = {
        "high": [1.0, inf, inf, inf, 2.0], "low": [-inf, -inf, -inf, 3.0, 4.0], "mixed": [-inf, 0.0, inf, nan, None],
        "edge": [-inf, 5.0, inf, inf, nan], "ties": [7.0] * 4 + [8.0], "none": [nan, None, nan, None, nan],
    }
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns))
    expected = {"high": inf, "low": -inf, "mixed": 0.0, "edge": inf, "ties": 7.0, "none": None}
    assert exact_medians(df, list(columns), rest_rows) == expected


def test_preparation_handles_empty_and_constant_columns(spark):
    df = spark.createDataFrame([(None, 2.0, 1.0), (None, 2.0, None), (None, 2.0, 3.0)], "a double, b double, c double")
    prepared = training.fit_preparation(df, ["a", "b", "c"])
    assert prepared.features == ["b", "c"] and prepared.deviations["b"] == 1.0
    assert prepared.medians["c"] == 2.0 and prepared.deviations["c"] == pytest.approx(math.sqrt(2 / 3))


def test_ridge_equals_the_closed_form(split):
    fitted = training.fit_ridge(split, alpha=1.0)
    x, _, y = _numpy(split, fitted)
    expected = np.linalg.solve(x.T @ x + np.eye(x.shape[1]), x.T @ (y - y.mean()))
    assert np.allclose(fitted.model.coefficients.toArray(), expected, atol=1e-8)
    assert fitted.model.intercept == pytest.approx(y.mean())


def test_logistic_equals_newton(split):
    fitted = training.fit_logistic(split, C=1.0)
    x, y, _ = _numpy(split, fitted)
    design, w = np.hstack([x, np.ones((len(x), 1))]), np.zeros(x.shape[1] + 1)
    penalty = np.eye(len(w))
    penalty[-1, -1] = 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ w))
        w -= np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + penalty, design.T @ (p - y) + penalty @ w)
    assert np.allclose(fitted.model.coefficients.toArray(), w[:-1], atol=1e-4)
    assert fitted.model.intercept == pytest.approx(w[-1], abs=1e-4)


@pytest.fixture(scope="module")
def winner(split):
    return training.fit_winner_trees(split, trees=8, rate=0.3)


@pytest.fixture(scope="module")
def runs(split):
    return training.fit_runs_trees(split, trees=6, depth=3, rate=0.3)


def test_trees_beat_the_baseline(split, winner, runs):
    based = splits.with_baselines(split)
    scored = winner.score(split, "predicted_home_win_prob")
    low, high = scored.agg(F.min("predicted_home_win_prob"), F.max("predicted_home_win_prob")).first()
    assert 0 <= low < high <= 1

    def val(df, metric):
        return df.filter("split = 'val'").first()[metric]

    assert val(splits.classification_metrics(scored, "split"), "log_loss") < val(
        splits.classification_metrics(based, "split"), "log_loss"
    )
    assert val(splits.regression_metrics(runs.score(split, "predicted_total_runs"), "split"), "mae") < val(
        splits.regression_metrics(based, "split"), "mae"
    )


def test_importance_is_sorted_and_finds_the_signal(spark, runs):
    rows = training.feature_importance(spark, runs).collect()
    assert len(rows) == len(FEATURES) and rows[0]["feature"] == FEATURES[0]
    assert [r["importance"] for r in rows] == sorted((r["importance"] for r in rows), reverse=True)


@pytest.mark.parametrize("kind", ["winner", "runs"])
def test_tree_contributions_add_up(split, winner, runs, kind):
    """Contributions sum to the raw output minus the same constant on every row."""
    fitted = winner if kind == "winner" else runs
    column = "predicted_home_win_prob" if kind == "winner" else "predicted_total_runs"
    output = {r["game_pk"]: r[column] for r in fitted.score(split, column).collect()}
    parts = attribution.tree_contributions(split, fitted, ["game_pk"]).collect()
    raw = (lambda p: math.log(p / (1 - p))) if kind == "winner" else (lambda v: v)
    rests = [raw(output[r["game_pk"]]) - sum(r["_contributions"]) for r in parts]
    assert len(parts) == 400 and np.ptp(rests) < 1e-6


def test_shapley_by_definition():
    """Against the definition: the mean marginal effect over all orders of the features."""
    from itertools import permutations

    leaves = [
        (2.0, [(0, -np.inf, 0.0, 0.4), (1, 1.0, np.inf, 0.7)]),
        (-1.0, [(0, 0.0, np.inf, 0.6), (2, -np.inf, 5.0, 0.2), (1, -np.inf, 1.0, 0.3)]),
        (3.0, []),
    ]
    x = np.array([[-1.0, 2.0, 4.0], [0.0, 1.0, 6.0], [3.0, 0.5, 5.0]])

    def value(row, known):
        total = 0.0
        for leaf, steps in leaves:
            for i, low, high, share in steps:
                leaf *= float(low < row[i] <= high) if i in known else share
            total += leaf
        return total

    for row, got in zip(x, attribution.shapley_of_leaves(x, leaves)):
        expected = np.zeros(3)
        for order in permutations(range(3)):
            for at, i in enumerate(order):
                expected[i] += value(row, {*order[: at + 1]}) - value(row, {*order[:at]})
        assert np.allclose(got, expected / 6)


def test_top_contributions_rank_and_break_ties_by_feature_order(spark):
    df = spark.createDataFrame([(1, [0.5, -2.0, -0.5, 0.0])], "game_pk long, _contributions array<double>")
    rows = attribution.top_contributions(df, list("abcd"), ["game_pk"], 3).orderBy("rank").collect()
    assert [(r["rank"], r["feature"], r["direction"]) for r in rows] == [
        (1, "b", "▼ away"), (2, "a", "▲ home"), (3, "c", "▼ away"),
    ]


def test_explanations_need_all_features(split, winner):
    assert attribution.explain_rows(split.drop(FEATURES[0]), winner, ["game_pk"]) is None
    assert attribution.explain_rows(split.limit(0), winner, ["game_pk"]).count() == 0
    assert attribution.explain_rows(split, training.fit_ridge(split), ["game_pk"], 2).count() == 800


def test_prediction_rows(split, winner, runs):
    dated = split.withColumn("game_date", F.to_date(F.lit("2024-04-01")))
    args = (winner, runs, "w", "r", F.lit("2024-04-01 07:00:00"))
    day = training.predict_day(dated, F.to_date(F.lit("2024-04-01")), *args)
    assert day.count() == 400 and day.first()["winner_model_run_id"] == "w"
    assert training.predict_day(dated, F.to_date(F.lit("2024-04-02")), *args).count() == 0


# --- registry ----------------------------------------------------------------

START = datetime(2024, 1, 1)


def _history(spark, *rows):
    """Rows of (id, experiment, family, metric or None, promoted tag or None) in time order."""
    full = [
        (run, experiment, family, run, START + timedelta(hours=i), {},
         {} if metric is None else {"val_log_loss": metric}, {} if tag is None else {"promoted": tag})
        for i, (run, experiment, family, metric, tag) in enumerate(rows)
    ]
    return spark.createDataFrame(full, RUNS)


def test_promoted_runs_serve_first(spark):
    runs = _history(
        spark, ("a", "winner", "f", 0.7, "true"), ("b", "winner", "f", 0.8, "false"),
        ("c", "runs", "f", 1.0, None), ("d", "runs", "f", 1.0, "false"),
    )
    assert registry.latest_run(runs, "winner", "f").first()["run_id"] == "a"
    assert registry.latest_run(runs, "runs", "f").first()["run_id"] == "d"
    assert registry.latest_run(runs, "other", "f").first() is None


def test_gate_needs_strict_improvement(spark):
    runs = _history(spark, ("a", "winner", "f", 0.7, "true"), ("b", "winner", "f", 0.6, "false"))

    def passes(value, lower=True, experiment="winner"):
        return registry.passes_gate(runs, experiment, "val_log_loss", value, lower, "f")

    assert passes(0.69) and not passes(0.7) and not passes(0.71)
    assert passes(0.71, lower=False) and not passes(0.7, lower=False)
    assert passes(9.0, experiment="none yet")


def test_of_two_writers_one_is_promoted(spark, tmp_path, monkeypatch):
    """Both have read the same incumbent; the one that comes second has to beat the first one."""
    runs = _history(spark, ("a", "winner", "f", 0.7, "true"))

    def promote(run_id, value):
        return registry.promote(spark, str(tmp_path / "log"), run_id, value, runs, "winner", "val_log_loss", family="f")

    put, inside = registry.VersionLog.put, []

    def interrupted(log, number, document):
        if not inside:
            inside.append(True)
            inside.append(promote("other", 0.5))
        return put(log, number, document)

    monkeypatch.setattr(registry.VersionLog, "put", interrupted)
    assert not promote("first", 0.6) and inside == [True, True]
    assert promote("better", 0.4) and not promote("as good", 0.4) and not promote("worse", 0.45)
    _, newest = registry.VersionLog(spark, str(tmp_path / "log" / "winner" / "f")).newest()
    assert newest == {"run_id": "better", "value": 0.4}


@pytest.mark.parametrize("strategy", [Strategy("plain"), Strategy("blocks", 2)])
def test_replayed_gate(spark, strategy):
    metrics = [0.7, 0.7, None, 0.65, 0.68, 0.6]
    runs = _history(spark, *[(str(i), "winner", "f", m, None) for i, m in enumerate(metrics)])
    rows = registry.replay_gate(runs, "val_log_loss", strategy=strategy).orderBy("run_id").collect()
    assert [(r["run_id"], r["promoted"]) for r in rows] == [
        ("0", True), ("1", False), ("3", True), ("4", False), ("5", True),
    ]
    higher = registry.replay_gate(runs, "val_log_loss", False, strategy).filter("promoted")
    assert [r["run_id"] for r in higher.collect()] == ["0"]


def test_registry_appends(spark, tmp_path):
    path = str(tmp_path / "runs")
    for i in range(2):
        registry.append_run(registry.run_row(spark, f"r{i}", "winner", "f", START, {"C": 1.0}, {"val_mae": 2}), path)
    stored = spark.read.schema(RUNS).parquet(path)
    assert stored.count() == 2 and stored.first()["params"] == {"C": "1.0"}
