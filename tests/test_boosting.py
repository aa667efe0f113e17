"""Boosted trees against a plain NumPy version on the same bins, and their contributions against the definition."""

from __future__ import annotations

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchlake.plans import attribution, boosting
from matchlake.plans.boosting import LOGISTIC, MISSING, SCALE, SQUARED, BoostedTrees, fit_boosted
from matchlake.plans.training import Fitted

NAMES = ["a", "b", "c", "d", "e"]


def table(spark, n, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, len(NAMES)))
    x[:, 3] = np.round(x[:, 3])
    won = x[:, 0] - 0.7 * x[:, 1] + 0.5 * rng.normal(size=n) > 0
    runs = np.round(9 + 2 * x[:, 0] + x[:, 3] ** 2 + rng.normal(size=n))
    holes = rng.random(x.shape) < 0.15
    x[holes] = np.nan
    won ^= np.isnan(x[:, 2]) & (rng.random(n) < 0.5)
    rows = [
        (i, *[None if np.isnan(v) else float(v) for v in r], bool(w), int(y)) for i, (r, w, y) in enumerate(zip(x, won, runs))
    ]
    fields = "id int, " + ", ".join(f"{c} double" for c in NAMES) + ", won boolean, runs int"
    return spark.createDataFrame(rows, fields), x, won.astype(float), runs


def plain_boosting(x, y, draw, cuts, objective, base, trees, depth, rate, weight, shrink, rows, columns, seed):
    """Margins after all trees, one node and one candidate at a time."""
    bins = np.stack([np.where(np.isnan(x[:, j]), MISSING, np.searchsorted(c, x[:, j])) for j, c in enumerate(cuts)], axis=1)
    rng, margins = np.random.default_rng(seed), np.full(len(y), base)
    for number in range(trees):
        chosen = sorted(rng.choice(x.shape[1], max(1, int(columns * x.shape[1])), replace=False))
        g, h = boosting.slopes(objective, y, margins)
        g, h = g / SCALE, h / SCALE
        inside = boosting.drawn(draw, seed, number, rows)
        added = np.zeros(len(y))

        def grow(members, level):
            used = members & inside
            g_all, h_all = g[used].sum(), h[used].sum()
            best = None
            for j in chosen if level < depth else []:
                for missing_left in (False, True):
                    for b in range(len(cuts[j])):
                        left = np.where(bins[:, j] == MISSING, missing_left, bins[:, j] <= b)
                        gl, hl = g[used & left].sum(), h[used & left].sum()
                        gr, hr = g[used & ~left].sum(), h[used & ~left].sum()
                        if min(hl, hr) < weight or min(hl, hr) <= 0:
                            continue
                        gain = gl**2 / (hl + shrink) + gr**2 / (hr + shrink) - g_all**2 / (h_all + shrink)
                        if gain > 1e-6 and (best is None or gain > best[0] + 1e-12):
                            best = (gain, left)
            if best:
                grow(members & best[1], level + 1)
                grow(members & ~best[1], level + 1)
            else:
                added[members] = -rate * g_all / (h_all + shrink) if h_all > 0 else 0.0

        grow(np.ones(len(y), bool), 0)
        margins = margins + added
    return margins


@pytest.mark.parametrize(("objective", "target"), [(LOGISTIC, "won"), (SQUARED, "runs")])
@pytest.mark.parametrize("settings", [
    {"trees": 5, "depth": 3, "rate": 0.3, "min_child_weight": 4.0, "rows": 0.8, "columns": 0.8, "bins": 12},
    {"trees": 3, "depth": 4, "rate": 0.5, "min_child_weight": 0.5, "reg_lambda": 0.1, "bins": 5, "seed": 9},
])
def test_trees_equal_the_plain_version(spark, monkeypatch, objective, target, settings):
    monkeypatch.setattr(boosting, "REFRESH", 2)
    monkeypatch.setattr(boosting, "FEW", 0 if target == "won" else 16)  # sums added up by Spark, and by the driver
    df, x, won, runs = table(spark, 300)
    model = fit_boosted(df.repartition(5), NAMES, target, objective, **settings)
    full = {**boosting.DEFAULTS, **settings}
    cuts = boosting.cut_points(df, NAMES, full["bins"])
    label = F.col("won").cast("int").cast("double") if target == "won" else F.col("runs").cast("double")
    draws = df.orderBy("id").select(F.xxhash64(model.inputs, label)).collect()
    y = won if target == "won" else runs
    expected = plain_boosting(
        x, y, np.array([d[0] for d in draws]), cuts, objective, model.base, full["trees"], full["depth"], full["rate"],
        full["min_child_weight"], full["reg_lambda"], full["rows"], full["columns"], full["seed"],
    )
    assert np.allclose(model.margins(x), expected, atol=1e-6)
    assert model.base == pytest.approx(np.log(y.mean() / (1 - y.mean())) if objective == LOGISTIC else y.mean())
    scored = {r.id: r.p for r in model.score(df, "p").collect()}
    raw = boosting.chance(expected) if objective == LOGISTIC else expected
    assert np.allclose([scored[i] for i in range(len(y))], raw, atol=1e-6)


def test_partitions_do_not_matter(spark):
    df, x, _, _ = table(spark, 500, seed=1)
    settings = {"trees": 4, "depth": 3, "rows": 0.7, "columns": 0.6}
    one, many = (fit_boosted(part, NAMES, "won", LOGISTIC, **settings) for part in (df.coalesce(1), df.repartition(9)))
    assert (one.margins(x) == many.margins(x)).all()


def test_missing_values_go_where_they_gain(spark):
    rows = [(float(i % 10), i % 10 >= 5) for i in range(200)] + [(None, True)] * 60
    df = spark.createDataFrame(rows, "a double, won boolean")
    model = fit_boosted(df, ["a"], "won", LOGISTIC, trees=1, depth=1, rate=1.0)
    tree = model.trees[0]
    assert tree.threshold[0] == 4.0 and not tree.missing_left[0]
    assert tree.value[2] > 0 > tree.value[1]


def test_odd_tables(spark):
    df, x, _, _ = table(spark, 60)
    none = df.withColumn("a", F.lit(None).cast("double")).withColumn("b", F.lit(float("inf")))
    model = fit_boosted(none, NAMES, "won", LOGISTIC, trees=3)
    assert all(j not in (0, 1) for tree in model.trees for j in tree.feature if j >= 0)
    assert dict(model.importances())["a"] == 0.0 and sum(v for _, v in model.importances()) == pytest.approx(1.0)
    same = fit_boosted(df.withColumn("won", F.lit(True)), NAMES, "won", LOGISTIC, trees=2)
    assert boosting.chance(same.margins(x)).min() > 0.9
    with pytest.raises(ValueError, match="no training rows"):
        fit_boosted(df.limit(0), NAMES, "won", LOGISTIC)
    with pytest.raises(TypeError):
        fit_boosted(df, NAMES, "won", LOGISTIC, min_rows=3)
    assert model.score(df.limit(0), "p").count() == 0


def test_models_are_stored_whole(spark, tmp_path):
    df, x, _, _ = table(spark, 120)
    model = fit_boosted(df, NAMES, "runs", SQUARED, trees=4)
    model.save(spark, str(tmp_path / "model"))
    again = BoostedTrees.load(spark, str(tmp_path / "model"))
    assert (again.margins(x) == model.margins(x)).all() and again.importances() == model.importances()


def enumerated(x, leaves):
    """Every coalition of every leaf, one row at a time."""
    out = np.zeros(x.shape)
    for r, row in enumerate(x):
        for value, steps in leaves:
            meets = [missing if np.isnan(row[i]) else low < row[i] <= high for i, low, high, _, missing in steps]
            for me, (index, *_, share, _) in enumerate(steps):
                others = [p for p in range(len(steps)) if p != me]
                for size in range(len(others) + 1):
                    weight = factorial(size) * factorial(len(others) - size) / factorial(len(steps))
                    for coalition in combinations(others, size):
                        product = weight
                        for p in others:
                            product *= meets[p] if p in coalition else steps[p][3]
                        out[r, index] += value * (meets[me] - share) * product
    return out


def test_contributions_equal_all_coalitions(spark):
    df, x, _, _ = table(spark, 250, seed=2)
    model = fit_boosted(df, NAMES, "won", LOGISTIC, trees=3, depth=4, bins=20)
    leaves = [leaf for tree in model.trees for leaf in attribution.leaf_paths(tree)]
    assert np.allclose(attribution.shapley_of_leaves(x[:40], leaves), enumerated(x[:40], leaves), atol=1e-9)


def test_deep_trees_add_up(spark):
    """Contributions and their expectation give the margin, on paths of up to twelve splits."""
    df, x, _, _ = table(spark, 400, seed=3)
    model = fit_boosted(df, NAMES, "runs", SQUARED, trees=2, depth=12, min_child_weight=1.0)
    leaves = [leaf for tree in model.trees for leaf in attribution.leaf_paths(tree)]
    expectation = model.base + sum(value * np.prod([step[3] for step in steps]) for value, steps in leaves)
    rows = attribution.tree_contributions(df.orderBy("id"), Fitted(model), ["id"]).collect()
    sums = np.array([sum(r["_contributions"]) for r in sorted(rows)])
    assert np.allclose(sums + expectation, model.margins(x), atol=1e-8)


def test_levels_are_counted_in_several_tasks(spark, monkeypatch):
    """Few bytes are many rows: partitions go by rows, the trees stay the same, and no stored blocks are left."""
    df, x, _, _ = table(spark, 500, seed=4)
    settings = {"trees": 4, "depth": 3, "rows": 0.7}
    one = fit_boosted(df, NAMES, "won", LOGISTIC, **settings)
    monkeypatch.setattr(boosting, "LEAST_ROWS", 150)
    monkeypatch.setattr(boosting, "REFRESH", 3)
    counted, kept, count = [], [], boosting._histograms

    def watched(blocks, *rest):
        counted.append(blocks.getNumPartitions())
        kept.append(blocks)
        return count(blocks, *rest)

    monkeypatch.setattr(boosting, "_histograms", watched)
    several = fit_boosted(df, NAMES, "won", LOGISTIC, **settings)
    assert set(counted) == {4} and (one.margins(x) == several.margins(x)).all()
    assert not any(blocks.is_cached for blocks in kept)
    files = spark._jvm.org.apache.hadoop.fs.Path(kept[-1].getCheckpointFile() or kept[-2].getCheckpointFile() or "none")
    assert not files.getFileSystem(spark._jsc.hadoopConfiguration()).exists(files)
