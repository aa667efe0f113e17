"""Per-row feature contributions to a prediction."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.functions import display
from matchlake.plans.boosting import BoostedTrees, Tree, matrix_of
from matchlake.plans.panels import by_keys
from matchlake.plans.training import Fitted

TOP_N = 5
_CONTRIBUTIONS = "_contributions"


def linear_contributions(
    df: DataFrame, coefficients: Mapping[str, float], scaled: Mapping[str, Column]
) -> DataFrame:
    """Append an array of coefficient times standardised value, in feature order."""
    parts = [scaled[name] * F.lit(float(weight)) for name, weight in coefficients.items()]
    return df.withColumn(_CONTRIBUTIONS, F.array(*parts))


def top_contributions(
    df: DataFrame, features: Sequence[str], keep: Sequence[str], n: int = TOP_N
) -> DataFrame:
    """The n largest contributions of each row as ranked rows; ties keep feature order."""
    names = F.array(*map(F.lit, features))
    ranked = F.array_sort(
        F.transform(
            F.arrays_zip(names.alias("feature"), F.col(_CONTRIBUTIONS).alias("contribution")),
            lambda pair, i: F.struct(
                (-F.abs(pair["contribution"])).alias("size"),
                i.alias("place"),
                pair["feature"].alias("feature"),
                pair["contribution"].alias("contribution"),
            ),
        )
    )
    return df.select(*keep, F.posexplode(F.slice(ranked, 1, n)).alias("_i", "_top")).select(
        *keep,
        (F.col("_i") + 1).alias("rank"),
        F.col("_top.feature").alias("feature"),
        F.col("_top.contribution").alias("contribution"),
        display.direction(F.col("_top.contribution")).alias("direction"),
        F.abs(F.col("_top.contribution")).alias("abs_contribution"),
    )


def explain_rows(
    df: DataFrame, fitted: Fitted, keep: Sequence[str], n: int = TOP_N
) -> DataFrame | None:
    """Top contributions of a fitted model, or None when `df` lacks one of its features."""
    if any(name not in df.columns for name in fitted.features):
        return None
    if isinstance(fitted.model, BoostedTrees):
        with_parts = tree_contributions(df, fitted, keep)
    else:
        weights = dict(zip(fitted.prepared.features, map(float, fitted.model.coefficients)))
        with_parts = linear_contributions(
            df, weights, {c: fitted.prepared.scaled(c) for c in weights}
        )
    return top_contributions(with_parts, fitted.features, keep, n)


def explain_keys(
    features: DataFrame, keys: Sequence | DataFrame, fitted: Fitted, key: str = "game_pk", n: int = TOP_N
) -> DataFrame | None:
    """Top contributions for a list of matches, each with its line of text; other matches are not scored."""
    found = explain_rows(by_keys(features, key, keys), fitted, [key], n)
    if found is None:
        return None
    return found.withColumn("line", display.contribution_line(F.col("feature"), F.col("contribution")))


# ---------------------------------------------------------------------------
# Trees
# ---------------------------------------------------------------------------


def leaf_paths(tree: Tree) -> list[tuple[float, list[tuple[int, float, float, float, bool]]]]:
    """Each leaf as its value and, per feature on its path, (index, low, high, share, takes_missing).

    A row reaches the leaf when low < x <= high for all of them, or when x is missing and the path takes missing values; `share`
    is the part of the training weight that follows the path through the feature's own splits.
    """
    leaves = []

    def walk(node: int, path: dict[int, tuple[float, float, float, bool]]) -> None:
        index = int(tree.feature[node])
        if index < 0:
            leaves.append((float(tree.value[node]), [(i, *step) for i, step in path.items()]))
            return
        threshold, missing_left = float(tree.threshold[node]), bool(tree.missing_left[node])
        low, high, share, missing = path.get(index, (-np.inf, np.inf, 1.0, True))
        for child, bounds, goes in (
            (2 * node + 1, (low, min(high, threshold)), missing_left),
            (2 * node + 2, (max(low, threshold), high), not missing_left),
        ):
            followed = share * float(tree.cover[child] / tree.cover[node])
            walk(child, {**path, index: (*bounds, followed, missing and goes)})

    walk(0, {})
    return leaves


def _meets(x: np.ndarray, low: float, high: float, takes_missing: bool = False) -> np.ndarray:
    below = x >= low if low == -np.inf else x > low
    return np.where(np.isnan(x), takes_missing, below & (x <= high))


def shapley_of_leaves(x: np.ndarray, leaves) -> np.ndarray:
    """Path-dependent Shapley values of a sum of leaves for each row of `x`; NaN is a missing value.

    For one leaf the game over the features on its path is a product: a feature in the coalition
    contributes whether the row satisfies its bounds, one outside it the share of training weight that
    does. So the coalitions of each size add up to a coefficient of the polynomial of all factors
    (share + meets * t). It is extended by one factor after another; a feature's value needs the
    polynomial of the others, which is had by taking its own factor out again. For m features on a path
    that is some m^2 steps, not 2^m, and all rows are worked on at once.
    """
    values = np.zeros(x.shape)
    for leaf_value, steps in leaves:
        m = len(steps)
        meets = [_meets(x[:, i], low, high, *missing) for i, low, high, _, *missing in steps]
        shares = [step[3] for step in steps]
        product = np.zeros((m + 1, len(x)))
        product[0] = 1.0
        for meet, share in zip(meets, shares):
            shifted = product[:-1] * meet
            product *= share
            product[1:] += shifted
        weights = [factorial(k) * factorial(m - k - 1) / factorial(m) for k in range(m)]
        for (index, *_), meet, share in zip(steps, meets, shares):
            # With the row inside the bounds the factor is (share + t), divided out from the top; else it is the share alone.
            inside, rest = np.zeros(len(x)), np.zeros(len(x))
            for k in range(m - 1, -1, -1):
                rest = product[k + 1] - share * rest
                inside += weights[k] * rest
            outside = (np.array(weights) @ product[:m]) / share if share else 0.0
            values[:, index] += leaf_value * np.where(meet, (1.0 - share) * inside, -share * outside)
    return values


def tree_contributions(df: DataFrame, fitted: Fitted, keep: Sequence[str]) -> DataFrame:
    """Append Shapley contributions of boosted trees, in log-odds or target units, in feature order.

    The leaves travel to the tasks with the function; their number depends on the model settings alone.
    """
    model = fitted.model
    leaves = [leaf for tree in model.trees for leaf in leaf_paths(tree)]
    width = len(model.features)

    @F.arrow_udf("array<double>")
    def explained(rows: pa.Array) -> pa.Array:
        values = shapley_of_leaves(matrix_of(rows, width), leaves)
        ends = np.arange(len(values) + 1, dtype=np.int32) * width
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))

    return df.select(*keep, explained(model.inputs).alias(_CONTRIBUTIONS))
