"""Turning two-sided match rows into one row per side, and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unpivot_sides(
    df: DataFrame,
    keep: Sequence[str],
    home: Mapping[str, Column],
    away: Mapping[str, Column],
) -> DataFrame:
    """Two rows per match from one scan: `keep` columns plus the home or away expressions."""
    if list(home) != list(away):
        raise ValueError("home and away must name the same columns in the same order")
    row = lambda side: F.struct(*[expr.alias(name) for name, expr in side.items()])
    return df.select(*keep, F.explode(F.array(row(home), row(away))).alias("_side")).select(
        *keep, "_side.*"
    )


def fold_sides(df: DataFrame, key: str, is_home: str, columns: Sequence[str]) -> DataFrame:
    """Back to one row per match: every column once with a `home_` and once with an `away_` prefix."""
    picks = [
        F.max(F.when(F.col(is_home) if side == "home" else ~F.col(is_home), F.col(name))).alias(
            f"{side}_{name}"
        )
        for side in ("home", "away")
        for name in columns
    ]
    return df.groupBy(key).agg(*picks)
