"""Wide ↔ long."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    """One row per id and value column."""
    return df.unpivot(list(ids), list(values), name, value)


def comparison_rows(
    summary: DataFrame, metrics: Mapping[str, tuple[str, str]], first: str, second: str
) -> DataFrame:
    """A one-row summary as one row per metric with two columns to compare."""
    rows = [
        F.struct(
            F.lit(label).alias("metric"),
            F.col(left).cast("double").alias(first),
            F.col(right).cast("double").alias(second),
        )
        for label, (left, right) in metrics.items()
    ]
    return summary.select(F.inline(F.array(*rows)))


def split_prefix(name: Column, prefixes: Sequence[str], other: str = "other") -> tuple[Column, Column]:
    """('train_accuracy') to ('train', 'accuracy'); a name without a known prefix goes to `other`."""
    pattern = f"^({'|'.join(prefixes)})_(.*)$"
    head = F.regexp_extract(name, pattern, 1)
    known = head != ""
    return (
        F.when(known, head).otherwise(other),
        F.when(known, F.regexp_extract(name, pattern, 2)).otherwise(name),
    )
