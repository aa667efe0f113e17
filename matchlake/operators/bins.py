"""Right-closed binning."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def equal_width_bin(df: DataFrame, column: str, n_bins: int) -> DataFrame:
    """Append `bin`, 0 to n_bins-1, over bins of equal width on the observed range.

    A bin holds its upper edge and not its lower one, except that the minimum belongs
    to bin 0. When all values agree the range is widened by a thousandth on both sides.
    """
    span = df.agg(
        F.struct(F.min(column).alias("low"), F.max(column).alias("high")).alias("span")
    ).scalar()
    ranged = df.withColumn("_span", span)
    low, high = F.col("_span.low"), F.col("_span.high")
    pad = F.when(low == high, F.when(low == 0, F.lit(0.001)).otherwise(F.abs(low) * 0.001)).otherwise(0.0)
    first, last = low - pad, high + pad
    step = (last - first) / F.lit(float(n_bins))
    passed = [(F.col(column) > F.lit(float(i)) * step + first).cast("int") for i in range(1, n_bins)]
    return ranged.withColumn("bin", reduce(lambda a, b: a + b, passed, F.lit(0))).drop("_span")


def ladder(value: Column, uppers: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the first upper edge not below the value; the last label has no upper edge."""
    steps = F
    for upper, label in zip(uppers, labels, strict=False):
        steps = steps.when(value <= upper, label)
    return steps.when(value.isNotNull(), labels[-1])
