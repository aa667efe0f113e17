"""Exact medians of many columns without gathering a column in one place."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Values of a column that are left to be sorted, after narrowing.
REST_ROWS = 1_000_000
SKETCH_ACCURACY = 10_000


@dataclass
class _Target:
    """A 0-based rank among the `rows` values of a column that lie strictly between `low` and `high`.

    None is no bound, so infinities are values like others.
    """

    column: str
    rank: int
    rows: int
    low: float | None = None
    high: float | None = None
    value: float | None = None

    def inside(self) -> Column:
        v = F.col(self.column)
        above = F.lit(True) if self.low is None else v > F.lit(self.low)
        below = F.lit(True) if self.high is None else v < F.lit(self.high)
        return F.when(above & below, v)

    def bracket(self) -> Column:
        share, margin = (self.rank + 0.5) / self.rows, 2.0 / SKETCH_ACCURACY
        around = [max(0.0, share - margin), min(1.0, share + margin)]
        return F.percentile_approx(self.inside(), around, SKETCH_ACCURACY)

    def counts(self, low: float, high: float) -> Column:
        v = self.inside()
        below = [v < low, v <= low, v < high, v <= high]
        return F.array(*[F.count(F.when(c, F.lit(1))) for c in below])

    def narrow(self, low: float, high: float, counts: Sequence[int]) -> None:
        under, through_low, before_high, through_high = counts
        if self.rank < under:  # the sketch was off: look below the bracket
            self.high, self.rows = low, under
        elif self.rank < through_low:
            self.value = low
        elif self.rank < before_high:
            self.low, self.high = low, high
            self.rank, self.rows = self.rank - through_low, before_high - through_low
        elif self.rank < through_high:
            self.value = high
        else:
            self.low = high
            self.rank, self.rows = self.rank - through_high, self.rows - through_high


def _of_ranks(doubles: DataFrame, targets: Sequence[_Target]) -> dict[int, float]:
    """The value of each target: its values counted, the counts summed up in order, and the rank looked up.

    Equal values are one row, so ties cost nothing; a target has at most its `rows` of them.
    """
    values = F.array(*[
        F.struct(F.lit(i).alias("target"), F.lit(t.rank).alias("rank"), t.inside().alias("v"))
        for i, t in enumerate(targets)
    ])
    counted = doubles.select(F.inline(values)).dropna().groupBy("target", "rank", "v").count()
    through = Window.partitionBy("target").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.withColumn("through", F.sum("count").over(through))
    found = placed.filter((F.col("rank") < F.col("through")) & (F.col("rank") >= F.col("through") - F.col("count")))
    return {row["target"]: row["v"] for row in found.collect()}


def exact_medians(
    df: DataFrame, columns: Sequence[str], rest_rows: int = REST_ROWS
) -> dict[str, float | None]:
    """Median of each column, the mean of the two middle values for an even count.

    NULL and NaN are no values; infinities are. All columns are worked on together. One pass counts
    the values, and while a middle rank lies among more than `rest_rows` values, a round takes a bracket
    around it from a quantile sketch and counts the values at its ends. A last pass counts the
    values inside each bracket and picks the one of the rank.
    """
    doubles = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in columns])
    counts = doubles.agg(*[F.count(c).alias(c) for c in columns]).first().asDict()
    pairs = {
        c: [_Target(c, (n - 1) // 2, n), _Target(c, n // 2, n)] for c, n in counts.items() if n
    }
    every = [target for pair in pairs.values() for target in pair]
    while wide := [t for t in every if t.value is None and t.rows > rest_rows]:
        brackets = doubles.agg(*[t.bracket().alias(str(i)) for i, t in enumerate(wide)]).first()
        counted = doubles.agg(
            *[t.counts(*b).alias(str(i)) for i, (t, b) in enumerate(zip(wide, brackets))]
        ).first()
        for target, bracket, seen in zip(wide, brackets, counted, strict=True):
            target.narrow(*bracket, seen)
    rest = [t for t in every if t.value is None]
    if rest:
        found = _of_ranks(doubles, rest)
        for i, target in enumerate(rest):
            target.value = found[i]
    medians: dict[str, float | None] = dict.fromkeys(columns)
    for column, (lower, upper) in pairs.items():
        same = lower.value == upper.value  # keeps an infinite median from becoming NaN
        medians[column] = lower.value if same else (lower.value + upper.value) / 2
    return medians
