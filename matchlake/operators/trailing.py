"""Leak-free trailing row frames that stay parallel when one entity is huge.

A trailing measure of a row sees at most `reach` earlier rows of its entity and
never the row itself. The plain plan is one window partitioned by the entity, which
puts an entity into one task. The block plan sorts the rows across the cluster by
(entity, order), cuts them into equal blocks, and gives each block also the last
`reach` rows of the block before it. Which plan is used is an argument; a frame over the
whole table, without entity, is always in blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from matchlake.session import materialise


@dataclass(frozen=True)
class Strategy:
    """How ordered work is laid out: plain (an entity to a task) or blocks (of equal numbers of rows).

    Plain is right where the calendar bounds an entity: a team, a pitcher or a venue has a few rows
    a day. Blocks are right for any entity.
    """

    kind: str = "plain"
    block_rows: int = 1_000_000

    def splits(self, entity: Sequence[str]) -> bool:
        if self.kind not in ("plain", "blocks"):
            raise ValueError(f"unknown strategy: {self.kind}")
        return self.kind == "blocks" or not entity


PLAIN = Strategy()

# monotonically_increasing_id keeps the row position in its low 33 bits.
_POSITION_BITS = 33


class Frames:
    """Window specs handed to the measure builder of `trailing`."""

    def __init__(self, ordered: WindowSpec) -> None:
        self.ordered = ordered

    def last(self, rows: int) -> WindowSpec:
        """The `rows` rows before the current one, the current one excluded."""
        return self.ordered.rowsBetween(-rows, -1)


Measures = Callable[[Frames], Mapping[str, Column]]


def trailing(
    df: DataFrame,
    entity: Sequence[str],
    order: Sequence[str],
    reach: int,
    measures: Measures,
    strategy: Strategy = PLAIN,
) -> DataFrame:
    """Append trailing measures to `df`.

    `order` must be a total order inside an entity. `reach` is the longest frame
    (or lag) the measures use.
    """
    if not strategy.splits(entity):
        return _measured(df, entity, order, measures)
    block_rows = max(strategy.block_rows, reach)
    blocked = with_blocks(df, [*entity, *order], reach, block_rows)
    result = _measured(blocked, ["_block", *entity], order, measures)
    return result.filter(~F.col("_halo")).drop("_block", "_halo")


def _measured(df: DataFrame, entity, order, measures: Measures) -> DataFrame:
    ordered = Window.partitionBy(*entity).orderBy(*order)
    return df.withColumns(dict(measures(Frames(ordered))))


def with_position(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Append `_position`, the dense 0-based rank of each row in a cluster-wide sort.

    The sorted rows are materialised, because the per-partition counts and the
    positions must come from the same range boundaries. The counts table has one
    row per partition, which bounds the broadcast and the single-task running sum.
    """
    placed = materialise(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_rid", F.monotonically_increasing_id())
    )
    part = F.shiftright("_rid", _POSITION_BITS)
    local = F.col("_rid").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn("_position", F.col("_offset") + local)
        .drop("_rid", "_part", "_offset")
    )


def with_blocks(df: DataFrame, order: Sequence[str], reach: int, block_rows: int) -> DataFrame:
    """Cut the sorted rows into blocks of `block_rows` rows, each led by a halo of `reach` rows.

    Every row appears once with `_halo` false; the last `reach` rows of a block
    appear again in the next block with `_halo` true.
    """
    home = F.floor(F.col("_position") / F.lit(block_rows)).cast("long")
    lent = F.col("_position") % block_rows >= block_rows - reach
    own_copy = F.struct(home.alias("_block"), F.lit(False).alias("_halo"))
    lent_copy = F.struct((home + 1).alias("_block"), F.lit(True).alias("_halo"))
    copies = F.when(lent, F.array(own_copy, lent_copy)).otherwise(F.array(own_copy))
    return (
        with_position(df, order)
        .withColumn("_copy", F.explode(copies))
        .select("*", "_copy._block", "_copy._halo")
        .drop("_copy", "_position")
    )


def running_min(
    df: DataFrame,
    entity: Sequence[str],
    order: Sequence[str],
    value: str,
    output: str,
    strategy: Strategy = PLAIN,
) -> DataFrame:
    """Append the smallest `value` among all earlier rows of the entity, NULL on its first row.

    In blocks, the minimum of the earlier blocks comes from a summary with one row
    per block and entity, of which an entity has at most as many as there are blocks.
    """

    def earlier(keys: Sequence[str], by: Sequence[str]):
        ordered = Window.partitionBy(*keys).orderBy(*by)
        return ordered.rowsBetween(Window.unboundedPreceding, -1)

    if not strategy.splits(entity):
        return df.withColumn(output, F.min(value).over(earlier(entity, order)))
    blocked = with_blocks(df, [*entity, *order], 0, strategy.block_rows).drop("_halo")
    keys = ["_block", *entity]
    carried = (
        blocked.groupBy(*keys)
        .agg(F.min(value).alias("_block_min"))
        .select(
            *[F.col(k).alias(f"_carry_{k}") for k in keys],
            F.min("_block_min").over(earlier(entity, ["_block"])).alias("_carried"),
        )
    )
    inside = blocked.withColumn("_inside", F.min(value).over(earlier(keys, order)))
    same = [F.col(k).eqNullSafe(F.col(f"_carry_{k}")) for k in keys]
    return (
        inside.join(carried, same, "left")
        .withColumn(output, F.least("_inside", "_carried"))
        .select(*df.columns, output)
    )
