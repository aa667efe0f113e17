"""Backward as-of join on calendar dates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.session import materialise


def asof_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    left_date: str,
    right_date: str,
    values: Mapping[str, str],
    tiebreak: str,
    stored: bool = False,
) -> DataFrame:
    """Left rows plus the newest right row of the same key dated on or before them.

    `values` maps right columns to output names. Of several right rows on one date
    the one with the highest `tiebreak` counts. Keys or dates that are NULL match nothing.

    Both sides are first reduced to one row per (key, date). The ordered scan then
    sees at most two rows per key and calendar day, however many rows a key has, and
    the matches come back through an equi-join that AQE can split on a hot key.
    With `stored` the answers are materialised: a few are then broadcast, and the left rows need no shuffle.
    """
    for df, name in ((left, left_date), (right, right_date)):
        if not isinstance(df.schema[name].dataType, T.DateType):
            raise TypeError(f"{name} must be a DATE: the calendar bounds the groups of the scan")

    known = (
        right.filter(F.col(right_key).isNotNull() & F.col(right_date).isNotNull())
        .groupBy(F.col(right_key).alias("_key"), F.col(right_date).alias("_date"))
        .agg(
            F.max_by(
                F.struct(*[F.col(c).alias(out) for c, out in values.items()]), F.col(tiebreak)
            ).alias("_hit")
        )
        .select("_key", "_date", "_hit", F.lit(False).alias("_asked"))
    )
    asked = (
        left.select(F.col(left_key).alias("_key"), F.col(left_date).alias("_date"))
        .dropna()
        .distinct()
        .select(
            F.col("_key").cast(known.schema["_key"].dataType),
            "_date",
            F.lit(None).cast(known.schema["_hit"].dataType).alias("_hit"),
            F.lit(True).alias("_asked"),
        )
    )
    upto = (
        Window.partitionBy("_key")
        .orderBy("_date", "_asked")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    answers = (
        known.unionByName(asked)
        .withColumn("_hit", F.last("_hit", ignorenulls=True).over(upto))
        .filter("_asked")
        .select("_key", "_date", "_hit")
    )
    if stored:
        answers = materialise(answers)
    joined = left.join(
        answers,
        (F.col(left_key) == F.col("_key")) & (F.col(left_date) == F.col("_date")),
        "left",
    )
    return joined.select(
        *left.columns, *[F.col(f"_hit.{out}").alias(out) for out in values.values()]
    )
