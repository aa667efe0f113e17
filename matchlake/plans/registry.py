"""Model runs as a table: which run serves, and which runs may replace it."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.operators.latest import latest_wins
from matchlake.operators.reshape import split_prefix
from matchlake.operators.trailing import PLAIN, Strategy, running_min
from matchlake.plans.splits import SPLITS
from matchlake.schemas import RUNS
from matchlake.sources.lake import append
from matchlake.sources.versions import VersionLog

# Experiments, the served family, and the tag that marks promotion.
WINNER_EXPERIMENT, RUNS_EXPERIMENT = "winner", "runs"
SERVED_FAMILY = "boosted_trees"
PROMOTED = "promoted"


def run_row(
    spark: SparkSession,
    run_id: str,
    experiment: str,
    family: str,
    started: datetime,
    params: Mapping[str, object],
    metrics: Mapping[str, float],
    tags: Mapping[str, str] | None = None,
    name: str | None = None,
) -> DataFrame:
    row = (
        run_id, experiment, family, name or family, started,
        {k: str(v) for k, v in params.items()},
        {k: float(v) for k, v in metrics.items()},
        dict(tags or {}),
    )
    return spark.createDataFrame([row], RUNS)


def append_run(run: DataFrame, path: str) -> None:
    append(run, path)


def serving_runs(runs: DataFrame) -> DataFrame:
    """Per experiment and family the newest promoted run, or the newest of any kind without one."""
    promoted = F.coalesce(F.col("tags")[PROMOTED] == "true", F.lit(False)).cast("int")
    ranked = runs.withColumn("_promoted", promoted)
    served = latest_wins(
        ranked, ["experiment", "model_family"], "_promoted", ["start_time", "run_id"]
    )
    return served.drop("_promoted")


def latest_run(runs: DataFrame, experiment: str, family: str = SERVED_FAMILY) -> DataFrame:
    """The run to serve for one experiment and family, as one row or none."""
    chosen = runs.filter((F.col("experiment") == experiment) & (F.col("model_family") == family))
    return serving_runs(chosen)


def passes_gate(
    runs: DataFrame,
    experiment: str,
    metric: str,
    value: float,
    lower_is_better: bool = True,
    family: str = SERVED_FAMILY,
) -> bool:
    """True for the first promoted run, or when strictly better than the newest promoted one."""
    incumbent = (
        runs.filter((F.col("experiment") == experiment) & (F.col("model_family") == family))
        .filter(F.col("tags")[PROMOTED] == "true")
        .orderBy(F.desc("start_time"), F.desc("run_id"))
        .select(F.col("metrics")[metric].alias("value"))
        .first()
    )
    if incumbent is None or incumbent["value"] is None:
        return True
    return value < incumbent["value"] if lower_is_better else value > incumbent["value"]


def promote(
    spark: SparkSession, folder: str, run_id: str, value: float, runs: DataFrame, experiment: str, metric: str,
    lower_is_better: bool = True, family: str = SERVED_FAMILY,
) -> bool:
    """Make a run the promoted one if it passes the gate, against any other writer.

    The promoted runs of an experiment and family are numbered in a log under `folder`. A run is compared with the newest of them
    and takes the next number; if another run has taken it meanwhile, it is compared with that one. An empty log
    begins with the newest promoted run of the table `runs`.
    """
    log = VersionLog(spark, f"{folder}/{experiment}/{family}")
    while True:
        number, incumbent = log.newest()
        if incumbent is None:
            if not passes_gate(runs, experiment, metric, value, lower_is_better, family):
                return False
        elif not (value < incumbent["value"] if lower_is_better else value > incumbent["value"]):
            return False
        if log.put(number + 1, {"run_id": run_id, "value": value}):
            return True


def replay_gate(
    runs: DataFrame,
    metric: str,
    lower_is_better: bool = True,
    strategy: Strategy = PLAIN,
) -> DataFrame:
    """The gate applied to a whole run history.

    Each promotion is strictly better than the one before, so the incumbent of a run
    is the best metric among all earlier runs of its experiment and family. Runs
    without the metric never reach the gate.
    """
    value = F.col("metrics")[metric]
    sign = 1.0 if lower_is_better else -1.0
    history = runs.filter(value.isNotNull()).withColumn("_signed", value * F.lit(sign))
    judged = running_min(
        history,
        ["experiment", "model_family"],
        ["start_time", "run_id"],
        "_signed",
        "_incumbent",
        strategy,
    )
    return judged.select(
        "run_id",
        "experiment",
        "model_family",
        "start_time",
        value.alias("value"),
        (F.col("_incumbent") * F.lit(sign)).alias("incumbent"),
        F.coalesce(F.col("_signed") < F.col("_incumbent"), F.lit(True)).alias("promoted"),
    )


def metrics_long(runs: DataFrame) -> DataFrame:
    """Flat metric names as split, metric and value; names without a split go to `other`."""
    entries = runs.select("run_id", F.explode("metrics").alias("name", "value"))
    split, metric = split_prefix(F.col("name"), SPLITS)
    return entries.select("run_id", split.alias("split"), metric.alias("metric"), "value")
