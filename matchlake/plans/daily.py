"""The daily batch: land, type, derive, score and grade.

Each stage writes its tables and the next one reads them back, so no plan grows
across stages and a lost executor costs at most one stage.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.plans import attribution, incremental, quality, registry
from matchlake.plans.boosting import BoostedTrees
from matchlake.plans.grading import grade_predictions
from matchlake.plans.incremental import MONTH
from matchlake.plans.training import Fitted, predict_day
from matchlake.schemas import RUNS
from matchlake.session import materialise, release_stored
from matchlake.sources import landing
from matchlake.sources.lake import Lake, append, drop_partitions, read_or_empty, replace_partitions

BRONZE_DOCUMENTS = {
    "schedule": landing.schedule_envelope,
    "boxscores": landing.document_envelope,
    "plays": landing.document_envelope,
    "transactions": landing.transactions_envelope,
    "odds": landing.odds_envelope,
}
PER_MATCH_TABLES = ("boxscores", "plays")
REJECTS = "_rejects"


KEYS = {
    "schedule": "game_pk", "boxscores": "game_pk", "plays": "game_pk",
    "transactions": "transaction_id", "odds": "odds_event_id",
}


def land_days(lake: Lake, landing_root: str, days: Sequence[str], landed_at: datetime) -> None:
    """Rewrite the raw partitions of the given days from the landed files.

    Only the folders of those days are listed and read, each file once. What is not JSON, or has no
    key, is set aside in the reject table and stops nothing else; the rejects of the days are
    those of this landing. Boxscores and plays are kept for the scheduled matches of those days only.
    """
    if not days:
        return
    stamp = F.lit(landed_at)
    wanted = F.col("date").isin(list(days))
    for table, to_envelope in BRONZE_DOCUMENTS.items():
        documents = landing.read_documents(lake.spark, f"{landing_root}/{table}", days)
        good = landing.is_json(F.col("document"))
        if table in PER_MATCH_TABLES:
            good = good & F.col("name").try_cast("long").isNotNull()
        tagged = materialise(documents.withColumn("good", good))
        bad = tagged.filter(~F.col("good")).select("name", "document", "date")
        rows = to_envelope(tagged.filter("good").drop("good"), stamp)
        keyless = rows.filter(F.col(KEYS[table]).isNull())
        bad = bad.unionByName(
            keyless.select(F.lit(None).cast("string").alias("name"), F.col("payload").alias("document"), "date")
        )
        rows = rows.filter(F.col(KEYS[table]).isNotNull())
        if table in PER_MATCH_TABLES:
            rows = landing.for_scheduled(rows, lake.bronze("schedule").filter(wanted))
        replace_partitions(rows, lake.path("bronze", table))
        rejects = lake.path("bronze", f"{REJECTS}/{table}")
        drop_partitions(lake.spark, rejects, days)
        replace_partitions(bad.withColumn("source", F.lit(table)), rejects)


def backfill(
    lake: Lake, landing_root: str, first: int, last: int, landed_at: datetime, force: bool = False
) -> list[str]:
    """Land every day with a match of an inclusive range of seasons; returns the days that were landed.

    Days whose schedule partition is stored already are skipped unless forced, so a broken backfill
    goes on where it stopped: days are landed in order, a season at a time.
    """
    landed = []
    for season in range(first, last + 1):
        days = landing.days_of_seasons(lake.spark, f"{landing_root}/seasons", season, season)
        stored = lake.bronze("schedule").select(F.col("date").try_cast("date").alias("game_date"))
        pending = landing.pending_days(days, stored, force).orderBy("game_date")
        wanted = [row["game_date"].isoformat() for row in pending.collect()]  # at most the days of a year
        land_days(lake, landing_root, wanted, landed_at)
        landed += wanted
    return landed


def days_before(day: date, days: int = landing.REINGEST_DAYS) -> list[str]:
    """The target day and the days before it, oldest first."""
    return [(day - timedelta(days=back)).isoformat() for back in reversed(range(days))]


def build_silver(lake: Lake) -> None:
    """All typed tables from all raw rows."""
    incremental.rebuild_typed(lake)


def build_gold(lake: Lake) -> DataFrame:
    """All feature tables from the typed ones."""
    incremental.rebuild_features(lake)
    return lake.gold("features")


def features_on(lake: Lake, day: date) -> DataFrame:
    """The stored features of a day; only the folder of its month is read."""
    stored = lake.gold("features", MONTH)
    if MONTH not in stored.columns:
        return stored.filter(F.col("game_date") == F.lit(day))
    wanted = (F.col(MONTH) == f"{day:%Y-%m}") & (F.col("game_date") == F.lit(day))
    return stored.filter(wanted).drop(MONTH)


def check_silver(lake: Lake, ran_at: datetime, fail: bool = False) -> DataFrame:
    """Run all checks, append them to the report, and raise on failures if asked."""
    report = quality.quality_report(
        lake.silver("games"), lake.silver("team_game_stats"), lake.silver("pitcher_game_stats")
    ).withColumn("ran_at", F.lit(ran_at).cast("timestamp"))
    path = lake.path("silver", "_quality")
    append(report, path)
    latest = lake.silver("_quality").filter(F.col("ran_at") == F.lit(ran_at).cast("timestamp"))
    if fail:
        quality.enforce(latest)
    return latest


@dataclass(frozen=True)
class Serving:
    """The two models in use and the runs they came from."""

    winner: Fitted
    runs: Fitted
    winner_run_id: str
    runs_run_id: str


def runs_path(lake: Lake) -> str:
    return lake.path("gold", "model_runs")


def model_path(lake: Lake, run_id: str) -> str:
    return lake.path("gold", f"models/{run_id}")


def save_model(lake: Lake, run_id: str, fitted: Fitted) -> None:
    fitted.model.save(lake.spark, model_path(lake, run_id))


def load_trees(lake: Lake, run_id: str) -> Fitted:
    return Fitted(BoostedTrees.load(lake.spark, model_path(lake, run_id)))


def load_serving(lake: Lake) -> Serving:
    """The runs the registry says to serve; an error names the experiment without any."""
    runs = read_or_empty(lake.spark, runs_path(lake), RUNS)
    chosen = {}
    for experiment in (registry.WINNER_EXPERIMENT, registry.RUNS_EXPERIMENT):
        row = registry.latest_run(runs, experiment).select("run_id").first()
        if row is None:
            raise LookupError(f"no model run for experiment {experiment}: train first")
        chosen[experiment] = row["run_id"]
    winner, total = chosen[registry.WINNER_EXPERIMENT], chosen[registry.RUNS_EXPERIMENT]
    return Serving(load_trees(lake, winner), load_trees(lake, total), winner, total)


def score_day(lake: Lake, day: date, predicted_at: datetime, serving: Serving | None = None) -> bool:
    """Write the day's prediction partition; nothing is written when no match is listed."""
    features = features_on(lake, day)
    if features.isEmpty():
        return False
    serving = serving or load_serving(lake)
    predicted = predict_day(
        features, F.lit(day), serving.winner, serving.runs,
        serving.winner_run_id, serving.runs_run_id, F.lit(predicted_at),
    )
    replace_partitions(predicted.withColumn("date", F.col("game_date")), lake.path("gold", "predictions"))
    return True


def explain_games(lake: Lake, keys: Sequence, serving: Serving | None = None) -> DataFrame | None:
    """Top contributions of the serving winner model for some matches of the stored features."""
    serving = serving or load_serving(lake)
    return attribution.explain_keys(lake.gold("features"), keys, serving.winner)


def grade(lake: Lake) -> DataFrame:
    """Rebuild the graded outcomes from all prediction partitions."""
    outcomes = grade_predictions(lake.gold("predictions"), lake.silver("games"), lake.silver("odds"))
    return lake.store(outcomes, "gold", "prediction_outcomes")


def daily_batch(
    lake: Lake,
    landing_root: str,
    day: date,
    now: datetime,
    serving: Serving | None = None,
) -> DataFrame:
    """One day's run over landed files, of which only what changed is worked on; returns the graded outcomes."""
    days = days_before(day)
    land_days(lake, landing_root, days, now)
    incremental.refresh(lake, days)
    score_day(lake, day, now, serving)
    outcomes = grade(lake)
    release_stored(lake.spark)  # all that is left is in the lake
    return outcomes
