"""Landed JSON responses to raw envelopes: key, date, payload text, time of landing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Regular season and postseason.
SEASON_GAME_TYPES = ["R", "P"]
# Fixed value: days read again on every run, the target day included.
REINGEST_DAYS = 3


def read_documents(spark: SparkSession, path: str, days: Sequence[str]) -> DataFrame:
    """One row per file landed on the given days: `date` from its folder, `name` and `document`.

    The folders of the days are named in the path, so that no other folder is listed.
    """
    folders = f"{path}/date={{{','.join(days)}}}"
    try:
        files = spark.read.schema("value string, date string").option("basePath", path).text(folders, wholetext=True)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "date string, name string, document string")
    return files.select(
        "date",
        F.regexp_extract("_metadata.file_name", r"^(.*?)(\.json)?$", 1).alias("name"),
        F.col("value").alias("document"),
    )


def is_json(document: Column) -> Column:
    """Whether a text is a JSON document, of any size and with repeated keys or not.

    get_json_object gives up on a single text of over 20 million characters, which the parser of
    from_json does not; that one takes any array for a broken object, though.
    """
    parsed = F.from_json(document, "struct<_broken:string>", {"columnNameOfCorruptRecord": "_broken"})
    whole_object = F.ltrim(document).startswith("{") & parsed["_broken"].isNull()
    return F.coalesce(F.get_json_object(document, "$").isNotNull() | whole_object, F.lit(False))


def split_rejects(documents: DataFrame, column: str = "document") -> tuple[DataFrame, DataFrame]:
    """Documents that are JSON, and those that are not. Two reads: store what is dear to read first."""
    good = is_json(F.col(column))
    return documents.filter(good), documents.filter(~good)


# Array elements declared as strings keep the JSON text of each object unchanged.


def schedule_games(documents: DataFrame) -> DataFrame:
    """One row per match of the schedule responses, any `date` column kept."""
    blocks = F.from_json("document", "struct<dates:array<struct<date:string,games:array<string>>>>")
    kept = [c for c in documents.columns if c != "document"]
    return (
        documents.select(*kept, F.explode(blocks["dates"]).alias("block"))
        .select(*kept, F.col("block.date").alias("block_date"), F.explode("block.games").alias("payload"))
    )


def transaction_items(documents: DataFrame) -> DataFrame:
    kept = [c for c in documents.columns if c != "document"]
    items = F.from_json("document", "struct<transactions:array<string>>")["transactions"]
    return documents.select(*kept, F.explode(items).alias("payload"))


def odds_events(documents: DataFrame) -> DataFrame:
    kept = [c for c in documents.columns if c != "document"]
    return documents.select(*kept, F.explode(F.from_json("document", "array<string>")).alias("payload"))


def envelope(
    payloads: DataFrame,
    keys: Mapping[str, Column],
    landed_at: Column,
    stamp: str = "ingested_at",
) -> DataFrame:
    """Raw rows: key columns, the partition date, the payload text and the time of landing."""
    return payloads.select(
        *[expr.alias(name) for name, expr in keys.items()],
        "payload",
        landed_at.cast("timestamp").alias(stamp),
        F.col("date").cast("string").alias("date"),
    )


def _field(path: str) -> Column:
    return F.get_json_object("payload", f"$.{path}")


def schedule_envelope(documents: DataFrame, landed_at: Column) -> DataFrame:
    keys = {"game_pk": _field("gamePk").try_cast("long"), "game_date": F.col("date").cast("string")}
    return envelope(schedule_games(documents), keys, landed_at)


def document_envelope(documents: DataFrame, landed_at: Column) -> DataFrame:
    """Boxscores and plays: one file per match, named by its key."""
    payloads = documents.withColumnRenamed("document", "payload")
    return envelope(payloads, {"game_pk": F.col("name").try_cast("long")}, landed_at)


def transactions_envelope(documents: DataFrame, landed_at: Column) -> DataFrame:
    keys = {"transaction_id": _field("id").try_cast("long")}
    return envelope(transaction_items(documents), keys, landed_at)


def odds_envelope(documents: DataFrame, landed_at: Column) -> DataFrame:
    event = F.from_json(
        "payload", "struct<id:string,commence_time:string,home_team:string,away_team:string>"
    )
    events = odds_events(documents).withColumn("event", event)
    keys = {
        "odds_event_id": F.col("event.id"),
        "commence_time": F.col("event.commence_time"),
        "home_team": F.col("event.home_team"),
        "away_team": F.col("event.away_team"),
    }
    return envelope(events, keys, landed_at, stamp="fetched_at")


def for_scheduled(landed: DataFrame, schedule: DataFrame) -> DataFrame:
    """Landed rows of the matches on the schedule."""
    return landed.join(schedule.select("game_pk"), "game_pk", "left_semi")


def game_days(scheduled: DataFrame) -> DataFrame:
    """Distinct days with a regular-season or postseason match, in order."""
    return (
        scheduled.filter(F.col("game_type").isin(SEASON_GAME_TYPES))
        .select("game_date")
        .distinct()
        .orderBy("game_date")
    )


def days_of_seasons(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """Days with a match in the schedule responses of an inclusive range of seasons.

    Responses lie under season=YYYY folders. Only those of the range are read; a season without
    response has no days, and neither has a response that is not JSON.
    """
    wanted = ",".join(str(season) for season in range(first, last + 1))
    try:
        documents = spark.read.option("basePath", path).text(f"{path}/season={{{wanted}}}", wholetext=True)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        documents = spark.createDataFrame([], "value string")
    games = schedule_games(documents.select(F.col("value").alias("document")).filter(is_json(F.col("document"))))
    return game_days(
        games.select(
            F.col("block_date").try_cast("date").alias("game_date"), _field("gameType").alias("game_type")
        ).filter("game_date IS NOT NULL")
    )


def pending_days(days: DataFrame, stored: DataFrame, force: bool = False) -> DataFrame:
    """Days without a stored partition; all of them when forced."""
    if force:
        return days
    return days.join(stored.select("game_date").distinct(), "game_date", "left_anti")


def seasons_between(spark: SparkSession, first: int, last: int) -> DataFrame:
    """Seasons of an inclusive range."""
    return spark.range(first, last + 1).select(F.col("id").cast("int").alias("season"))


def reingest_days(day: Column, days: int = REINGEST_DAYS) -> Column:
    """The target day and the days before it, oldest first."""
    return F.sequence(F.date_sub(day, days - 1), day)
