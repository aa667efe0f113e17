"""Typed, deduplicated tables from landed JSON payloads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.functions.innings import innings_to_number
from matchlake.operators.latest import latest_wins

# Transaction codes that change who is available.
AVAILABILITY_CODES = ["IL10", "IL60", "IL15", "SC", "RA", "DFA"]

# Payload shapes. Leaves are strings, because the feeds mix numbers and quoted
# numbers; the select that follows casts them, and a text that is no number gives NULL.
_REF = "struct<id:string,name:string>"
_PERSON = "struct<id:string,fullName:string>"
_GAME_SIDE = f"struct<team:{_REF},score:string,probablePitcher:{_PERSON}>"
GAME_PAYLOAD = (
    "struct<gameDate:string,season:string,gameType:string,status:struct<detailedState:string>,"
    f"teams:struct<home:{_GAME_SIDE},away:{_GAME_SIDE}>,venue:{_REF},dayNight:string>"
)
_BATTING = (
    "struct<runs:string,hits:string,atBats:string,strikeOuts:string,baseOnBalls:string,"
    "homeRuns:string,leftOnBase:string>"
)
_PITCHING = (
    "struct<inningsPitched:string,hits:string,runs:string,earnedRuns:string,"
    "baseOnBalls:string,strikeOuts:string,numberOfPitches:string>"
)
_PLAYER = f"struct<person:{_PERSON},stats:struct<pitching:{_PITCHING}>>"
_TEAM_LINE = f"team:{_REF},teamStats:struct<batting:{_BATTING},fielding:struct<errors:string>>"
_PLAYERS = f"pitchers:array<string>,players:map<string,{_PLAYER}>"


def _both_sides(fields: str) -> str:
    return f"struct<teams:struct<home:struct<{fields}>,away:struct<{fields}>>>"


# Each table has a type with what it needs only: the parser skips all else, the players of a team line above all.
TEAM_PAYLOAD, PITCHER_PAYLOAD = _both_sides(_TEAM_LINE), _both_sides(f"team:{_REF},{_PLAYERS}")
BOXSCORE_PAYLOAD = _both_sides(f"{_TEAM_LINE},{_PLAYERS}")
TRANSACTION_PAYLOAD = (
    "struct<typeCode:string,typeDesc:string,description:string,"
    f"person:{_PERSON},fromTeam:{_REF},toTeam:{_REF}>"
)


def parsed(payload_type: str) -> Column:
    """The payload column parsed once; everything else is field access on the result."""
    return F.from_json("payload", payload_type)


def newest_landing(df: DataFrame, *keys: str, fingerprint: str | None = None) -> DataFrame:
    """Newest landed version per key, ties settled by payload hash so that reruns agree."""
    settled = F.col(fingerprint) if fingerprint else F.xxhash64("payload")
    return latest_wins(df, keys, "ingested_at", [settled])


def affects_availability(code: Column) -> Column:
    return code.isin(AVAILABILITY_CODES)


def with_targets(games: DataFrame) -> DataFrame:
    """Total runs and home win of Final matches; a tie or an unfinished match has no winner."""
    final = F.col("status") == "Final"
    home, away = F.col("home_score"), F.col("away_score")
    return games.withColumns(
        {
            "total_runs": F.when(final, home + away),
            "home_win": F.when(final & (home > away), True).when(final & (home < away), False),
        }
    )


def games(schedule: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Typed matches, newest version each; `keep` names raw columns to hand on."""
    g = newest_landing(schedule, "game_pk").withColumn("p", parsed(GAME_PAYLOAD))

    def side(name: str) -> list[Column]:
        return [
            F.col(f"p.teams.{name}.team.id").try_cast("int").alias(f"{name}_team_id"),
            F.col(f"p.teams.{name}.team.name").alias(f"{name}_team_name"),
            F.col(f"p.teams.{name}.score").try_cast("int").alias(f"{name}_score"),
            F.col(f"p.teams.{name}.probablePitcher.id")
            .try_cast("int")
            .alias(f"{name}_probable_pitcher_id"),
            F.col(f"p.teams.{name}.probablePitcher.fullName").alias(
                f"{name}_probable_pitcher_name"
            ),
        ]

    typed = g.select(
        "game_pk",
        F.col("game_date").try_cast("date").alias("game_date"),
        F.col("p.gameDate").try_cast("timestamp").alias("game_datetime_utc"),
        F.col("p.season").try_cast("int").alias("season"),
        F.col("p.gameType").alias("game_type"),
        F.col("p.status.detailedState").alias("status"),
        *side("home"),
        *side("away"),
        F.col("p.venue.id").try_cast("int").alias("venue_id"),
        F.col("p.venue.name").alias("venue_name"),
        F.col("p.dayNight").alias("day_night"),
        "ingested_at",
        *keep,
    )
    return with_targets(typed).select(
        "game_pk", "game_date", "game_datetime_utc", "season", "game_type", "status",
        "home_team_id", "home_team_name", "away_team_id", "away_team_name",
        "home_score", "away_score", "total_runs", "home_win",
        "venue_id", "venue_name", "day_night",
        "home_probable_pitcher_id", "home_probable_pitcher_name",
        "away_probable_pitcher_id", "away_probable_pitcher_name", "ingested_at", *keep,
    )


def parse_boxscores(
    boxscores: DataFrame, keep: Sequence[str] = (), payload_type: str = BOXSCORE_PAYLOAD
) -> DataFrame:
    """Boxscores with what both tables below need of their payload, parsed once.

    Stored, the result serves both; the payload itself is not read again.
    """
    return boxscores.select(
        "game_pk",
        "ingested_at",
        F.xxhash64("payload").alias("fingerprint"),
        parsed(payload_type).alias("p"),
        *keep,
    )


def _parsed_boxscores(boxscores: DataFrame, keep: Sequence[str], payload_type: str) -> DataFrame:
    return boxscores if "p" in boxscores.columns else parse_boxscores(boxscores, keep, payload_type)


def team_game_stats(boxscores: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Batting and fielding line of both teams of each match, from raw or parsed boxscores."""
    lines = _parsed_boxscores(boxscores, keep, TEAM_PAYLOAD).select(
        "game_pk",
        "ingested_at",
        "fingerprint",
        *keep,
        F.explode(
            F.array(
                F.struct(F.lit(True).alias("is_home"), F.col("p.teams.home").alias("t")),
                F.struct(F.lit(False).alias("is_home"), F.col("p.teams.away").alias("t")),
            )
        ).alias("s"),
    )
    batting = {
        "runs": "runs", "hits": "hits", "at_bats": "atBats", "strikeouts": "strikeOuts",
        "walks": "baseOnBalls", "home_runs": "homeRuns", "left_on_base": "leftOnBase",
    }
    typed = lines.select(
        "game_pk",
        F.col("s.t.team.id").try_cast("int").alias("team_id"),
        "s.is_home",
        *[F.col(f"s.t.teamStats.batting.{j}").try_cast("int").alias(c) for c, j in batting.items()],
        F.col("s.t.teamStats.fielding.errors").try_cast("int").alias("errors"),
        "ingested_at",
        *keep,
        "fingerprint",
    )
    return newest_landing(typed, "game_pk", "team_id", fingerprint="fingerprint").drop("fingerprint")


def pitcher_game_stats(boxscores: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per player listed among a side's pitchers; the first listed one started.

    Boxscores are raw or parsed.
    """
    sides = _parsed_boxscores(boxscores, keep, PITCHER_PAYLOAD).select(
        "game_pk",
        "fingerprint",
        "ingested_at",
        *keep,
        F.explode(F.array("p.teams.home", "p.teams.away")).alias("side"),
    )
    players = sides.select(
        "game_pk",
        "fingerprint",
        "ingested_at",
        *keep,
        F.col("side.team.id").try_cast("int").alias("team_id"),
        F.col("side.pitchers").alias("pitchers"),
        F.explode(F.map_values("side.players")).alias("player"),
    ).filter(F.array_contains("pitchers", F.col("player.person.id")))
    rows = players.select(
        "game_pk",
        "team_id",
        F.col("player.person.id").try_cast("int").alias("pitcher_id"),
        F.col("player.person.fullName").alias("pitcher_name"),
        (F.col("player.person.id") == F.get("pitchers", F.lit(0))).alias("is_starter"),
        F.col("player.stats.pitching").alias("line"),
        "fingerprint",
        "ingested_at",
        *keep,
    )
    counts = {
        "hits_allowed": "hits", "runs_allowed": "runs", "earned_runs": "earnedRuns",
        "walks": "baseOnBalls", "strikeouts": "strikeOuts", "pitches_thrown": "numberOfPitches",
    }
    return newest_landing(rows, "game_pk", "pitcher_id", fingerprint="fingerprint").select(
        "game_pk",
        "team_id",
        "pitcher_id",
        "pitcher_name",
        "is_starter",
        innings_to_number(F.col("line.inningsPitched")).alias("innings_pitched"),
        *[F.col(f"line.{j}").try_cast("int").alias(c) for c, j in counts.items()],
        "ingested_at",
        *keep,
    )


def transactions(landed: DataFrame) -> DataFrame:
    t = newest_landing(landed, "transaction_id").withColumn("p", parsed(TRANSACTION_PAYLOAD))
    return t.select(
        "transaction_id",
        F.col("date").try_cast("date").alias("transaction_date"),
        F.col("p.typeCode").alias("type_code"),
        F.col("p.typeDesc").alias("type_desc"),
        F.col("p.description").alias("description"),
        F.col("p.person.id").try_cast("int").alias("person_id"),
        F.col("p.person.fullName").alias("person_name"),
        F.col("p.fromTeam.id").try_cast("int").alias("from_team_id"),
        F.col("p.fromTeam.name").alias("from_team_name"),
        F.col("p.toTeam.id").try_cast("int").alias("to_team_id"),
        F.col("p.toTeam.name").alias("to_team_name"),
        affects_availability(F.col("p.typeCode")).alias("affects_availability"),
        "ingested_at",
    )
