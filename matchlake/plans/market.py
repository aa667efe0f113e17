"""Market consensus per match."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.functions.odds import BOOKMAKERS_TYPE, implied_probability, with_consensus
from matchlake.operators.latest import latest_wins

MARKET_COLUMNS = [
    "market_home_win_prob", "market_away_win_prob", "market_total_line",
    "n_books_moneyline", "n_books_totals",
]


def consensus_of_quotes(quotes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Consensus from one row per book: price_home, price_away and point may each be NULL."""
    home, away = implied_probability(F.col("price_home")), implied_probability(F.col("price_away"))
    fair = home / (home + away)
    return quotes.groupBy(*keys).agg(
        F.avg(fair).alias("market_home_win_prob"),
        F.avg(away / (home + away)).alias("market_away_win_prob"),
        F.avg("point").alias("market_total_line"),
        F.count(fair).alias("n_books_moneyline"),
        F.count("point").alias("n_books_totals"),
    )


def odds(landed: DataFrame, games: DataFrame) -> DataFrame:
    """Typed odds: consensus of the newest fetch per date and pairing, with the match key.

    Names that match no game keep a NULL key; a doubleheader gets its pairing's odds twice.
    """
    newest = latest_wins(
        landed,
        ["date", "home_team", "away_team"],
        "fetched_at",
        ["odds_event_id", F.xxhash64("payload")],
    )
    event = F.from_json(
        "payload", f"struct<home_team:string,away_team:string,bookmakers:{BOOKMAKERS_TYPE}>"
    )
    typed = with_consensus(
        newest.withColumn("e", event),
        F.col("e.bookmakers"),
        F.col("e.home_team"),
        F.col("e.away_team"),
    ).select(
        "odds_event_id",
        F.col("date").cast("string").alias("odds_date"),
        "home_team",
        "away_team",
        "commence_time",
        "fetched_at",
        *MARKET_COLUMNS,
    )
    keys = games.select(
        "game_pk",
        F.col("game_date").cast("string").alias("game_date"),
        F.col("home_team_name").alias("home_team"),
        F.col("away_team_name").alias("away_team"),
        F.col("game_date").cast("string").alias("odds_date"),
    )
    return typed.join(keys, ["odds_date", "home_team", "away_team"], "left").select(
        "odds_event_id", "odds_date", "home_team", "away_team", "commence_time", "fetched_at",
        *MARKET_COLUMNS, "game_pk", "game_date",
    )
