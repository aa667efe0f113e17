"""Betting-line arithmetic on nested book → market → outcome arrays."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BOOKMAKERS_TYPE = (
    "array<struct<key:string,markets:array<struct<key:string,"
    "outcomes:array<struct<name:string,price:double,point:double>>>>>>"
)
EVENT_TYPE = (
    "struct<id:string,commence_time:string,home_team:string,away_team:string,"
    f"bookmakers:{BOOKMAKERS_TYPE}>"
)


def implied_probability(price: Column) -> Column:
    """American odds to the probability they imply, bookmaker margin included."""
    return F.when(price < 0, -price / (100.0 - price)).otherwise(100.0 / (100.0 + price))


def _last_price(outcomes: Column, team: Column) -> Column:
    priced = F.filter(outcomes, lambda o: (o["name"] == team) & o["price"].isNotNull())
    return F.try_element_at(priced, F.lit(-1))["price"]


def _outcomes_of(markets: Column, kind: str) -> Column:
    chosen = F.filter(markets, lambda m: m["key"] == kind)
    return F.transform(chosen, lambda m: F.coalesce(m["outcomes"], F.array()))


def _moneyline(markets: Column, home_team: Column, away_team: Column) -> Column:
    """Sums of margin-free probabilities and the number of books that price both sides."""
    visitor = F.nullif(away_team, home_team)
    prices = F.transform(
        _outcomes_of(markets, "h2h"),
        lambda os: F.struct(
            _last_price(os, home_team).alias("home"), _last_price(os, visitor).alias("away")
        ),
    )
    raw = F.transform(
        F.filter(prices, lambda p: p["home"].isNotNull() & p["away"].isNotNull()),
        lambda p: F.struct(
            implied_probability(p["home"]).alias("home"),
            implied_probability(p["away"]).alias("away"),
        ),
    )
    start = F.struct(F.lit(0.0).alias("home"), F.lit(0.0).alias("away"), F.lit(0).alias("n"))
    return F.aggregate(
        raw,
        start,
        lambda acc, p: F.struct(
            (acc["home"] + p["home"] / (p["home"] + p["away"])).alias("home"),
            (acc["away"] + p["away"] / (p["home"] + p["away"])).alias("away"),
            (acc["n"] + 1).alias("n"),
        ),
    )


def _totals(markets: Column) -> Column:
    """Sum of the totals lines and the number of books that give one."""
    points = F.transform(
        _outcomes_of(markets, "totals"),
        lambda os: F.get(F.filter(os, lambda o: o["point"].isNotNull()), F.lit(0))["point"],
    )
    start = F.struct(F.lit(0.0).alias("line"), F.lit(0).alias("n"))
    return F.aggregate(
        F.filter(points, lambda point: point.isNotNull()),
        start,
        lambda acc, point: F.struct((acc["line"] + point).alias("line"), (acc["n"] + 1).alias("n")),
    )


def with_consensus(
    df: DataFrame, bookmakers: Column, home_team: Column, away_team: Column
) -> DataFrame:
    """Append mean margin-free win probabilities and total line over the books, with book counts.

    A moneyline market counts when both sides have a price; of several prices for a
    side the last counts. A totals market gives the point of its first outcome that has one.
    Each stage is its own projection, so that a row's arrays are walked once.
    """
    markets = F.flatten(
        F.transform(
            F.coalesce(bookmakers, F.array()), lambda b: F.coalesce(b["markets"], F.array())
        )
    )
    summed = df.withColumn("_markets", markets).withColumns(
        {
            "_h2h": _moneyline(F.col("_markets"), home_team, away_team),
            "_totals": _totals(F.col("_markets")),
        }
    )
    books, lines = F.col("_h2h.n"), F.col("_totals.n")
    return summed.withColumns(
        {
            "market_home_win_prob": F.col("_h2h.home") / F.nullif(books, F.lit(0)),
            "market_away_win_prob": F.col("_h2h.away") / F.nullif(books, F.lit(0)),
            "market_total_line": F.col("_totals.line") / F.nullif(lines, F.lit(0)),
            "n_books_moneyline": books,
            "n_books_totals": lines,
        }
    ).drop("_markets", "_h2h", "_totals")
