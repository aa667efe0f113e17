"""The driver's star-schema tables read as match data.

Each function reshapes whole tables; `ORACLE` holds the same definition in ANSI SQL,
so that a query and its oracle start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchlake.functions.innings import innings_to_number
from matchlake.operators.latest import latest_wins
from matchlake.plans import gold
from matchlake.plans.grading import grade_predictions
from matchlake.plans.market import consensus_of_quotes
from matchlake.plans.silver import affects_availability, with_targets
from matchlake.plans.splits import split_by_season
from matchlake.session import materialise

# Seasons of the time-based split.
TRAIN_SEASONS, VAL_SEASONS, TEST_SEASONS = [1995, 1996, 1997, 1998], [1999], [2000, 2001]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _mod(expr: str, n: int) -> Column:
    return F.expr(f"({expr}) % {n}").cast("int")


def game_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every match as first landed, and a quarter of them landed again once finished."""
    orders = read(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    base = orders.select(
        F.col("o_orderkey").alias("game_pk"),
        F.col("day").alias("game_date"),
        F.year("day").alias("season"),
        F.when(F.col("o_orderpriority").startswith("1"), "P").otherwise("R").alias("game_type"),
        "o_orderstatus",
        _mod("o_custkey", 30).alias("home_team_id"),
        _mod("o_custkey % 30 + 1 + o_orderkey % 29", 30).alias("away_team_id"),
        _mod("7 * o_orderkey + 3 * o_custkey", 13).alias("home_runs"),
        _mod("5 * o_orderkey + 11 * o_custkey", 13).alias("away_runs"),
        F.when(F.col("o_orderkey") % 3 == 0, "day").otherwise("night").alias("day_night"),
        F.when(F.col("o_orderkey") % 10 != 0, _mod("o_custkey", 100)).alias(
            "home_probable_pitcher_id"
        ),
        F.when(F.col("o_orderkey") % 11 != 0, _mod("3 * o_custkey + 1", 100)).alias(
            "away_probable_pitcher_id"
        ),
    )
    again = (F.col("game_pk") % 4 == 0).cast("int")
    landed = base.withColumn("version", F.explode(F.sequence(F.lit(1), 1 + again)))
    first_status = (
        F.when(F.col("o_orderstatus") == "F", "Final")
        .when(F.col("o_orderstatus") == "O", "Scheduled")
        .otherwise("In Progress")
    )
    status = F.when(F.col("version") == 2, "Final").otherwise(first_status)
    known = status != "Scheduled"
    return landed.select(
        "game_pk",
        "game_date",
        "season",
        "game_type",
        status.alias("status"),
        "home_team_id",
        "away_team_id",
        F.concat(F.lit("Team "), F.col("home_team_id").cast("string")).alias("home_team_name"),
        F.concat(F.lit("Team "), F.col("away_team_id").cast("string")).alias("away_team_name"),
        F.when(known, F.col("home_runs")).alias("home_score"),
        F.when(known, F.col("away_runs")).alias("away_score"),
        (F.col("home_team_id") + 100).alias("venue_id"),
        "day_night",
        "home_probable_pitcher_id",
        "away_probable_pitcher_id",
        "version",
        F.date_add("game_date", F.col("version") - 1).alias("ingested_on"),
    )


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First versions with their targets: one row per match."""
    first = game_versions(spark, sf_dir).filter("version = 1").drop("version", "ingested_on")
    return with_targets(first)


def latest_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest version of every match with its targets."""
    newest = latest_wins(game_versions(spark, sf_dir), ["game_pk"], "ingested_on")
    return with_targets(newest)


def pitchers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pitcher lines from order lines; even ids pitch for the home team."""
    # One shuffle of the lines, by match, serves their sums, the starters and the join with the matches.
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity").repartition("l_orderkey")
    home_side = (F.col("l_suppkey") % 2 == 0).alias("is_home")
    per_pitcher = lines.filter("l_suppkey IS NOT NULL").groupBy("l_orderkey", "l_suppkey").agg(
        F.sum("l_quantity").cast("long").alias("q"), F.count(F.lit(1)).alias("c")
    )
    of_side = Window.partitionBy("l_orderkey", "is_home")
    teams = games(spark, sf_dir).select("game_pk", "home_team_id", "away_team_id")
    text = F.expr("concat(cast((q % 22) div 3 as string), '.', cast((q % 22) % 3 as string))")
    return (
        per_pitcher.withColumn("is_home", home_side)
        .withColumn("starter", F.min("l_suppkey").over(of_side))
        .join(teams, F.col("l_orderkey") == F.col("game_pk"))
        .select(
            "game_pk",
            F.when(F.col("is_home"), F.col("home_team_id"))
            .otherwise(F.col("away_team_id"))
            .alias("team_id"),
            F.col("l_suppkey").cast("int").alias("pitcher_id"),
            (F.col("l_suppkey") == F.col("starter")).alias("is_starter"),
            innings_to_number(text).alias("innings_pitched"),
            _mod("q", 7).alias("earned_runs"),
            _mod("q + c", 12).alias("strikeouts"),
        )
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_type")
    code = (
        F.when(event == "error", "IL10")
        .when(event == "signup", "DFA")
        .when(event == "purchase", "IL60")
        .when(event == "click", "TR")
    )
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("transaction_id"),
        F.date_add(F.lit("1995-01-01").cast("date"), _mod("7 * event_id", 2400)).alias(
            "transaction_date"
        ),
        code.alias("type_code"),
        F.when(F.col("user_id") % 5 != 0, _mod("user_id", 30)).alias("from_team_id"),
        F.when(F.col("user_id") % 10 != 0, _mod("user_id + 3", 30)).alias("to_team_id"),
        affects_availability(code).alias("affects_availability"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prediction per match; every sixth match predicted again an hour later by the same run."""
    orders = read(spark, sf_dir, "orders")
    again = (F.col("o_orderkey") % 6 == 0).cast("int")
    p = F.expr("((37 * o_orderkey + o_custkey) % 1000) / 1000.0D")
    return orders.withColumn("n", F.explode(F.sequence(F.lit(0), again))).select(
        F.col("o_orderkey").alias("game_pk"),
        F.to_date("o_orderdate").alias("game_date"),
        F.when(F.col("n") == 0, p).otherwise(1 - p).alias("predicted_home_win_prob"),
        F.expr("(o_orderkey % 170) / 10.0D").alias("predicted_total_runs"),
        F.concat(F.lit("run-"), F.expr("cast(o_custkey % 2 as string)")).alias(
            "winner_model_run_id"
        ),
        F.lit("run-r").alias("runs_model_run_id"),
        F.expr("o_orderdate + make_dt_interval(0, n)").alias("predicted_at"),
    )


_PRICE_HOME = "if(o_custkey % 2 = 0, -1, 1) * (100 + (o_orderkey * (b + 3)) % 150)"
_PRICE_AWAY = "if(o_custkey % 2 = 0, 1, -1) * (100 + (o_orderkey * (b + 3)) % 150)"


def book_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three books' prices for each match that has a market."""
    orders = read(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 8 != 0)
    return orders.withColumn("b", F.explode(F.array(*map(F.lit, (0, 1, 2))))).select(
        F.col("o_orderkey").alias("game_pk"),
        F.col("b").alias("book"),
        F.expr(_PRICE_HOME).cast("double").alias("price_home"),
        F.expr(_PRICE_AWAY).cast("double").alias("price_away"),
        F.expr("6 + (o_orderkey % 9) / 2.0D").alias("point"),
    )


def market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market consensus per match."""
    return consensus_of_quotes(book_quotes(spark, sf_dir), ["game_pk"])


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table over stored match and pitcher tables, as in the daily batch."""
    return gold.build_features(
        materialise(games(spark, sf_dir)),
        materialise(pitchers(spark, sf_dir)),
        transactions(spark, sf_dir),
    )


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grade_predictions(
        predictions(spark, sf_dir), games(spark, sf_dir), market(spark, sf_dir)
    )


# ---------------------------------------------------------------------------
# Landed JSON, written by Spark from the same tables.
# ---------------------------------------------------------------------------


def _named(id_column: str) -> Column:
    name = F.concat(F.lit("Team "), F.col(id_column).cast("string"))
    return F.struct(F.col(id_column).alias("id"), name.alias("name"))


def landed_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw schedule rows; numbers appear quoted in some payloads, as in the feeds."""

    def side(name: str) -> Column:
        pitcher = F.col(f"{name}_probable_pitcher_id")
        full_name = F.concat(F.lit("Pitcher "), pitcher.cast("string"))
        return F.struct(
            _named(f"{name}_team_id").alias("team"),
            F.col(f"{name}_score").alias("score"),
            F.when(
                pitcher.isNotNull(), F.struct(pitcher.alias("id"), full_name.alias("fullName"))
            ).alias("probablePitcher"),
        ).alias(name)

    payload = F.struct(
        F.col("game_pk").alias("gamePk"),
        F.concat(F.col("game_date").cast("string"), F.lit("T23:05:00Z")).alias("gameDate"),
        F.col("season").cast("string").alias("season"),
        F.col("game_type").alias("gameType"),
        F.struct(F.col("status").alias("detailedState")).alias("status"),
        F.struct(side("home"), side("away")).alias("teams"),
        F.struct(
            F.col("venue_id").alias("id"),
            F.concat(F.lit("Park "), F.col("venue_id").cast("string")).alias("name"),
        ).alias("venue"),
        F.col("day_night").alias("dayNight"),
    )
    return game_versions(spark, sf_dir).select(
        "game_pk",
        F.col("game_date").cast("string").alias("game_date"),
        F.to_json(payload).alias("payload"),
        F.col("ingested_on").cast("timestamp").alias("ingested_at"),
    )


def landed_boxscores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw boxscores: two home pitchers, one away pitcher and one batter per match."""

    def pitcher(id_expr: str) -> Column:
        line = F.expr(
            f"""named_struct(
                'inningsPitched', concat(cast(({id_expr}) % 7 as string), '.',
                                         cast(game_pk % 3 as string)),
                'hits', cast((game_pk + {id_expr}) % 9 as int),
                'runs', cast(({id_expr}) % 6 as int),
                'earnedRuns', cast((game_pk + version) % 5 as int),
                'baseOnBalls', cast(game_pk % 4 as int),
                'strikeOuts', cast((game_pk + 2 * ({id_expr})) % 11 as int),
                'numberOfPitches', cast(20 + game_pk % 80 as int))"""
        )
        player = F.struct(
            F.struct(
                F.expr(id_expr).alias("id"),
                F.concat(F.lit("Pitcher "), F.expr(id_expr).cast("string")).alias("fullName"),
            ).alias("person"),
            F.struct(line.alias("pitching")).alias("stats"),
        )
        return F.concat(F.lit("ID"), F.expr(id_expr).cast("string")), player

    first, second, visitor = "1000 + game_pk % 97", "1500 + game_pk % 97", "3000 + game_pk % 89"
    _, some_player = pitcher(first)
    batter = some_player.withField(
        "person", F.struct(F.lit(9999).cast("bigint").alias("id"), F.lit("Batter").alias("fullName"))
    ).withField("stats.pitching", F.lit(None).cast(_PITCHING_LINE))

    def side(name: str, ids: list[str], players: Column) -> Column:
        batting = F.struct(
            F.col(f"{name}_score").alias("runs"),
            F.expr("cast(game_pk % 14 as int)").alias("hits"),
            F.expr("cast(27 + game_pk % 9 as int)").alias("atBats"),
            F.expr("cast(game_pk % 12 as int)").alias("strikeOuts"),
            F.expr("cast(game_pk % 6 as int)").alias("baseOnBalls"),
            F.expr("cast(game_pk % 3 as int)").alias("homeRuns"),
            F.expr("cast(game_pk % 10 as int)").alias("leftOnBase"),
        )
        fielding = F.struct(F.expr("cast(game_pk % 2 as int)").alias("errors"))
        return F.struct(
            _named(f"{name}_team_id").alias("team"),
            F.struct(batting.alias("batting"), fielding.alias("fielding")).alias("teamStats"),
            F.array(*[F.expr(i) for i in ids]).alias("pitchers"),
            players.alias("players"),
        ).alias(name)

    home_players = F.create_map(*pitcher(first), *pitcher(second), F.lit("ID9999"), batter)
    payload = F.struct(
        F.struct(
            side("home", [first, second], home_players),
            side("away", [visitor], F.create_map(*pitcher(visitor))),
        ).alias("teams")
    )
    return game_versions(spark, sf_dir).select(
        "game_pk",
        F.to_json(payload).alias("payload"),
        F.col("ingested_on").cast("timestamp").alias("ingested_at"),
    )


_PITCHING_LINE = (
    "struct<inningsPitched:string,hits:int,runs:int,earnedRuns:int,baseOnBalls:int,"
    "strikeOuts:int,numberOfPitches:int>"
)


def landed_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions; every fifth one landed again a day later as a trade."""
    events = read(spark, sf_dir, "events")
    again = (F.col("event_id") % 5 == 0).cast("int")
    versions = events.withColumn("version", F.explode(F.sequence(F.lit(1), 1 + again)))
    code = F.when(F.col("version") == 2, "TR").otherwise(
        F.when(F.col("event_type") == "error", "IL10")
        .when(F.col("event_type") == "signup", "DFA")
        .when(F.col("event_type") == "purchase", "IL60")
    )
    team = F.struct(
        F.expr("user_id % 30").alias("id"),
        F.expr("concat('Team ', cast(user_id % 30 as string))").alias("name"),
    )
    payload = F.struct(
        F.col("event_id").alias("id"),
        code.alias("typeCode"),
        F.col("event_type").alias("typeDesc"),
        F.concat(F.lit('"quoted" é '), F.col("event_type")).alias("description"),
        F.struct(
            F.col("user_id").alias("id"),
            F.expr("concat('Player ', cast(user_id as string))").alias("fullName"),
        ).alias("person"),
        F.when(F.col("user_id") % 5 != 0, team).alias("fromTeam"),
        F.when(F.col("user_id") % 10 != 0, team).alias("toTeam"),
    )
    day = F.date_add(F.lit("1995-01-01").cast("date"), _mod("7 * event_id", 2400))
    return versions.select(
        F.col("event_id").alias("transaction_id"),
        day.cast("string").alias("date"),
        F.to_json(payload).alias("payload"),
        F.date_add(day, F.col("version")).cast("timestamp").alias("ingested_at"),
    )


def landed_odds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw odds events: three books with both markets, none for every sixteenth event."""

    def book(b: int) -> Column:
        price = f"(100 + (game_pk * {b + 3}) % 150)"
        sign = "if(home_team_id % 2 = 0, -1, 1)"  # as the customer's key, whose remainder by 30 the id is

        def outcome(name: Column, price_expr: str, point: Column) -> Column:
            return F.struct(
                name.alias("name"), F.expr(price_expr).alias("price"), point.alias("point")
            )

        none = F.lit(None).cast("double")
        line = F.expr("6 + (game_pk % 9) / 2.0D")
        moneyline = F.array(
            outcome(F.col("home_team"), f"{sign} * {price}", none),
            outcome(F.col("away_team"), f"-{sign} * {price}", none),
        )
        totals = F.array(
            outcome(F.lit("Over"), "-110L", line), outcome(F.lit("Under"), "-110L", line)
        )
        return F.struct(
            F.lit(f"book{b}").alias("key"),
            F.array(
                F.struct(F.lit("h2h").alias("key"), moneyline.alias("outcomes")),
                F.struct(F.lit("totals").alias("key"), totals.alias("outcomes")),
            ).alias("markets"),
        )

    priced = games(spark, sf_dir).filter("game_pk IS NOT NULL").select(
        "game_pk",
        "home_team_id",
        F.col("game_date").cast("string").alias("date"),
        F.col("home_team_name").alias("home_team"),
        # Every seventh event spells the visitor in a way the schedule does not.
        F.expr("if(game_pk % 7 = 0, concat('The ', away_team_name), away_team_name)").alias(
            "away_team"
        ),
    )
    books = F.array(book(0), book(1), book(2))
    event = F.struct(
        F.col("game_pk").cast("string").alias("id"),
        "home_team",
        "away_team",
        F.when(F.col("game_pk") % 16 == 0, F.slice(books, 1, 0)).otherwise(books).alias("bookmakers"),
    )
    return priced.select(
        F.col("game_pk").cast("string").alias("odds_event_id"),
        "date",
        F.concat("date", F.lit("T23:05:00Z")).alias("commence_time"),
        "home_team",
        "away_team",
        F.to_json(event).alias("payload"),
        F.expr("cast(cast(date as date) as timestamp) + make_dt_interval(0, 0, game_pk % 600)").alias(
            "fetched_at"
        ),
    )


def schedule_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One schedule response per order with two matches, some broken and some odd."""
    orders = read(spark, sf_dir, "orders")
    day = F.to_date("o_orderdate").cast("string")

    def game(k: int) -> Column:
        return F.struct(
            F.expr(f"2 * o_orderkey + {k}").alias("gamePk"),
            F.col("o_orderpriority").alias("gameType"),
        )

    whole = F.to_json(
        F.struct(
            F.array(
                F.struct(day.alias("date"), F.array(game(0), game(1)).alias("games")),
                F.struct(day.alias("date"), F.slice(F.array(game(0)), 1, 0).alias("games")),
            ).alias("dates")
        )
    )
    # Every seventh response is cut off, every fifth repeats a key, and both may happen.
    repeated = F.when(F.col("o_orderkey") % 5 == 0, F.concat(F.lit('{"note":1,"note":{"x":2},'), F.substr("response", F.lit(2))))
    response = F.coalesce(repeated, "response")
    cut = F.when(F.col("o_orderkey") % 7 == 0, F.left(response, F.length(response) - 3))
    return orders.select(
        F.col("o_orderkey").cast("string").alias("name"),
        day.alias("date"),
        whole.alias("response"),
        "o_orderkey",
    ).select("name", "date", F.coalesce(cut, response).alias("document"))


def transaction_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transactions response per event, holding one or two items."""
    item = F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("typeCode"))
    other = F.struct(F.expr("-event_id").alias("id"), F.col("event_type").alias("typeCode"))
    items = F.when(F.col("event_id") % 3 == 0, F.array(item)).otherwise(F.array(item, other))
    return read(spark, sf_dir, "events").select(
        F.to_date("ts").cast("string").alias("date"),
        F.to_json(F.struct(items.alias("transactions"))).alias("document"),
    )


def odds_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One odds response per landed odds event: a top-level list."""
    event = F.concat(F.lit("["), F.col("payload"), F.lit("]")).alias("document")
    return landed_odds(spark, sf_dir).select("date", event)


def team_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Team lines with gaps and repeats, so that the checks find something."""
    sides = gold.team_games(games(spark, sf_dir))
    key = F.col("game_pk")
    copies = F.when(key % 50 == 0, 0).when(key % 60 == 1, 2).otherwise(1)
    return sides.select(
        "game_pk", "team_id", F.explode(F.array_repeat(F.col("runs_scored"), copies)).alias("runs")
    )


def split_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled matches with split and freshest prediction."""
    labelled = games(spark, sf_dir).select(
        "game_pk",
        "season",
        F.col("home_win").alias("target_home_win"),
        F.col("total_runs").alias("target_total_runs"),
    )
    split = split_by_season(labelled, TRAIN_SEASONS, VAL_SEASONS, TEST_SEASONS)
    freshest = latest_wins(predictions(spark, sf_dir), ["game_pk"], "predicted_at")
    return split.join(
        freshest.select("game_pk", "predicted_home_win_prob", "predicted_total_runs"), "game_pk"
    )


def split_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_by_season(features(spark, sf_dir), TRAIN_SEASONS, VAL_SEASONS, TEST_SEASONS)


def model_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run history with one run per order."""
    metric = F.expr("0.5 + ((37 * o_orderkey + 11 * o_custkey) % 5000) / 10000.0D")
    key = F.col("o_orderkey")
    metrics = F.when(
        key % 9 == 0, F.create_map(F.lit("train_log_loss"), metric / 2)
    ).otherwise(
        F.create_map(
            F.lit("train_log_loss"), metric / 2,
            F.lit("val_log_loss"), metric,
            F.lit("test_log_loss"), metric + 0.25,
            F.lit("promoted"), F.lit(1.0),
        )
    )
    promoted = F.when(key % 4 == 0, "true").when(key % 4 == 1, "false")
    return read(spark, sf_dir, "orders").select(
        F.concat(F.lit("run-"), key.cast("string")).alias("run_id"),
        F.when(F.col("o_custkey") % 2 == 0, "winner").otherwise("runs").alias("experiment"),
        F.concat(F.lit("family-"), F.expr("cast(o_custkey % 5 as string)")).alias("model_family"),
        F.col("o_orderdate").cast("timestamp").alias("start_time"),
        metrics.alias("metrics"),
        F.when(
            promoted.isNotNull() & (F.col("o_custkey") % 5 != 4),
            F.create_map(F.lit("promoted"), promoted),
        ).alias("tags"),
    )


# ---------------------------------------------------------------------------
# The same tables in SQL. Values refer to the driver's views and to each other.
# ---------------------------------------------------------------------------

ORACLE: dict[str, str] = {}

ORACLE["versions_v"] = """
SELECT o_orderkey AS game_pk, CAST(o_orderdate AS DATE) AS game_date,
       CAST(extract(year FROM o_orderdate) AS INTEGER) AS season,
       CASE WHEN o_orderpriority LIKE '1%' THEN 'P' ELSE 'R' END AS game_type,
       CASE WHEN ver = 2 OR o_orderstatus = 'F' THEN 'Final'
            WHEN o_orderstatus = 'O' THEN 'Scheduled' ELSE 'In Progress' END AS status,
       CAST(o_custkey % 30 AS INTEGER) AS home_team_id,
       CAST((o_custkey % 30 + 1 + o_orderkey % 29) % 30 AS INTEGER) AS away_team_id,
       'Team ' || CAST(o_custkey % 30 AS VARCHAR) AS home_team_name,
       'Team ' || CAST((o_custkey % 30 + 1 + o_orderkey % 29) % 30 AS VARCHAR) AS away_team_name,
       CASE WHEN ver = 2 OR o_orderstatus <> 'O'
            THEN CAST((7 * o_orderkey + 3 * o_custkey) % 13 AS INTEGER) END AS home_score,
       CASE WHEN ver = 2 OR o_orderstatus <> 'O'
            THEN CAST((5 * o_orderkey + 11 * o_custkey) % 13 AS INTEGER) END AS away_score,
       CAST(o_custkey % 30 + 100 AS INTEGER) AS venue_id,
       CASE WHEN o_orderkey % 3 = 0 THEN 'day' ELSE 'night' END AS day_night,
       CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_custkey % 100 AS INTEGER) END
           AS home_probable_pitcher_id,
       CASE WHEN o_orderkey % 11 <> 0 THEN CAST((3 * o_custkey + 1) % 100 AS INTEGER) END
           AS away_probable_pitcher_id,
       ver, CAST(o_orderdate AS DATE) + (ver - 1) AS ingested_on
FROM orders, (VALUES (1), (2)) AS v(ver)
WHERE ver = 1 OR o_orderkey % 4 = 0
"""

_TARGETS = """
       CASE WHEN status = 'Final' THEN home_score + away_score END AS total_runs,
       CASE WHEN status = 'Final' AND home_score <> away_score
            THEN home_score > away_score END AS home_win
"""
ORACLE["games_v"] = f"SELECT * EXCLUDE (ver, ingested_on), {_TARGETS} FROM versions_v WHERE ver = 1"
ORACLE["latest_v"] = f"""
SELECT *, {_TARGETS} FROM versions_v
QUALIFY row_number() OVER (PARTITION BY game_pk ORDER BY ingested_on DESC) = 1
"""

ORACLE["pitcher_v"] = """
SELECT game_pk, CASE WHEN sup % 2 = 0 THEN home_team_id ELSE away_team_id END AS team_id,
       CAST(sup AS INTEGER) AS pitcher_id,
       sup = min(sup) OVER (PARTITION BY game_pk, sup % 2) AS is_starter,
       (q % 22) // 3 + ((q % 22) % 3) / 3.0::DOUBLE AS innings_pitched,
       CAST(q % 7 AS INTEGER) AS earned_runs, CAST((q + c) % 12 AS INTEGER) AS strikeouts
FROM (SELECT l_orderkey AS ord, l_suppkey AS sup,
             CAST(sum(l_quantity) AS BIGINT) AS q, count(*) AS c
      FROM lineitem GROUP BY l_orderkey, l_suppkey) AS lines
JOIN games_v ON game_pk = ord
"""

ORACLE["transactions_v"] = """
SELECT event_id AS transaction_id,
       DATE '1995-01-01' + CAST((7 * event_id) % 2400 AS INTEGER) AS transaction_date,
       type_code, from_team_id, to_team_id,
       type_code IN ('IL10', 'IL60', 'IL15', 'SC', 'RA', 'DFA') AS affects_availability
FROM (SELECT event_id,
             CASE event_type WHEN 'error' THEN 'IL10' WHEN 'signup' THEN 'DFA'
                  WHEN 'purchase' THEN 'IL60' WHEN 'click' THEN 'TR' END AS type_code,
             CASE WHEN user_id % 5 <> 0 THEN CAST(user_id % 30 AS INTEGER) END AS from_team_id,
             CASE WHEN user_id % 10 <> 0 THEN CAST((user_id + 3) % 30 AS INTEGER) END
                 AS to_team_id
      FROM events) AS e
"""

ORACLE["predictions_v"] = """
SELECT o_orderkey AS game_pk, CAST(o_orderdate AS DATE) AS game_date,
       CASE WHEN n = 0 THEN p ELSE 1 - p END AS predicted_home_win_prob,
       (o_orderkey % 170) / 10.0::DOUBLE AS predicted_total_runs,
       'run-' || CAST(o_custkey % 2 AS VARCHAR) AS winner_model_run_id,
       'run-r' AS runs_model_run_id,
       o_orderdate + n * INTERVAL 1 HOUR AS predicted_at
FROM (SELECT *, ((37 * o_orderkey + o_custkey) % 1000) / 1000.0::DOUBLE AS p FROM orders) AS o,
     (VALUES (0), (1)) AS t(n)
WHERE n = 0 OR o_orderkey % 6 = 0
"""

ORACLE["quotes_v"] = """
SELECT o_orderkey AS game_pk, b AS book,
       CAST(sgn * (100 + (o_orderkey * (b + 3)) % 150) AS DOUBLE) AS price_home,
       CAST(-sgn * (100 + (o_orderkey * (b + 3)) % 150) AS DOUBLE) AS price_away,
       6 + (o_orderkey % 9) / 2.0::DOUBLE AS point
FROM (SELECT *, CASE WHEN o_custkey % 2 = 0 THEN -1 ELSE 1 END AS sgn FROM orders) AS o,
     (VALUES (0), (1), (2)) AS t(b)
WHERE o_orderkey % 8 <> 0
"""

ORACLE["market_v"] = """
SELECT game_pk, avg(h / (h + a)) AS market_home_win_prob, avg(a / (h + a)) AS market_away_win_prob,
       avg(point) AS market_total_line, count(*) AS n_books_moneyline, count(*) AS n_books_totals
FROM (SELECT game_pk, point,
             CASE WHEN price_home < 0 THEN -price_home / (-price_home + 100)
                  ELSE 100 / (price_home + 100) END AS h,
             CASE WHEN price_away < 0 THEN -price_away / (-price_away + 100)
                  ELSE 100 / (price_away + 100) END AS a
      FROM quotes_v) AS q
GROUP BY game_pk
"""

ORACLE["rolling_v"] = """
SELECT game_pk, team_id,
       avg(scored) OVER last10 AS runs_scored_l10, avg(allowed) OVER last10 AS runs_allowed_l10,
       avg(won) OVER last10 AS win_pct_l10, count(scored) OVER last10 AS n_prior_games,
       CAST(date_diff('day', lag(game_date) OVER (PARTITION BY team_id ORDER BY game_date, game_pk),
                      game_date) AS INTEGER) AS days_rest
FROM (SELECT game_pk, game_date, unnest([home_team_id, away_team_id]) AS team_id,
             unnest([total_runs - away_score, total_runs - home_score]) AS scored,
             unnest([total_runs - home_score, total_runs - away_score]) AS allowed,
             unnest([CAST(home_win AS INTEGER), 1 - CAST(home_win AS INTEGER)]) AS won
      FROM games_v) AS s
WINDOW last10 AS (PARTITION BY team_id ORDER BY game_date, game_pk
                  ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)
"""

ORACLE["form_v"] = """
SELECT game_pk, pitcher_id, game_date,
       9.0::DOUBLE * sum(earned_runs) OVER last5 / nullif(sum(innings_pitched) OVER last5, 0)
           AS era_l5,
       9.0::DOUBLE * sum(strikeouts) OVER last5 / nullif(sum(innings_pitched) OVER last5, 0)
           AS k_per_9_l5,
       CAST(game_date - lag(game_date) OVER (PARTITION BY pitcher_id ORDER BY game_date, game_pk)
            AS INTEGER) AS days_rest,
       count(*) OVER last5 AS n_prior_starts
FROM pitcher_v NATURAL JOIN (SELECT game_pk, game_date FROM games_v) AS d
WHERE is_starter
WINDOW last5 AS (PARTITION BY pitcher_id ORDER BY game_date, game_pk
                 ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)
"""

ORACLE["bullpen_v"] = """
SELECT game_pk, team_id,
       9.0::DOUBLE * sum(er) OVER form / nullif(sum(ip) OVER form, 0) AS bullpen_era_l10,
       sum(ip) OVER (PARTITION BY team_id ORDER BY game_date, game_pk
                     ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS bullpen_ip_l3,
       count(ip) OVER form AS bullpen_prior_games
FROM (SELECT t.game_pk, t.team_id, t.game_date,
             sum(p.innings_pitched) FILTER (WHERE t.status = 'Final') AS ip,
             sum(p.earned_runs) FILTER (WHERE t.status = 'Final') AS er
      FROM (SELECT game_pk, game_date, status, unnest([home_team_id, away_team_id]) AS team_id
            FROM games_v) AS t
      LEFT JOIN pitcher_v AS p
             ON p.game_pk = t.game_pk AND p.team_id = t.team_id AND NOT p.is_starter
      GROUP BY ALL) AS b
WINDOW form AS (PARTITION BY team_id ORDER BY game_date, game_pk
                ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)
"""

ORACLE["parks_v"] = """
SELECT game_pk, venue_id, game_date, v AS venue_avg_runs, l AS league_avg_runs,
       v / nullif(l, 0) AS venue_park_factor_runs, n AS n_prior_venue_games
FROM (SELECT *, avg(total_runs) OVER at_venue AS v, count(*) OVER at_venue AS n,
             avg(total_runs) OVER (ORDER BY game_date, game_pk
                                   ROWS BETWEEN 82 PRECEDING AND 1 PRECEDING) AS l
      FROM games_v WHERE total_runs IS NOT NULL
      WINDOW at_venue AS (PARTITION BY venue_id ORDER BY game_date, game_pk
                          ROWS BETWEEN 82 PRECEDING AND 1 PRECEDING)) AS w
"""

ORACLE["roster_v"] = """
SELECT d.team_id, d.game_date,
       sum(coalesce(m.n, 0)) OVER (PARTITION BY d.team_id ORDER BY d.game_date
           RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) AS il_events_l30
FROM (SELECT home_team_id AS team_id, game_date FROM games_v
      UNION SELECT away_team_id, game_date FROM games_v) AS d
LEFT JOIN (SELECT coalesce(from_team_id, to_team_id) AS team_id, transaction_date, count(*) AS n
           FROM transactions_v WHERE affects_availability GROUP BY ALL) AS m
       ON m.team_id = d.team_id AND m.transaction_date = d.game_date
"""

# ASOF needs a right side that is unique per key and date: the highest game key counts.
ORACLE["form_daily_v"] = """
SELECT pitcher_id, game_date, era_l5, k_per_9_l5, days_rest FROM form_v
QUALIFY row_number() OVER (PARTITION BY pitcher_id, game_date ORDER BY game_pk DESC) = 1
"""
ORACLE["parks_daily_v"] = """
SELECT venue_id, game_date, venue_park_factor_runs FROM parks_v
QUALIFY row_number() OVER (PARTITION BY venue_id, game_date ORDER BY game_pk DESC) = 1
"""

# What a match knows of each of its sides, and where it comes from.
_SIDE_FEATURES = {
    "runs_scored_l10": "rolling", "runs_allowed_l10": "rolling", "win_pct_l10": "rolling", "days_rest": "rolling",
    "sp_era_l5": "form.era_l5", "sp_k_per_9_l5": "form.k_per_9_l5", "sp_days_rest": "form.days_rest",
    "bullpen_era_l10": "bullpen", "bullpen_ip_l3": "bullpen", "il_events_l30": "moves",
}


def _pivoted() -> str:
    """One column for each side and feature, from rows of one side."""
    return ", ".join(
        f"any_value({source if '.' in source else f'{source}.{name}'}) FILTER (side = '{side}') AS {side}_{name}"
        for side in ("home", "away")
        for name, source in _SIDE_FEATURES.items()
    )


# Rows of one side each, then the newest state up to the day by arg_max, then a pivot.
ORACLE["features_v"] = f"""
WITH sides AS (
    SELECT game_pk, game_date, 'home' AS side, home_team_id AS team_id, home_probable_pitcher_id AS starter FROM games_v
    UNION ALL
    SELECT game_pk, game_date, 'away', away_team_id, away_probable_pitcher_id FROM games_v),
forms AS (
    SELECT s.game_pk, s.side, arg_max(f, f.game_date) AS form
    FROM sides AS s JOIN form_daily_v AS f ON s.starter = f.pitcher_id AND f.game_date <= s.game_date GROUP BY ALL),
parks AS (
    SELECT m.game_pk, arg_max({{'factor': v.venue_park_factor_runs}}, v.game_date) AS park
    FROM games_v AS m JOIN parks_daily_v AS v ON m.venue_id = v.venue_id AND v.game_date <= m.game_date GROUP BY ALL),
moves AS (SELECT team_id, game_date, CAST(il_events_l30 AS BIGINT) AS il_events_l30 FROM roster_v),
folded AS (
    SELECT game_pk, {_pivoted()}
    FROM sides
    LEFT JOIN rolling_v AS rolling USING (game_pk, team_id)
    LEFT JOIN bullpen_v AS bullpen USING (game_pk, team_id)
    LEFT JOIN moves USING (team_id, game_date)
    LEFT JOIN forms USING (game_pk, side)
    GROUP BY game_pk)
SELECT folded.*, game_date, season, home_team_id, away_team_id, venue_id,
    parks.park.factor AS venue_park_factor_runs, day_night = 'day' AS is_day_game,
    CAST(month(game_date) AS INTEGER) AS month, game_type AS season_type,
    home_win AS target_home_win, total_runs AS target_total_runs
FROM games_v JOIN folded USING (game_pk) LEFT JOIN parks USING (game_pk)
"""

ORACLE["outcomes_v"] = """
SELECT p.*, CAST(g.home_win AS INTEGER) AS actual_home_win, g.total_runs AS actual_total_runs,
       CASE WHEN p.predicted_home_win_prob >= 0.5 THEN g.home_win ELSE NOT g.home_win END
           AS winner_correct,
       -ln(CASE WHEN g.home_win THEN greatest(1e-15, least(1 - 1e-15::DOUBLE, p.predicted_home_win_prob))
                ELSE 1 - greatest(1e-15, least(1 - 1e-15::DOUBLE, p.predicted_home_win_prob)) END) AS winner_log_loss,
       (p.predicted_home_win_prob - CAST(g.home_win AS INTEGER)) ** 2 AS winner_brier,
       abs(p.predicted_total_runs - g.total_runs) AS runs_abs_error,
       (p.predicted_total_runs - g.total_runs) ** 2 AS runs_squared_error,
       m.market_home_win_prob, m.market_total_line,
       (m.market_home_win_prob - CAST(g.home_win AS INTEGER)) ** 2 AS market_winner_brier,
       abs(m.market_total_line - g.total_runs) AS market_runs_abs_error
FROM (SELECT * FROM predictions_v
      QUALIFY row_number() OVER (PARTITION BY game_pk, winner_model_run_id
                                 ORDER BY predicted_at DESC) = 1) AS p
JOIN games_v AS g ON g.game_pk = p.game_pk AND g.status = 'Final' AND g.home_win IS NOT NULL
LEFT JOIN market_v AS m ON m.game_pk = p.game_pk
"""

ORACLE["split_v"] = """
SELECT *, CASE WHEN season IN (1995, 1996, 1997, 1998) THEN 'train' WHEN season = 1999 THEN 'val'
               WHEN season IN (2000, 2001) THEN 'test' END AS split
FROM features_v WHERE target_home_win IS NOT NULL AND season BETWEEN 1995 AND 2001
"""

ORACLE["split_games_v"] = """
SELECT g.game_pk, g.home_win AS target_home_win, g.total_runs AS target_total_runs,
       p.predicted_home_win_prob, p.predicted_total_runs,
       CASE WHEN g.season <= 1998 THEN 'train' WHEN g.season = 1999 THEN 'val' ELSE 'test' END
           AS split
FROM games_v AS g
JOIN (SELECT * FROM predictions_v QUALIFY row_number() OVER (PARTITION BY game_pk
                                                ORDER BY predicted_at DESC) = 1) AS p
  ON p.game_pk = g.game_pk
WHERE g.home_win IS NOT NULL AND g.season BETWEEN 1995 AND 2001
"""

ORACLE["team_stats_v"] = """
SELECT game_pk, unnest([home_team_id, away_team_id]) AS team_id FROM games_v
WHERE game_pk % 50 <> 0
UNION ALL
SELECT game_pk, unnest([home_team_id, away_team_id]) FROM games_v
WHERE game_pk % 60 = 1 AND game_pk % 50 <> 0
"""

ORACLE["runs_v"] = """
SELECT 'run-' || CAST(o_orderkey AS VARCHAR) AS run_id,
       CASE o_custkey % 2 WHEN 0 THEN 'winner' ELSE 'runs' END AS experiment,
       'family-' || CAST(o_custkey % 5 AS VARCHAR) AS model_family, o_orderdate AS start_time,
       0.5::DOUBLE + ((37 * o_orderkey + 11 * o_custkey) % 5000) / 10000.0::DOUBLE AS metric,
       o_orderkey % 9 <> 0 AS validated,
       o_orderkey % 4 = 0 AND o_custkey % 5 <> 4 AS promoted
FROM orders
"""

ORACLE["history_v"] = """
SELECT o.*, g.home_team_name, g.away_team_name, g.home_score, g.away_score, g.status
FROM outcomes_v AS o JOIN games_v AS g ON g.game_pk = o.game_pk
"""

_NEEDS = {
    "versions_v": [],
    "games_v": ["versions_v"],
    "latest_v": ["versions_v"],
    "pitcher_v": ["games_v"],
    "transactions_v": [],
    "predictions_v": [],
    "quotes_v": [],
    "market_v": ["quotes_v"],
    "rolling_v": ["games_v"],
    "form_v": ["pitcher_v", "games_v"],
    "bullpen_v": ["pitcher_v", "games_v"],
    "parks_v": ["games_v"],
    "roster_v": ["games_v", "transactions_v"],
    "form_daily_v": ["form_v"],
    "parks_daily_v": ["parks_v"],
    "features_v": ["games_v", "rolling_v", "bullpen_v", "roster_v", "form_daily_v", "parks_daily_v"],
    "outcomes_v": ["predictions_v", "games_v", "market_v"],
    "split_v": ["features_v"],
    "split_games_v": ["games_v", "predictions_v"],
    "team_stats_v": ["games_v"],
    "runs_v": [],
    "history_v": ["outcomes_v", "games_v"],
}


def oracle(sql: str, *tables: str) -> str:
    """`sql` with the named tables, and what they need, defined in front of it."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in _NEEDS[name]:
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for table in tables:
        visit(table)
    if not ordered:
        return sql
    definitions = ",\n".join(f"{name} AS MATERIALIZED ({ORACLE[name]})" for name in ordered)
    return f"WITH {definitions}\n{sql}"
