"""Leak-free features of every match, built from the typed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.operators.asof import asof_join
from matchlake.operators.sides import fold_sides, unpivot_sides
from matchlake.operators.trailing import PLAIN, Frames, Strategy, trailing

FINAL = "Final"

# Window lengths of the published feature names.
TEAM_GAMES = 10
PITCHER_STARTS = 5
BULLPEN_FORM_GAMES = 10
BULLPEN_FATIGUE_GAMES = 3
PARK_GAMES = 82
ROSTER_DAYS = 30

# Model inputs, in the order the models see them.
FEATURES = [
    "home_runs_scored_l10", "home_runs_allowed_l10", "home_win_pct_l10", "home_days_rest",
    "away_runs_scored_l10", "away_runs_allowed_l10", "away_win_pct_l10", "away_days_rest",
    "home_sp_era_l5", "home_sp_k_per_9_l5", "home_sp_days_rest",
    "away_sp_era_l5", "away_sp_k_per_9_l5", "away_sp_days_rest",
    "home_bullpen_era_l10", "home_bullpen_ip_l3", "away_bullpen_era_l10", "away_bullpen_ip_l3",
    "home_il_events_l30", "away_il_events_l30",
    "venue_park_factor_runs", "is_day_game", "month",
]
# What the matches of a team and of its relief pitchers say about it.
TEAM_FORM = [
    "runs_scored_l10", "runs_allowed_l10", "win_pct_l10", "days_rest", "bullpen_era_l10", "bullpen_ip_l3",
]
WINNER_TARGET = "target_home_win"
RUNS_TARGET = "target_total_runs"


def days_since_previous(date: str, ordered) -> Column:
    return F.datediff(F.col(date), F.lag(date).over(ordered))


def per_nine(amount: str, innings: str, frame) -> Column:
    """Amount per nine innings over a frame; NULL when no inning was pitched in it."""
    pitched = F.nullif(F.sum(innings).over(frame), F.lit(0.0))
    return F.sum(amount).over(frame) * F.lit(9.0) / pitched


def team_games(games: DataFrame, guard_status: bool = True, starters: bool = False) -> DataFrame:
    """Each match from both teams' point of view; only Final matches carry results.

    With `starters` also whether the team is at home, and its probable pitcher.
    """

    def result(name: str) -> Column:
        return F.when(F.col("status") == FINAL, F.col(name)) if guard_status else F.col(name)

    home = {
        "team_id": F.col("home_team_id"),
        "runs_scored": result("home_score"),
        "runs_allowed": result("away_score"),
        "won": result("home_win"),
    }
    away = {
        "team_id": F.col("away_team_id"),
        "runs_scored": result("away_score"),
        "runs_allowed": result("home_score"),
        "won": ~result("home_win"),
    }
    if starters:
        home |= {"is_home": F.lit(True), "probable_id": F.col("home_probable_pitcher_id")}
        away |= {"is_home": F.lit(False), "probable_id": F.col("away_probable_pitcher_id")}
    return unpivot_sides(games, ["game_pk", "game_date", "status"], home, away)


def _team_measures(frames: Frames) -> dict[str, Column]:
    recent = frames.last(TEAM_GAMES)
    return {
        "runs_scored_l10": F.avg("runs_scored").over(recent),
        "runs_allowed_l10": F.avg("runs_allowed").over(recent),
        "win_pct_l10": F.avg(F.col("won").cast("int")).over(recent),
        "n_prior_games": F.count("runs_scored").over(recent),
        "days_rest": days_since_previous("game_date", frames.ordered),
    }


def team_rolling(games: DataFrame, guard_status: bool = True, strategy: Strategy = PLAIN) -> DataFrame:
    """Runs scored and allowed, win share and rest of each team going into each match.

    Frames count rows: a match that is not Final takes a slot and adds nothing.
    """
    rolled = trailing(
        team_games(games, guard_status),
        ["team_id"],
        ["game_date", "game_pk"],
        TEAM_GAMES,
        _team_measures,
        strategy,
    )
    return rolled.select(
        "game_pk", "team_id", "runs_scored_l10", "runs_allowed_l10", "win_pct_l10",
        "n_prior_games", "days_rest",
    )


def pitcher_form(games: DataFrame, pitchers: DataFrame, strategy: Strategy = PLAIN) -> DataFrame:
    """Earned runs and strikeouts per nine innings over a starter's previous starts."""

    def measures(frames: Frames) -> dict[str, Column]:
        recent = frames.last(PITCHER_STARTS)
        return {
            "era_l5": per_nine("earned_runs", "innings_pitched", recent),
            "k_per_9_l5": per_nine("strikeouts", "innings_pitched", recent),
            "days_rest": days_since_previous("game_date", frames.ordered),
            "n_prior_starts": F.count(F.lit(1)).over(recent),
        }

    starts = (
        pitchers.filter("is_starter")
        .select("game_pk", "pitcher_id", "innings_pitched", "earned_runs", "strikeouts")
        .join(games.select("game_pk", "game_date"), "game_pk")
    )
    rolled = trailing(
        starts, ["pitcher_id"], ["game_date", "game_pk"], PITCHER_STARTS, measures, strategy
    )
    return rolled.select(
        "game_pk", "pitcher_id", "game_date", "era_l5", "k_per_9_l5", "days_rest", "n_prior_starts"
    )


def with_relief(sides: DataFrame, pitchers: DataFrame) -> DataFrame:
    """Append innings and earned runs of each team's relief pitchers, of Final matches only."""
    relief = (
        pitchers.filter(~F.col("is_starter"))
        .groupBy("game_pk", "team_id")
        .agg(F.sum("innings_pitched").alias("ip"), F.sum("earned_runs").alias("er"))
    )
    played = F.col("status") == FINAL
    return sides.join(relief, ["game_pk", "team_id"], "left").withColumns(
        {"ip": F.when(played, F.col("ip")), "er": F.when(played, F.col("er"))}
    )


def _bullpen_measures(frames: Frames) -> dict[str, Column]:
    form = frames.last(BULLPEN_FORM_GAMES)
    return {
        "bullpen_era_l10": per_nine("er", "ip", form),
        "bullpen_ip_l3": F.sum("ip").over(frames.last(BULLPEN_FATIGUE_GAMES)),
        "bullpen_prior_games": F.count("ip").over(form),
    }


def bullpen_form(games: DataFrame, pitchers: DataFrame, strategy: Strategy = PLAIN) -> DataFrame:
    """Relief earned-run rate and recent relief workload of each team."""
    sides = unpivot_sides(
        games,
        ["game_pk", "game_date", "status"],
        {"team_id": F.col("home_team_id")},
        {"team_id": F.col("away_team_id")},
    )
    rolled = trailing(
        with_relief(sides, pitchers).drop("status"),
        ["team_id"],
        ["game_date", "game_pk"],
        BULLPEN_FORM_GAMES,
        _bullpen_measures,
        strategy,
    )
    return rolled.select(
        "game_pk", "team_id", "bullpen_era_l10", "bullpen_ip_l3", "bullpen_prior_games"
    )


def park_factors(games: DataFrame, strategy: Strategy = PLAIN) -> DataFrame:
    """Run scoring at a venue relative to the league, from earlier Final matches only."""
    played = games.filter((F.col("status") == FINAL) & F.col("total_runs").isNotNull()).select(
        "game_pk", "game_date", "venue_id", "total_runs"
    )
    order = ["game_date", "game_pk"]

    def at_venue(frames: Frames) -> dict[str, Column]:
        recent = frames.last(PARK_GAMES)
        return {
            "venue_avg_runs": F.avg("total_runs").over(recent),
            "n_prior_venue_games": F.count(F.lit(1)).over(recent),
        }

    def in_league(frames: Frames) -> dict[str, Column]:
        return {"league_avg_runs": F.avg("total_runs").over(frames.last(PARK_GAMES))}

    league = trailing(played, [], order, PARK_GAMES, in_league, strategy)
    both = trailing(league, ["venue_id"], order, PARK_GAMES, at_venue, strategy)
    factor = F.col("venue_avg_runs") / F.nullif(F.col("league_avg_runs"), F.lit(0.0))
    return both.select(
        "game_pk", "venue_id", "game_date", "venue_avg_runs", "league_avg_runs",
        factor.alias("venue_park_factor_runs"), "n_prior_venue_games",
    )


def roster_activity(games: DataFrame, transactions: DataFrame) -> DataFrame:
    """Availability moves of each team in the 30 days before each of its match days.

    Both inputs shrink to one row per team and day before the window, so a team's
    group is bounded by the calendar. Moves on days without a match are not counted.
    """
    days = unpivot_sides(
        games,
        ["game_date"],
        {"team_id": F.col("home_team_id")},
        {"team_id": F.col("away_team_id")},
    ).distinct()
    moves = (
        transactions.filter("affects_availability")
        .groupBy(
            F.coalesce("from_team_id", "to_team_id").alias("team_id"),
            F.col("transaction_date").alias("game_date"),
        )
        .agg(F.count(F.lit(1)).alias("moves"))
        .filter(F.col("team_id").isNotNull())
    )
    before = (
        Window.partitionBy("team_id").orderBy(F.unix_date("game_date")).rangeBetween(-ROSTER_DAYS, -1)
    )
    return days.join(moves, ["team_id", "game_date"], "left").select(
        "team_id",
        "game_date",
        F.sum(F.coalesce("moves", F.lit(0))).over(before).alias("il_events_l30"),
    )


def assemble_features(
    games: DataFrame,
    rolling: DataFrame,
    form: DataFrame,
    bullpen: DataFrame,
    roster: DataFrame,
    parks: DataFrame,
) -> DataFrame:
    """One row per match with all model inputs and targets.

    The lookups run on team-side rows, so each feature table is joined once for
    both sides; one aggregation on the match key then folds the sides together.
    """
    sides = unpivot_sides(
        games,
        ["game_pk", "game_date"],
        {
            "is_home": F.lit(True),
            "team_id": F.col("home_team_id"),
            "probable_id": F.col("home_probable_pitcher_id"),
        },
        {
            "is_home": F.lit(False),
            "team_id": F.col("away_team_id"),
            "probable_id": F.col("away_probable_pitcher_id"),
        },
    )
    sides = (
        sides.join(rolling.drop("n_prior_games"), ["game_pk", "team_id"], "left")
        .join(bullpen.drop("bullpen_prior_games"), ["game_pk", "team_id"], "left")
    )
    return _assembled(games, sides, form, roster, parks)


def assemble_sides(
    games: DataFrame, formed: DataFrame, form: DataFrame, roster: DataFrame, parks: DataFrame
) -> DataFrame:
    """The same from rows of `side_form`, where nothing has to be joined back.

    What is known of a pitcher or a venue on a day is stored, so that Spark knows its size before it plans the joins.
    """
    return _assembled(games, _known_sides(formed), form, roster, parks, stored=True)


def _assembled(
    games: DataFrame, sides: DataFrame, form: DataFrame, roster: DataFrame, parks: DataFrame, stored: bool = False
) -> DataFrame:
    """One row per match from team-side rows that know the team's and its relief pitchers' form."""
    sides = asof_join(
        sides, form, "probable_id", "pitcher_id", "game_date", "game_date",
        {"era_l5": "sp_era_l5", "k_per_9_l5": "sp_k_per_9_l5", "days_rest": "sp_days_rest"},
        tiebreak="game_pk", stored=stored,
    ).join(roster, ["team_id", "game_date"], "left")
    matches = asof_join(
        games, parks, "venue_id", "venue_id", "game_date", "game_date",
        {"venue_park_factor_runs": "venue_park_factor_runs"}, tiebreak="game_pk", stored=stored,
    )
    known = [
        "runs_scored_l10", "runs_allowed_l10", "win_pct_l10", "days_rest", "sp_era_l5", "sp_k_per_9_l5", "sp_days_rest",
        "bullpen_era_l10", "bullpen_ip_l3", "il_events_l30",
    ]
    if stored:  # read twice, they are joined side by side, which is cheaper than to group them
        for side, rows in (("home", sides.filter("is_home")), ("away", sides.filter("NOT is_home"))):
            rows = rows.select("game_pk", *[F.col(c).alias(f"{side}_{c}") for c in known])
            matches = matches.join(rows, "game_pk", "left")
    else:
        matches = matches.join(fold_sides(sides, "game_pk", "is_home", known), "game_pk", "left")
    return (
        matches
        .withColumns(
            {
                "is_day_game": F.col("day_night") == "day",
                "month": F.month("game_date"),
                "season_type": F.col("game_type"),
                WINNER_TARGET: F.col("home_win"),
                RUNS_TARGET: F.col("total_runs"),
            }
        )
        .select(
            "game_pk", "game_date", "season", "home_team_id", "away_team_id", "venue_id",
            *FEATURES, "season_type", WINNER_TARGET, RUNS_TARGET,
        )
    )


def side_form(games: DataFrame, pitchers: DataFrame, strategy: Strategy = PLAIN) -> DataFrame:
    """Each match from both teams' point of view, with the form of the team and of its relief pitchers.

    Both are frames over the same rows in the same order, so one pass gives them.
    """

    def measures(frames: Frames) -> dict[str, Column]:
        return {**_team_measures(frames), **_bullpen_measures(frames)}

    rolled = trailing(
        with_relief(team_games(games, starters=True), pitchers), ["team_id"], ["game_date", "game_pk"],
        max(TEAM_GAMES, BULLPEN_FORM_GAMES), measures, strategy,
    )
    return rolled.select(
        "game_pk", "game_date", "is_home", "team_id", "probable_id", *TEAM_FORM, "n_prior_games", "bullpen_prior_games"
    )


def _known_sides(formed: DataFrame) -> DataFrame:
    """Sides with their form; a side without a team has none."""
    return formed.select(
        "game_pk", "game_date", "is_home", "team_id", "probable_id",
        *[F.when(F.col("team_id").isNotNull(), F.col(c)).alias(c) for c in TEAM_FORM],
    )


def build_features(
    games: DataFrame, pitchers: DataFrame, transactions: DataFrame, strategy: Strategy = PLAIN
) -> DataFrame:
    """The feature table in one lazy plan, without storing the intermediates.

    The rows of the form of teams and of their relief pitchers are the sides of the matches, so nothing is joined back.
    Of starts only those of probable pitchers are looked at.
    """
    probable = team_games(games, starters=True).select(F.col("probable_id").alias("pitcher_id")).distinct()
    return _assembled(
        games,
        _known_sides(side_form(games, pitchers, strategy)),
        pitcher_form(games, pitchers.join(probable, "pitcher_id", "left_semi"), strategy),
        roster_activity(games, transactions),
        park_factors(games, strategy),
    )
