"""Every operator as a query over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.functions.innings import innings_to_number
from matchlake.functions.odds import EVENT_TYPE, with_consensus
from matchlake.harness import round_trips
from matchlake.harness import tables as t
from matchlake.operators.asof import asof_join
from matchlake.operators.latest import latest_wins
from matchlake.operators.quantiles import exact_medians
from matchlake.operators.trailing import Frames, Strategy, trailing
from matchlake.plans import (
    attribution,
    gold,
    grading,
    market,
    panels,
    quality,
    registry,
    silver,
    splits,
    training,
)
from matchlake.session import materialise
from matchlake.sources import landing, lake

Query = Callable[[SparkSession, str], DataFrame]

NOISE_DIGITS, DIGITS = 9, 6
# Small blocks, so that the block layout is exercised on small tables too.
BLOCKS = Strategy("blocks", block_rows=5_000)


def rounded(df: DataFrame) -> DataFrame:
    """Doubles rounded, so that summation order does not show.

    The first rounding removes it, so that the second one meets the same ties everywhere.
    """
    return df.select(
        *[
            F.round(F.round(c, NOISE_DIGITS), DIGITS).alias(c) if kind == "double" else F.col(c)
            for c, kind in df.dtypes
        ]
    )


def team_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(gold.team_rolling(t.games(spark, sf_dir)))


def team_rolling_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(gold.team_rolling(t.games(spark, sf_dir), strategy=BLOCKS))


def pitcher_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(gold.pitcher_form(t.games(spark, sf_dir), t.pitchers(spark, sf_dir)))


def bullpen_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(gold.bullpen_form(t.games(spark, sf_dir), t.pitchers(spark, sf_dir)))


def park_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(gold.park_factors(t.games(spark, sf_dir)))


def park_factors_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(gold.park_factors(t.games(spark, sf_dir), BLOCKS))


def roster_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.roster_activity(t.games(spark, sf_dir), t.transactions(spark, sf_dir))


def asof_pitcher_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    games = t.games(spark, sf_dir)
    joined = asof_join(
        games, gold.pitcher_form(games, t.pitchers(spark, sf_dir)),
        "home_probable_pitcher_id", "pitcher_id", "game_date", "game_date",
        {"era_l5": "era_l5", "days_rest": "days_rest"}, tiebreak="game_pk",
    )
    return rounded(joined.select("game_pk", "era_l5", "days_rest"))


def asof_park_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    games = t.games(spark, sf_dir)
    joined = asof_join(
        games, gold.park_factors(games), "venue_id", "venue_id", "game_date", "game_date",
        {"venue_park_factor_runs": "venue_park_factor_runs"}, tiebreak="game_pk",
    )
    return rounded(joined.select("game_pk", "venue_park_factor_runs"))


def features_assembled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(t.features(spark, sf_dir))


def latest_wins_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = latest_wins(t.game_versions(spark, sf_dir), ["game_pk"], "ingested_on")
    return newest.select("game_pk", "version", "status", "home_score", "away_score", "ingested_on")


def game_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.latest_games(spark, sf_dir).select("game_pk", "status", "total_runs", "home_win")


def home_away_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.team_games(t.games(spark, sf_dir))


def team_rolling_unguarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = gold.team_rolling(t.games(spark, sf_dir), guard_status=False)
    return rounded(rolled.drop("days_rest"))


# --- landing -----------------------------------------------------------------


def json_extract_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.from_json("props", "struct<k:string,absent:string>")
    return t.read(spark, sf_dir, "events").select(
        "event_id",
        F.get_json_object("props", "$.k").alias("k_text"),
        props["k"].cast("int").alias("k"),
        props["absent"].alias("absent"),
    )


def landed_schedule_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = landing.split_rejects(t.schedule_documents(spark, sf_dir))
    return landing.schedule_games(good).select(
        F.get_json_object("payload", "$.gamePk").cast("long").alias("game_pk"),
        F.get_json_object("payload", "$.gameType").alias("game_type"),
        "block_date",
    )


def landed_list_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = landing.transaction_items(t.transaction_documents(spark, sf_dir))
    events = landing.odds_events(t.odds_documents(spark, sf_dir))
    return items.select(
        F.lit("transaction").alias("source"), F.get_json_object("payload", "$.id").alias("id"), "date"
    ).unionByName(
        events.select(
            F.lit("odds").alias("source"), F.get_json_object("payload", "$.id").alias("id"), "date"
        )
    )


def envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = landing.split_rejects(t.schedule_documents(spark, sf_dir))
    rows = landing.schedule_envelope(good, F.lit("2024-01-01 00:00:00"))
    return rows.select(
        "game_pk", "game_date", "date", F.get_json_object("payload", "$.gameType").alias("game_type"),
        F.col("ingested_at").cast("string").alias("ingested_at"),
    )


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, bad = landing.split_rejects(t.schedule_documents(spark, sf_dir))
    return bad.select("name", "date")


def landed_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = t.read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("game_pk"), "l_linenumber", "l_suppkey"
    )
    return landing.for_scheduled(landed, t.games(spark, sf_dir).filter("status = 'Final'"))


def season_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.game_days(t.games(spark, sf_dir).filter("game_type = 'P'"))


def resume_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    games = t.games(spark, sf_dir)
    return landing.pending_days(landing.game_days(games), games.filter("game_type = 'P'"))


def reingest_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = t.games(spark, sf_dir).select("game_date").distinct()
    return days.select(
        "game_date", F.explode(landing.reingest_days(F.col("game_date"))).alias("reingest_date")
    )


def season_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches per season of an inclusive range, seasons without matches included."""
    played = t.games(spark, sf_dir).groupBy("season").agg(F.count(F.lit(1)).alias("n"))
    wanted = landing.seasons_between(spark, 1996, 2003)
    return wanted.join(played, "season", "left")


# --- typed tables ------------------------------------------------------------


def silver_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.games(t.landed_schedule(spark, sf_dir)).drop("ingested_at")


def silver_team_game_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.team_game_stats(t.landed_boxscores(spark, sf_dir)).drop("ingested_at")


def pitcher_map_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(silver.pitcher_game_stats(t.landed_boxscores(spark, sf_dir)).drop("ingested_at"))


def silver_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.transactions(t.landed_transactions(spark, sf_dir)).drop("ingested_at")


def latest_wins_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = latest_wins(
        t.predictions(spark, sf_dir), ["game_pk", "winner_model_run_id"], "predicted_at"
    )
    return rounded(newest.select("game_pk", "winner_model_run_id", "predicted_home_win_prob"))


def _hot_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by customer group; one group holds about a third of them."""
    return t.read(spark, sf_dir, "orders").select(
        F.when(F.col("o_custkey") % 3 == 0, F.lit(0)).otherwise(F.col("o_custkey")).alias("bucket"),
        F.to_date("o_orderdate").alias("day"),
        "o_orderkey",
        "o_orderstatus",
    )


def latest_wins_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = latest_wins(_hot_orders(spark, sf_dir), ["bucket"], "day", ["o_orderkey"])
    return newest.select("bucket", "o_orderkey")


def trailing_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trailing sums and previous keys with the hot group cut into blocks."""

    def measures(frames: Frames):
        last = frames.last(20)
        return {
            "key_sum": F.sum("o_orderkey").over(last),
            "n": F.count(F.lit(1)).over(last),
            "previous": F.lag("o_orderkey").over(frames.ordered),
        }

    rolled = trailing(
        _hot_orders(spark, sf_dir), ["bucket"], ["day", "o_orderkey"], 20, measures, BLOCKS
    )
    return rolled.select("o_orderkey", "bucket", "key_sum", "n", "previous")


def asof_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each order the newest finished order of its group up to its day."""
    orders = _hot_orders(spark, sf_dir)
    finished = orders.filter("o_orderstatus = 'F'").withColumnRenamed("o_orderkey", "found")
    joined = asof_join(
        orders, finished, "bucket", "bucket", "day", "day", {"found": "found"}, tiebreak="found"
    )
    return joined.select("o_orderkey", "found")


def innings_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = t.read(spark, sf_dir, "lineitem")
    text = F.expr(
        """CASE CAST(l_quantity AS INT) % 5
           WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN CAST(l_linenumber AS STRING)
           ELSE concat(CAST(l_linenumber - 1 AS STRING), '.', CAST(l_suppkey % 3 AS STRING)) END"""
    )
    parsed = lines.select("l_linenumber", "l_suppkey", text.alias("ip"))
    counted = parsed.groupBy("ip").agg(F.count(F.lit(1)).alias("n"))
    return rounded(counted.select("ip", "n", innings_to_number("ip").alias("innings")))


# --- market ------------------------------------------------------------------


def odds_devig(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(t.market(spark, sf_dir))


def odds_json_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = t.landed_odds(spark, sf_dir).withColumn("e", F.from_json("payload", EVENT_TYPE))
    summed = with_consensus(
        events, F.col("e.bookmakers"), F.col("e.home_team"), F.col("e.away_team")
    )
    return rounded(
        summed.select(F.col("e.id").cast("long").alias("game_pk"), *market.MARKET_COLUMNS)
    )


def odds_to_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = market.odds(t.landed_odds(spark, sf_dir), t.games(spark, sf_dir))
    return rounded(
        typed.select(
            "odds_event_id", "odds_date", "home_team", "away_team", "market_home_win_prob",
            "market_total_line", "n_books_moneyline", "game_pk",
        )
    )


# --- grading and read queries ------------------------------------------------


def outcomes_graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    graded = grading.grade_predictions(t.predictions(spark, sf_dir), t.games(spark, sf_dir))
    return rounded(
        graded.select(
            "game_pk", "winner_model_run_id", "predicted_home_win_prob", "actual_home_win",
            "actual_total_runs", "winner_correct", "winner_log_loss", "winner_brier",
            "runs_abs_error", "runs_squared_error",
        )
    )


def outcomes_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(
        t.outcomes(spark, sf_dir).select(
            "game_pk", "market_home_win_prob", "market_total_line", "market_winner_brier",
            "market_runs_abs_error",
        )
    )


def rolling_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(panels.rolling_performance(t.outcomes(spark, sf_dir), 365))


def baseline_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(panels.baseline_comparison(t.outcomes(spark, sf_dir)))


def baseline_comparison_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = panels.baseline_comparison(t.outcomes(spark, sf_dir))
    return rounded(panels.comparison_long(compared, "baseline"))


def market_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(panels.market_comparison(t.outcomes(spark, sf_dir)))


def market_comparison_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = panels.market_comparison(t.outcomes(spark, sf_dir))
    return rounded(panels.comparison_long(compared, "market"))


def confidence_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(panels.confidence_tiers(t.outcomes(spark, sf_dir)))


def calibration_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(panels.calibration_bins(t.outcomes(spark, sf_dir)))


def daily_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(panels.daily_trend(t.outcomes(spark, sf_dir)))


def trend_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(panels.trend_long(panels.daily_trend(t.outcomes(spark, sf_dir))))


def runs_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.runs_scatter(t.outcomes(spark, sf_dir))


def _newest_day(games: DataFrame):
    return games.agg(F.max("game_date")).scalar()


def games_for_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    games = t.games(spark, sf_dir)
    shown = panels.games_on(games, t.predictions(spark, sf_dir), _newest_day(games))
    return rounded(
        shown.select(
            "game_pk", "game_date", "home_team_name", "away_team_name", "status",
            "predicted_home_win_prob", "predicted_total_runs",
        )
    )


def game_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A card for every match with its freshest prediction."""
    freshest = latest_wins(t.predictions(spark, sf_dir), ["game_pk"], "predicted_at")
    named = t.games(spark, sf_dir).withColumns(
        {
            f"{side}_probable_pitcher_name": F.concat(
                F.lit("Pitcher "), F.col(f"{side}_probable_pitcher_id").cast("string")
            )
            for side in ("home", "away")
        }
    )
    scored = named.join(
        freshest.select("game_pk", "predicted_home_win_prob", "predicted_total_runs"), "game_pk", "left"
    )
    return panels.game_cards(scored)


def history_explorer(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = panels.history(t.outcomes(spark, sf_dir), t.games(spark, sf_dir))
    chosen = panels.explore_history(
        history,
        F.lit("1996-03-01").cast("date"),
        F.lit("2000-09-30").cast("date"),
        ["Team 3", "Team 12", "Team 21"],
    )
    return panels.history_rows(chosen)


def history_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panels.history_teams(panels.history(t.outcomes(spark, sf_dir), t.games(spark, sf_dir)))


def history_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = panels.history(t.outcomes(spark, sf_dir), t.games(spark, sf_dir))
    return rounded(
        history.dropna(subset=["market_home_win_prob"])
        .withColumnsRenamed({"actual_home_win": "home_won", "actual_total_runs": "runs"})
        .select("game_pk", "game_date", "home_team_name", "home_won", "runs", "market_home_win_prob")
    )


def feature_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Match rows for the keys of returned order lines."""
    wanted = t.read(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select("l_orderkey")
    return panels.by_keys(t.games(spark, sf_dir), "game_pk", wanted).select(
        "game_pk", "game_date", "status"
    )


def json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    games = t.games(spark, sf_dir).select(
        "game_pk", "game_date", "home_team_name", "home_score", "home_win"
    )
    return lake.json_records(games)


def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.table_counts(
        {
            "games": t.games(spark, sf_dir),
            "transactions": t.transactions(spark, sf_dir),
            "predictions": t.predictions(spark, sf_dir),
        }
    )


# --- quality -----------------------------------------------------------------


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(
        t.games(spark, sf_dir), t.team_stats(spark, sf_dir), t.pitchers(spark, sf_dir)
    )


def declared_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {"game_pk": ["unique", "not_null"], "home_score": ["not_null"]}
    return quality.declared_checks(t.game_versions(spark, sf_dir), "games", rules)


# --- models ------------------------------------------------------------------


def classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(splits.classification_metrics(t.split_games(spark, sf_dir), "split"))


def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(splits.regression_metrics(t.split_games(spark, sf_dir), "split"))


def baselines_winner(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = t.split_games(spark, sf_dir)
    constants = splits.with_baselines(split)
    return rounded(
        splits.model_comparison(
            {
                "baseline": splits.classification_metrics(constants, "split"),
                "predictions": splits.classification_metrics(split, "split"),
            }
        )
    )


def baselines_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = t.split_games(spark, sf_dir)
    constants = splits.with_baselines(split)
    return rounded(
        splits.model_comparison(
            {
                "baseline": splits.regression_metrics(constants, "split"),
                "predictions": splits.regression_metrics(split, "split"),
            }
        )
    )


def metric_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = splits.regression_metrics(t.split_games(spark, sf_dir), "split")
    return rounded(splits.metric_entries(metrics, ["n", "mae", "rmse", "within_1", "within_2"]))


def metric_prefix_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(registry.metrics_long(t.model_runs(spark, sf_dir)))


def promotion_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    replayed = registry.replay_gate(t.model_runs(spark, sf_dir), "val_log_loss")
    return rounded(replayed.drop("start_time"))


def promotion_gate_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = t.model_runs(spark, sf_dir)
    replayed = registry.replay_gate(runs, "val_log_loss", strategy=BLOCKS)
    return rounded(replayed.drop("start_time"))


def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.serving_runs(t.model_runs(spark, sf_dir)).select(
        "experiment", "model_family", "run_id"
    )


def _medians(spark: SparkSession, sf_dir: str, **limits: int) -> DataFrame:
    train = t.split_features(spark, sf_dir).filter("split = 'train'")
    numbers = train.select(*[F.col(c).cast("double").alias(c) for c in NUMERIC_FEATURES])
    medians = exact_medians(materialise(numbers), NUMERIC_FEATURES, **limits)
    return rounded(spark.createDataFrame(list(medians.items()), "feature string, median double"))


# All model inputs but the boolean one.
NUMERIC_FEATURES = [c for c in gold.FEATURES if c != "is_day_game"]


def impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _medians(spark, sf_dir)


def impute_median_narrowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The medians by narrowing brackets, as on tables too large for one buffer."""
    return _medians(spark, sf_dir, rest_rows=100)


def standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = materialise(t.split_features(spark, sf_dir))
    prepared = training.fit_preparation(split.filter("split = 'train'"), NUMERIC_FEATURES)
    return rounded(
        split.select("game_pk", *[prepared.scaled(c).alias(c) for c in prepared.features])
    )


def linear_attribution_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top contributions of a linear model whose i-th coefficient is (i + 1) / 10."""
    split = materialise(t.split_features(spark, sf_dir))
    prepared = training.fit_preparation(split.filter("split = 'train'"), NUMERIC_FEATURES)
    weights = {c: (i + 1) / 10 for i, c in enumerate(prepared.features)}
    parts = attribution.linear_contributions(split, weights, {c: prepared.scaled(c) for c in weights})
    return rounded(attribution.top_contributions(parts, list(weights), ["game_pk"], n=5))


@dataclass(frozen=True)
class _FixedWeights:
    """A linear model whose i-th coefficient is (i + 1) / 10."""

    coefficients: list[float]


def attribution_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top contributions, with their lines of text, for the matches of returned order lines."""
    split = materialise(t.split_features(spark, sf_dir))
    prepared = training.fit_preparation(split.filter("split = 'train'"), NUMERIC_FEATURES)
    weights = [(i + 1) / 10 for i in range(len(prepared.features))]
    fitted = training.Fitted(_FixedWeights(weights), prepared, True)
    wanted = t.read(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select("l_orderkey")
    return rounded(attribution.explain_keys(split, wanted, fitted).select("game_pk", "rank", "feature", "line"))


def _gradients(spark: SparkSession, split: DataFrame, fitted: training.Fitted, target: str, penalty: float, digits: int):
    """The slope of the training objective at the fitted model, by feature: zero where it is least."""
    train = split.filter("split = 'train'")
    names, weights = fitted.prepared.features, list(map(float, fitted.model.coefficients))
    error = F.col("_score") - F.col(target).cast("int")
    slopes = [F.avg(error * fitted.prepared.scaled(c)).alias(c) for c in names]
    row = fitted.score(train, "_score").agg(F.avg(error).alias("intercept"), F.count("*").alias("n"), *slopes).first()
    rows = [
        (name, abs(round(row[name] + penalty / row["n"] * weight, digits)), row["n"], weight != 0.0)
        for name, weight in zip([*names, "intercept"], [*weights, 0.0])
    ]
    return spark.createDataFrame(rows, "feature string, gradient double, n long, used boolean")


def logistic_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = materialise(t.split_features(spark, sf_dir))
    fitted = training.fit_logistic(split)
    return _gradients(spark, split, fitted, gold.WINNER_TARGET, 1.0 / training.LOGISTIC["C"], 4)


def ridge_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = materialise(t.split_features(spark, sf_dir))
    fitted = training.fit_ridge(split)
    return _gradients(spark, split, fitted, gold.RUNS_TARGET, training.RIDGE["alpha"], 6)


# The boosted models of the last tables that were asked for: some thousand nodes, which all queries on these tables share.
_boosted: dict[tuple[str, str], tuple[training.Fitted, training.Fitted]] = {}


def _trees(spark: SparkSession, sf_dir: str, split: DataFrame) -> tuple[training.Fitted, training.Fitted]:
    """The winner and the total-runs trees at their real settings."""
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _boosted:
        _boosted.clear()
        _boosted[key] = training.fit_winner_trees(split), training.fit_runs_trees(split)
    return _boosted[key]


def gbt_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What both boosted models say of every labelled match."""
    split = materialise(t.split_features(spark, sf_dir))
    winner, runs = _trees(spark, sf_dir, split)
    scored = runs.score(winner.score(split, "predicted_home_win_prob"), "predicted_total_runs")
    return rounded(scored.select("game_pk", "split", "predicted_home_win_prob", "predicted_total_runs"))


def fit_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every model fitted on the training seasons and evaluated on all splits, a row for each metric."""
    split = materialise(t.split_features(spark, sf_dir))
    boosted, based = _trees(spark, sf_dir, split), splits.with_baselines(split)
    p, runs = "predicted_home_win_prob", "predicted_total_runs"
    winner_models = {
        "baseline": based, "logistic_regression": training.fit_logistic(split).score(split, p),
        "boosted_trees": boosted[0].score(split, p),
    }
    runs_models = {
        "baseline": based, "ridge_regression": training.fit_ridge(split).score(split, runs),
        "boosted_trees": boosted[1].score(split, runs),
    }
    return rounded(splits.evaluated(winner_models, runs_models))


def importance_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The features of both boosted models by importance: the mean gain of their splits, as a share."""
    split = materialise(t.split_features(spark, sf_dir))
    named = zip(("winner", "runs"), _trees(spark, sf_dir, split))
    tables = [
        training.feature_importance(spark, fitted).select(F.lit(name).alias("model"), "feature", "importance")
        for name, fitted in named
    ]
    return rounded(tables[0].unionByName(tables[1]))


def tree_contributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five features that moved the chance of each labelled match most, by the boosted winner model."""
    split = materialise(t.split_features(spark, sf_dir))
    winner, _ = _trees(spark, sf_dir, split)
    return rounded(attribution.explain_rows(split, winner, ["game_pk"], 5))


def gbt_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of both boosted models for every match of the newest day, and whether they are in range."""
    features = materialise(t.features(spark, sf_dir))
    split = splits.split_by_season(features, t.TRAIN_SEASONS, t.VAL_SEASONS, t.TEST_SEASONS)
    winner, runs = _trees(spark, sf_dir, split)
    predicted = training.predict_day(
        features,
        _newest_day(features),
        winner,
        runs,
        "winner-run",
        "runs-run",
        F.lit("2024-01-01 00:00:00"),
    )
    return predicted.select(
        "game_pk", "game_date", "winner_model_run_id", "runs_model_run_id",
        F.col("predicted_home_win_prob").between(0, 1).alias("probability_in_range"),
        F.col("predicted_total_runs").between(0, 24).alias("runs_in_range"),
    )


def importance_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of the features by importance, whether it falls, and its total."""
    split = materialise(t.split_features(spark, sf_dir))
    found = training.feature_importance(spark, _trees(spark, sf_dir, split)[1]).collect()  # a row for each feature
    values = [row["importance"] for row in found]
    rows = [
        (i + 1, not i or value <= values[i - 1], 0.0 <= value <= 1.0, round(sum(values), 6))
        for i, value in enumerate(values)
    ]
    return spark.createDataFrame(rows, "place int, falling boolean, in_range boolean, total double")


def attribution_tidy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every labelled match how far its contributions are from adding up to its log-odds, but for a constant."""
    split = materialise(t.split_features(spark, sf_dir))
    fitted, _ = _trees(spark, sf_dir, split)
    n = len(fitted.features)
    parts = materialise(attribution.explain_rows(split, fitted, ["game_pk"], n))
    summed = parts.groupBy("game_pk").agg(
        F.sum("contribution").alias("total"), F.count("*").alias("n"), F.max("rank").alias("last_rank"),
        F.array_sort(F.collect_list(F.struct("rank", F.col("abs_contribution").alias("size")))).alias("ranked"),
    )
    chance = F.col("p")
    odds = fitted.score(split, "p").select("game_pk", F.log(chance / (1 - chance)).alias("odds"))
    rows = materialise(summed.join(odds, "game_pk").withColumn("rest", F.col("odds") - F.col("total")))
    constant = rows.agg(F.avg("rest")).first()[0]
    falling = F.forall(F.slice("ranked", 2, n), lambda x: x["size"] <= F.get("ranked", x["rank"] - 2)["size"])
    return rows.select(
        "game_pk", "n", "last_rank", falling.alias("falling"),
        F.abs(F.round(F.col("rest") - F.lit(constant), 4)).alias("off"),
    )


def queries() -> dict[str, Query]:
    return {
        name: value
        for name, value in globals().items()
        if callable(value)
        and getattr(value, "__module__", None) == __name__
        and not name.startswith("_")
        and name not in ("rounded", "queries")
    } | round_trips.queries()
