"""What the lake stores, read back: queries that write the driver's tables as lake tables first."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.harness import tables as t
from matchlake.harness.tables import oracle
from matchlake.plans import incremental, quality, registry, silver
from matchlake.plans.daily import runs_path
from matchlake.schemas import RUNS
from matchlake.session import ensure_checkpoint_dir
from matchlake.sources.lake import Lake, append, read_or_empty, replace_partitions, write_csv


def _lake(spark: SparkSession) -> Lake:
    ensure_checkpoint_dir(spark)
    return Lake(spark, f"{spark.sparkContext.getCheckpointDir()}/lake-{uuid.uuid4().hex}")


def _by_year(df: DataFrame, column: str) -> DataFrame:
    """Rows with the year of a day as their partition."""
    return df.withColumn("date", F.year(column).cast("string"))


def partitions_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches by year; then two years are written again with finished matches only, and nothing else."""
    lake, games = _lake(spark), _by_year(t.games(spark, sf_dir), "game_date")
    path = lake.path("silver", "by_year")
    replace_partitions(games, path)
    again = games.filter("status = 'Final' AND date IN ('1996', '1997')")
    for df in (again, again, games.limit(0)):
        replace_partitions(df, path)
    stored = spark.read.schema(games.schema).parquet(path)
    return stored.groupBy("date").agg(F.count("*").alias("n"), F.sum("game_pk").alias("keys"))


def bronze_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed tables as views, joined in SQL; a table that was never stored gets no view."""
    lake = _lake(spark)
    schedule = _by_year(t.landed_schedule(spark, sf_dir), "game_date")
    moves = _by_year(t.landed_transactions(spark, sf_dir), "date")
    replace_partitions(schedule, lake.path("bronze", "schedule"))
    replace_partitions(moves, lake.path("bronze", "transactions"))
    prefix = f"landed_{uuid.uuid4().hex[:8]}_"
    assert lake.register_views("bronze", prefix) == [f"{prefix}schedule", f"{prefix}transactions"]
    return spark.sql(f"""
        SELECT date, landings, moves
        FROM (SELECT date, count(*) AS landings FROM {prefix}schedule GROUP BY date)
        LEFT JOIN (SELECT date, count(*) AS moves FROM {prefix}transactions GROUP BY date) USING (date)
    """)


def inner_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose own date column differs from the folder they lie in, read by either."""
    lake = _lake(spark)
    rows = t.landed_transactions(spark, sf_dir).withColumn("date", F.col("date").cast("string"))
    rows.select("transaction_id", "payload", "ingested_at", "date").write.parquet(
        f"{lake.path('bronze', 'transactions')}/date=1900-01-01"
    )
    inner, outer = lake.bronze("transactions", inner_date=True), lake.bronze("transactions")
    inner = inner.groupBy("date").count().select("date", F.lit("inner").alias("read_by"), F.col("count").alias("n"))
    outer = outer.groupBy("date").count().select("date", F.lit("folder").alias("read_by"), F.col("count").alias("n"))
    return inner.unionByName(outer)


def rebuilt_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed match table stored in part, rebuilt whole, and asked through a view and a fresh read."""
    lake, games = _lake(spark), silver.games(t.landed_schedule(spark, sf_dir))
    lake.store(games.filter("status = 'Final'"), "silver", "games")
    stored = lake.store(games, "silver", "games")
    prefix = f"typed_{uuid.uuid4().hex[:8]}_"
    lake.register_views("silver", prefix)
    viewed = spark.sql(f"SELECT status, count(*) AS viewed FROM {prefix}games GROUP BY status")
    counted = stored.groupBy("status").agg(F.count("*").alias("stored"), F.sum("total_runs").alias("runs"))
    read = lake.silver("games").groupBy("status").agg(F.max("game_pk").alias("last_key"))
    return viewed.join(counted, "status").join(read, "status")


def appended_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality report of two runs, the second one over finished matches only."""
    lake = _lake(spark)
    path = lake.path("silver", "_quality")
    games = t.games(spark, sf_dir)
    for ran_at, checked in (("2024-01-01", games), ("2024-01-02", games.filter("status = 'Final'"))):
        report = quality.quality_report(checked, t.team_stats(spark, sf_dir), t.pitchers(spark, sf_dir))
        append(report.withColumn("ran_at", F.lit(ran_at).cast("timestamp")), path)
    rows = lake.silver("_quality").filter("name = 'games.pk_unique'")
    return rows.select("name", "passed", "details", F.col("ran_at").cast("date").alias("ran_on"))


def csv_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _lake(spark)
    rows = t.games(spark, sf_dir).select("game_pk", "game_date", "home_team_name", "home_score", "home_win")
    path = lake.path("gold", "games_csv")
    write_csv(rows.limit(1), path)
    write_csv(rows, path)
    return spark.read.option("header", True).schema(rows.schema).csv(path)


def prediction_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All prediction partitions as one table, and one of them alone, of which only the folder is read."""
    lake = _lake(spark)
    rows = _by_year(t.predictions(spark, sf_dir), "game_date").withColumn("game_date", F.col("game_date").cast("string"))
    replace_partitions(rows, lake.path("gold", "predictions"))
    every, one = lake.gold("predictions"), lake.gold("predictions").filter("date = '1997'")
    assert "PartitionFilters: [isnotnull(date" in one._jdf.queryExecution().executedPlan().toString()
    every = every.groupBy("date").agg(F.count("*").alias("n"), F.sum("game_pk").alias("keys"))
    one = one.groupBy("date").agg(F.count("*").alias("n"), F.sum("game_pk").alias("keys"))
    return every.withColumn("part_of", F.lit("all")).unionByName(one.withColumn("part_of", F.lit("one")))


def absent_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches with the park factors of a table that does not exist yet: a typed empty one."""
    factors = _lake(spark).gold("park_factors").select("game_pk", "venue_park_factor_runs")
    return t.games(spark, sf_dir).select("game_pk").join(factors, "game_pk", "left")


def appended_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run registry filled by several appends: its size and the run to serve for each family."""
    lake, runs = _lake(spark), t.model_runs(spark, sf_dir)
    read_or_empty(spark, runs_path(lake), RUNS)
    for experiment in ("winner", "runs"):
        registry.append_run(runs.filter(F.col("experiment") == experiment), runs_path(lake))
    stored = read_or_empty(spark, runs_path(lake), RUNS)
    served = registry.serving_runs(stored).select("experiment", "model_family", "run_id")
    return served.join(stored.groupBy("experiment", "model_family").agg(F.count("*").alias("runs")),
                       ["experiment", "model_family"])


def refreshed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Team form and park factors after the two last months were landed again, with new matches and results.

    The refresh has to do with those months and the tails of the time before; a whole rebuild would be an error here.
    """
    lake = _lake(spark)
    landed = t.landed_schedule(spark, sf_dir).withColumn("date", F.substring("game_date", 1, 7))
    month, path = F.col("date"), lake.path("bronze", "schedule")
    last = [row[0] for row in landed.select("date").distinct().orderBy(F.desc("date")).limit(2).collect()]
    first_landing = F.col("ingested_at") == F.col("game_date").cast("timestamp")
    known = (month == last[1]) & (F.substring("game_date", 9, 2) <= "10") & first_landing
    replace_partitions(landed.filter((month < last[1]) | known), path)
    incremental.refresh(lake, last[1:])
    replace_partitions(landed.filter(month >= last[1]), path)
    if incremental.refresh(lake, last) is None:
        raise AssertionError("everything was rebuilt")
    sides = [f"{side}_{name}" for side in ("home", "away") for name in REFRESHED]
    features = lake.gold("features").select("game_pk", "game_date", *sides, "venue_park_factor_runs", "target_home_win")
    return features.select(*[
        F.round(F.round(c, 9), 6).alias(c) if kind == "double" else F.col(c) for c, kind in features.dtypes
    ])


REFRESHED = ["runs_scored_l10", "runs_allowed_l10", "win_pct_l10", "days_rest"]


def _refreshed_oracle() -> str:
    """The same features from the newest version of every match."""
    rolled = ", ".join(
        f"{side}.{name} AS {side}_{name}" if name == "days_rest" else f"round(round({side}.{name}, 9), 6) AS {side}_{name}"
        for side in ("home", "away") for name in REFRESHED
    )
    sql = oracle(
        f"""
        SELECT g.game_pk, g.game_date, {rolled},
            (SELECT round(round(arg_max({{'f': p.venue_park_factor_runs}}, p.game_date).f, 9), 6) FROM parks_daily_v p
             WHERE p.venue_id = g.venue_id AND p.game_date <= g.game_date) AS venue_park_factor_runs,
            g.home_win AS target_home_win
        FROM games_v g
        JOIN rolling_v home ON home.game_pk = g.game_pk AND home.team_id = g.home_team_id
        JOIN rolling_v away ON away.game_pk = g.game_pk AND away.team_id = g.away_team_id
        """,
        "rolling_v",
        "parks_daily_v",
    )
    return sql.replace(t.ORACLE["games_v"], f"SELECT * EXCLUDE (ver, ingested_on) FROM ({t.ORACLE['latest_v']})")


def queries() -> dict:
    return {
        "refreshed_days": refreshed_days,
        "partitions_replaced": partitions_replaced,
        "bronze_views": bronze_views,
        "inner_dates": inner_dates,
        "rebuilt_table": rebuilt_table,
        "appended_report": appended_report,
        "csv_back": csv_back,
        "prediction_partitions": prediction_partitions,
        "absent_table": absent_table,
        "appended_runs": appended_runs,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "refreshed_days": _refreshed_oracle(),
        "partitions_replaced": oracle(
            """
            SELECT CAST(year(game_date) AS VARCHAR) AS date, count(*) AS n, CAST(sum(game_pk) AS BIGINT) AS keys
            FROM games_v WHERE status = 'Final' OR year(game_date) NOT IN (1996, 1997) GROUP BY ALL
            """,
            "games_v",
        ),
        "bronze_views": oracle(
            """
            SELECT date, landings, moves
            FROM (SELECT CAST(year(game_date) AS VARCHAR) AS date, count(*) AS landings FROM versions_v GROUP BY ALL)
            LEFT JOIN (SELECT CAST(year(transaction_date) AS VARCHAR) AS date,
                           sum(CASE WHEN transaction_id % 5 = 0 THEN 2 ELSE 1 END)::BIGINT AS moves
                       FROM transactions_v GROUP BY ALL) USING (date)
            """,
            "versions_v",
            "transactions_v",
        ),
        "inner_dates": oracle(
            """
            SELECT CAST(transaction_date AS VARCHAR) AS date, 'inner' AS read_by, count(*) AS n
            FROM moves GROUP BY ALL
            UNION ALL SELECT '1900-01-01', 'folder', count(*) FROM moves
            """,
            "transactions_v",
        ).replace("FROM moves", "FROM (SELECT unnest([transaction_date, CASE WHEN transaction_id % 5 = 0"
                  " THEN transaction_date END]) AS transaction_date FROM transactions_v) WHERE transaction_date IS NOT NULL"),
        "rebuilt_table": oracle(
            """
            SELECT status, count(*) AS viewed, count(*) AS stored, CAST(sum(total_runs) AS BIGINT) AS runs,
                max(game_pk) AS last_key
            FROM latest_v GROUP BY status
            """,
            "latest_v",
        ),
        "appended_report": oracle(
            """
            SELECT 'games.pk_unique' AS name, true AS passed,
                '0 duplicate game_pk rows out of ' || count(*) FILTER (final OR NOT only_final) AS details, ran_on
            FROM (SELECT status = 'Final' AS final FROM games_v),
                (VALUES (false, DATE '2024-01-01'), (true, DATE '2024-01-02')) AS r(only_final, ran_on)
            GROUP BY ran_on
            """,
            "games_v",
        ),
        "csv_back": oracle(
            "SELECT game_pk, game_date, home_team_name, home_score, home_win FROM games_v", "games_v"
        ),
        "prediction_partitions": oracle(
            """
            SELECT CAST(year(game_date) AS VARCHAR) AS date, count(*) AS n, CAST(sum(game_pk) AS BIGINT) AS keys,
                unnest(CASE WHEN year(game_date) = 1997 THEN ['all', 'one'] ELSE ['all'] END) AS part_of
            FROM predictions_v GROUP BY year(game_date)
            """,
            "predictions_v",
        ),
        "absent_table": "SELECT o_orderkey AS game_pk, CAST(NULL AS DOUBLE) AS venue_park_factor_runs FROM orders",
        "appended_runs": oracle(
            """
            SELECT experiment, model_family, run_id, runs
            FROM (SELECT *, count(*) OVER f AS runs, row_number() OVER (f ORDER BY promoted DESC, start_time DESC, run_id DESC) AS place
                  FROM runs_v WINDOW f AS (PARTITION BY experiment, model_family)) WHERE place = 1
            """,
            "runs_v",
        ),
    }
