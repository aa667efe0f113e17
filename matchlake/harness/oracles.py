"""SQL with the same result as the query of the same name."""

from __future__ import annotations

from matchlake.harness import round_trips
from matchlake.harness.tables import oracle
from matchlake.plans.gold import FEATURES

# Columns rounded like the query results.


def _round(columns: str) -> str:
    return ", ".join(f"round(round({c}, 9), 6) AS {c}" for c in columns.split())


_FEATURE_DOUBLES = (
    "home_runs_scored_l10 home_runs_allowed_l10 home_win_pct_l10 away_runs_scored_l10"
    " away_runs_allowed_l10 away_win_pct_l10 home_sp_era_l5 home_sp_k_per_9_l5 away_sp_era_l5"
    " away_sp_k_per_9_l5 home_bullpen_era_l10 home_bullpen_ip_l3 away_bullpen_era_l10"
    " away_bullpen_ip_l3 venue_park_factor_runs"
)


def _replace(columns: str) -> str:
    return f"* REPLACE ({_round(columns)})"


_ROLLING = f"SELECT {_replace('runs_scored_l10 runs_allowed_l10 win_pct_l10')} FROM rolling_v"
_PARKS = (
    f"SELECT {_replace('venue_avg_runs league_avg_runs venue_park_factor_runs')} FROM parks_v"
)


_HISTORY_PERCENT = "printf('%.1f', round(predicted_home_win_prob * 100, 1)) || '%'"

_NUMERIC = [
    "home_runs_scored_l10", "home_runs_allowed_l10", "home_win_pct_l10", "home_days_rest",
    "away_runs_scored_l10", "away_runs_allowed_l10", "away_win_pct_l10", "away_days_rest",
    "home_sp_era_l5", "home_sp_k_per_9_l5", "home_sp_days_rest", "away_sp_era_l5",
    "away_sp_k_per_9_l5", "away_sp_days_rest", "home_bullpen_era_l10", "home_bullpen_ip_l3",
    "away_bullpen_era_l10", "away_bullpen_ip_l3", "home_il_events_l30", "away_il_events_l30",
    "venue_park_factor_runs", "month",
]

_MEDIANS = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, round(round(median(CAST({c} AS DOUBLE)), 9), 6) AS median"
    " FROM split_v WHERE split = 'train'"
    for c in _NUMERIC
)

# Imputed with training medians, then centred and scaled with training moments.
_SCALED = """
(SELECT game_pk, feature, place,
        (x - avg(x) FILTER (WHERE split = 'train') OVER f)
        / stddev_pop(x) FILTER (WHERE split = 'train') OVER f AS z
 FROM (SELECT game_pk, split, feature, place,
              coalesce(v, median(v) FILTER (WHERE split = 'train') OVER (PARTITION BY feature)) AS x
       FROM (""" + "\nUNION ALL\n".join(
    f"SELECT game_pk, split, '{c}' AS feature, {i} AS place, CAST({c} AS DOUBLE) AS v FROM split_v"
    for i, c in enumerate(_NUMERIC)
) + """) AS l) AS m
 WINDOW f AS (PARTITION BY feature)) AS scaled
"""

_WINNER_METRICS = """
SELECT split, count(*) AS n, round(round(avg(CAST((p >= 0.5) = won AS INTEGER)), 9), 6) AS accuracy,
       round(round(avg(-ln(CASE WHEN won THEN clipped ELSE 1 - clipped END)), 9), 6)
           AS log_loss,
       round(round(avg((p - CAST(won AS INTEGER)) ** 2), 9), 6) AS brier
"""
_RUNS_METRICS = """
SELECT split, count(*) AS n, round(round(avg(abs(runs - p)), 9), 6) AS mae,
       round(round(sqrt(avg((runs - p) ** 2)), 9), 6) AS rmse,
       round(round(avg(CAST(abs(runs - p) <= 1 AS INTEGER)), 9), 6) AS within_1,
       round(round(avg(CAST(abs(runs - p) <= 2 AS INTEGER)), 9), 6) AS within_2
"""
_BY_PREDICTION = {
    "winner": "(SELECT split, target_home_win AS won, predicted_home_win_prob AS p,"
    " greatest(1e-15, least(1 - 1e-15::DOUBLE, predicted_home_win_prob)) AS clipped"
    " FROM split_games_v)",
    "runs": "(SELECT split, target_total_runs AS runs, predicted_total_runs AS p FROM split_games_v)",
}
_BY_MEAN = {
    "winner": "(SELECT split, target_home_win AS won, avg(CAST(target_home_win AS INTEGER))"
    " FILTER (WHERE split = 'train') OVER () AS p, p AS clipped FROM split_games_v)",
    "runs": "(SELECT split, target_total_runs AS runs, avg(target_total_runs)"
    " FILTER (WHERE split = 'train') OVER () AS p FROM split_games_v)",
}


def _both_models(select: str, task: str) -> str:
    return (
        f"{select}, 'baseline' AS model FROM {_BY_MEAN[task]} AS b GROUP BY split"
        f" UNION ALL {select}, 'predictions' FROM {_BY_PREDICTION[task]} AS m GROUP BY split"
    )


_BASELINE = """
SELECT metric, round(round(model, 9), 6) AS model, round(round(baseline, 9), 6) AS baseline
FROM (SELECT unnest(['Accuracy', 'Log loss', 'Brier', 'MAE (runs)', 'RMSE (runs)']) AS metric,
             unnest([avg(CAST(winner_correct AS INTEGER)), avg(winner_log_loss), avg(winner_brier),
                     avg(runs_abs_error), sqrt(avg(runs_squared_error))]) AS model,
             unnest([avg(CAST((p >= 0.5) = (actual_home_win = 1) AS INTEGER)),
                     avg(-ln(CASE actual_home_win WHEN 1 THEN p ELSE 1 - p END)),
                     avg((p - actual_home_win) ** 2), avg(abs(r - actual_total_runs)),
                     sqrt(avg((r - actual_total_runs) ** 2))]) AS baseline
      FROM (SELECT *, avg(actual_home_win) OVER () AS p, avg(actual_total_runs) OVER () AS r
            FROM outcomes_v) AS o) AS c
"""
_MARKET = """
SELECT metric, round(round(model, 9), 6) AS model, round(round(market, 9), 6) AS market
FROM (SELECT unnest(['Log loss', 'Brier', 'MAE (runs)']) AS metric,
             unnest([avg(winner_log_loss), avg(winner_brier), avg(runs_abs_error)]) AS model,
             unnest([avg(-ln(CASE actual_home_win WHEN 1 THEN market_home_win_prob
                             ELSE 1 - market_home_win_prob END)),
                     avg(market_winner_brier), avg(market_runs_abs_error)]) AS market
      FROM outcomes_v
      WHERE market_home_win_prob IS NOT NULL AND market_total_line IS NOT NULL) AS c
"""
_TREND = """
SELECT *, avg(a) OVER w AS ar, avg(l) OVER w AS lr
FROM (SELECT game_date, count(*) AS n, avg(CAST(winner_correct AS INTEGER)) AS a,
             avg(winner_log_loss) AS l, avg(runs_abs_error) AS m
      FROM outcomes_v GROUP BY game_date) AS d
WINDOW w AS (ORDER BY game_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
"""
_GATE = """
SELECT run_id, experiment, model_family, round(round(metric, 9), 6) AS value, round(round(best, 9), 6) AS incumbent,
       best IS NULL OR metric < best AS promoted
FROM (SELECT *, min(metric) OVER (PARTITION BY experiment, model_family
                                  ORDER BY start_time, run_id
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best
      FROM runs_v WHERE validated) AS r
"""


def _unpivoted(table: str, other: str) -> str:
    return (
        f"SELECT metric, 'model' AS source, model AS value FROM ({table}) AS a"
        f" UNION ALL SELECT metric, '{other}', {other} FROM ({table}) AS b"
    )


def _rows_check(name: str, rows: str, wrong: str, missing: str) -> str:
    return f"""
    SELECT '{name}' AS name, bad + none = 0 AS passed,
           format('{{}} Final games with {wrong}, {{}} Final games with {missing}', bad, none) AS details
    FROM (SELECT count(*) FILTER (WHERE n BETWEEN 1 AND 1 OR n > 2) AS bad,
                 count(*) FILTER (WHERE n = 0) AS none
          FROM (SELECT g.game_pk, count(r.game_pk) AS n
                FROM (SELECT game_pk FROM games_v WHERE status = 'Final') AS g
                LEFT JOIN {rows} AS r ON r.game_pk = g.game_pk GROUP BY g.game_pk) AS c) AS t
    """


def _unique_check(name: str, rows: str, keys: str, shown: str) -> str:
    return f"""
    SELECT '{name}' AS name, extra = 0 AS passed,
           format('{{}} duplicate {shown} rows out of {{}}', extra, n) AS details
    FROM (SELECT count(*) AS n, count(*) - count(DISTINCT ({keys})) AS extra FROM {rows}) AS t
    """


_QUALITY = " UNION ALL ".join(
    [
        _unique_check("games.pk_unique", "games_v", "game_pk", "game_pk"),
        """
        SELECT 'games.no_null_ids', a + b + c + d = 0,
               'nulls: {' || format('''game_pk'': {}, ''game_date'': {}, ''home_team_id'': {},'
                                    || ' ''away_team_id'': {}', a, b, c, d) || '}'
        FROM (SELECT count(*) - count(game_pk) AS a, count(*) - count(game_date) AS b,
                     count(*) - count(home_team_id) AS c, count(*) - count(away_team_id) AS d
              FROM games_v) AS t
        """,
        """
        SELECT 'games.final_has_scores', m = 0,
               format('{} missing scores among {} Final games', m, n)
        FROM (SELECT 2 * count(*) - count(home_score) - count(away_score) AS m, count(*) AS n
              FROM games_v WHERE status = 'Final') AS t
        """,
        """
        SELECT 'games.total_runs_consistent', w = 0,
               format('{} rows where total_runs != home_score + away_score', w)
        FROM (SELECT count(*) FILTER (WHERE total_runs IS DISTINCT FROM home_score + away_score)
                     AS w
              FROM games_v WHERE status = 'Final') AS t
        """,
        _unique_check(
            "team_stats.pk_unique", "team_stats_v", "game_pk, team_id", "(game_pk, team_id)"
        ),
        _rows_check(
            "team_stats.two_rows_per_final_game",
            "team_stats_v",
            "row-count != 2",
            "no team_game_stats rows at all",
        ),
        _unique_check(
            "pitcher_stats.pk_unique", "pitcher_v", "game_pk, pitcher_id", "(game_pk, pitcher_id)"
        ),
        _rows_check(
            "pitcher_stats.two_starters_per_final_game",
            "(SELECT game_pk FROM pitcher_v WHERE is_starter)",
            "!= 2 starters",
            "no starter rows at all",
        ),
    ]
)

_DECLARED = " UNION ALL ".join(
    [
        _unique_check("games.game_pk.unique", "versions_v", "game_pk", "game_pk"),
        """
        SELECT 'games.' || c || '.not_null', n = 0, 'nulls: {''' || c || ''': ' || n || '}'
        FROM (SELECT 'game_pk' AS c, count(*) - count(game_pk) AS n FROM versions_v
              UNION ALL SELECT 'home_score', count(*) - count(home_score) FROM versions_v) AS t
        """,
    ]
)

_PITCHER_IDS = """
SELECT *, sup = 0 AS starts_home, CAST(CASE sup WHEN 2 THEN away_team_id ELSE home_team_id END AS INTEGER)
              AS team_id,
       CAST(CASE sup WHEN 0 THEN 1000 + game_pk % 97 WHEN 1 THEN 1500 + game_pk % 97
            ELSE 3000 + game_pk % 89 END AS INTEGER) AS pid
FROM latest_v, (VALUES (0), (1), (2)) AS t(sup)
"""

_ODDS_EVENTS = """
SELECT g.game_pk, CAST(g.game_pk AS VARCHAR) AS odds_event_id, CAST(g.game_date AS VARCHAR) AS odds_date,
       g.home_team_name AS home_team,
       CASE WHEN g.game_pk % 7 = 0 THEN 'The ' ELSE '' END || g.away_team_name AS away_team,
       s.sgn, g.game_pk % 600 AS minute, g.game_pk % 16 <> 0 AS quoted
FROM games_v AS g
JOIN (SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 THEN -1 ELSE 1 END AS sgn FROM orders) AS s
  ON s.o_orderkey = g.game_pk
"""
_ODDS_SUMMARY = f"""
SELECT game_pk, odds_event_id, odds_date, home_team, away_team, minute,
       avg(h / (h + a)) AS home, avg(a / (h + a)) AS away,
       CASE WHEN quoted THEN 6 + (game_pk % 9) / 2.0::DOUBLE END AS line, count(h) AS books
FROM (SELECT *, CASE WHEN sgn * m < 0 THEN m / (m + 100) ELSE 100 / (m + 100) END AS h,
                CASE WHEN sgn * m > 0 THEN m / (m + 100) ELSE 100 / (m + 100) END AS a
      FROM (SELECT e.*, CASE WHEN quoted
                        THEN CAST(100 + (game_pk * (b + 3)) % 150 AS DOUBLE) END AS m
            FROM ({_ODDS_EVENTS}) AS e, (VALUES (0), (1), (2)) AS t(b)) AS q) AS p
GROUP BY ALL
"""


_HOT_ORDERS = """
(SELECT *, CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE o_custkey END AS bucket,
        CAST(o_orderdate AS DATE) AS day FROM orders) AS o
"""


# At the least of a convex objective each slope is zero.
_LEAST = f"""
SELECT unnest({[*FEATURES, "intercept"]}) AS feature, 0.0::DOUBLE AS gradient, n,
       unnest({[*["true"] * len(FEATURES), "false"]}::BOOLEAN[]) AS used
FROM (SELECT count(*) AS n FROM split_v WHERE split = 'train') AS c
"""


def oracle_sql() -> dict[str, str]:
    return {
        "team_rolling": oracle(_ROLLING, "rolling_v"),
        "team_rolling_blocks": oracle(_ROLLING, "rolling_v"),
        "pitcher_form": oracle(f"SELECT {_replace('era_l5 k_per_9_l5')} FROM form_v", "form_v"),
        "bullpen_form": oracle(
            f"SELECT {_replace('bullpen_era_l10 bullpen_ip_l3')} FROM bullpen_v", "bullpen_v"
        ),
        "park_factors": oracle(_PARKS, "parks_v"),
        "park_factors_blocks": oracle(_PARKS, "parks_v"),
        "roster_activity": oracle(
            "SELECT team_id, game_date, CAST(il_events_l30 AS BIGINT) AS il_events_l30"
            " FROM roster_v",
            "roster_v",
        ),
        "asof_pitcher_form": oracle(
            """
            SELECT g.game_pk, round(round(f.era_l5, 9), 6) AS era_l5, f.days_rest
            FROM games_v AS g ASOF LEFT JOIN form_daily_v AS f
              ON f.pitcher_id = g.home_probable_pitcher_id AND f.game_date <= g.game_date
            """,
            "games_v",
            "form_daily_v",
        ),
        "asof_park_factor": oracle(
            """
            SELECT g.game_pk, round(round(f.venue_park_factor_runs, 9), 6) AS venue_park_factor_runs
            FROM games_v AS g ASOF LEFT JOIN parks_daily_v AS f
              ON f.venue_id = g.venue_id AND f.game_date <= g.game_date
            """,
            "games_v",
            "parks_daily_v",
        ),
        "features_assembled": oracle(
            f"SELECT {_replace(_FEATURE_DOUBLES)} FROM features_v", "features_v"
        ),
        "latest_wins_games": oracle(
            "SELECT game_pk, ver AS version, status, home_score, away_score, ingested_on"
            " FROM latest_v",
            "latest_v",
        ),
        "game_targets": oracle("SELECT game_pk, status, total_runs, home_win FROM latest_v", "latest_v"),
        "home_away_unpivot": oracle(
            """
            SELECT game_pk, game_date, status, home_team_id AS team_id,
                   CASE status WHEN 'Final' THEN home_score END AS runs_scored,
                   CASE status WHEN 'Final' THEN away_score END AS runs_allowed, home_win AS won
            FROM games_v
            UNION ALL
            SELECT game_pk, game_date, status, away_team_id,
                   CASE status WHEN 'Final' THEN away_score END,
                   CASE status WHEN 'Final' THEN home_score END, NOT home_win
            FROM games_v
            """,
            "games_v",
        ),
        "team_rolling_unguarded": oracle(
            """
            SELECT game_pk, team_id, round(round(avg(f) OVER w, 9), 6) AS runs_scored_l10,
                   round(round(avg(a) OVER w, 9), 6) AS runs_allowed_l10, round(round(avg(won) OVER w, 9), 6) AS win_pct_l10,
                   count(f) OVER w AS n_prior_games
            FROM (SELECT game_pk, game_date, home_team_id AS team_id, home_score AS f, away_score AS a,
                         CAST(home_win AS INTEGER) AS won FROM games_v
                  UNION ALL
                  SELECT game_pk, game_date, away_team_id, away_score, home_score,
                         1 - CAST(home_win AS INTEGER) FROM games_v) AS s
            WINDOW w AS (PARTITION BY team_id ORDER BY game_date, game_pk
                         ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)
            """,
            "games_v",
        ),
        "json_extract_typed": """
            SELECT event_id, props ->> '$.k' AS k_text, CAST(props ->> '$.k' AS INTEGER) AS k,
                   props ->> '$.absent' AS absent
            FROM events
            """,
        "landed_schedule_flatten": """
            SELECT 2 * o_orderkey + k AS game_pk, o_orderpriority AS game_type,
                   strftime(o_orderdate, '%Y-%m-%d') AS block_date
            FROM orders, (VALUES (0), (1)) AS t(k) WHERE o_orderkey % 7 <> 0
            """,
        "landed_list_flatten": """
            SELECT 'transaction' AS source, CAST(s * event_id AS VARCHAR) AS id,
                   strftime(ts, '%Y-%m-%d') AS date
            FROM events, (VALUES (1), (-1)) AS t(s) WHERE s = 1 OR event_id % 3 <> 0
            UNION ALL
            SELECT 'odds', CAST(o_orderkey AS VARCHAR), strftime(o_orderdate, '%Y-%m-%d') FROM orders
            """,
        "envelope": """
            SELECT 2 * o_orderkey + k AS game_pk, strftime(o_orderdate, '%Y-%m-%d') AS game_date,
                   strftime(o_orderdate, '%Y-%m-%d') AS date, o_orderpriority AS game_type,
                   '2024-01-01 00:00:00' AS ingested_at
            FROM orders, (VALUES (0), (1)) AS t(k) WHERE o_orderkey % 7 <> 0
            """,
        "rejects": """
            SELECT CAST(o_orderkey AS VARCHAR) AS name, strftime(o_orderdate, '%Y-%m-%d') AS date
            FROM orders WHERE o_orderkey % 7 = 0
            """,
        "landed_semi": """
            SELECT l_orderkey AS game_pk, l_linenumber, l_suppkey FROM lineitem
            WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
            """,
        "season_dates": oracle(
            "SELECT DISTINCT game_date FROM games_v WHERE game_type = 'P'", "games_v"
        ),
        "resume_dates": oracle(
            """
            SELECT game_date FROM games_v
            EXCEPT SELECT game_date FROM games_v WHERE game_type = 'P'
            """,
            "games_v",
        ),
        "reingest_dates": oracle(
            """
            SELECT DISTINCT game_date, game_date - d AS reingest_date
            FROM games_v, (VALUES (0), (1), (2)) AS t(d)
            """,
            "games_v",
        ),
        "season_range": oracle(
            """
            SELECT CAST(s AS INTEGER) AS season, n
            FROM range(1996, 2004) AS r(s)
            LEFT JOIN (SELECT season, count(*) AS n FROM games_v GROUP BY season) AS g ON season = s
            """,
            "games_v",
        ),
        "silver_games": oracle(
            """
            SELECT game_pk, game_date, CAST(game_date AS TIMESTAMP) + INTERVAL '23:05' HOUR TO MINUTE
                       AS game_datetime_utc,
                   season, game_type, status, home_team_id, home_team_name, away_team_id,
                   away_team_name, home_score, away_score, total_runs, home_win, venue_id,
                   'Park ' || venue_id AS venue_name, day_night, home_probable_pitcher_id,
                   'Pitcher ' || home_probable_pitcher_id AS home_probable_pitcher_name,
                   away_probable_pitcher_id,
                   'Pitcher ' || away_probable_pitcher_id AS away_probable_pitcher_name
            FROM latest_v
            """.replace("INTERVAL '23:05' HOUR TO MINUTE", "INTERVAL '23 hours 5 minutes'"),
            "latest_v",
        ),
        "silver_team_game_stats": oracle(
            """
            SELECT game_pk, team_id, is_home, runs, CAST(game_pk % 14 AS INTEGER) AS hits,
                   CAST(27 + game_pk % 9 AS INTEGER) AS at_bats,
                   CAST(game_pk % 12 AS INTEGER) AS strikeouts, CAST(game_pk % 6 AS INTEGER) AS walks,
                   CAST(game_pk % 3 AS INTEGER) AS home_runs,
                   CAST(game_pk % 10 AS INTEGER) AS left_on_base,
                   CAST(game_pk % 2 AS INTEGER) AS errors
            FROM (SELECT game_pk, home_team_id AS team_id, true AS is_home, home_score AS runs
                  FROM latest_v
                  UNION ALL SELECT game_pk, away_team_id, false, away_score FROM latest_v) AS s
            """,
            "latest_v",
        ),
        "pitcher_map_flatten": oracle(
            f"""
            SELECT game_pk, team_id, pid AS pitcher_id, 'Pitcher ' || pid AS pitcher_name,
                   sup <> 1 AS is_starter,
                   round(round(pid % 7 + (game_pk % 3) / 3.0::DOUBLE, 9), 6) AS innings_pitched,
                   CAST((game_pk + pid) % 9 AS INTEGER) AS hits_allowed,
                   CAST(pid % 6 AS INTEGER) AS runs_allowed,
                   CAST((game_pk + ver) % 5 AS INTEGER) AS earned_runs,
                   CAST(game_pk % 4 AS INTEGER) AS walks,
                   CAST((game_pk + 2 * pid) % 11 AS INTEGER) AS strikeouts,
                   CAST(20 + game_pk % 80 AS INTEGER) AS pitches_thrown
            FROM ({_PITCHER_IDS}) AS p
            """,
            "latest_v",
        ),
        "silver_transactions": """
            SELECT event_id AS transaction_id,
                   DATE '1995-01-01' + CAST((7 * event_id) % 2400 AS INTEGER) AS transaction_date,
                   code AS type_code, event_type AS type_desc, '"quoted" é ' || event_type AS description,
                   CAST(user_id AS INTEGER) AS person_id, 'Player ' || user_id AS person_name,
                   CASE WHEN user_id % 5 <> 0 THEN team END AS from_team_id,
                   CASE WHEN user_id % 5 <> 0 THEN 'Team ' || team END AS from_team_name,
                   CASE WHEN user_id % 10 <> 0 THEN team END AS to_team_id,
                   CASE WHEN user_id % 10 <> 0 THEN 'Team ' || team END AS to_team_name,
                   code IN ('IL10', 'IL60', 'IL15', 'SC', 'RA', 'DFA') AS affects_availability
            FROM (SELECT *, CAST(user_id % 30 AS INTEGER) AS team,
                         CASE WHEN event_id % 5 = 0 THEN 'TR' WHEN event_type = 'error' THEN 'IL10'
                              WHEN event_type = 'signup' THEN 'DFA'
                              WHEN event_type = 'purchase' THEN 'IL60' END AS code
                  FROM events) AS e
            """,
        "latest_wins_sorted": oracle(
            """
            SELECT game_pk, winner_model_run_id,
                   round(round(arg_max(predicted_home_win_prob, predicted_at), 9), 6) AS predicted_home_win_prob
            FROM predictions_v GROUP BY game_pk, winner_model_run_id
            """,
            "predictions_v",
        ),
        "latest_wins_hot": f"""
            SELECT DISTINCT ON (bucket) bucket, o_orderkey FROM {_HOT_ORDERS}
            ORDER BY bucket, day DESC, o_orderkey DESC
            """,
        "trailing_hot": f"""
            SELECT o_orderkey, bucket, CAST(sum(o_orderkey) OVER w AS BIGINT) AS key_sum,
                   count(*) OVER w AS n,
                   lag(o_orderkey) OVER (PARTITION BY bucket ORDER BY day, o_orderkey) AS previous
            FROM {_HOT_ORDERS}
            WINDOW w AS (PARTITION BY bucket ORDER BY day, o_orderkey
                         ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)
            """,
        "asof_hot": f"""
            SELECT o.o_orderkey, f.found
            FROM {_HOT_ORDERS}
            ASOF LEFT JOIN (SELECT bucket, day, max(o_orderkey) AS found FROM {_HOT_ORDERS}
                            WHERE o_orderstatus = 'F' GROUP BY bucket, day) AS f
              ON f.bucket = o.bucket AND f.day <= o.day
            """,
        "innings_parse": """
            SELECT ip, count(*) AS n,
                   round(round(CASE WHEN ip = '' THEN NULL
                         ELSE CAST(regexp_extract(ip, '^[0-9]+') AS INTEGER)
                              + coalesce(TRY_CAST(regexp_extract(ip, '[.]([0-9])', 1) AS INTEGER), 0)
                                / 3.0::DOUBLE END, 9), 6) AS innings
            FROM (SELECT CASE CAST(l_quantity AS INTEGER) % 5
                         WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN CAST(l_linenumber AS VARCHAR)
                         ELSE (l_linenumber - 1) || '.' || (l_suppkey % 3) END AS ip
                  FROM lineitem) AS l
            GROUP BY ip
            """,
        "odds_devig": oracle(
            f"SELECT {_replace('market_home_win_prob market_away_win_prob market_total_line')}"
            " FROM market_v",
            "market_v",
        ),
        "odds_json_consensus": oracle(
            f"""
            SELECT game_pk, round(round(home, 9), 6) AS market_home_win_prob, round(round(away, 9), 6) AS market_away_win_prob,
                   line AS market_total_line, CAST(books AS INTEGER) AS n_books_moneyline,
                   CAST(books AS INTEGER) AS n_books_totals
            FROM ({_ODDS_SUMMARY}) AS s
            """,
            "games_v",
        ),
        "odds_to_games": oracle(
            f"""
            SELECT s.odds_event_id, s.odds_date, s.home_team, s.away_team,
                   round(round(s.home, 9), 6) AS market_home_win_prob, s.line AS market_total_line,
                   CAST(s.books AS INTEGER) AS n_books_moneyline, g.game_pk
            FROM (SELECT * FROM ({_ODDS_SUMMARY}) AS e
                  QUALIFY row_number() OVER (PARTITION BY odds_date, home_team, away_team
                                             ORDER BY minute DESC, odds_event_id DESC) = 1) AS s
            LEFT JOIN games_v AS g
              ON CAST(g.game_date AS VARCHAR) = s.odds_date AND g.home_team_name = s.home_team
             AND g.away_team_name = s.away_team
            """,
            "games_v",
        ),
        "outcomes_graded": oracle(
            f"""
            SELECT game_pk, winner_model_run_id, actual_home_win, actual_total_runs, winner_correct,
                   {_round('predicted_home_win_prob winner_log_loss winner_brier runs_abs_error runs_squared_error')}
            FROM outcomes_v
            """,
            "outcomes_v",
        ),
        "outcomes_market": oracle(
            f"""
            SELECT game_pk,
                   {_round('market_home_win_prob market_total_line market_winner_brier market_runs_abs_error')}
            FROM outcomes_v
            """,
            "outcomes_v",
        ),
        "rolling_performance": oracle(
            """
            SELECT count(*) AS n_games, round(round(avg(CAST(winner_correct AS INTEGER)), 9), 6) AS accuracy,
                   round(round(avg(winner_log_loss), 9), 6) AS log_loss, round(round(avg(winner_brier), 9), 6) AS brier,
                   round(round(avg(runs_abs_error), 9), 6) AS mae,
                   round(round(sqrt(avg(runs_squared_error)), 9), 6) AS rmse
            FROM outcomes_v WHERE game_date > (SELECT max(game_date) FROM outcomes_v) - 365
            """,
            "outcomes_v",
        ),
        "baseline_comparison": oracle(_BASELINE, "outcomes_v"),
        "baseline_comparison_long": oracle(_unpivoted(_BASELINE, "baseline"), "outcomes_v"),
        "market_comparison": oracle(_MARKET, "outcomes_v"),
        "market_comparison_long": oracle(_unpivoted(_MARKET, "market"), "outcomes_v"),
        "confidence_tiers": oracle(
            """
            SELECT CASE WHEN c <= 0.55 THEN '50–55%' WHEN c <= 0.6 THEN '55–60%'
                        WHEN c <= 0.65 THEN '60–65%' WHEN c <= 0.7 THEN '65–70%' ELSE '70%+' END AS tier,
                   count(*) AS n, round(round(avg(CAST(winner_correct AS INTEGER)), 9), 6) AS accuracy
            FROM (SELECT *, greatest(predicted_home_win_prob, 1 - predicted_home_win_prob) AS c
                  FROM outcomes_v) AS o
            GROUP BY ALL
            """,
            "outcomes_v",
        ),
        "calibration_bins": oracle(
            """
            SELECT CAST(len(list_filter(range(1, 10), lambda i: p > i * ((hi - lo) / 10) + lo)) AS INTEGER)
                       AS bin,
                   count(*) AS n, round(round(avg(p), 9), 6) AS mean_predicted,
                   round(round(avg(actual_home_win), 9), 6) AS mean_actual
            FROM (SELECT actual_home_win, predicted_home_win_prob AS p,
                         min(predicted_home_win_prob) OVER () AS lo,
                         max(predicted_home_win_prob) OVER () AS hi FROM outcomes_v) AS o
            GROUP BY ALL
            """,
            "outcomes_v",
        ),
        "daily_trend": oracle(
            f"""
            SELECT game_date, n, round(round(a, 9), 6) AS accuracy, round(round(l, 9), 6) AS log_loss, round(round(m, 9), 6) AS mae,
                   round(round(ar, 9), 6) AS accuracy_rolling, round(round(lr, 9), 6) AS log_loss_rolling
            FROM ({_TREND}) AS t
            """,
            "outcomes_v",
        ),
        "trend_long": oracle(
            f"""
            SELECT game_date, unnest(['accuracy', 'accuracy_rolling']) AS series,
                   unnest([round(round(a, 9), 6), round(round(ar, 9), 6)]) AS value
            FROM ({_TREND}) AS t
            """,
            "outcomes_v",
        ),
        "runs_scatter": oracle(
            "SELECT game_pk, predicted_total_runs, actual_total_runs FROM outcomes_v", "outcomes_v"
        ),
        "games_for_date": oracle(
            """
            SELECT game_pk, g.game_date, home_team_name, away_team_name, status,
                   round(round(predicted_home_win_prob, 9), 6) AS predicted_home_win_prob, predicted_total_runs
            FROM games_v AS g LEFT JOIN predictions_v AS p USING (game_pk)
            WHERE g.game_date = (SELECT max(game_date) FROM games_v)
            """,
            "games_v",
            "predictions_v",
        ),
        "game_cards": oracle(
            """
            SELECT g.game_pk, away_team_name || ' @ ' || home_team_name AS matchup,
                   'SP: ' || coalesce('Pitcher ' || away_probable_pitcher_id, '(TBD)') || ' vs '
                          || coalesce('Pitcher ' || home_probable_pitcher_id, '(TBD)') AS starters,
                   CASE WHEN p >= 0.5 THEN home_team_name ELSE away_team_name END AS favoured,
                   printf('%.0f', round(100 * greatest(p, 1 - p), 0)) || '%' AS favoured_chance,
                   printf('%.1f', predicted_total_runs) AS total_runs_shown,
                   CASE WHEN status = 'Final' THEN CASE WHEN home_win THEN home_team_name
                                                        ELSE away_team_name END END AS winner,
                   CASE WHEN status = 'Final' THEN greatest(home_score, away_score) || '–'
                                                   || least(home_score, away_score) END AS final_score
            FROM games_v AS g
            JOIN (SELECT game_pk, arg_max(predicted_home_win_prob, predicted_at) AS p,
                         any_value(predicted_total_runs) AS predicted_total_runs
                  FROM predictions_v GROUP BY game_pk) AS q USING (game_pk)
            """,
            "games_v",
            "predictions_v",
        ),
        "history_explorer": oracle(
            f"""
            SELECT game_pk, winner_model_run_id, game_date,
                   away_team_name || ' @ ' || home_team_name AS matchup,
                   {_HISTORY_PERCENT} AS home_win_prob,
                   CASE actual_home_win WHEN 1 THEN 'home won' ELSE 'away won' END AS actual,
                   CASE WHEN winner_correct THEN '✓' ELSE '✗' END AS hit,
                   round(predicted_total_runs, 1) AS pred_runs, actual_total_runs AS actual_runs,
                   round(runs_abs_error, 2) AS runs_error, away_score || '–' || home_score AS score
            FROM history_v
            WHERE game_date BETWEEN DATE '1996-03-01' AND DATE '2000-09-30'
              AND ('Team 3' IN (home_team_name, away_team_name)
                   OR 'Team 12' IN (home_team_name, away_team_name)
                   OR 'Team 21' IN (home_team_name, away_team_name))
            """,
            "history_v",
        ),
        "history_teams": oracle(
            "SELECT home_team_name AS team FROM history_v UNION SELECT away_team_name FROM history_v",
            "history_v",
        ),
        "history_columns": oracle(
            """
            SELECT game_pk, game_date, home_team_name, actual_home_win AS home_won,
                   actual_total_runs AS runs, round(round(market_home_win_prob, 9), 6) AS market_home_win_prob
            FROM history_v WHERE market_home_win_prob IS NOT NULL
            """,
            "history_v",
        ),
        "feature_lookup": oracle(
            """
            SELECT game_pk, game_date, status FROM games_v
            WHERE EXISTS (FROM lineitem WHERE l_orderkey = game_pk AND l_returnflag = 'R')
            """,
            "games_v",
        ),
        "json_records": oracle(
            """
            SELECT '{"game_pk":' || game_pk || ',"game_date":"' || game_date || '","home_team_name":"'
                   || home_team_name || '","home_score":' || coalesce(CAST(home_score AS VARCHAR), 'null')
                   || ',"home_win":' || coalesce(CAST(home_win AS VARCHAR), 'null') || '}' AS record
            FROM games_v
            """,
            "games_v",
        ),
        "table_counts": oracle(
            """
            SELECT 'games' AS table_name, count(*) AS n FROM games_v
            UNION ALL SELECT 'transactions', count(*) FROM transactions_v
            UNION ALL SELECT 'predictions', count(*) FROM predictions_v
            """,
            "games_v",
            "transactions_v",
            "predictions_v",
        ),
        "quality_report": oracle(_QUALITY, "games_v", "team_stats_v", "pitcher_v"),
        "declared_checks": oracle(_DECLARED, "versions_v"),
        "classification_metrics": oracle(
            f"{_WINNER_METRICS} FROM {_BY_PREDICTION['winner']} AS s GROUP BY split", "split_games_v"
        ),
        "regression_metrics": oracle(
            f"{_RUNS_METRICS} FROM {_BY_PREDICTION['runs']} AS s GROUP BY split", "split_games_v"
        ),
        "baselines_winner": oracle(_both_models(_WINNER_METRICS, "winner"), "split_games_v"),
        "baselines_runs": oracle(_both_models(_RUNS_METRICS, "runs"), "split_games_v"),
        "metric_entries": oracle(
            f"""
            SELECT split || '_' || metric AS name, value
            FROM (UNPIVOT (SELECT split, CAST(n AS DOUBLE) AS n, mae, rmse, within_1, within_2
                           FROM ({_RUNS_METRICS} FROM {_BY_PREDICTION['runs']} AS s GROUP BY split))
                  ON n, mae, rmse, within_1, within_2 INTO NAME metric VALUE value)
            """,
            "split_games_v",
        ),
        "metric_prefix_long": oracle(
            """
            SELECT run_id, unnest(['train', 'val', 'test', 'other']) AS split,
                   unnest(['log_loss', 'log_loss', 'log_loss', 'promoted']) AS metric,
                   unnest([round(round(metric / 2, 9), 6), round(round(metric, 9), 6), round(round(metric + 0.25, 9), 6), 1.0]) AS value
            FROM runs_v WHERE validated
            UNION ALL
            SELECT run_id, 'train', 'log_loss', round(round(metric / 2, 9), 6) FROM runs_v WHERE NOT validated
            """,
            "runs_v",
        ),
        "promotion_gate": oracle(_GATE, "runs_v"),
        "promotion_gate_blocks": oracle(_GATE, "runs_v"),
        "latest_run": oracle(
            """
            SELECT DISTINCT ON (experiment, model_family) experiment, model_family, run_id FROM runs_v
            ORDER BY experiment, model_family, promoted DESC, start_time DESC, run_id DESC
            """,
            "runs_v",
        ),
        "impute_median": oracle(_MEDIANS, "split_v"),
        "impute_median_narrowed": oracle(_MEDIANS, "split_v"),
        "standardize": oracle(
            "PIVOT (SELECT game_pk, feature, round(round(z, 9), 6) AS z FROM "
            + _SCALED
            + ") ON feature IN ("
            + ", ".join(f"'{c}'" for c in _NUMERIC)
            + ") USING first(z) GROUP BY game_pk",
            "split_v",
        ),
        "logistic_fit": oracle(_LEAST, "split_v"),
        "ridge_fit": oracle(_LEAST, "split_v"),
        "gbt_scores": oracle(
            """
            SELECT game_pk, CAST(game_date AS VARCHAR) AS game_date, 'winner-run' AS winner_model_run_id,
                   'runs-run' AS runs_model_run_id, true AS probability_in_range, true AS runs_in_range
            FROM features_v WHERE game_date = (SELECT max(game_date) FROM features_v)
            """,
            "features_v",
        ),
        "importance_sorted": f"""
            SELECT CAST(unnest(range(1, {len(FEATURES) + 1})) AS INTEGER) AS place, true AS falling, true AS in_range,
                   1.0::DOUBLE AS total
            """,
        "attribution_tidy": oracle(
            f"""
            SELECT game_pk, CAST({len(FEATURES)} AS BIGINT) AS n, CAST({len(FEATURES)} AS INTEGER) AS last_rank, true AS falling,
                   0.0::DOUBLE AS off
            FROM split_v
            """,
            "split_v",
        ),
        "attribution_by_key": oracle(
            f"""
            SELECT game_pk, CAST(r AS INTEGER) AS rank, feature,
                   format('{{}} `{{}}` +{{:.3f}}', CASE WHEN c < 0 THEN '↓' ELSE '↑' END, feature, abs(c)) AS line
            FROM (SELECT *, row_number() OVER (PARTITION BY game_pk ORDER BY abs(c) DESC, place) AS r
                  FROM (SELECT *, z * (place + 1) / 10.0::DOUBLE AS c FROM {_SCALED}) AS p) AS t
            WHERE r <= 5 AND game_pk IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
            """,
            "split_v",
        ),
        "linear_attribution_topn": oracle(
            f"""
            SELECT game_pk, CAST(r AS INTEGER) AS rank, feature, round(round(c, 9), 6) AS contribution,
                   CASE WHEN c > 0 THEN '▲ home' ELSE '▼ away' END AS direction,
                   round(round(abs(c), 9), 6) AS abs_contribution
            FROM (SELECT *, row_number() OVER (PARTITION BY game_pk ORDER BY abs(c) DESC, place) AS r
                  FROM (SELECT *, z * (place + 1) / 10.0::DOUBLE AS c FROM {_SCALED}) AS p) AS t
            WHERE r <= 5
            """,
            "split_v",
        ),
    } | round_trips.oracle_sql()
