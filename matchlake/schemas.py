"""Schemas of the stored tables, stated rather than inferred."""

BRONZE = {
    "schedule": "game_pk long, game_date string, payload string, ingested_at timestamp, date string",
    "boxscores": "game_pk long, payload string, ingested_at timestamp, date string",
    "plays": "game_pk long, payload string, ingested_at timestamp, date string",
    "transactions": "transaction_id long, payload string, ingested_at timestamp, date string",
    "odds": (
        "odds_event_id string, commence_time string, home_team string, away_team string, "
        "payload string, fetched_at timestamp, date string"
    ),
}

SILVER = {
    "games": (
        "game_pk long, game_date date, game_datetime_utc timestamp, season int, game_type string, "
        "status string, home_team_id int, home_team_name string, away_team_id int, "
        "away_team_name string, home_score int, away_score int, total_runs int, home_win boolean, "
        "venue_id int, venue_name string, day_night string, home_probable_pitcher_id int, "
        "home_probable_pitcher_name string, away_probable_pitcher_id int, "
        "away_probable_pitcher_name string, ingested_at timestamp"
    ),
    "team_game_stats": (
        "game_pk long, team_id int, is_home boolean, runs int, hits int, at_bats int, "
        "strikeouts int, walks int, home_runs int, left_on_base int, errors int, "
        "ingested_at timestamp"
    ),
    "pitcher_game_stats": (
        "game_pk long, team_id int, pitcher_id int, pitcher_name string, is_starter boolean, "
        "innings_pitched double, hits_allowed int, runs_allowed int, earned_runs int, walks int, "
        "strikeouts int, pitches_thrown int, ingested_at timestamp"
    ),
    "transactions": (
        "transaction_id long, transaction_date date, type_code string, type_desc string, "
        "description string, person_id int, person_name string, from_team_id int, "
        "from_team_name string, to_team_id int, to_team_name string, "
        "affects_availability boolean, ingested_at timestamp"
    ),
    "odds": (
        "odds_event_id string, odds_date string, home_team string, away_team string, "
        "commence_time string, fetched_at timestamp, market_home_win_prob double, "
        "market_away_win_prob double, market_total_line double, n_books_moneyline int, "
        "n_books_totals int, game_pk long, game_date string"
    ),
    "_quality": "name string, passed boolean, details string, ran_at timestamp",
}

GOLD = {
    "team_rolling": (
        "game_pk long, team_id int, runs_scored_l10 double, runs_allowed_l10 double, "
        "win_pct_l10 double, n_prior_games long, days_rest int"
    ),
    "pitcher_form": (
        "game_pk long, pitcher_id int, game_date date, era_l5 double, k_per_9_l5 double, "
        "days_rest int, n_prior_starts long"
    ),
    "bullpen_form": (
        "game_pk long, team_id int, bullpen_era_l10 double, bullpen_ip_l3 double, "
        "bullpen_prior_games long"
    ),
    "park_factors": (
        "game_pk long, venue_id int, game_date date, venue_avg_runs double, "
        "league_avg_runs double, venue_park_factor_runs double, n_prior_venue_games long"
    ),
    "roster_activity": "team_id int, game_date date, il_events_l30 long",
    "features": (
        "game_pk long, game_date date, season int, home_team_id int, away_team_id int, "
        "venue_id int, home_runs_scored_l10 double, home_runs_allowed_l10 double, "
        "home_win_pct_l10 double, home_days_rest int, away_runs_scored_l10 double, "
        "away_runs_allowed_l10 double, away_win_pct_l10 double, away_days_rest int, "
        "home_sp_era_l5 double, home_sp_k_per_9_l5 double, home_sp_days_rest int, "
        "away_sp_era_l5 double, away_sp_k_per_9_l5 double, away_sp_days_rest int, "
        "home_bullpen_era_l10 double, home_bullpen_ip_l3 double, away_bullpen_era_l10 double, "
        "away_bullpen_ip_l3 double, home_il_events_l30 long, away_il_events_l30 long, "
        "venue_park_factor_runs double, is_day_game boolean, month int, season_type string, "
        "target_home_win boolean, target_total_runs int"
    ),
    "predictions": (
        "game_pk long, game_date string, predicted_home_win_prob double, "
        "predicted_total_runs double, winner_model_run_id string, runs_model_run_id string, "
        "predicted_at timestamp, date string"
    ),
    "prediction_outcomes": (
        "game_pk long, game_date string, predicted_home_win_prob double, "
        "predicted_total_runs double, winner_model_run_id string, runs_model_run_id string, "
        "predicted_at timestamp, actual_home_win int, actual_total_runs int, "
        "winner_correct boolean, winner_log_loss double, winner_brier double, "
        "runs_abs_error double, runs_squared_error double, market_home_win_prob double, "
        "market_total_line double, market_winner_brier double, market_runs_abs_error double"
    ),
}

RUNS = (
    "run_id string, experiment string, model_family string, run_name string, "
    "start_time timestamp, params map<string,string>, metrics map<string,double>, "
    "tags map<string,string>"
)
