"""Data-quality checks: each gives one row of name, passed, details."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GAME_IDS = ["game_pk", "game_date", "home_team_id", "away_team_id"]
ROWS_PER_FINAL = 2


class QualityError(RuntimeError):
    """Raised by the gate when a check failed."""


def _total(condition: Column) -> Column:
    """Rows for which the condition is true, 0 on an empty table."""
    return F.count(F.when(condition, F.lit(1)))


def _verdict(counted: DataFrame, name: str, issues: Column, details: Column) -> DataFrame:
    return counted.select(
        F.lit(name).alias("name"), (issues == 0).alias("passed"), details.alias("details")
    )


def check_unique(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Rows beyond the first of their key, NULL keys being equal."""
    counted = (
        df.groupBy(*keys)
        .count()
        .agg(
            F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("dupes"),
            F.coalesce(F.sum("count"), F.lit(0)).alias("n"),
        )
    )
    what = keys[0] if len(keys) == 1 else f"({', '.join(keys)})"
    details = F.format_string(f"%d duplicate {what} rows out of %d", "dupes", "n")
    return _verdict(counted, name, F.col("dupes"), details)


def _rows_by_game(rows: DataFrame, key: str, counted: Column, prefix: str) -> DataFrame:
    """One row per match: rows beyond the first of their (match, key), all rows, and the counted ones."""
    per_key = rows.groupBy("game_pk", key).agg(F.count(F.lit(1)).alias("n"), _total(counted).alias("counted"))
    return per_key.groupBy("game_pk").agg(
        F.sum(F.col("n") - 1).alias(f"{prefix}_dupes"),
        F.sum("n").alias(f"{prefix}_n"),
        F.sum("counted").alias(f"{prefix}_rows"),
    )


def quality_report(games: DataFrame, team_stats: DataFrame, pitchers: DataFrame) -> DataFrame:
    """All checks as one table.

    Each input is aggregated once, by match; the three results meet on the match key, by which they
    are already partitioned. An unknown total or score counts as an inconsistent total. Of a
    Final match, no detail rows at all are reported apart from a wrong number of them.
    """
    final = F.col("status") == "Final"
    agrees = F.col("total_runs") == F.col("home_score") + F.col("away_score")
    counters = {
        **{f"null_{c}": F.col(c).isNull() for c in GAME_IDS},
        "finals": final,
        "no_home": final & F.col("home_score").isNull(),
        "no_away": final & F.col("away_score").isNull(),
        "wrong": final & ~F.coalesce(agrees, F.lit(False)),
    }
    by_game = games.groupBy("game_pk").agg(
        F.count(F.lit(1)).alias("n"), *[_total(c).alias(name) for name, c in counters.items()]
    )
    details = {
        "team": _rows_by_game(team_stats, "team_id", F.lit(True), "team"),
        "pitcher": _rows_by_game(pitchers, "pitcher_id", F.col("is_starter"), "pitcher"),
    }
    for rows in details.values():
        by_game = by_game.join(rows, "game_pk", "full")

    def total(amount: Column | str) -> Column:
        return F.coalesce(F.sum(amount), F.lit(0))

    sums = {"dupes": total(F.col("n") - 1), **{name: total(name) for name in ("n", *counters)}}
    for prefix in details:
        found = F.coalesce(f"{prefix}_rows", F.lit(0))
        sums |= {f"{prefix}_{name}": total(f"{prefix}_{name}") for name in ("n", "dupes")}
        sums[f"{prefix}_none"] = _total((F.col("finals") > 0) & (found == 0))
        sums[f"{prefix}_wrong"] = _total((F.col("finals") > 0) & (found != 0) & (found != ROWS_PER_FINAL))
    counted = by_game.agg(*[expr.alias(name) for name, expr in sums.items()])

    # Names and texts of the checks.
    nulls = [f"null_{c}" for c in GAME_IDS]
    shown = ", ".join(f"'{c}': %d" for c in GAME_IDS)
    texts = [
        ("games.pk_unique", ["dupes"], "%d duplicate game_pk rows out of %d", ["dupes", "n"]),
        ("games.no_null_ids", nulls, f"nulls: {{{shown}}}", nulls),
        ("games.final_has_scores", ["no_home", "no_away"],
         "%d missing scores among %d Final games", ["missing", "finals"]),
        ("games.total_runs_consistent", ["wrong"],
         "%d rows where total_runs != home_score + away_score", ["wrong"]),
        ("team_stats.pk_unique", ["team_dupes"],
         "%d duplicate (game_pk, team_id) rows out of %d", ["team_dupes", "team_n"]),
        ("team_stats.two_rows_per_final_game", ["team_wrong", "team_none"],
         "%d Final games with row-count != 2, %d Final games with no team_game_stats rows at all",
         ["team_wrong", "team_none"]),
        ("pitcher_stats.pk_unique", ["pitcher_dupes"],
         "%d duplicate (game_pk, pitcher_id) rows out of %d", ["pitcher_dupes", "pitcher_n"]),
        ("pitcher_stats.two_starters_per_final_game", ["pitcher_wrong", "pitcher_none"],
         "%d Final games with != 2 starters, %d Final games with no starter rows at all",
         ["pitcher_wrong", "pitcher_none"]),
    ]
    verdicts = [
        F.struct(
            F.lit(name).alias("name"),
            (reduce(lambda a, b: a + b, map(F.col, issues)) == 0).alias("passed"),
            F.format_string(text, *values).alias("details"),
        )
        for name, issues, text, values in texts
    ]
    counted = counted.withColumn("missing", F.col("no_home") + F.col("no_away"))
    return counted.select(F.inline(F.array(*verdicts)))


def declared_checks(table: DataFrame, name: str, rules: Mapping[str, Sequence[str]]) -> DataFrame:
    """Column rules such as {'game_pk': ['unique', 'not_null']} as check rows.

    All NULL counts come from one pass; each unique column has a grouping of its own.
    """
    checks = [
        check_unique(table, [column], f"{name}.{column}.unique")
        for column, wanted in rules.items()
        if "unique" in wanted
    ]
    columns = [column for column, wanted in rules.items() if "not_null" in wanted]
    if columns:
        counted = table.agg(*[_total(F.col(c).isNull()).alias(c) for c in columns])
        rows = [
            F.struct(
                F.lit(f"{name}.{c}.not_null").alias("name"),
                (F.col(c) == 0).alias("passed"),
                F.format_string(f"nulls: {{'{c}': %d}}", c).alias("details"),
            )
            for c in columns
        ]
        checks.append(counted.select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, checks)


def enforce(report: DataFrame) -> None:
    """Raise when any check of the report failed."""
    failed = report.filter(~F.col("passed")).select("name", "details").collect()
    if failed:
        raise QualityError("; ".join(f"{r['name']}: {r['details']}" for r in failed))
