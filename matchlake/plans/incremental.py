"""The daily refresh that redoes only what changed.

Raw days that were landed again are merged into the typed tables, which rewrites the months that hold their rows. From these
rows follows the first day of play on which anything may differ. All features from a sealed day on, which is not after it,
are computed anew; of the time before only the tails are needed: the last rows that a frame of each team, venue, pitcher and the
league can reach, and the last form of each pitcher and park. So history is neither read nor rewritten. The tails then
move up to that first day. A change before the sealed day, or a match without a day, leads to a whole rebuild.

A refresh that is lost leaves the tails as they were, so that it can be done again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from datetime import date, timedelta
from functools import partial

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchlake.operators.latest import latest_wins
from matchlake.operators.sides import unpivot_sides
from matchlake.plans import gold, market, silver
from matchlake.schemas import GOLD, SILVER
from matchlake.session import at_once, materialise
from matchlake.sources.lake import Lake
from matchlake.sources.versions import LANDED_IN, SnapshotTable, VersionLog, merge_landing, month_of

# The partition column of the typed and the feature tables.
MONTH = "game_month"
TYPED_KEYS = {
    "games": ["game_pk"], "team_game_stats": ["game_pk", "team_id"], "pitcher_game_stats": ["game_pk", "pitcher_id"],
    "transactions": ["transaction_id"],
}
# The rows that the tables of both kinds of team form are taken from.
SIDES, OF_SIDES = "sides", ["team_rolling", "bullpen_form"]
TAILS = {
    "games": SILVER["games"], "pitchers": SILVER["pitcher_game_stats"], "transactions": SILVER["transactions"],
    "form": GOLD["pitcher_form"], "parks": GOLD["park_factors"],
}


def typed_table(lake: Lake, name: str) -> SnapshotTable:
    return lake.snapshots("silver", name, MONTH, [TYPED_KEYS[name][0], LANDED_IN])


def feature_table(lake: Lake, name: str) -> SnapshotTable:
    return lake.snapshots("gold", name, MONTH)


def _state(lake: Lake) -> VersionLog:
    return VersionLog(lake.spark, lake.path("gold", "_tails/_versions"))


def _games(raw: DataFrame) -> DataFrame:
    return silver.games(raw, keep=["date"]).withColumnRenamed("date", LANDED_IN).withColumn(MONTH, month_of(F.col("game_date")))


def _moves(raw: DataFrame) -> DataFrame:
    typed = silver.transactions(raw).withColumn(LANDED_IN, F.col("transaction_date").cast("string"))
    return typed.withColumn(MONTH, month_of(F.col("transaction_date")))


def _lines(table: str):
    make = {"team_game_stats": silver.team_game_stats, "pitcher_game_stats": silver.pitcher_game_stats}[table]

    def parse(raw: DataFrame) -> DataFrame:
        typed = make(raw, keep=["date"]).withColumnRenamed("date", LANDED_IN)
        return typed.withColumn(MONTH, F.substring(LANDED_IN, 1, 7))

    return parse


# Typed table: raw table and how it is parsed, with the landing partition and the month. A boxscore lies in the month of its landing day.
PARSED = {
    "games": ("schedule", _games), "team_game_stats": ("boxscores", _lines("team_game_stats")),
    "pitcher_game_stats": ("boxscores", _lines("pitcher_game_stats")), "transactions": ("transactions", _moves),
}


def rebuild_typed(lake: Lake) -> None:
    """All typed tables from all raw rows."""
    at_once(*[partial(_rebuild_typed, lake, name) for name in PARSED])
    _rebuild_odds(lake)


def _rebuild_typed(lake: Lake, name: str) -> None:
    raw, parse = PARSED[name]
    typed_table(lake, name).rebuild(parse(lake.bronze(raw)))


def _rebuild_odds(lake: Lake) -> None:
    _odds_table(lake).rebuild(_odds(lake.bronze("odds"), lake.silver("games")))


def _odds_table(lake: Lake) -> SnapshotTable:
    return lake.snapshots("silver", "odds", MONTH)


def _odds(raw: DataFrame, games: DataFrame) -> DataFrame:
    return market.odds(raw, games).withColumn(MONTH, F.substring("odds_date", 1, 7))


def _features(games: DataFrame, pitchers: DataFrame, moves: DataFrame, since: date | None = None) -> dict[str, DataFrame]:
    """The sides of the matches of `games` from a day on with their form, and the feature tables that need no sides, by name."""
    wanted = (lambda df: df.filter(F.col("game_date") >= F.lit(since))) if since else (lambda df: df)
    return {
        SIDES: wanted(gold.side_form(games, pitchers)),
        "pitcher_form": wanted(gold.pitcher_form(games, pitchers)),
        "park_factors": wanted(gold.park_factors(games)).filter(F.col("game_pk").isNotNull()),
        "roster_activity": wanted(gold.roster_activity(games, moves)).filter(F.col("game_date").isNotNull()),
    }


def _of_sides(name: str, sides: DataFrame) -> DataFrame:
    columns = [field.split()[0] for field in GOLD[name].split(", ")]
    return sides.filter(F.col("game_pk").isNotNull()).select(*columns, "game_date")


def _monthly(df: DataFrame) -> DataFrame:
    return df.withColumn(MONTH, month_of(F.col("game_date")))


def rebuild_features(lake: Lake, seal: date | None = None) -> None:
    """All feature tables from the typed ones; with `seal` also the tails of the time before that day."""
    games, pitchers, moves = lake.silver("games"), lake.silver("pitcher_game_stats"), lake.silver("transactions")
    built = _features(games, pitchers, moves)

    def store(name: str, df: DataFrame) -> DataFrame:
        if name == SIDES:
            return materialise(df)
        table = feature_table(lake, name)
        return table.read(table.rebuild(_monthly(df))).drop(MONTH)

    stored = dict(zip(built, at_once(*[partial(store, name, df) for name, df in built.items()])))
    sides, form, parks = stored[SIDES], stored["pitcher_form"], stored["park_factors"]
    _, *tails = at_once(
        lambda: store("features", gold.assemble_sides(games, sides, form, stored["roster_activity"], parks)),
        *[partial(_write_tails, lake, seal, games, pitchers, moves, form, parks)] * bool(seal),
        *[partial(store, name, _of_sides(name, sides)) for name in OF_SIDES],
    )
    if seal:
        _use_tails(lake, seal, tails[0])


def _last(df: DataFrame, entity: Sequence[str], n: int) -> DataFrame:
    """The keys of the last n rows of each entity, in the order of the frames."""
    newest = Window.partitionBy(*entity).orderBy(F.desc("game_date"), F.desc("game_pk"))
    return df.withColumn("_place", F.row_number().over(newest)).filter(F.col("_place") <= n).select("game_pk")


def _on_last_days(df: DataFrame, entity: str, n: int) -> DataFrame:
    """The rows of the days that hold the last n rows of each entity, found from the numbers of rows a day."""
    later = Window.partitionBy(entity).orderBy(F.desc("game_date")).rowsBetween(Window.unboundedPreceding, -1)
    days = df.groupBy(entity, "game_date").count().withColumn("_later", F.coalesce(F.sum("count").over(later), F.lit(0)))
    first = days.filter(F.col("_later") < n).groupBy(F.col(entity).alias("_entity")).agg(F.min("game_date").alias("_first"))
    reached = F.col(entity).eqNullSafe(F.col("_entity")) & (F.col("game_date") >= F.col("_first"))
    return df.join(materialise(first), reached, "left_semi")


def _last_in_league(df: DataFrame, n: int) -> DataFrame:
    return df.orderBy(F.desc("game_date"), F.desc("game_pk")).limit(n).select("game_pk")


def _write_tails(
    lake: Lake, seal: date, games: DataFrame, pitchers: DataFrame, moves: DataFrame, form: DataFrame, parks: DataFrame
) -> str:
    """Store what frames from `seal` on reach of the time before it; returns the folder."""
    before = games.filter(F.col("game_date") < F.lit(seal))
    played = before.filter((F.col("status") == gold.FINAL) & F.col("total_runs").isNotNull())
    starts = pitchers.filter("is_starter").select("game_pk", "pitcher_id").join(before.select("game_pk", "game_date"), "game_pk")
    sides = unpivot_sides(
        before, ["game_pk", "game_date"], {"team_id": F.col("home_team_id")}, {"team_id": F.col("away_team_id")}
    )
    roster_from = seal - timedelta(days=gold.ROSTER_DAYS)
    reach = max(gold.TEAM_GAMES, gold.BULLPEN_FORM_GAMES)
    needed = [
        _last(_on_last_days(sides, "team_id", reach), ["team_id"], reach),
        _last(_on_last_days(played, "venue_id", gold.PARK_GAMES), ["venue_id"], gold.PARK_GAMES),
        _last_in_league(played, gold.PARK_GAMES), _last(starts, ["pitcher_id"], gold.PITCHER_STARTS),
        before.filter(F.col("game_date") >= F.lit(roster_from)).select("game_pk"),
    ]
    keys = needed[0]
    for more in needed[1:]:
        keys = keys.unionByName(more)
    # Stored, the few keys have a known size, and the matches are not shuffled to meet them.
    tail_games = materialise(before.join(materialise(keys.distinct()), "game_pk", "left_semi"))
    earlier = F.col("game_date") < F.lit(seal)
    rows = {
        "games": tail_games,
        "pitchers": pitchers.join(tail_games.select("game_pk"), "game_pk", "left_semi"),
        "transactions": moves.filter(F.col("transaction_date").between(F.lit(roster_from), F.lit(seal - timedelta(days=1)))),
        "form": latest_wins(form.filter(earlier), ["pitcher_id"], "game_date", ["game_pk"]),
        "parks": latest_wins(parks.filter(earlier), ["venue_id"], "game_date", ["game_pk"]),
    }
    folder = f"_tails/{uuid.uuid4().hex}"

    def write(name: str, schema: str) -> None:
        rows[name].select(*[c.split()[0] for c in schema.split(", ")]).write.parquet(lake.path("gold", f"{folder}/{name}"))

    at_once(*[partial(write, name, schema) for name, schema in TAILS.items()])
    return folder


def _use_tails(lake: Lake, seal: date, folder: str) -> None:
    log = _state(lake)
    while not log.put(log.newest()[0] + 1, {"sealed": seal.isoformat(), "parts": {"": folder}}):
        pass


def _tail(lake: Lake, state: dict, name: str) -> DataFrame:
    return lake.spark.read.schema(TAILS[name]).parquet(lake.path("gold", f"{state['parts']['']}/{name}"))


def _from(table: SnapshotTable, month: str) -> DataFrame:
    """The partitions of a table from a month on; no other is listed or read."""
    base = table.snapshot()
    return table.read(base, [part for part in base.parts if month <= part < "A"]) if base else table.read()


def _replace_from(table: SnapshotTable, first: date, day: str, rows: DataFrame) -> None:
    """Replace the rows from a day on; the months before it keep their folders."""
    base, month = table.snapshot(), f"{first:%Y-%m}"
    gone = [part for part in base.parts if month <= part < "A"] if base else []
    known = table.read(base, [part for part in gone if part == month], "" if f"{day} " in table.schema else f"{day} date")
    kept = known.filter(F.col(day) < F.lit(first).cast(known.schema[day].dataType))
    table.replace(base, gone, kept.unionByName(rows.select(*known.columns)))


def _first_day(frames: Iterable[tuple[DataFrame, str]]) -> date | None:
    """The first day of all; None if a row has none."""
    days, undated = [], 0
    for df, column in frames:
        row = df.agg(F.min(column), F.count(F.when(F.col(column).isNull(), 1))).first()
        days += [row[0]] if row[0] else []
        undated += row[1]
    return None if undated or not days else min(days)


def refresh(lake: Lake, partitions: Sequence[str]) -> date | None:
    """Bring typed tables and features up to date after landing partitions were written again.

    Returns the first day that was computed anew, or None if everything was rebuilt. Afterwards all tables are as a
    whole rebuild would leave them.
    """
    _, state = _state(lake).newest()
    if state is None or any(typed_table(lake, name).snapshot() is None for name in PARSED):
        rebuild_typed(lake)
        games = lake.silver("games")
        again = games.join(lake.bronze("schedule").filter(F.col("date").isin(list(partitions))), "game_pk", "left_semi")
        rebuild_features(lake, _seal(again) or _seal(games))
        return None
    changed: list[tuple[DataFrame, str]] = []
    line_keys = []
    merged = at_once(*[
        partial(merge_landing, typed_table(lake, name), lake.bronze(raw), partitions, parse, TYPED_KEYS[name])
        for name, (raw, parse) in PARSED.items()
    ])
    for name, (came, went) in zip(PARSED, merged):
        for rows in (came, went):
            if name == "games":
                changed.append((rows, "game_date"))
            elif name == "transactions":
                changed.append((rows, "transaction_date"))
            else:
                line_keys.append(rows.select("game_pk"))
    sealed = date.fromisoformat(state["sealed"])
    recent = materialise(_from(typed_table(lake, "games"), f"{sealed:%Y-%m}").drop(MONTH).filter(F.col("game_date") >= F.lit(sealed)))
    lines = line_keys[0]
    for more in line_keys[1:]:
        lines = lines.unionByName(more)
    lines = lines.distinct()
    first = _first_day([*changed, (recent.join(lines, "game_pk", "left_semi"), "game_date")])
    older = not lines.join(recent, "game_pk", "left_anti").isEmpty()  # lines of matches before the sealed day, or of none
    nothing = first is None and all(df.isEmpty() for df, _ in changed) and lines.isEmpty()
    if nothing:
        return sealed
    if first is None or first < sealed or older:
        _rebuild_odds(lake)  # first, because the new tails say that all is done
        rebuild_features(lake, first or _seal(lake.silver("games")))
        return None
    return _refresh_from(lake, state, sealed, first, recent)


def _seal(games: DataFrame) -> date | None:
    return games.agg(F.min("game_date")).first()[0]


def _refresh_from(lake: Lake, state: dict, sealed: date, first: date, recent: DataFrame) -> date:
    month = f"{sealed:%Y-%m}"
    pitchers = _from(typed_table(lake, "pitcher_game_stats"), month).drop(MONTH)
    pitchers = pitchers.join(recent.select("game_pk"), "game_pk", "left_semi")
    moves = _from(typed_table(lake, "transactions"), month).drop(MONTH).filter(F.col("transaction_date") >= F.lit(sealed))
    games, pitchers, moves = at_once(*[
        partial(materialise, _tail(lake, state, name).unionByName(rows))
        for name, rows in (("games", recent), ("pitchers", pitchers), ("transactions", moves))
    ])
    built = _features(games, pitchers, moves, sealed)
    built = dict(zip(built, at_once(*[partial(materialise, df) for df in built.values()])))
    sides = built.pop(SIDES)
    form = _tail(lake, state, "form").unionByName(built["pitcher_form"])
    parks = _tail(lake, state, "parks").unionByName(built["park_factors"])
    built["features"] = gold.assemble_sides(recent, sides, form, built["roster_activity"], parks)
    built |= {name: _of_sides(name, sides) for name in OF_SIDES}
    raw = lake.bronze("odds").filter(F.col("date") >= F.lit(sealed.isoformat()))
    tails, *_ = at_once(
        partial(_write_tails, lake, first, games, pitchers, moves, form, parks),
        partial(_replace_from, _odds_table(lake), sealed, "odds_date", _odds(raw, recent)),
        *[partial(_replace_from, feature_table(lake, name), sealed, "game_date", _monthly(df)) for name, df in built.items()],
    )
    _use_tails(lake, first, tails)
    return sealed
