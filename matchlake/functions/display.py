"""Text shown to readers of the tables."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed display values.
UNKNOWN_PITCHER = "(TBD)"
HIT_MARK, MISS_MARK = "✓", "✗"
HOME_WON, AWAY_WON = "home won", "away won"
TOWARDS_HOME, TOWARDS_AWAY = "▲ home", "▼ away"
ARROW_UP, ARROW_DOWN = "↑", "↓"


def matchup(away: Column, home: Column) -> Column:
    return F.concat(away, F.lit(" @ "), home)


def score(first: Column, second: Column) -> Column:
    return F.concat(first.cast("string"), F.lit("–"), second.cast("string"))


def percent(share: Column, digits: int = 1) -> Column:
    return F.concat(F.format_string(f"%.{digits}f", F.round(share * 100, digits)), F.lit("%"))


def hit_mark(correct: Column) -> Column:
    return F.when(correct, HIT_MARK).when(~correct, MISS_MARK)


def pitcher_name(name: Column) -> Column:
    return F.coalesce(F.nullif(name, F.lit("")), F.lit(UNKNOWN_PITCHER))


def favoured_team(p_home: Column, home: Column, away: Column) -> Column:
    return F.when(p_home >= 0.5, home).when(p_home < 0.5, away)


def favoured_probability(p_home: Column) -> Column:
    return F.when(p_home >= 0.5, p_home).otherwise(1 - p_home)


def winner(status: Column, home_win: Column, home: Column, away: Column) -> Column:
    """Name of the side that won a Final game; a tie reads as the away side, as on the game cards."""
    return F.when(status == "Final", F.when(home_win, home).otherwise(away))


def direction(contribution: Column) -> Column:
    return F.when(contribution > 0, TOWARDS_HOME).otherwise(TOWARDS_AWAY)


def contribution_line(feature: Column, contribution: Column) -> Column:
    """One line per contribution: an arrow, the feature in backticks, the magnitude with a plus sign."""
    arrow = F.when(contribution > 0, ARROW_UP).when(contribution < 0, ARROW_DOWN).otherwise(ARROW_UP)
    return F.format_string("%s `%s` %+.3f", arrow, feature, F.abs(contribution))
