"""Innings notation."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def innings_to_number(text: str | Column) -> Column:
    """'6.1' means six innings and one third. Empty and NULL give NULL, '0.0' gives 0."""
    text = F.nullif(F.col(text) if isinstance(text, str) else text, F.lit(""))
    whole = F.split_part(text, F.lit("."), F.lit(1)).cast("int")
    thirds = F.nullif(F.split_part(text, F.lit("."), F.lit(2)), F.lit("")).cast("int")
    return whole + F.coalesce(thirds / F.lit(3.0), F.lit(0.0))
