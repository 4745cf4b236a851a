"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Season names, three months each, winter opening in December.
SEASONS = ("Winter", "Spring", "Summer", "Autumn")
UNKNOWN_SEASON = "Unknown"


def season(date: Column) -> Column:
    """Season of a date, ``Unknown`` for NULL."""
    position = ((F.month(date) % 12) / 3).cast("int")
    return F.coalesce(F.get(F.array(*map(F.lit, SEASONS)), position), F.lit(UNKNOWN_SEASON))


def month_label(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")
