"""Points within intervals, joined through bins of a fitting width."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bins of a level are so many times as wide as those of the level below, and an
# interval lies on the lowest level where it touches no more than BINS + 1 of them.
STEP = 8
BINS = 4

# A bin with more than this share of all points is dealt out to several tasks:
# there are fewer than LEVELS / SHARE of them, so that they can be broadcast.
SHARE = 1 / 200
PARTS = 32


def _number(df: DataFrame, name: str) -> Column:
    """A date, time stamp or number as a double (time stamps in seconds)."""
    kind, column = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp")) / F.lit(1e6)
    return column.cast("double")


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    at: str,
    start: str,
    end: str,
    share: float = SHARE,
    parts: int = PARTS,
) -> DataFrame:
    """Each pair of a point and an interval of the same keys with start <= at <= end.

    All columns of both, the keys once; other names must differ. NULL keys,
    places and ends never match, nor do intervals that end before they start.
    Repeated rows give repeated pairs.

    The bins are as wide as half of the intervals are long or less; longer
    intervals go to levels of wider bins, so that each is copied a few times
    only, and a point is copied once for each level that occurs. A pair meets in
    one bin. Bins that hold more than ``share`` of all points are parted: their
    points are dealt out by a hash of the row (the same in a repeated task, as a
    random number may not be), their intervals copied to each part.
    """
    clash = set(points.columns) & set(intervals.columns) - set(keys)
    if clash:
        raise ValueError(f"columns of the same name on both sides: {sorted(clash)}")
    low, high = _number(intervals, start), _number(intervals, end)
    held = intervals.withColumns({"__low": low, "__high": high}).filter("__low <= __high").dropna(subset=list(keys))
    length = F.col("__high") - F.col("__low")
    summary = held.agg(F.percentile_approx(F.when(length > 0, length), 0.5, 1000).alias("half"), F.max(length).alias("longest")).first()
    width = summary["half"] or 1.0
    highest = 0
    while (summary["longest"] or 0.0) > width * BINS * STEP**highest:
        highest += 1

    sizes = [width * STEP**level for level in range(highest + 1)]
    level = reduce(
        lambda other, n: F.when(length <= sizes[n] * BINS, n).otherwise(other), reversed(range(highest)), F.lit(highest)
    )
    held = held.withColumn("__level", level)
    used = [row[0] for row in held.select("__level").distinct().collect()]  # as many as the lengths have powers

    size = F.element_at(F.array(*map(F.lit, sizes)), F.col("__level") + 1)
    bins = F.sequence(F.floor(F.col("__low") / size), F.floor(F.col("__high") / size))
    binned = held.withColumn("__bin", F.explode(bins)).drop("__low", "__high")
    levels = F.explode(F.array(*map(F.lit, sorted(used))).cast("array<int>"))
    placed = points.withColumns({"__at": _number(points, at)}).filter("__at is not null").dropna(subset=list(keys))
    placed = placed.withColumn("__level", levels).withColumn("__bin", F.floor(F.col("__at") / size)).drop("__at")

    own = [*keys, "__level", "__bin"]
    counts = placed.groupBy(*own).agg(F.count("*").alias("__n"))
    limit = counts.agg((F.sum("__n") * F.lit(share)).alias("limit")).scalar()
    crowded = F.broadcast(counts.filter(F.col("__n") > limit).select(*own, F.lit(True).alias("__crowded")))
    hashed = [F.col(f"`{f.name}`") for f in points.schema if not isinstance(f.dataType, T.MapType)]
    placed = placed.join(crowded, own, "left").withColumn(
        "__part", F.when(F.col("__crowded"), F.pmod(F.xxhash64(*hashed), F.lit(parts))).otherwise(0).cast("int")
    )
    binned = binned.join(crowded, own, "left").withColumn(
        "__part", F.explode(F.when(F.col("__crowded"), F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0))))
    )
    inside = (F.col(f"`{start}`") <= F.col(f"`{at}`")) & (F.col(f"`{at}`") <= F.col(f"`{end}`"))
    joined = placed.drop("__crowded").join(binned.drop("__crowded"), [*own, "__part"]).filter(inside)
    return joined.select(*points.columns, *(name for name in intervals.columns if name not in keys))
