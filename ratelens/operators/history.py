"""Reviews in the order of time: moving means, what came before and after, and the latest earlier event.

No window spans all reviews of an entity: running sums and carried values go
from chunk to chunk of the order, so an entity with a third of all reviews is as
many chunks as its rows fill (see :mod:`ratelens.functions.ordered`). Only days
of an entity, after all its reviews of a day are one row, stand in one window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.functions.ordered import carried, range_chunks, running_sums
from ratelens.functions.parsing import day
from ratelens.sources.schema import REVIEWS, ReviewColumns

# Sums that are added and taken off again are exact: scores as decimals.
EXACT = T.DecimalType(28, 9)

MICROS = 1_000_000


def moving_sums(
    df: DataFrame, keys: Sequence[str], at: str, width: int, values: Mapping[str, Column], earlier: Sequence[int] = ()
) -> DataFrame:
    """Sums over the last ``width`` units of a whole number ``at``, for each keys and value of ``at``.

    The sum over all rows of the keys whose ``at`` lies in [own - width, own], and
    for each number n in ``earlier`` also in [own - n - width, own - n], as
    ``name_n``. Rows of one place are folded first. Each enters the sum at its
    place and leaves it behind its place + width, so that a running sum over
    entries and exits is the sum over the frame, however many rows it spans.
    Rows without a place are left out.
    """
    exact = {name: F.coalesce(value.cast(EXACT), F.lit(0).cast(EXACT)) for name, value in values.items()}
    folded = df.filter(F.col(at).isNotNull()).groupBy(*keys, at).agg(*(F.sum(v).alias(n) for n, v in exact.items()))
    frames = {0: "", **{n: f"_{n}" for n in earlier}}
    out = [f"{name}{suffix}" for suffix in frames.values() for name in values]

    def steps(shift: int, sign: int, order: int, suffix: str) -> DataFrame:
        own = {f"{name}{suffix}": F.col(name) * sign for name in values}
        steps = [(own[name] if name in own else F.lit(0)).cast(EXACT).alias(name) for name in out]
        return folded.select(*keys, (F.col(at).cast("long") + shift).alias(at), F.lit(order).alias("__step"), *steps)

    changes = None
    for n, suffix in frames.items():  # what enters at a place counts there, what leaves counts there still
        for part in (steps(n, 1, 0, suffix), steps(n + width, -1, 2, suffix)):
            changes = part if changes is None else changes.unionByName(part)
    asked = folded.select(*keys, F.col(at).cast("long").alias(at), F.lit(1).alias("__step"), *(F.lit(0).cast(EXACT).alias(n) for n in out))
    steps_at = changes.unionByName(asked).groupBy(*keys, at, "__step").agg(*(F.sum(n).alias(f"__{n}") for n in out))
    chunked = range_chunks(steps_at, [*keys, at, "__step"], "__chunk")
    summed = running_sums(chunked, keys, [at, "__step"], {n: F.col(f"__{n}") for n in out}, "__chunk")
    return summed.filter("__step = 1").select(*keys, at, *out)


def moving_scores(df: DataFrame, days: int = 90, cols: ReviewColumns = REVIEWS) -> DataFrame:
    """Mean score of an entity over the last ``days`` days, on each day with reviews.

    Columns: the entity, Review_Day, Review_Count and Average_Score of the day,
    Moving_Count and Moving_Average over the ``days`` days that end with it,
    Earlier_Average over the ``days`` days before those (NULL if there is none),
    Change from the one to the other, Previous_Average and Next_Average of the
    entity's review days before and behind, and Total_Count up to the day.
    Reviews without score or valid date are left out.

    Reviews are folded to a row for each entity and day first, so a window over an
    entity is never longer than the calendar. A frame is the difference of two
    running sums, in exact decimals, so frames of any width cost the same.
    """
    scored = df.select(F.col(cols.entity).alias("entity"), day(df, cols.date).alias("day"), F.col(cols.score).cast(EXACT).alias("score"))
    daily = (
        scored.groupBy("entity", "day")
        .agg(F.count("score").alias("n"), F.sum("score").alias("total"))
        .filter("n > 0 and day is not null")
        .withColumn("at", F.unix_date("day"))
    )

    def mean(total: Column, n: Column) -> Column:
        return F.when(n > 0, total.cast("double") / n.cast("double"))

    order = Window.partitionBy("entity").orderBy("at")
    until = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = daily.withColumn("mean", mean(F.col("total"), F.col("n")))
    sums = own.select(
        "*",
        *(
            F.coalesce(F.sum(name).over(order.rangeBetween(Window.unboundedPreceding, -shift) if shift else until), F.lit(0)).alias(f"{name}_{shift}")
            for name in ("n", "total")
            for shift in (0, days, 2 * days)
        ),
        F.lag("mean").over(order).alias("previous"),
        F.lead("mean").over(order).alias("following"),
    )

    def frame(name: str, end: int) -> Column:
        """The sum over the ``days`` days up to ``end`` days ago."""
        kind = EXACT if name == "total" else "long"
        return F.col(f"{name}_{end}").cast(kind) - F.col(f"{name}_{end + days}").cast(kind)

    last, before = (mean(frame("total", end), frame("n", end)) for end in (0, days))
    return sums.select(
        F.col("entity").alias(cols.entity),
        F.col("day").alias("Review_Day"),
        F.col("n").alias("Review_Count"),
        F.col("mean").alias("Average_Score"),
        frame("n", 0).alias("Moving_Count"),
        last.alias("Moving_Average"),
        before.alias("Earlier_Average"),
        (last - before).alias("Change"),
        F.col("previous").alias("Previous_Average"),
        F.col("following").alias("Next_Average"),
        F.col("n_0").alias("Total_Count"),
    )


def review_history(df: DataFrame, tie: str, cols: ReviewColumns = REVIEWS) -> DataFrame:
    """Each review with its place in its entity's history.

    Reviews of an entity go by day, those of one day by ``tie``, which must tell
    them apart. Columns: the entity, ``tie``, Review_Day, the score, Review_Number
    (from 1), Running_Average of the scores so far, Previous_Score,
    Days_Since_Previous, Next_Score. Reviews without score or valid date are left out.
    """
    scored = df.select(
        F.col(cols.entity).alias("entity"),
        F.unix_date(day(df, cols.date)).alias("at"),
        F.col(tie).alias("tie"),
        F.col(cols.score).cast("double").alias("score"),
    ).filter("score is not null and at is not null")
    order = ["at", "tie"]
    chunked = range_chunks(scored, ["entity", *order])
    summed = running_sums(chunked, ["entity"], order, {"number": F.lit(1), "total": F.col("score").cast(EXACT)})
    before = carried(summed, ["entity"], order, {"previous": F.struct("at", "score")})
    both = carried(before, ["entity"], order, {"following": F.col("score")}, backward=True)
    return both.select(
        F.col("entity").alias(cols.entity),
        F.col("tie").alias(tie),
        F.date_from_unix_date("at").alias("Review_Day"),
        F.col("score").alias(cols.score),
        F.col("number").alias("Review_Number"),
        (F.col("total").cast("double") / F.col("number")).alias("Running_Average"),
        F.col("previous.score").alias("Previous_Score"),
        (F.col("at") - F.col("previous.at")).alias("Days_Since_Previous"),
        F.col("following").alias("Next_Score"),
    )


def moving_values(df: DataFrame, key: str, at: str, value: str, seconds: int) -> DataFrame:
    """Number and sum of the values of a key in the last ``seconds`` seconds, at each time stamp of it.

    Columns: key, at, Moving_Count, Moving_Sum. The frame has both ends.
    """
    rows = df.select(F.col(key).alias("key"), F.unix_micros(F.col(at).cast("timestamp")).alias("at"), F.col(value).alias("value"))
    counted = {"n": F.col("value").isNotNull().cast("long"), "total": F.col("value")}
    moving = moving_sums(rows, ["key"], "at", seconds * MICROS, counted)
    return moving.select(
        F.col("key").alias(key),
        F.timestamp_micros("at").alias(at),
        F.col("n").cast("long").alias("Moving_Count"),
        F.col("total").cast("double").alias("Moving_Sum"),
    )


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_at: str,
    right_at: str,
    take: Sequence[str],
    tie: str,
    strict: bool = False,
    within: Column | None = None,
    prefix: str = "Latest_",
) -> DataFrame:
    """All rows of ``left``, each with the latest row of ``right`` at or before it under the same keys.

    ``take`` are the columns of ``right`` that are added, as ``prefix`` + name;
    of rows of ``right`` at one time that of the greatest ``tie`` counts. With
    ``strict`` a row at the same time isn't earlier. ``within`` is the greatest
    difference in time (an interval). No match gives NULLs, and a NULL key or
    time never matches.

    Both sides are sorted into one order and cut into chunks; the last row of
    ``right`` is carried on within a chunk and over its border. So neither a
    hot key nor the pairs of a key ever meet in one task.
    """
    at, side = "__at", "__side"
    found = [*dict.fromkeys([right_at, *take])]
    kind = T.StructType([right.schema[name] for name in found])
    whole = F.struct(*(F.col(f"`{name}`") for name in left.columns))
    of_left = left.select(
        *(F.col(f"`{key}`").alias(f"__{key}") for key in keys),
        F.col(f"`{left_at}`").alias(at),
        F.lit(0 if strict else 2).alias(side),
        F.lit(None).cast(right.schema[tie].dataType).alias("__tie"),
        whole.alias("__left"),
        F.lit(None).cast(kind).alias("__right"),
    )
    of_right = right.select(
        *(F.col(f"`{key}`").alias(f"__{key}") for key in keys),
        F.col(f"`{right_at}`").alias(at),
        F.lit(1).alias(side),
        F.col(f"`{tie}`").alias("__tie"),
        F.lit(None).cast(T.StructType([f for f in left.schema])).alias("__left"),
        F.struct(*(F.col(f"`{name}`") for name in found)).cast(kind).alias("__right"),
    ).dropna(subset=[*(f"__{key}" for key in keys), at])
    own = [f"__{key}" for key in keys]
    order = [at, side, "__tie"]
    chunked = range_chunks(of_left.unionByName(of_right), [*own, *order], "__chunk")
    merged = carried(chunked, own, order, {"__found": F.col("__right")}, chunk="__chunk").filter(F.col(side) != 1)
    near = F.col("__found").isNotNull() & F.col(at).isNotNull()
    if within is not None:
        near &= F.col(f"__found.`{right_at}`") + within >= F.col(at)
    matched = F.when(near, F.col("__found"))
    return merged.select(
        *(F.col("__left")[name].alias(name) for name in left.columns), *(matched[name].alias(f"{prefix}{name}") for name in take)
    )
