"""Analyses from saved sums and new reviews only.

A state is a table of sums that can be stored and added up: an analysis of all
reviews so far needs the stored state and the state of the new reviews.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.functions.parsing import tag_list
from ratelens.operators.history import EXACT
from ratelens.operators.tags import RELIABILITY_DAMPING
from ratelens.operators.trends import _dated_scores
from ratelens.sources.schema import REVIEWS, ReviewColumns

WHOLE = "decimal(20,0)"


def trend_state(df: DataFrame, min_number_of_reviews: int = 30, cols: ReviewColumns = REVIEWS) -> DataFrame:
    """Exact sums of days and scores of each entity, enough for its trend."""
    scored = _dated_scores(df, min_number_of_reviews, cols).filter("score is not null")
    x, y = F.unix_date("day").cast("long"), F.col("score").cast(EXACT)
    return scored.groupBy(F.col(cols.entity).alias("Entity")).agg(
        F.count("*").alias("n"),
        F.sum(x).alias("x"),
        F.sum((x * x).cast(WHOLE)).alias("xx"),
        F.sum(y).alias("y"),
        F.sum(x.cast("decimal(9,0)") * y).alias("xy"),
        F.max("entity_score").alias("entity_score"),
        F.min("day").alias("first_day"),
        F.max("day").alias("last_day"),
    )


def tag_state(df: DataFrame, cols: ReviewColumns = REVIEWS) -> DataFrame:
    """Sums of the scores of each tag, and those of all reviews beside their first tag.

    A review without tags has the tag NULL; blank tags keep their row for the reviews' own sums.
    """
    rows = df.select(F.col(cols.score).alias("score"), F.posexplode_outer(tag_list(df, cols.tags)).alias("place", "raw"))
    score, first = F.col("score").cast(EXACT), F.coalesce(F.col("place"), F.lit(0)) == 0
    return rows.groupBy(F.trim("raw").alias("Single_Tag")).agg(
        F.count("score").alias("n"),
        F.sum(score).alias("total"),
        F.sum(F.col("score").cast("double") * F.col("score").cast("double")).alias("squares"),
        F.count(F.when(first, F.col("score"))).alias("reviews"),
        F.sum(F.when(first, score)).alias("reviews_total"),
    )


_ADDED = {"min": ("first_day",), "max": ("last_day", "entity_score")}


def merged(*states: DataFrame) -> DataFrame:
    """States of one kind added up: sums are added, first days and last days compared."""
    together = reduce(DataFrame.unionByName, states)
    key, *names = together.columns
    how = {name: F.min if name in _ADDED["min"] else F.max if name in _ADDED["max"] else F.sum for name in names}
    return together.groupBy(key).agg(*(how[name](name).alias(name) for name in names)).to(states[0].schema)


def trends_of(state: DataFrame, min_number_of_reviews: int = 30, cols: ReviewColumns = REVIEWS) -> DataFrame:
    """What :func:`ratelens.operators.trends.review_trends` gives, from a state."""
    n = F.col("n").cast(WHOLE)
    spread = (n * F.col("xx") - F.col("x").cast(WHOLE) * F.col("x").cast(WHOLE)).cast("double")
    joint = n * F.col("xy") - F.col("x").cast(WHOLE) * F.col("y")
    return state.filter(F.col("n") >= max(min_number_of_reviews, 1)).select(
        F.col("Entity").alias(cols.entity),
        F.when(spread > 0, joint.cast("double") / spread).otherwise(0.0).alias("Trend_Slope"),
        F.col("n").alias("Review_Count"),
        (F.col("y").cast("double") / F.col("n")).alias("Average_Score_Calculated"),
        F.round("entity_score", 1).alias("Average_Score"),
        F.col("first_day").alias("First_Review_Date"),
        F.col("last_day").alias("Last_Review_Date"),
    )


def tag_influence_of(state: DataFrame, min_count: int = 50) -> DataFrame:
    """What :func:`ratelens.operators.tags.tag_influence` gives, unsorted, from a state."""
    n, total, squares = F.col("n"), F.col("total").cast("double"), F.col("squares")
    apart = squares - total * total / n
    spread = F.when(n > 1, F.sqrt(F.when(apart > 1e-11 * squares, apart).otherwise(0.0) / (n - 1)))  # below that it is rounding
    mean = state.agg((F.sum("reviews_total").cast("double") / F.sum("reviews"))).scalar()
    return (
        state.filter((F.col("Single_Tag") != "") & (n >= min_count))
        .select(
            "Single_Tag",
            n.alias("Count"),
            (total / n).alias("Average_Score"),
            spread.alias("StdDev_Score"),
            mean.alias("Global_Average"),
        )
        .withColumn("Impact", F.col("Average_Score") - F.col("Global_Average"))
        .withColumn("Reliability_Index", F.ln("Count") / (F.col("StdDev_Score") + RELIABILITY_DAMPING))
        .withColumn("Weighted_Impact", F.col("Impact") * F.col("Reliability_Index"))
    )
