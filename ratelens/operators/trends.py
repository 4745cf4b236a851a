"""Score trend of each entity over time."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.functions.parsing import day
from ratelens.sources.schema import REVIEWS, ReviewColumns


def _dated_scores(df: DataFrame, min_reviews: int, cols: ReviewColumns) -> DataFrame:
    """Day and score of the reviews of entities large enough to have a trend.

    The score is NULL where the date is not valid. Such rows are left to the
    aggregates, which skip NULL: a filter on the day would make Spark parse every
    date twice, once for the filter and once for the value.
    """
    if cols.entity_reviews in df.columns:
        df = df.filter(F.col(cols.entity_reviews) >= min_reviews)
    entity_score = F.col(cols.entity_score) if cols.entity_score in df.columns else F.lit(None)
    scored = df.filter(F.col(cols.score).isNotNull()).select(
        cols.entity,
        day(df, cols.date).alias("day"),
        F.col(cols.score).cast("double").alias("score"),
        entity_score.cast("double").alias("entity_score"),
    )
    return scored.withColumn("score", F.when(F.col("day").isNotNull(), F.col("score")))


def review_trends(df: DataFrame, min_number_of_reviews: int = 30, cols: ReviewColumns = REVIEWS) -> DataFrame:
    """Least-squares slope of the score over days, with count, means and date range.

    A table without an entity score or review count has NULL for the one and no
    pre-filter on the other. All of it is one hash aggregate: each task folds its
    reviews to a row per entity before the shuffle, so an entity with a third of
    all reviews costs a row per task. Entities whose reviews fall on a single day
    have slope 0.
    """
    return (
        _dated_scores(df, min_number_of_reviews, cols)
        .groupBy(cols.entity)
        .agg(
            F.coalesce(F.regr_slope("score", F.unix_date("day")), F.lit(0.0)).alias("Trend_Slope"),
            F.count("score").alias("Review_Count"),
            F.avg("score").alias("Average_Score_Calculated"),
            F.round(F.max("entity_score"), 1).alias("Average_Score"),
            F.min("day").alias("First_Review_Date"),
            F.max("day").alias("Last_Review_Date"),
        )
        .filter(F.col("Review_Count") >= max(min_number_of_reviews, 1))
    )


def grouped_map(
    df: DataFrame,
    keys: str | Sequence[str],
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema: T.StructType | str,
) -> DataFrame:
    """Run a pandas function on each group (0..n output rows per group).

    Spark hands a whole group to one task, so pass rows that are already folded
    to a bounded number per group, as :func:`review_trends_udf` does.
    """
    return df.groupBy(*([keys] if isinstance(keys, str) else keys)).applyInPandas(fn, schema=schema)


def review_trends_udf(df: DataFrame, min_number_of_reviews: int = 30, cols: ReviewColumns = REVIEWS) -> DataFrame:
    """:func:`review_trends` computed by a pandas function per entity.

    Reviews are folded to one row per entity and day before they reach Python.
    A group is then at most as long as the calendar, however hot the entity is;
    least squares over the daily sums gives the slope over the reviews.
    """
    entity = cols.entity

    def fit(daily: pd.DataFrame) -> pd.DataFrame:
        n = daily["n"].to_numpy(dtype=float)
        total = daily["total"].to_numpy(dtype=float)
        x = daily["day_number"].to_numpy(dtype=float)
        reviews, mean = n.sum(), total.sum() / n.sum()
        dx = x - (n @ x) / reviews
        spread = n @ (dx * dx)
        return pd.DataFrame(
            {
                entity: [daily[entity].iloc[0]],
                "Trend_Slope": [(dx @ total) / spread if spread > 0 else 0.0],
                "Review_Count": [int(reviews)],
                "Average_Score_Calculated": [mean],
                "Average_Score": [daily["entity_score"].max()],
                "First_Review_Date": [daily["day"].min()],
                "Last_Review_Date": [daily["day"].max()],
            }
        )

    daily = (
        _dated_scores(df, min_number_of_reviews, cols)
        .groupBy(entity, "day")
        .agg(
            F.count("score").alias("n"),
            F.sum("score").alias("total"),
            F.round(F.max("entity_score"), 1).alias("entity_score"),
        )
        .filter(F.col("n") > 0)
        .withColumn("day_number", F.unix_date("day"))
    )
    schema = T.StructType(
        [
            T.StructField(entity, df.schema[entity].dataType),
            T.StructField("Trend_Slope", T.DoubleType()),
            T.StructField("Review_Count", T.LongType()),
            T.StructField("Average_Score_Calculated", T.DoubleType()),
            T.StructField("Average_Score", T.DoubleType()),
            T.StructField("First_Review_Date", T.DateType()),
            T.StructField("Last_Review_Date", T.DateType()),
        ]
    )
    return grouped_map(daily, entity, fit, schema).filter(F.col("Review_Count") >= min_number_of_reviews)
