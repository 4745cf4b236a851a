"""Topics mentioned in review texts and what they do to the score."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.functions.calendar import month_label
from ratelens.functions.numeric import stable
from ratelens.functions.parsing import day
from ratelens.functions.text import HOTEL_TOPICS, joined_text, mentioned_words, sentiment, topics_of, words_of
from ratelens.sources.schema import REVIEWS, ReviewColumns

Dictionary = Mapping[str, Sequence[str]]


def entity_reviews(df: DataFrame, entity: str, limit: int = 50, cols: ReviewColumns = REVIEWS) -> DataFrame:
    """Date, score and texts of one entity's reviews, newest first."""
    out = [cols.date, cols.score, cols.negative_text, cols.positive_text]
    return (
        df.filter(F.col(cols.entity) == entity)
        .select(*out)
        .orderBy(day(df, cols.date).desc_nulls_last(), F.col(cols.score), cols.negative_text, cols.positive_text)
        .limit(limit)
    )


def review_text(df: DataFrame, cols: ReviewColumns = REVIEWS, keep: Sequence[str] = ()) -> DataFrame:
    """Date, score and whole text of each review that has one (plus the ``keep`` columns).

    The text is generated, not projected: a filter on a projected text would have
    Spark build it once for the filter and once for the value.
    """
    text = F.nullif(joined_text(F.col(cols.positive_text), F.col(cols.negative_text)), F.lit(""))
    generated = F.explode_outer(F.array(text)).alias("Review_Text")
    return df.select(*keep, cols.date, cols.score, generated).filter(F.col("Review_Text").isNotNull())


def derived_sentiment(df: DataFrame, cols: ReviewColumns = REVIEWS) -> DataFrame:
    """Add the sentiment that the score stands for."""
    return df.withColumn("Derived_Sentiment", sentiment(F.col(cols.score)))


def topic_tagging(
    df: DataFrame,
    dictionary: Dictionary = HOTEL_TOPICS,
    cols: ReviewColumns = REVIEWS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Text, sentiment and topics of each review.

    The whole text is split once and met with the dictionary, row by row and
    JVM-side: no explode of the words, no join and no shuffle. The topics of a
    large table are best written once and read by the reports below.
    """
    return tagged(derived_sentiment(review_text(df, cols, keep), cols), "Review_Text", dictionary)


def tagged(df: DataFrame, text: str, dictionary: Dictionary = HOTEL_TOPICS) -> DataFrame:
    """``df`` with the topics of a text column as ``Topics``.

    Where texts have to be joined to scores and dates, tag them first and drop
    the text: an exchange then carries a few topic names instead of it.
    """
    mentioned = mentioned_words(F.col("__words"), dictionary)
    return (
        df.withColumn("__words", words_of(F.col(text)))
        .withColumn("__mentioned", mentioned)
        .withColumn("Topics", topics_of(F.col("__mentioned"), dictionary))
        .drop("__words", "__mentioned")
    )


def _one_row_per_topic(enriched: DataFrame, topics: str, *keep: Column) -> DataFrame:
    """One row per mentioned topic. The outer explode keeps Spark from tagging every
    text twice, once for a filter on the number of topics."""
    return enriched.select(*keep, F.explode_outer(topics).alias("Topic")).filter(F.col("Topic").isNotNull())


def negative_topic_frequency(enriched: DataFrame, topics: str = "Topics") -> DataFrame:
    """How often each topic occurs in negative reviews."""
    return (
        _one_row_per_topic(enriched.filter(F.col("Derived_Sentiment") == "Negative"), topics)
        .groupBy("Topic")
        .agg(F.count("*").alias("Frequency"))
        .orderBy(F.col("Frequency").desc(), "Topic")
    )


def topic_trends(enriched: DataFrame, topics: str = "Topics", cols: ReviewColumns = REVIEWS) -> DataFrame:
    """Mentions of each topic per month. Reviews without a valid date have no month."""
    return (
        _one_row_per_topic(enriched, topics, month_label(day(enriched, cols.date)).alias("Month_Year"))
        .groupBy("Month_Year", "Topic")
        .agg(F.count("Month_Year").alias("Count"))  # 0 without a month
        .filter(F.col("Count") > 0)
        .orderBy("Month_Year", "Topic")
    )


def topic_score_impact(
    enriched: DataFrame, min_count: int = 2, topics: str = "Topics", cols: ReviewColumns = REVIEWS
) -> DataFrame:
    """Mean score of the reviews that mention a topic, against the mean of all reviews.

    The texts behind ``enriched`` are the bulk of the table, so they are read
    once: each review also adds a row without a topic, and the group of those
    rows is the mean of all reviews. The subquery folds the same groups as the
    main query, which lets Spark reuse its shuffle.
    """
    with_overall = F.explode(F.concat(F.coalesce(topics, F.array()), F.array(F.lit(None).cast("string"))))
    groups = (
        enriched.select(F.col(cols.score).cast("double").alias("score"), with_overall.alias("Topic"))
        .groupBy("Topic")
        .agg(F.sum("score").alias("total"), F.count("score").alias("Count"), F.count("Topic").alias("mentions"))
        .withColumn("Average_Score", F.try_divide("total", F.nullif("Count", F.lit(0))))
    )
    overall = groups.agg(F.max(F.when(F.col("mentions") == 0, F.col("Average_Score")))).scalar()
    return (
        groups.filter((F.col("mentions") > 0) & (F.col("Count") >= min_count))
        .select("Topic", "Average_Score", "Count", overall.alias("Global_Average"))
        .withColumn("Impact", F.col("Average_Score") - F.col("Global_Average"))
        .orderBy(stable("Impact"), "Topic")
    )
