"""Analyses of the multi-valued tags field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.functions.numeric import bins, stable
from ratelens.functions.parsing import STAY_TAG_LIKE, nights, one_row_per_tag, tag_list
from ratelens.sources.schema import REVIEWS, ReviewColumns

# Fixed value: damps the reliability of tags whose scores hardly vary.
RELIABILITY_DAMPING = 0.1

# Inclusive upper bound in nights and label of each stay length.
STAY_BINS = ((3, "Short Stay (1-3)"), (7, "Medium Stay (4-7)"))
LONG_STAY = "Long Stay (8+)"


def tag_influence(
    df: DataFrame, min_count: int = 50, cols: ReviewColumns = REVIEWS, ordered: bool = True
) -> DataFrame:
    """How far the mean score of each tag lies from the mean over all reviews.

    Only the score travels through the explode, and the exploded rows are folded
    in the same stage, so the shuffle carries one row per tag and task. Each
    review also adds one row without a tag; the group of those is the mean of all
    reviews. The subquery that looks it up names every measure, so that Spark
    reuses the shuffle of the main query. Without ``ordered`` the rows come
    unsorted, for a report on them.
    """
    with_marker = F.concat(
        F.array_compact(F.coalesce(tag_list(df, cols.tags), F.array())), F.array(F.lit(None).cast("string"))
    )
    per_tag = (
        df.select(cols.score, F.explode_outer(with_marker).alias("raw_tag"))
        .select(cols.score, F.trim("raw_tag").alias("Single_Tag"))
        .filter(F.col("Single_Tag").isNull() | (F.col("Single_Tag") != ""))
        .groupBy("Single_Tag")
        .agg(
            F.count(cols.score).alias("Count"),
            F.avg(cols.score).alias("Average_Score"),
            F.stddev_samp(cols.score).alias("StdDev_Score"),
            F.count("Single_Tag").alias("mentions"),
        )
    )
    every = F.max(F.when(F.col("mentions") == 0, F.struct("Average_Score", "Count", "StdDev_Score")))
    spread = F.col("StdDev_Score") + RELIABILITY_DAMPING
    result = (
        per_tag.filter((F.col("mentions") > 0) & (F.col("Count") >= min_count))
        .drop("mentions")
        .withColumn("Global_Average", per_tag.agg(every).scalar()["Average_Score"])
        .withColumn("Impact", F.col("Average_Score") - F.col("Global_Average"))
        .withColumn("Reliability_Index", F.ln("Count") / spread)
        .withColumn("Weighted_Impact", F.col("Impact") * F.col("Reliability_Index"))
    )
    return result.orderBy(stable("Weighted_Impact").desc(), "Single_Tag") if ordered else result


def stay_duration(
    df: DataFrame, min_reviews: int = 10, cols: ReviewColumns = REVIEWS, ordered: bool = True
) -> DataFrame:
    """Mean score per entity and length of stay, read from the stay tags.

    Tags without a number of nights fall into a group without a category, which
    is dropped after the aggregate: as a row filter the number would be extracted
    twice from each tag.
    """
    stays = (
        one_row_per_tag(df, cols.tags, [cols.entity, cols.score])
        .filter(F.col("Single_Tag").like(STAY_TAG_LIKE))
        .select(cols.entity, cols.score, nights(F.col("Single_Tag")).alias("nights"))
        .withColumn("Stay_Category", F.when(F.col("nights") > 0, bins(F.col("nights"), STAY_BINS, LONG_STAY)))
    )
    result = (
        stays.groupBy(cols.entity, "Stay_Category")
        .agg(
            F.avg(cols.score).alias("Avg_Score"),
            F.count(cols.score).alias("Review_Count"),
            F.avg("nights").alias("Avg_Nights_Actual"),
            F.count("Stay_Category").alias("stays"),
        )
        .filter((F.col("stays") > 0) & (F.col("Review_Count") >= min_reviews))
        .drop("stays")
    )
    return result.orderBy(stable("Avg_Score").desc(), cols.entity, "Stay_Category") if ordered else result


def _tags_text(df: DataFrame, cols: ReviewColumns) -> Column:
    """Tags as one text, of the raw form as of the typed one."""
    typed = isinstance(df.schema[cols.tags].dataType, T.ArrayType)
    return (F.array_join(cols.tags, ", ") if typed else F.col(cols.tags)).alias(cols.tags)


def tag_pattern_coverage(df: DataFrame, pattern: str = f"%{STAY_TAG_LIKE}", cols: ReviewColumns = REVIEWS) -> DataFrame:
    """Rows in all, rows whose tags text matches ``pattern``, and their percentage."""
    return df.agg(
        F.count("*").alias("Total_Rows"), F.count_if(_tags_text(df, cols).like(pattern)).alias("Matching_Rows")
    ).withColumn("Coverage_Pct", F.try_divide(F.col("Matching_Rows") * 100.0, F.col("Total_Rows")))


def tag_pattern_sample(
    df: DataFrame, pattern: str = f"%{STAY_TAG_LIKE}", n: int = 20, cols: ReviewColumns = REVIEWS
) -> DataFrame:
    """The first ``n`` matching tags texts in text order."""
    return df.select(_tags_text(df, cols)).filter(F.col(cols.tags).like(pattern)).orderBy(cols.tags).limit(n)
