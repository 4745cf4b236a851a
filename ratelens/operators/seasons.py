"""Scores by season and type of traveller."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.functions.calendar import season
from ratelens.functions.numeric import stable
from ratelens.functions.geo import one_place
from ratelens.functions.parsing import day, number, region_of
from ratelens.sources.schema import REVIEWS, ReviewColumns

# Traveller types with the text that marks them in the tags.
TRAVELER_TYPES = {
    "Business": "business",
    "Family": "family",
    "Couple": "couple",
    "Solo": "solo",
    "Group": "group",
    "Leisure": "leisure",
}
ANY_TRAVELER = "Other"


def seasonal_preferences(
    df: DataFrame,
    min_reviews: int = 10,
    traveler_types: Mapping[str, str] = TRAVELER_TYPES,
    two_word_regions: dict[str, str] | None = None,
    cols: ReviewColumns = REVIEWS,
    ordered: bool = True,
) -> DataFrame:
    """Mean score per entity, season and traveller type; ``Other`` covers all reviews.

    A review counts for every type whose mark occurs in its tags. Instead of
    copying it once per type, one aggregate keeps a sum and a count per type side
    by side; the types become rows only after the reviews are folded to a row per
    entity and season. Without ``ordered`` the rows come unsorted, for a report on them.
    """
    tags = F.col(cols.tags)
    if isinstance(df.schema[cols.tags].dataType, T.ArrayType):
        tags = F.array_join(tags, ",")
    marks = {name: F.col("tags").contains(mark.lower()) for name, mark in traveler_types.items()}
    marks[ANY_TRAVELER] = F.lit(True)
    reviews = df.select(
        cols.entity,
        cols.address,
        season(day(df, cols.date)).alias("Season"),
        F.col(cols.score).cast("double").alias("score"),
        F.lower(tags).alias("tags"),
        number(df, cols.lat).alias("lat"),
        number(df, cols.lng).alias("lng"),
    ).withColumns({f"score_{i}": F.when(mark, F.col("score")) for i, mark in enumerate(marks.values())})
    measures, segments = [], []
    for i, (name, mark) in enumerate(marks.items()):
        total, count, rows = f"total_{i}", f"count_{i}", f"rows_{i}"
        measures += [F.sum(f"score_{i}").alias(total), F.count(f"score_{i}").alias(count)]
        if min_reviews < 1:  # otherwise a segment that is kept has a review
            measures.append(F.count_if(mark).alias(rows))
        segments.append(
            F.struct(
                F.lit(name).alias("Traveler_Type"),
                F.try_divide(total, F.nullif(count, F.lit(0))).alias("Avg_Score"),
                F.col(count).alias("Review_Count"),
                F.col(rows if min_reviews < 1 else count).alias("rows"),
            )
        )
    lat, lng = one_place(F.col("lat"), F.col("lng"))
    result = (
        reviews.groupBy(cols.entity, cols.address, "Season")
        .agg(*measures, lat.alias("lat"), lng.alias("lng"))
        .select(cols.entity, cols.address, "Season", "lat", "lng", F.inline(F.array(*segments)))
        .filter((F.col("rows") > 0) & (F.col("Review_Count") >= min_reviews))
        .select(
            cols.entity,
            cols.address,
            "Season",
            "Traveler_Type",
            "Avg_Score",
            "Review_Count",
            "lat",
            "lng",
            region_of(cols.address, two_word_regions).alias("Nation"),
        )
    )
    order = [stable("Avg_Score").desc(), cols.entity, cols.address, "Season", "Traveler_Type"]
    return result.orderBy(*order) if ordered else result
