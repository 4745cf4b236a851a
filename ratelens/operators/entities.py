"""The entity view of a review table: one row per entity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.functions.geo import one_place
from ratelens.functions.numeric import stable
from ratelens.functions.parsing import number
from ratelens.sources.schema import REVIEWS, ReviewColumns


def entities(df: DataFrame, attributes: dict[str, str], cols: ReviewColumns = REVIEWS) -> DataFrame:
    """One row per entity with its denormalised ``attributes`` (output name -> source column).

    An attribute that is not constant resolves to its greatest value; NULL is
    ignored. Latitude and longitude resolve as a pair, to the greatest place of
    one row, if both are asked for. Text attributes are grouping keys of a first aggregate, because a
    text buffer would force a sort of every review: the first aggregate hashes
    and collapses the reviews map-side, the second sees a row per entity (or a
    few, where a text attribute varies).
    """
    texts = [
        name
        for name, source in attributes.items()
        if isinstance(df.schema[source].dataType, T.StringType) and source not in (cols.lat, cols.lng)
    ]
    measures = [name for name in attributes if name not in texts]

    def value(name: str):
        source = attributes[name]
        return number(df, source) if source in (cols.lat, cols.lng) else F.col(source)

    names_of = {source: name for name, source in attributes.items()}
    pair = [names_of[source] for source in (cols.lat, cols.lng) if source in names_of]

    def greatest(names):
        places = one_place(*map(F.col, pair)) if len(pair) == 2 else [F.max(name) for name in pair]
        place = dict(zip(pair, places, strict=True))
        return [place.get(name, F.max(name)).alias(name) for name in names]

    rows = df.select(cols.entity, *[value(name).alias(name) for name in attributes])
    if not texts:
        return rows.groupBy(cols.entity).agg(*greatest(measures))
    if measures:
        rows = rows.groupBy(cols.entity, *texts).agg(*greatest(measures))
    else:
        rows = rows.distinct()
    return rows.groupBy(cols.entity).agg(*greatest(attributes))


def top_hotels(
    df: DataFrame, num_results: int = 10, min_reviews: int = 20, cols: ReviewColumns = REVIEWS
) -> DataFrame:
    """Entities with the best mean review score, among those with enough reviews."""
    return (
        df.groupBy(cols.entity)
        .agg(F.avg(cols.score).alias("Average_Score"), F.count(cols.score).alias("Review_Count"))
        .filter(F.col("Review_Count") >= min_reviews)
        .orderBy(stable("Average_Score").desc(), cols.entity)
        .limit(num_results)
    )
