"""Reports on top of the analyses: labels, shortlists, profiles and grids.

Each takes the result of an analysis and stays in Spark; only the rows of a
report reach the caller.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelens.functions.calendar import SEASONS
from ratelens.functions.numeric import stable
from ratelens.functions.parsing import number
from ratelens.sources.schema import REVIEWS, ReviewColumns

# A slope is points per day, so its meaningful digits start far behind the point.
SLOPE_DIGITS = 12

# Names of the two lists of favourites.
LOCAL_FAVOURITES = "Local Favorites"
TOURIST_FAVOURITES = "Tourist Favorites"

# Fixed value: how one reviewer group reads in a composition text.
GROUP_SHARE_REGEX = r"^(.*) \((\d+)%\)$"


def _top(df: DataFrame, order: Sequence[Column], n: int, where: Column | None = None) -> DataFrame:
    return (df if where is None else df.filter(where)).orderBy(*order).limit(n)


# trends


def trend_direction(trends: DataFrame) -> DataFrame:
    """Add whether the score of each entity is rising, falling or stable."""
    slope = stable("Trend_Slope", SLOPE_DIGITS)
    return trends.withColumn(
        "Trend_Direction", F.when(slope > 0, "Rising").when(slope < 0, "Falling").otherwise("Stable")
    )


def trend_top_improving(trends: DataFrame, n: int = 10, cols: ReviewColumns = REVIEWS) -> DataFrame:
    slope = stable("Trend_Slope", SLOPE_DIGITS)
    return _top(trends, [slope.desc(), F.col(cols.entity)], n, slope > 0)


def trend_top_declining(trends: DataFrame, n: int = 10, cols: ReviewColumns = REVIEWS) -> DataFrame:
    slope = stable("Trend_Slope", SLOPE_DIGITS)
    return _top(trends, [slope.asc(), F.col(cols.entity)], n, slope < 0)


# tags


def tag_consensus_band(tags: DataFrame) -> DataFrame:
    """Add how much reviewers agree on each tag: spread below 1, from 1 to 2, above 2."""
    spread = F.col("StdDev_Score")
    return tags.withColumn(
        "Consensus", F.when(spread < 1, "Strong consensus").when(spread <= 2, "Normal").when(spread > 2, "Controversial")
    )


def tag_top_positive(tags: DataFrame, n: int = 10) -> DataFrame:
    return _top(tags, [stable("Weighted_Impact").desc(), F.col("Single_Tag")], n, stable("Impact") > 0)


def tag_top_negative(tags: DataFrame, n: int = 10) -> DataFrame:
    return _top(tags, [stable("Weighted_Impact").asc_nulls_last(), F.col("Single_Tag")], n, stable("Impact") < 0)


# reviewer groups


def nationality_critics(bias: DataFrame, n: int = 10, cols: ReviewColumns = REVIEWS) -> DataFrame:
    return _top(bias, [stable("Score_Deviation").asc_nulls_last(), F.col(cols.group)], n)


def nationality_generous(bias: DataFrame, n: int = 10, cols: ReviewColumns = REVIEWS) -> DataFrame:
    return _top(bias, [stable("Score_Deviation").desc(), F.col(cols.group)], n)


def preference_delta_mean(compared: DataFrame) -> DataFrame:
    return compared.agg(F.avg("Preference_Delta").alias("Avg_Preference_Delta"))


def local_favourites(compared: DataFrame, n: int = 10, cols: ReviewColumns = REVIEWS) -> DataFrame:
    return _top(compared, [stable("Preference_Delta").desc(), F.col(cols.entity)], n)


def tourist_favourites(compared: DataFrame, n: int = 10, cols: ReviewColumns = REVIEWS) -> DataFrame:
    return _top(compared, [stable("Preference_Delta").asc_nulls_last(), F.col(cols.entity)], n)


def nationality_shares(compared: DataFrame, category: str, cols: ReviewColumns = REVIEWS) -> DataFrame:
    """Rows (entity, nation, percentage) read back from composition texts; malformed parts are skipped."""
    parts = compared.select(cols.entity, F.explode(F.split("Top_Nationalities", ", ")).alias("part"))
    return parts.filter(F.col("part").rlike(GROUP_SHARE_REGEX)).select(
        cols.entity,
        F.regexp_extract("part", GROUP_SHARE_REGEX, 1).alias("Nation"),
        F.regexp_extract("part", GROUP_SHARE_REGEX, 2).try_cast("double").alias("Percentage"),
        F.lit(category).alias("Category"),
    )


def nationality_summary_parse(compared: DataFrame, n: int = 10, cols: ReviewColumns = REVIEWS) -> DataFrame:
    """Composition of the local and of the tourist favourites, as one table."""
    return nationality_shares(local_favourites(compared, n, cols), LOCAL_FAVOURITES, cols).unionByName(
        nationality_shares(tourist_favourites(compared, n, cols), TOURIST_FAVOURITES, cols)
    )


def experience_gap_mean(experience: DataFrame) -> DataFrame:
    return experience.agg(F.avg("Experience_Gap").alias("Avg_Experience_Gap"))


def experience_critics(experience: DataFrame, n: int = 10, cols: ReviewColumns = REVIEWS) -> DataFrame:
    return _top(experience, [stable("Experience_Gap").asc_nulls_last(), F.col(cols.entity)], n)


def experience_fans(experience: DataFrame, n: int = 10, cols: ReviewColumns = REVIEWS) -> DataFrame:
    return _top(experience, [stable("Experience_Gap").desc(), F.col(cols.entity)], n)


# neighbourhood and maps


def local_gems(competitors: DataFrame, n: int = 10, cols: ReviewColumns = REVIEWS) -> DataFrame:
    delta = stable("Score_Delta")
    return _top(competitors, [delta.desc(), F.col(cols.entity)], n, delta > 0)


def local_underperformers(competitors: DataFrame, n: int = 10, cols: ReviewColumns = REVIEWS) -> DataFrame:
    delta = stable("Score_Delta")
    return _top(competitors, [delta.asc(), F.col(cols.entity)], n, delta < 0)


def map_centroid(df: DataFrame, lat: str = "lat", lng: str = "lng") -> DataFrame:
    """Middle of the rows that have coordinates."""
    points = df.select(number(df, lat).alias("lat"), number(df, lng).alias("lng")).dropna()
    return points.agg(
        F.avg("lat").alias("Center_Lat"), F.avg("lng").alias("Center_Lng"), F.count("*").alias("Point_Count")
    )


# clusters


def cluster_profile(clustered: DataFrame) -> DataFrame:
    """Mean features and number of entities of each cluster."""
    means = ["Avg_Score", "Total_Reviews", "Avg_Pos_Words", "Avg_Neg_Words", "Lat", "Lng"]
    profile = clustered.groupBy("prediction").agg(F.count("*").alias("Count"), *[F.avg(c).alias(c) for c in means])
    return profile.withColumn("Cluster_Name", F.concat(F.lit("Cluster "), F.col("prediction")))


def cluster_nationality_mix(clustered: DataFrame, nationalities: Sequence[str]) -> DataFrame:
    """Mean reviews per entity from each reviewer group, by cluster, and its share within the cluster."""
    means = clustered.groupBy("prediction").agg(
        *[F.avg(F.coalesce(F.col(c).cast("double"), F.lit(0.0))).alias(c) for c in nationalities]
    )
    long = means.unpivot("prediction", list(nationalities), "Nation", "Avg_Reviews_Count")
    in_cluster = F.sum("Avg_Reviews_Count").over(Window.partitionBy("prediction"))
    return long.withColumn("Share", F.try_divide("Avg_Reviews_Count", F.nullif(in_cluster, F.lit(0.0))))


# seasons


def seasonal_select(
    segments: DataFrame,
    seasons: Sequence[str] = (),
    types: Sequence[str] = (),
    n: int = 20,
    cols: ReviewColumns = REVIEWS,
) -> DataFrame:
    """Best segments of the chosen seasons and traveller types; an empty choice means all."""
    if seasons:
        segments = segments.filter(F.col("Season").isin(*seasons))
    if types:
        segments = segments.filter(F.col("Traveler_Type").isin(*types))
    order = [stable("Avg_Score").desc(), F.col(cols.entity), F.col(cols.address), F.col("Season"), F.col("Traveler_Type")]
    return _top(segments, order, n)


def season_entities(segments: DataFrame, cols: ReviewColumns = REVIEWS) -> DataFrame:
    """The entities that have a segment, to choose one from."""
    return segments.select(cols.entity).distinct()


def season_heatmap(segments: DataFrame, entity: str | None = None, cols: ReviewColumns = REVIEWS) -> DataFrame:
    """Grid of mean scores, one row per traveller type and one column per season.

    For one entity, or for all of them.
    """
    if entity is not None:
        segments = segments.filter(F.col(cols.entity) == entity)
    cells = [F.max(F.when(F.col("Season") == name, F.col("Avg_Score"))).alias(name) for name in SEASONS]
    return segments.groupBy(cols.entity, cols.address, "Traveler_Type").agg(*cells)


# stays


def stay_category_delta(stays: DataFrame) -> DataFrame:
    """Mean of the entity means per stay length, against the mean over the stay lengths."""
    means = stays.groupBy("Stay_Category").agg(F.avg("Avg_Score").alias("Avg_Score"))
    return means.withColumn("Overall_Mean", means.agg(F.avg("Avg_Score")).scalar()).withColumn(
        "Delta", F.col("Avg_Score") - F.col("Overall_Mean")
    )


def stay_top_per_category(stays: DataFrame, n: int = 5, cols: ReviewColumns = REVIEWS) -> DataFrame:
    """The best entities for each length of stay."""
    best_first = Window.partitionBy("Stay_Category").orderBy(stable("Avg_Score").desc(), cols.entity)
    return stays.withColumn("Position", F.row_number().over(best_first)).filter(F.col("Position") <= n)
