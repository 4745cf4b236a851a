"""Registered queries over the given tables, and their SQL counterparts."""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import series_queries  # noqa: E402
from expected_sql import DOCUMENT_PHRASES, DOCUMENT_TOPICS, expected_sql  # noqa: E402
from ratelens.functions.checkpoints import checkpoint_folder, checkpointed, shuffles_dropped  # noqa: E402
from ratelens.functions.text import HOTEL_TOPICS  # noqa: E402
from ratelens.operators.clustering import group_columns_in, segment_features, segment_kmeans, top_groups  # noqa: E402
from ratelens.operators.entities import top_hotels  # noqa: E402
from ratelens.operators.groups import (  # noqa: E402
    local_vs_tourist,
    nationality_bias,
    nationality_composition,
    reviewer_experience,
)
from ratelens.operators.proximity import local_competitiveness  # noqa: E402
from ratelens.operators.regions import top_hotels_by_nation  # noqa: E402
from ratelens.operators.regression import feature_names, satisfaction_regression  # noqa: E402
from ratelens.operators.seasons import seasonal_preferences  # noqa: E402
from ratelens.operators.tags import (  # noqa: E402
    stay_duration,
    tag_influence,
    tag_pattern_coverage,
    tag_pattern_sample,
)
from ratelens.operators.topics import (  # noqa: E402
    derived_sentiment,
    entity_reviews,
    negative_topic_frequency,
    review_text,
    topic_score_impact,
    topic_tagging,
    topic_trends,
)
from ratelens.operators.trends import review_trends, review_trends_udf  # noqa: E402
from ratelens.plans import shortlists as S  # noqa: E402
from ratelens.operators.topics import tagged as topic_tags  # noqa: E402
from ratelens.sources.files import dataset_row_count, read_reviews  # noqa: E402
from ratelens.sources.schema import REVIEW_SCHEMA, ReviewColumns  # noqa: E402
from ratelens.sources.star_schema import (  # noqa: E402
    STAR_REGIONS,
    document_reviews,
    document_topics,
    star_reviews,
    table,
)

try:  # the operators on training text are optional
    import corpus_pipeline  # noqa: E402
    import ratelens.llm.queries as llm  # noqa: E402
except ModuleNotFoundError as missing:  # them, or a package that only they need
    own = (missing.name or "").partition(".")[0] in ("ratelens", "series_queries", "expected_sql")
    if own and not missing.name.startswith("ratelens.llm"):
        raise
    llm = None

Query = Callable[[SparkSession, str], DataFrame]

# Traveller types that occur in the tags of the given tables.
STAR_TYPES = {"Hot": "hot", "Cold": "cold", "New": "new", "Old": "old", "Ring": "ring", "Gear": "gear"}

# Digits kept of a double: engines add up in different orders, and solvers of
# least squares agree to fewer digits than sums do.
DIGITS = 9
DIGITS_OF = {"Trend_Slope": 10, "Coefficient": 6}


def comparable(df: DataFrame) -> DataFrame:
    """Rounded doubles, dates and arrays as text, no ML vectors."""
    out = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            column = F.round(column, DIGITS_OF.get(field.name, DIGITS))
        elif isinstance(field.dataType, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, ",")
        elif field.dataType.typeName() == "vectorudt":
            continue
        out.append(column.alias(field.name))
    return df.select(*out)


# the analyses over the given tables


def trends(spark: SparkSession, sf_dir: str, analysis=review_trends) -> DataFrame:
    columns = ["Hotel_Name", "Review_Date", "Reviewer_Score", "Average_Score", "Total_Number_of_Reviews"]
    return analysis(star_reviews(spark, sf_dir, columns))


def user_value_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ReviewColumns(entity="user_id", date="ts", score="value")
    return review_trends(table(spark, sf_dir, "events"), cols=cols).drop("Average_Score")


def tags(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return tag_influence(star_reviews(spark, sf_dir, ["Tags", "Reviewer_Score"]), **options)


def stays(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return stay_duration(star_reviews(spark, sf_dir, ["Hotel_Name", "Tags", "Reviewer_Score"]), **options)


def bias(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    words = ["Review_Total_Positive_Word_Counts", "Review_Total_Negative_Word_Counts"]
    return nationality_bias(star_reviews(spark, sf_dir, ["Reviewer_Nationality", "Reviewer_Score", *words]), **options)


def composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nationality_composition(star_reviews(spark, sf_dir, ["Hotel_Name", "Reviewer_Nationality"]))


def compared(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    columns = ["Hotel_Name", "Hotel_Address", "Reviewer_Nationality", "Reviewer_Score"]
    return local_vs_tourist(star_reviews(spark, sf_dir, columns), two_word_regions=STAR_REGIONS, **options)


def experience(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    columns = ["Hotel_Name", "Reviewer_Score", "Total_Number_of_Reviews_Reviewer_Has_Given"]
    return reviewer_experience(star_reviews(spark, sf_dir, columns), novice_below=25, expert_above=50, **options)


def competitors(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return local_competitiveness(star_reviews(spark, sf_dir, ["Hotel_Name", "Average_Score", "lat", "lng"]), **options)


def by_nation(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    columns = ["Hotel_Name", "Hotel_Address", "Average_Score", "Total_Number_of_Reviews", "lat", "lng"]
    return top_hotels_by_nation(star_reviews(spark, sf_dir, columns), two_word_regions=STAR_REGIONS, **options)


def top_parts_by_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ReviewColumns(entity="p_partkey", address="p_brand", entity_score="p_size", entity_reviews="p_retailprice")
    return top_hotels_by_nation(table(spark, sf_dir, "part"), cols=cols)


def best_hotels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_hotels(star_reviews(spark, sf_dir, ["Hotel_Name", "Reviewer_Score"]))


def segments(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    columns = ["Hotel_Name", "Hotel_Address", "Review_Date", "Reviewer_Score", "Tags", "lat", "lng"]
    return seasonal_preferences(
        star_reviews(spark, sf_dir, columns), traveler_types=STAR_TYPES, two_word_regions=STAR_REGIONS, **options
    )


def _cluster_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_reviews(
        spark,
        sf_dir,
        [
            "Hotel_Name",
            "Average_Score",
            "Total_Number_of_Reviews",
            "Review_Total_Positive_Word_Counts",
            "Review_Total_Negative_Word_Counts",
            "lat",
            "lng",
            "Reviewer_Nationality",
        ],
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviews = _cluster_reviews(spark, sf_dir)
    return segment_features(reviews, use_location=True, groups=top_groups(reviews))


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_kmeans(
        _cluster_reviews(spark, sf_dir), use_verbosity=True, use_location=True, use_nationality=True
    )


def nationality_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    clustered = clusters(spark, sf_dir)
    return S.cluster_nationality_mix(clustered, group_columns_in(clustered))


def clusters_in_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds of any clustering: entities and clusters in all, and sums of the features."""
    sums = ["Avg_Score", "Total_Reviews", "Avg_Pos_Words", "Avg_Neg_Words", "Lat", "Lng"]
    return clusters(spark, sf_dir).agg(
        F.count("*").alias("Entities"),
        F.count_distinct("prediction").alias("Clusters"),
        *[F.sum(F.col(name).cast("double")).alias(f"Sum_{name}") for name in sums],
    )


def profile_in_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The means of the clusters, weighted by their entities: those over all entities."""
    means = ["Avg_Score", "Total_Reviews", "Avg_Pos_Words", "Avg_Neg_Words", "Lat", "Lng"]
    return S.cluster_profile(clusters(spark, sf_dir)).agg(
        F.sum("Count").alias("Entities"),
        *[(F.sum(F.col(name) * F.col("Count")) / F.sum("Count")).alias(name) for name in means],
    )


def mix_in_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean reviews of each reviewer group, times the entities of the clusters: all its reviews."""
    clustered = checkpointed(clusters(spark, sf_dir).drop("features_raw", "features"))
    counts = S.cluster_profile(clustered).select("prediction", "Count")
    return (
        S.cluster_nationality_mix(clustered, group_columns_in(clustered))
        .join(counts, "prediction")
        .groupBy("Nation")
        .agg(F.round(F.sum(F.col("Avg_Reviews_Count") * F.col("Count"))).cast("long").alias("Reviews"))
    )


def regression(spark: SparkSession, sf_dir: str):
    reviews = star_reviews(spark, sf_dir, [*feature_names(), "Reviewer_Score", "review_id"])
    return satisfaction_regression(reviews, in_training=F.pmod("review_id", F.lit(10)) < 8)


def nearest_centres(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """Entities in all, and those that no other centre is nearer to than their own."""
    clustered = segment_kmeans(_cluster_reviews(spark, sf_dir), **options)
    nearest = F.col("Centre_Distance") <= F.coalesce("Other_Distance", F.lit(float("inf"))) + 1e-9
    return clustered.agg(F.count("*").alias("Entities"), F.count_if(nearest).alias("At_Nearest_Centre"))


def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_topics(spark, sf_dir, DOCUMENT_TOPICS)


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topic_trends(document_topics(spark, sf_dir, DOCUMENT_PHRASES))


def hotel_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hotel topics of the parts' names, and the scores of the reviews of those parts."""
    parts = topic_tags(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name", HOTEL_TOPICS).drop("p_name")
    items = table(spark, sf_dir, "lineitem").select("l_partkey", (F.col("l_quantity") / 5.0).alias("Reviewer_Score"))
    return topic_score_impact(items.join(parts, F.col("l_partkey") == F.col("p_partkey")))


def from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews written to a CSV and read from it by the names in its header."""
    given = ["Hotel_Name", "Hotel_Address", "Review_Date", "Reviewer_Score", "Average_Score", "Tags", "lat", "lng", "Reviewer_Nationality"]
    reviews = star_reviews(spark, sf_dir, given)
    written = reviews.select(*(F.col(f.name) if f.name in given else F.lit(None).cast(f.dataType).alias(f.name) for f in reversed(REVIEW_SCHEMA)))
    folder = f"{checkpoint_folder(spark)}/reviews-{uuid.uuid4()}"
    with shuffles_dropped(spark):
        written.write.csv(folder, header=True, compression="gzip")
    return (
        read_reviews(spark, folder)
        .groupBy("Hotel_Name", "Hotel_Address")
        .agg(
            F.count("*").alias("Review_Count"),
            F.avg("Reviewer_Score").alias("Average_Score"),
            F.count_distinct("Tags").alias("Tag_Lists"),
            F.max("lat").alias("lat"),
            F.max(F.try_to_date("Review_Date", "M/d/yyyy")).alias("Last_Review_Date"),
        )
    )


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topic_tagging(document_reviews(spark, sf_dir), DOCUMENT_TOPICS)


def sentiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        derived_sentiment(review_text(document_reviews(spark, sf_dir)))
        .groupBy("Derived_Sentiment")
        .agg(F.count("*").alias("Review_Count"), F.avg("Reviewer_Score").alias("Average_Score"))
    )


def event_type_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("ts", F.array("event_type").alias("Topics"))
    return topic_trends(events, cols=ReviewColumns(date="ts")).filter(F.col("Topic").isNotNull())


def _then(analysis: Query, report: Callable[..., DataFrame], *args, **options) -> Query:
    return lambda spark, sf_dir: report(analysis(spark, sf_dir), *args, **options)


def _on(analysis: Query, report: Callable[..., DataFrame], *args, **options) -> Query:
    """A report on the unsorted rows of an analysis."""
    return lambda spark, sf_dir: report(analysis(spark, sf_dir, ordered=False), *args, **options)


def _registered() -> dict[str, Query]:
    tag_rows = ["Tags"]
    return {
        # trends
        "review_trends": trends,
        "review_trends_udf": lambda spark, sf_dir: trends(spark, sf_dir, review_trends_udf),
        "trend_direction": _then(trends, S.trend_direction),
        "trend_top_improving": _then(trends, S.trend_top_improving),
        "trend_top_declining": _then(trends, S.trend_top_declining),
        "user_value_trends": user_value_trends,
        # tags
        "tag_influence": tags,
        "tag_consensus_band": _on(tags, S.tag_consensus_band),
        "tag_top_positive": _on(tags, S.tag_top_positive),
        "tag_top_negative": _on(tags, S.tag_top_negative),
        "stay_duration": stays,
        "stay_category_delta": _on(stays, S.stay_category_delta),
        "stay_top_per_category": _on(stays, S.stay_top_per_category),
        "tag_pattern_coverage": lambda spark, sf_dir: tag_pattern_coverage(star_reviews(spark, sf_dir, tag_rows)),
        "tag_pattern_sample": lambda spark, sf_dir: tag_pattern_sample(star_reviews(spark, sf_dir, tag_rows)),
        # reviewer groups
        "nationality_bias": bias,
        "nationality_critics": _on(bias, S.nationality_critics, n=3),
        "nationality_generous": _on(bias, S.nationality_generous, n=3),
        "nationality_composition": composition,
        "local_vs_tourist": compared,
        "preference_delta_mean": _on(compared, S.preference_delta_mean),
        "local_favourites": _on(compared, S.local_favourites),
        "tourist_favourites": _on(compared, S.tourist_favourites),
        "nationality_summary_parse": _on(compared, S.nationality_summary_parse),
        "reviewer_experience": experience,
        "experience_gap_mean": _on(experience, S.experience_gap_mean),
        "experience_critics": _on(experience, S.experience_critics),
        "experience_fans": _on(experience, S.experience_fans),
        # neighbourhood, regions, maps
        "local_competitiveness": competitors,
        "local_competitiveness_halved": lambda spark, sf_dir: competitors(spark, sf_dir, pair_limit=16),
        "local_gems": _on(competitors, S.local_gems),
        "local_underperformers": _on(competitors, S.local_underperformers),
        "top_hotels_by_nation": by_nation,
        "top_hotels_by_nation_untied": lambda spark, sf_dir: by_nation(spark, sf_dir, ties="drop"),
        "map_centroid": _on(by_nation, S.map_centroid),
        "top_parts_by_brand": top_parts_by_brand,
        "top_hotels": best_hotels,
        "dataset_row_count": lambda spark, sf_dir: dataset_row_count(table(spark, sf_dir, "lineitem")),
        # seasons
        "seasonal_preferences": segments,
        "seasonal_select": _on(segments, S.seasonal_select, seasons=["Summer", "Winter"], types=["Hot", "Old"]),
        "season_entities": _on(segments, S.season_entities),
        "season_heatmap": _on(segments, S.season_heatmap),
        # models
        "segment_features": features,
        "segment_kmeans": clusters,
        "cluster_profile": _then(clusters, S.cluster_profile),
        "cluster_nationality_mix": nationality_mix,
        "segment_kmeans_in_all": clusters_in_all,
        "cluster_profile_in_all": profile_in_all,
        "cluster_nationality_mix_in_all": mix_in_all,
        "satisfaction_regression": lambda spark, sf_dir: regression(spark, sf_dir).coefficients,
        "satisfaction_metrics": lambda spark, sf_dir: regression(spark, sf_dir).metrics,
        # texts
        "entity_reviews": lambda spark, sf_dir: entity_reviews(document_reviews(spark, sf_dir), "src1"),
        "review_text": lambda spark, sf_dir: review_text(document_reviews(spark, sf_dir)),
        "derived_sentiment": sentiments,
        "topic_tagging": tagged,
        "negative_topic_frequency": _then(topics, negative_topic_frequency),
        "topic_trends": _then(topics, topic_trends),
        "topic_score_impact": _then(topics, topic_score_impact),
        "phrase_trends": phrases,
        "hotel_topic_impact": hotel_topics,
        "reviews_from_csv": from_csv,
        "segment_kmeans_nearest": lambda spark, sf_dir: nearest_centres(
            spark, sf_dir, use_verbosity=True, use_location=True, use_nationality=True
        ),
        "segment_kmeans_default_nearest": nearest_centres,
        "event_type_trends": event_type_trends,
    }


def entry(spark: SparkSession) -> DataFrame:
    """The best suppliers of each region, ties kept."""
    return by_nation(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    own = {name: _then(query, comparable) for name, query in (_registered() | series_queries.queries()).items()}
    return own | ({**llm.queries(), "pipeline": corpus_pipeline.run} if llm else {})


def oracle_sql() -> dict[str, str]:
    return expected_sql() | series_queries.expected() | (llm.oracle_sql() if llm else {})
