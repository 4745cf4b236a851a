"""Segmentation of entities by k-means."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.functions.checkpoints import checkpointed
from ratelens.functions.geo import one_place, unit_sphere
from ratelens.functions.parsing import number
from ratelens.sources.schema import REVIEWS, ReviewColumns

TOP_GROUPS = 10

FEATURE_COLUMNS = ("Avg_Score", "Total_Reviews", "Avg_Pos_Words", "Avg_Neg_Words", "Lat", "Lng", "x", "y", "z")
RESULT_COLUMNS = ("features_raw", "features", "prediction", "Centre_Distance", "Other_Distance")

# Partitions of the entities in a fit.
PARTITIONS = 32


def folded_reviews(df: DataFrame, cols: ReviewColumns = REVIEWS) -> DataFrame:
    """A row for each entity and reviewer group: all that features and frequent groups need of the reviews."""
    place = one_place(F.col("lat"), F.col("lng"))
    rows = df.select(
        F.col(cols.entity).alias("entity"),
        F.trim(cols.group).alias("group") if cols.group in df.columns else F.lit(None).cast("string").alias("group"),
        F.col(cols.entity_score).cast("double").alias("score"),
        F.col(cols.entity_reviews).alias("reviews"),
        F.col(cols.positive_words).alias("pos"),
        F.col(cols.negative_words).alias("neg"),
        number(df, cols.lat).alias("lat"),
        number(df, cols.lng).alias("lng"),
    )
    return rows.groupBy("entity", "group").agg(
        F.count("*").alias("n"),
        F.max("score").alias("score"),
        F.max("reviews").alias("reviews"),
        *(f(name).alias(f"{name}_{kind}") for name in ("pos", "neg") for kind, f in (("sum", F.sum), ("n", F.count))),
        *(column.alias(name) for column, name in zip(place, ("lat", "lng"), strict=True)),
    )


def top_groups(df: DataFrame, n: int = TOP_GROUPS, cols: ReviewColumns = REVIEWS) -> list[str]:
    """The ``n`` most frequent reviewer groups (a list of n names reaches the driver)."""
    return _top_groups(df.groupBy(F.trim(cols.group).alias("group")).agg(F.count("*").alias("n")), n)


def _top_groups(folded: DataFrame, n: int) -> list[str]:
    ranked = folded.filter(F.col("group") != "").groupBy("group").agg(F.sum("n").alias("n"))
    return [row["group"] for row in ranked.orderBy(F.col("n").desc(), "group").limit(n).collect()]


def group_columns(groups: list[str]) -> dict[str, str]:
    """Column name of each reviewer group: without dots, which would read as nested fields, and different from all others."""
    taken = {name.lower() for name in (*FEATURE_COLUMNS, *RESULT_COLUMNS, "entity")}
    out = {}
    for group in groups:
        name = group.replace(".", "")
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out[group] = name
    return out


def group_columns_in(clustered: DataFrame, cols: ReviewColumns = REVIEWS) -> list[str]:
    """The columns of a clustering result that count reviews of a reviewer group."""
    return [name for name in clustered.columns if name not in (cols.entity, *FEATURE_COLUMNS, *RESULT_COLUMNS)]


def segment_features(
    df: DataFrame, use_location: bool = False, groups: list[str] | None = None, cols: ReviewColumns = REVIEWS
) -> DataFrame:
    """One feature row per entity, with the review counts of the given reviewer groups."""
    return _features(folded_reviews(df, cols), use_location, groups, cols)


def _features(folded: DataFrame, use_location: bool, groups: list[str] | None, cols: ReviewColumns) -> DataFrame:
    own = F.col("group")
    counts = [F.sum(F.when(own == name, F.col("n")).otherwise(0)).alias(column) for name, column in group_columns(groups or []).items()]
    lat, lng = one_place(F.col("lat"), F.col("lng"))
    features = folded.groupBy(F.col("entity").alias(cols.entity)).agg(
        F.max("score").alias("Avg_Score"),
        F.max("reviews").alias("Total_Reviews"),
        *(
            F.try_divide(F.sum(f"{name}_sum"), F.nullif(F.sum(f"{name}_n"), F.lit(0))).alias(f"Avg_{title}_Words")
            for name, title in (("pos", "Pos"), ("neg", "Neg"))
        ),
        lat.alias("Lat"),
        lng.alias("Lng"),
        *counts,
    )
    if use_location:
        features = features.dropna(subset=["Lat", "Lng"]).withColumns(unit_sphere(F.col("Lat"), F.col("Lng")))
    if groups:
        features = features.na.fill(0, subset=["Avg_Score", "Total_Reviews", "Avg_Pos_Words", "Avg_Neg_Words"])
    return features


def segment_kmeans(
    df: DataFrame,
    k: int = 4,
    use_score: bool = True,
    use_popularity: bool = True,
    use_verbosity: bool = False,
    use_location: bool = False,
    use_nationality: bool = False,
    n_groups: int = TOP_GROUPS,
    seed: int = 1,
    cols: ReviewColumns = REVIEWS,
) -> DataFrame:
    """Cluster the entities on the chosen standardised features.

    Adds ``prediction``, Centre_Distance (to the entity's own centre) and
    Other_Distance (to the nearest other one; NULL if there is no other). The reviews are read once:
    frequent groups and features both come from their fold by entity and group.
    The fit starts from the entities in a fixed order, so that the result doesn't
    depend on how the reviews are partitioned.
    """
    folded = checkpointed(folded_reviews(df, cols))
    groups = _top_groups(folded, n_groups) if use_nationality else []
    inputs = [
        *(["Avg_Score"] if use_score else []),
        *(["Total_Reviews"] if use_popularity else []),
        *(["Avg_Pos_Words", "Avg_Neg_Words"] if use_verbosity else []),
        *(["x", "y", "z"] if use_location else []),
        *group_columns(groups).values(),
    ]
    if not inputs:
        raise ValueError("choose at least one feature to cluster on")
    features = _features(folded, use_location, groups, cols)
    # The fit reads the features many times; its start depends on their partitions and order.
    features = checkpointed(features.repartition(PARTITIONS, cols.entity).sortWithinPartitions(cols.entity))
    pipeline = Pipeline(
        stages=[
            VectorAssembler(inputCols=inputs, outputCol="features_raw"),
            StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True),
            KMeans(featuresCol="features", k=k, seed=seed),
        ]
    )
    model = pipeline.fit(features)
    centres = [F.array(*(F.lit(float(x)) for x in centre)) for centre in model.stages[-1].clusterCenters()]
    own = vector_to_array("features")
    apart = [F.sqrt(F.aggregate(F.zip_with(own, c, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x)) for c in centres]
    others = [F.when(F.col("prediction") != i, distance) for i, distance in enumerate(apart)]
    return model.transform(features).withColumns(
        {
            "Centre_Distance": F.get(F.array(*apart), F.col("prediction")),
            "Other_Distance": F.array_min(F.array(*others)),
        }
    )
