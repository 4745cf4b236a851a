"""Comparisons between groups of reviewers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.functions.checkpoints import checkpointed
from ratelens.functions.numeric import avg_where, count_where, stable
from ratelens.functions.parsing import region_of
from ratelens.sources.schema import REVIEWS, ReviewColumns

# Smallest share, in percent, that a composition text names.
PCT_FLOOR = 2


def nationality_bias(
    df: DataFrame, min_reviews: int = 50, cols: ReviewColumns = REVIEWS, ordered: bool = True
) -> DataFrame:
    """How generous each reviewer group is, against the mean over all reviews.

    Reviews without a group are folded like the others, so that the mean over
    all comes from the groups. The subquery sums every measure, which lets Spark
    reuse the shuffle of the main query. Without ``ordered`` the rows come
    unsorted, for a report on them.
    """
    measures = {"score": cols.score, "positive": cols.positive_words, "negative": cols.negative_words}
    groups = (
        df.groupBy(F.trim(cols.group).alias(cols.group))
        .agg(
            F.count(F.nullif(F.trim(cols.group), F.lit(""))).alias("named"),
            *[F.sum(F.col(source).cast("double")).alias(f"{name}_total") for name, source in measures.items()],
            *[F.count(source).alias(f"{name}_count") for name, source in measures.items()],
        )
    )
    sums = [F.sum(name).alias(name) for name in groups.columns[1:]]
    every = groups.agg(F.struct(*sums)).scalar()

    def mean(total: Column, count: Column) -> Column:
        return F.try_divide(total, F.nullif(count, F.lit(0)))

    total_words = F.col("Total_Words_Avg")
    result = (
        groups.filter((F.col("named") > 0) & (F.col("score_count") >= min_reviews))
        .select(
            cols.group,
            F.col("score_count").alias("Count"),
            mean(F.col("score_total"), F.col("score_count")).alias("Average_Score"),
            mean(F.col("positive_total"), F.col("positive_count")).alias("Avg_Positive_Words"),
            mean(F.col("negative_total"), F.col("negative_count")).alias("Avg_Negative_Words"),
            mean(every["score_total"], every["score_count"]).alias("Global_Average"),
        )
        .withColumn("Score_Deviation", F.col("Average_Score") - F.col("Global_Average"))
        .withColumn("Total_Words_Avg", F.col("Avg_Positive_Words") + F.col("Avg_Negative_Words"))
        .withColumn(
            "Sentiment_Ratio",
            F.coalesce(F.try_divide("Avg_Positive_Words", F.nullif(total_words, F.lit(0.0))), F.lit(0.0)),
        )
    )
    return result.orderBy(stable("Score_Deviation").desc(), cols.group) if ordered else result


def nationality_composition(df: DataFrame, pct_floor: int = PCT_FLOOR, cols: ReviewColumns = REVIEWS) -> DataFrame:
    """Reviewer groups of each entity as one text, ``"A (45%), B (21%)"``, largest first.

    Reviews are folded to a row per entity and group before anything is put
    together. Totals come from those rows and are joined back, so no task needs
    all groups of an entity at once; Spark picks the join by the real sizes and
    splits a hot entity. A floor of p percent, 1 at least, leaves at most 100/p
    names per text. Percentages are whole, rounded down exactly.
    """
    if pct_floor < 1:
        raise ValueError("a floor under 1 percent would put all groups of an entity into one row")
    counts = df.groupBy(cols.entity, F.trim(cols.group).alias("name")).agg(F.count("*").alias("n"))
    return _composition(counts, pct_floor, cols)


def _composition(counts: DataFrame, pct_floor: int, cols: ReviewColumns) -> DataFrame:
    """The texts, from rows (entity, name, n); groups without a name are left out."""
    counts = counts.filter(F.col("name").isNotNull())
    totals = counts.groupBy(cols.entity).agg(F.sum("n").alias("total"))
    percent = F.expr("cast(n * 100 div total as int)")
    named = (
        counts.join(totals, cols.entity)
        .select(cols.entity, "name", percent.alias("percent"))
        .filter(F.col("percent") >= pct_floor)
    )
    largest_first = F.sort_array(F.collect_list(F.struct((-F.col("percent")).alias("rank"), "name", "percent")))
    return (
        named.groupBy(cols.entity)
        .agg(largest_first.alias("groups"))
        .select(
            cols.entity,
            F.array_join(
                F.transform("groups", lambda g: F.format_string("%s (%d%%)", g["name"], g["percent"])), ", "
            ).alias("Top_Nationalities"),
        )
    )


def _split_by(labels: Mapping[str, Column], measure: str) -> list[Column]:
    """Mean and count of ``measure`` for each label, as columns of one aggregate."""
    out = []
    for label, condition in labels.items():
        out.append(avg_where(condition, measure).alias(f"{label}_Avg_Score"))
        out.append(count_where(condition, measure).alias(f"{label}_Count"))
    return out


def local_vs_tourist(
    df: DataFrame,
    min_reviews_per_group: int = 10,
    two_word_regions: dict[str, str] | None = None,
    cols: ReviewColumns = REVIEWS,
    ordered: bool = True,
) -> DataFrame:
    """Mean score given by reviewers of the entity's own region against all others.

    Reviewers without a group count as tourists. The reviews are folded once, to
    a row per entity, region and reviewer group, and kept in the checkpoint
    folder: both sides and the composition text come from those rows. Without
    ``ordered`` the rows come unsorted, for a report on them.
    """
    folded = checkpointed(
        df.groupBy(
            cols.entity,
            region_of(cols.address, two_word_regions).alias("Hotel_Nation"),
            F.trim(cols.group).alias("name"),
        ).agg(
            F.sum(F.col(cols.score).cast("double")).alias("total"),
            F.count(cols.score).alias("scored"),
            F.count("*").alias("n"),
        )
    )
    local = F.coalesce(F.col("Hotel_Nation") == F.col("name"), F.lit(False))
    measures = []
    for label, side in {"Local": local, "Tourist": ~local}.items():
        count = F.sum(F.when(side, F.col("scored")))  # NULL without a group on this side
        total = F.sum(F.when(side, F.col("total")))
        measures += [
            F.try_divide(total, F.nullif(count, F.lit(0))).alias(f"{label}_Avg_Score"),
            count.alias(f"{label}_Count"),
        ]
    compared = (
        folded.groupBy(cols.entity, "Hotel_Nation")
        .agg(*measures)
        .filter((F.col("Local_Count") >= min_reviews_per_group) & (F.col("Tourist_Count") >= min_reviews_per_group))
        .withColumn("Preference_Delta", F.col("Local_Avg_Score") - F.col("Tourist_Avg_Score"))
    )
    counts = folded.groupBy(cols.entity, "name").agg(F.sum("n").alias("n"))
    result = compared.join(_composition(counts, PCT_FLOOR, cols), cols.entity, "left")
    return result.orderBy(stable("Preference_Delta").desc(), cols.entity) if ordered else result


def reviewer_experience(
    df: DataFrame,
    min_reviews_per_level: int = 5,
    novice_below: int = 5,
    expert_above: int = 25,
    cols: ReviewColumns = REVIEWS,
    ordered: bool = True,
) -> DataFrame:
    """Mean score by reviewer experience, and the gap between experts and novices.

    A reviewer without a history counts as an expert. Levels an entity lacks are 0.
    Without ``ordered`` the rows come unsorted, for a report on them.
    """
    history = F.col(cols.history)
    novice = F.coalesce(history < novice_below, F.lit(False))
    intermediate = F.coalesce(history.between(novice_below, expert_above), F.lit(False))
    levels = {"Novice": novice, "Intermediate": intermediate, "Expert": ~(novice | intermediate)}
    result = (
        df.groupBy(cols.entity)
        .agg(*_split_by(levels, cols.score))
        .filter((F.col("Novice_Count") >= min_reviews_per_level) & (F.col("Expert_Count") >= min_reviews_per_level))
        .na.fill(0, subset=[f"{level}_{measure}" for level in levels for measure in ("Avg_Score", "Count")])
        .withColumn("Experience_Gap", F.col("Expert_Avg_Score") - F.col("Novice_Avg_Score"))
        .withColumn(
            "Total_Analyzed_Reviews",
            F.col("Novice_Count") + F.col("Intermediate_Count") + F.col("Expert_Count"),
        )
    )
    return result.orderBy(stable("Experience_Gap"), cols.entity) if ordered else result
