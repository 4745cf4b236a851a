"""Aggregates with all their subtotals, from reviews that are folded first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.operators.history import EXACT
from ratelens.sources.schema import REVIEWS, ReviewColumns


def subtotals(
    df: DataFrame,
    dimensions: Sequence[str],
    sets: str | Sequence[Sequence[str]] = "cube",
    distinct: str | None = None,
    cols: ReviewColumns = REVIEWS,
) -> DataFrame:
    """Scores by the dimensions and by sets of them, all in one pass over the reviews.

    ``sets`` is ``"cube"`` (every set of dimensions), ``"rollup"`` (each
    beginning of the list) or a list of sets. Columns: the dimensions (NULL
    where a row is the total over them), Grouping (a bit for each dimension, the
    last one the lowest, set if the row is a total over it; it tells a total from
    the group of NULL), Review_Count, Average_Score, StdDev_Score (of the
    sample), Lowest_Score, Highest_Score and, for a column named by ``distinct``,
    Distinct_Count of its values.

    Reviews are folded to the finest groups (and the distinct column) within
    tasks; only those rows are copied for each set, and a hot group is a row for each task.
    """
    score = F.col(cols.score).cast(EXACT)
    finest = df.select(*dimensions, *([F.col(distinct).alias("__distinct")] if distinct else []), score.alias("__score"))
    folded = finest.groupBy(*dimensions, *(["__distinct"] if distinct else [])).agg(
        F.count("__score").alias("__n"),
        F.sum("__score").alias("__total"),
        F.sum(F.col("__score").cast("double") * F.col("__score").cast("double")).alias("__squares"),
        F.min("__score").alias("__low"),
        F.max("__score").alias("__high"),
    )
    if sets == "cube":
        grouped = folded.cube(*dimensions)
    elif sets == "rollup":
        grouped = folded.rollup(*dimensions)
    elif isinstance(sets, str):
        raise ValueError("sets is 'cube', 'rollup' or a list of sets of dimensions")
    else:
        grouped = folded.groupingSets([[F.col(name) for name in one] for one in sets], *dimensions)
    totals = grouped.agg(
        F.grouping_id().alias("Grouping"),
        F.sum("__n").alias("Review_Count"),
        F.sum("__total").cast("double").alias("__total"),
        F.sum("__squares").alias("__squares"),
        F.min("__low").cast("double").alias("Lowest_Score"),
        F.max("__high").cast("double").alias("Highest_Score"),
        *([F.count_distinct("__distinct").alias("Distinct_Count")] if distinct else []),
    )
    n, total = F.col("Review_Count"), F.col("__total")
    spread = F.greatest(F.col("__squares") - total * total / n, F.lit(0.0))
    return totals.select(
        *dimensions,
        "Grouping",
        "Review_Count",
        F.when(n > 0, total / n).alias("Average_Score"),
        F.when(n > 1, F.sqrt(spread / (n - 1))).alias("StdDev_Score"),
        "Lowest_Score",
        "Highest_Score",
        *(["Distinct_Count"] if distinct else []),
    )
