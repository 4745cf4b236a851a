"""Approximate aggregates as columns that can be stored and added up later."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.functions.parsing import day
from ratelens.operators.history import EXACT
from ratelens.sources.schema import REVIEWS, ReviewColumns

# Buckets of the distinct counter as a power of two: its relative standard error is 1.04 / sqrt(2**12).
LOG_BUCKETS = 12
DISTINCT_ERROR = 1.04 / 2 ** (LOG_BUCKETS / 2)

# Size of the quantile sketch: ranks are off by 1.33 % at most with a confidence of 99 %.
QUANTILE_SIZE = 200
RANK_ERROR = 0.0133


def monthly_sketches(df: DataFrame, distinct: str, cols: ReviewColumns = REVIEWS) -> DataFrame:
    """A row for each entity and month, to be stored: Review_Count, Total_Score and two sketches.

    ``Distinct`` counts the values of the column ``distinct``, ``Scores`` knows
    the quantiles of the score. Reviews without score or valid date are left
    out. Sketches are built within tasks and merged: a hot entity sends one of each task.
    """
    rows = df.select(
        F.col(cols.entity).alias("Entity"),
        F.trunc(day(df, cols.date), "month").alias("Month"),
        F.col(cols.score).alias("score"),
        F.col(distinct).alias("value"),
    ).filter("score is not null and Month is not null")
    return rows.groupBy("Entity", "Month").agg(
        F.count("*").alias("Review_Count"),
        F.sum(F.col("score").cast(EXACT)).alias("Total_Score"),
        F.hll_sketch_agg("value", LOG_BUCKETS).alias("Distinct"),
        F.kll_sketch_agg_double(F.col("score").cast("double"), QUANTILE_SIZE).alias("Scores"),
    )


def rolled_up(sketches: DataFrame, by: Sequence[Column | str], quantiles: Sequence[float] = (0.5, 0.9)) -> DataFrame:
    """Stored rows added up by other groups: Review_Count, Average_Score, Distinct_Estimate and Quantile_<percent>.

    The reviews themselves are not read again.
    """
    merged = sketches.groupBy(*by).agg(
        F.sum("Review_Count").alias("Review_Count"),
        (F.sum("Total_Score").cast("double") / F.sum("Review_Count")).alias("Average_Score"),
        F.hll_sketch_estimate(F.hll_union_agg("Distinct")).alias("Distinct_Estimate"),
        F.kll_merge_agg_double("Scores").alias("Scores"),
    )
    at = [F.kll_sketch_get_quantile_double("Scores", F.lit(q)).alias(f"Quantile_{round(100 * q)}") for q in quantiles]
    return merged.select("*", *at).drop("Scores")


def within_bounds(estimates: DataFrame, df: DataFrame, by: Sequence[str], distinct: str, score: str, quantiles: Sequence[float]) -> DataFrame:
    """Exact counts of ``df`` by ``by``, and whether the estimates lie within twice the sketches' bounds.

    Columns: ``by``, Review_Count, Distinct_Count, Distinct_Holds and
    Quantile_<percent>_Holds: the share of scores below the estimate is not
    above the quantile, and that of scores up to it not below, but for the bound.
    """
    named = [f"Quantile_{round(100 * q)}" for q in quantiles]
    rows = df.filter(F.col(score).isNotNull()).join(estimates.select(*by, "Distinct_Estimate", *named), list(by))
    exact = rows.groupBy(*by).agg(
        F.count("*").alias("Review_Count"),
        F.count_distinct(distinct).alias("Distinct_Count"),
        F.max("Distinct_Estimate").alias("estimate"),
        *(F.avg((F.col(score) < F.col(name)).cast("double")).alias(f"{name}_below") for name in named),
        *(F.avg((F.col(score) <= F.col(name)).cast("double")).alias(f"{name}_up_to") for name in named),
    )
    apart = F.abs(F.col("estimate") - F.col("Distinct_Count"))
    return exact.select(
        *by,
        "Review_Count",
        "Distinct_Count",
        (apart <= F.greatest(2 * 3 * DISTINCT_ERROR * F.col("Distinct_Count"), F.lit(1.0))).alias("Distinct_Holds"),
        *(
            ((F.col(f"{name}_below") <= q + 2 * RANK_ERROR) & (F.col(f"{name}_up_to") >= q - 2 * RANK_ERROR)).alias(f"{name}_Holds")
            for name, q in zip(named, quantiles, strict=True)
        ),
    )
