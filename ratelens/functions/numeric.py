"""Small numeric expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stable(value: Column | str, digits: int = 9) -> Column:
    """Value used for ranking and for comparing with zero.

    A floating sum depends on the order in which partitions arrive, so two equal
    means may differ in their last bits from run to run. Rounding far below any
    meaningful difference keeps ranks, ties and signs the same on every run.
    """
    return F.round(value, digits)


def global_mean(df: DataFrame, measure: str) -> Column:
    """Mean over the whole table as a scalar subquery (runs inside the same query)."""
    return df.agg(F.avg(measure)).scalar()


def count_where(condition: Column, measure: str) -> Column:
    """Non-NULL values of ``measure`` in the rows that meet ``condition``; NULL if no row does."""
    return F.when(F.count_if(condition) > 0, F.count(F.when(condition, F.col(measure))))


def avg_where(condition: Column, measure: str) -> Column:
    return F.avg(F.when(condition, F.col(measure)))


def bins(value: Column, upper_bounds: Sequence[tuple[float, str]], rest: str) -> Column:
    """Label of the first inclusive upper bound not exceeded, else ``rest`` (also for NULL)."""
    first_bound, first_label = upper_bounds[0]
    label = F.when(value <= first_bound, first_label)
    for bound, name in upper_bounds[1:]:
        label = label.when(value <= bound, name)
    return label.otherwise(rest)
