"""Functions of the user's own in Python: a table function for SQL and aggregates with a mergeable state."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Keys whose states a task keeps before it passes them on.
KEYS_KEPT = 100_000


def _tags_of(batch: pa.RecordBatch) -> pa.Table:
    tags = pc.replace_substring_regex(batch.column("tags").cast(pa.string()), r"[\[\]']", "")
    parts = pc.split_pattern(tags, ",")
    row = pc.list_parent_indices(parts)
    tag = pc.utf8_trim(pc.list_flatten(parts), characters=" ")
    used = pc.not_equal(tag, "")
    score = batch.column("score").cast(pa.float64())
    return pa.table({"Single_Tag": tag.filter(used), "Score": score.take(row.filter(used))})


def register_review_tags(spark: SparkSession, name: str = "review_tags") -> None:
    """Make ``name`` a table function for SQL: one row (Single_Tag, Score) for each tag that isn't blank.

    ``select * from review_tags(table(select tags, score from reviews))`` takes
    the text form of the tags, and whole batches of them at once.
    """

    class ReviewTags:
        def eval(self, batch: pa.RecordBatch):
            yield _tags_of(batch)

    spark.udtf.register(name, F.arrow_udtf(ReviewTags, returnType="Single_Tag string, Score double"))


@dataclass(frozen=True)
class Aggregate:
    """An aggregate of one column: states of numbers that can be merged in any order.

    ``fold`` makes the states of groups from an array of values and one of group
    numbers; ``merge`` adds up states likewise; ``finish`` makes the results.
    States and results are arrays with a row for each group.
    """

    fold: Callable[[np.ndarray, np.ndarray, int], np.ndarray]
    merge: Callable[[np.ndarray, np.ndarray, int], np.ndarray]
    finish: Callable[[np.ndarray], np.ndarray]
    results: Sequence[str]


def aggregated(df: DataFrame, keys: Sequence[str], value: str, aggregate: Aggregate) -> DataFrame:
    """The results of an aggregate for each keys, over the values that aren't NULL.

    Tasks fold their rows to a state for each key before anything is shuffled,
    and what meets for a key are the states of the tasks, however hot it is.
    """
    key_fields = [df.schema[key] for key in keys]
    partial = T.StructType([*key_fields, T.StructField("__state", T.ArrayType(T.DoubleType()))])
    final = T.StructType([*key_fields, *(T.StructField(name, T.DoubleType()) for name in aggregate.results)])
    names = list(keys)

    def grouped(table: pd.DataFrame) -> tuple[np.ndarray, pd.DataFrame]:
        of = table.groupby(names, sort=False, dropna=False)
        number = of.ngroup().to_numpy()
        return number, table.iloc[np.unique(number, return_index=True)[1]][names].reset_index(drop=True)

    def merged(groups: pd.DataFrame, states: np.ndarray) -> tuple[pd.DataFrame, np.ndarray]:
        number, firsts = grouped(groups)
        return firsts, aggregate.merge(states, number, len(firsts))

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, states = None, None
        for batch in batches:
            if not len(batch):
                continue
            number, firsts = grouped(batch)
            made = aggregate.fold(batch["__value"].to_numpy(float), number, len(firsts))
            if held is not None:
                firsts, made = merged(pd.concat([held, firsts], ignore_index=True), np.concatenate([states, made]))
            held, states = firsts, made
            if len(held) > KEYS_KEPT:
                yield held.assign(__state=list(states))
                held = states = None
        if held is not None:
            yield held.assign(__state=list(states))

    def finish(batch: pd.DataFrame) -> pd.DataFrame:
        firsts, states = merged(batch[names], np.stack(batch["__state"]))
        return firsts.join(pd.DataFrame(aggregate.finish(states), columns=list(aggregate.results)))

    rows = df.select(*keys, F.col(value).cast("double").alias("__value")).filter("__value is not null")
    return rows.mapInPandas(fold, partial).groupBy(*keys).applyInPandas(finish, final)


def _moments(values: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    n = np.bincount(group, minlength=groups).astype(float)
    mean = np.bincount(group, values, groups) / n
    apart = values - mean[group]
    return np.stack([n, mean, *(np.bincount(group, apart**k, groups) for k in (2, 3, 4))], axis=1)


def _merged_moments(states: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    n, mean, m2, m3, m4 = states.T
    total = np.bincount(group, n, groups)
    center = np.bincount(group, n * mean, groups) / total
    d = mean - center[group]
    second = m2 + n * d**2
    third = m3 + 3 * d * m2 + n * d**3
    fourth = m4 + 4 * d * m3 + 6 * d**2 * m2 + n * d**4
    return np.stack([total, center, *(np.bincount(group, m, groups) for m in (second, third, fourth))], axis=1)


def _shape(states: np.ndarray) -> np.ndarray:
    n, mean, m2, m3, m4 = states.T
    flat = m2 <= 1e-20 * n * np.maximum(mean**2, 1e-20)
    spread = np.where(flat, np.nan, m2)
    return np.stack([n, mean, np.sqrt(n) * m3 / spread**1.5, n * m4 / spread**2 - 3], axis=1)


#: Count, mean, skewness and excess kurtosis (of the population; NULL where all values are equal).
SHAPE = Aggregate(_moments, _merged_moments, _shape, ("Review_Count", "Average_Score", "Skewness", "Kurtosis"))
