"""Differences between two versions of a table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.functions.ordered import range_chunks, running_sums


def _digest(names: Sequence[str]) -> Column:
    """Digest of some columns; NULL differs from every value, and a value from the same in another column."""
    parts = []
    for name in names:
        text = F.col(f"`{name}`").cast("string")
        parts += [F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))]
    return F.unhex(F.md5(F.concat(F.lit(""), *parts)))


def _numbered(df: DataFrame, keys: Sequence[str], others: Sequence[str], side: str) -> DataFrame:
    """Keys, the number of the row among those of its keys, and the other columns as ``side``."""
    rows = df.select(*keys, F.struct(_digest(others).alias("digest"), *others).alias(side), _digest(others).alias("__digest"))
    chunked = range_chunks(rows, [*keys, "__digest"], "__chunk")
    return running_sums(chunked, keys, ["__digest"], {"Occurrence": F.lit(1)}, "__chunk").select(*keys, "Occurrence", side)


def compare_versions(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that were added, removed, changed or kept from one version of a table to the next.

    Columns: the keys, Occurrence, Change ("added", "removed", "changed" or
    "same"), Changed (names of the other columns that differ) and the row of each
    version as the structs ``old`` and ``new`` (NULL where there is none). Both
    versions have the same columns. NULL equals NULL, in keys and elsewhere.
    Rows that share their keys are numbered by content and compared by number,
    so that repeated rows count as often as they stand there.

    One full outer join on the keys; contents are compared by their digests.
    """
    if sorted(old.columns) != sorted(new.columns):
        raise ValueError("both versions need the same columns")
    others = [name for name in old.columns if name not in keys]
    before = _numbered(old, keys, others, "old").toDF(*(f"old_{k}" for k in keys), "old_number", "old")
    after = _numbered(new, keys, others, "new").toDF(*(f"new_{k}" for k in keys), "new_number", "new")
    same = reduce(
        Column.__and__,
        (F.col(f"old_{k}").eqNullSafe(F.col(f"new_{k}")) for k in keys),
        F.col("old_number") == F.col("new_number"),
    )
    joined = before.join(after, same, "full")
    change = (
        F.when(F.col("old").isNull(), "added")
        .when(F.col("new").isNull(), "removed")
        .when(F.col("old.digest") != F.col("new.digest"), "changed")
        .otherwise("same")
    )
    differing = [F.when(~F.col(f"old.`{name}`").eqNullSafe(F.col(f"new.`{name}`")), F.lit(name)) for name in others]
    found = joined.select(
        *(F.when(F.col("old").isNotNull(), F.col(f"old_{k}")).otherwise(F.col(f"new_{k}")).alias(k) for k in keys),
        F.coalesce("old_number", "new_number").alias("Occurrence"),
        change.alias("Change"),
        (F.array_compact(F.array(*differing)) if differing else F.array().cast("array<string>")).alias("Changed"),
        *(F.when(F.col(side).isNotNull(), F.col(side).dropFields("digest") if others else F.struct()).alias(side) for side in ("old", "new")),
    )
    both = F.col("old").isNotNull() & F.col("new").isNotNull()
    return found.withColumn("Changed", F.when(both, F.col("Changed")).otherwise(F.array().cast("array<string>")))


def rows_to_load(comparison: DataFrame, change: Sequence[str] = ("added", "changed")) -> DataFrame:
    """The rows of the new version that an update has to write, under the names of the table."""
    keys = comparison.columns[: comparison.columns.index("Occurrence")]
    return comparison.filter(F.col("Change").isin(*change)).select(*keys, "new.*")
