"""Running sums and followers over rows in order, where one key may hold any share of the rows.

A window over a key sorts all its rows in one task. Here the order is cut into
chunks, a window runs within a chunk, and what stands before a chunk follows
from totals, of which there is a row for each key and chunk.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelens.functions.checkpoints import checkpointed


def range_chunks(df: DataFrame, order: Sequence[str], chunk: str = "chunk") -> DataFrame:
    """``df`` with a number of the range of ``order`` that a row lies in, about as many rows to each; NULLs first.

    Rows that are equal in ``order`` have one number. The result is
    materialised, because ranges are cut by a sample.
    """
    return checkpointed(df.repartitionByRange(*order).withColumn(chunk, F.spark_partition_id()))


def running_sums(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], sums: Mapping[str, Column], chunk: str = "chunk"
) -> DataFrame:
    """``df`` with sums over the rows of its keys up to and with its own, in ``order``.

    ``order`` must tell the rows of a key apart; ``chunk`` grows with it. NULL
    values are left out of the sums, which are 0 before the first value. NULL
    keys are a key like any other.
    """
    totals = df.groupBy(*keys, chunk).agg(*(F.sum(value).alias(name) for name, value in sums.items()))
    earlier = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        *(F.col(name).alias(f"__{name}") for name in (*keys, chunk)),
        *(F.sum(name).over(earlier).alias(f"__before_{name}") for name in sums),
    )
    so_far = Window.partitionBy(*keys, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = df.select("*", *(F.sum(value).over(so_far).alias(name) for name, value in sums.items()))
    same = [local[name].eqNullSafe(before[f"__{name}"]) for name in (*keys, chunk)]
    zero = F.lit(0)
    return local.join(before, same).select(
        *(local[name] for name in df.columns),
        *((F.coalesce(F.col(name), zero) + F.coalesce(F.col(f"__before_{name}"), zero)).alias(name) for name in sums),
    )


def carried(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Mapping[str, Column],
    own: bool = False,
    backward: bool = False,
    chunk: str = "chunk",
) -> DataFrame:
    """``df`` with the last value that isn't NULL in the rows of its keys before its own.

    With ``own`` its own row counts too; ``backward`` looks at the rows behind
    instead. ``chunk`` and ``order`` are as in :func:`running_sums`. Within a
    chunk a window carries the value on; from chunk to chunk the last one of
    each is carried, of which there is a row for each key and chunk.
    """
    place = F.struct(*order)
    latest = F.min_by if backward else F.max_by
    ends = df.groupBy(*keys, chunk).agg(
        *(latest(value, F.when(value.isNotNull(), place)).alias(name) for name, value in values.items())
    )
    turn = (lambda name: F.col(name).desc()) if backward else F.col
    earlier = Window.partitionBy(*keys).orderBy(turn(chunk)).rowsBetween(Window.unboundedPreceding, -1)
    before = ends.select(
        *(F.col(name).alias(f"__{name}") for name in (*keys, chunk)),
        *(F.last(name, ignorenulls=True).over(earlier).alias(f"__before_{name}") for name in values),
    )
    until = Window.partitionBy(*keys, chunk).orderBy(*map(turn, order))
    until = until.rowsBetween(Window.unboundedPreceding, 0 if own else -1)
    local = df.select("*", *(F.last(value, ignorenulls=True).over(until).alias(name) for name, value in values.items()))
    same = [local[name].eqNullSafe(before[f"__{name}"]) for name in (*keys, chunk)]
    return local.join(before, same).select(
        *(local[name] for name in df.columns), *(F.coalesce(local[name], F.col(f"__before_{name}")).alias(name) for name in values)
    )


def with_next(df: DataFrame, order: Sequence[str], chunk: str = "chunk", name: str = "next") -> DataFrame:
    """``df``, chunked by ``order``, with the values of ``order`` of the row behind, as a struct; NULL for the last one.

    Only the first row of each chunk is looked at outside its chunk.
    """
    own = F.struct(*order)
    heads = df.groupBy(chunk).agg(F.min(own).alias("head"))
    behind = heads.select(F.col(chunk).alias("__chunk"), F.lead("head").over(Window.orderBy(chunk)).alias("__head"))
    local = df.select("*", F.lead(own).over(Window.partitionBy(chunk).orderBy(*order)).alias(name))
    joined = local.join(F.broadcast(behind), F.col(chunk) == F.col("__chunk"))  # a row for each chunk
    return joined.select(*df.columns, F.coalesce(name, "__head").alias(name))
