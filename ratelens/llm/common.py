"""What the operators on texts share: reading, batches of rows in Python, keys."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ratelens.functions.checkpoints import stored

#: Bits of a filter of keys, by their number: up to 32 MB are sent to all executors.
FILTER_BITS = range(18, 29)

# Characters of text that Python takes up at once; one longer text is taken alone.
SLICE_CHARS = 2_000_000

Step = Callable[..., Sequence[Sequence[Any]]]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False), np.int64)
    start = taken = 0
    for i, size in enumerate(sizes):
        if i > start and taken + size > SLICE_CHARS:
            yield batch.slice(start, i - start)
            start, taken = i, 0
        taken += size
    if len(sizes) > start:
        yield batch.slice(start)


def map_texts(df: DataFrame, start: Callable[[], Step], schema: T.StructType, text: str) -> DataFrame:
    """Rows made from rows in Python, in slices of bounded length.

    ``start`` is called once for each task and gives the function that turns
    lists of the columns of ``df`` into lists of the columns of ``schema``.
    """
    arrow, at = to_arrow_schema(schema), df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = start()
        for batch in batches:
            for part in slices(batch, at):
                made = step(*(column.to_pylist() for column in part.columns))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, field.type) for values, field in zip(made, arrow, strict=True)], schema=arrow
                )

    return df.mapInArrow(run, schema)


def texts_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only id and text, under fixed names: other columns of ``docs`` never clash with those of an operator."""
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def free_name(name: str, docs: DataFrame) -> str:
    """A name that no column of ``docs`` has, in any case."""
    taken = {column.lower() for column in docs.columns}
    while name in taken:
        name += "_"
    return name


def id_field(docs: DataFrame, id_col: str) -> T.StructField:
    return T.StructField("doc_id", docs.schema[id_col].dataType)


def text_key(text) -> Any:
    """The content address of a text: its MD5 as 16 bytes."""
    return F.unhex(F.md5(text))


def may_be_in(df: DataFrame, key: Column, keys: DataFrame, name: str) -> DataFrame:
    """``df`` with a flag ``name``: false only if its key is none of ``keys``, a table of one column of few rows for their filter.

    The filter has a bit for each value of a hash, about 64 for each key up to
    its greatest size, so that most rows whose key isn't among them are known
    without a shuffle.
    """
    bits = min(max((64 * keys.count()).bit_length(), FILTER_BITS[0]), FILTER_BITS[-1])

    def bit(value: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(value), 64 - bits)

    own, of_key = bit(key), bit(F.col(keys.columns[0]))
    part, bitmap = free_name("part", df), free_name("bitmap", df)
    parts = keys.groupBy(F.bitmap_bucket_number(of_key).alias(part)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(of_key)).alias(bitmap)
    )
    at = F.bitmap_bit_position(own)
    byte = F.conv(F.hex(F.substring(F.col(bitmap), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    placed = df.join(F.broadcast(parts), F.bitmap_bucket_number(own) == F.col(part), "left")
    return placed.select(*(F.col(f"`{column}`") for column in df.columns), held.alias(name))


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the checkpoint folder of the session: cuts the lineage, packed more tightly than a checkpoint.

    A folder of its own for each call; like checkpoints, they are left to the
    cluster's cleaning of that folder.
    """
    return stored(df)
