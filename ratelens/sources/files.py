"""Readers for review files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.functions.parsing import day, number, tag_list
from ratelens.functions.text import absent_as_null
from ratelens.sources.schema import REVIEW_SCHEMA, REVIEWS, ReviewColumns


def read_reviews(spark: SparkSession, path: str, format: str = "csv") -> DataFrame:
    """Read a review table.

    Columns of a CSV are found by the names in its header, in any order, and cast
    to the declared schema: no inference pass over the file is made, one bad
    number becomes NULL instead of turning a column to text, and a missing column
    is an error.
    """
    if format == "csv":
        text = spark.read.csv(path, header=True)
        return text.select(*(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in REVIEW_SCHEMA))
    return spark.read.format(format).load(path)


def normalize_reviews(df: DataFrame, cols: ReviewColumns = REVIEWS) -> DataFrame:
    """Typed form of a review table, for storing once and reading many times.

    Dates, coordinates and tags are parsed, the reviewer group is trimmed (a
    blank one stays a group of its own) and the "nothing to say" texts are NULL.
    Every operator takes the raw and the typed form alike.
    """
    typed = {
        cols.date: day(df, cols.date),
        cols.lat: number(df, cols.lat),
        cols.lng: number(df, cols.lng),
        cols.tags: tag_list(df, cols.tags),
        cols.group: F.trim(cols.group),
        cols.positive_text: absent_as_null(F.col(cols.positive_text)),
        cols.negative_text: absent_as_null(F.col(cols.negative_text)),
    }
    return df.withColumns({name: expr for name, expr in typed.items() if name in df.columns})


def dataset_row_count(df: DataFrame) -> DataFrame:
    """Rows of the source, as a one-row table."""
    return df.agg(F.count("*").alias("Row_Count"))
