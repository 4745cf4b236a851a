"""Parsing of text fields. Bad values become NULL, never an error under ANSI mode.

Each function looks at the declared type of the field, so a table that already
holds dates, numbers or arrays is not parsed a second time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Formats of the review file.
DATE_FORMAT = "M/d/yyyy"
MISSING_NUMBER = "NA"
TAG_BRACKETS = "[]'"
TAG_SEPARATOR = ","
STAY_TAG_LIKE = "Stayed % night%"
STAY_NIGHTS_REGEX = r"Stayed (\d+) night"
TWO_WORD_REGIONS = {"Kingdom": "United Kingdom"}


def day(df: DataFrame, name: str) -> Column:
    """Calendar day of a text, date or timestamp field."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.try_to_date(F.col(name), DATE_FORMAT)
    return F.col(name).cast("date")


def number(df: DataFrame, name: str) -> Column:
    """Double value of a text or numeric field; missing marks and NaN become NULL."""
    value = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        value = F.nullif(F.trim(value), F.lit(MISSING_NUMBER)).try_cast("double")
    else:
        value = value.cast("double")
    return F.nanvl(value, F.lit(None).cast("double"))


def tag_list(df: DataFrame, name: str) -> Column:
    """Array form of a ``"[' a ', ' b ']"`` text field (items are not trimmed)."""
    if isinstance(df.schema[name].dataType, T.ArrayType):
        return F.col(name)
    text = F.col(name)
    for mark in TAG_BRACKETS:  # byte-wise; translate and regexp_replace go through every character
        text = F.replace(text, F.lit(mark), F.lit(""))
    return F.split(text, TAG_SEPARATOR)


def one_row_per_tag(df: DataFrame, name: str, keep: list[str], tag: str = "Single_Tag") -> DataFrame:
    """One row per tag that is not blank, with only ``keep`` beside it.

    The outer form is used because for the inner one Spark adds a filter on the
    size of the list, which parses every list a second time. A review without
    tags then has one NULL tag, which the filter drops like a blank one.
    """
    exploded = df.select(*keep, F.explode_outer(tag_list(df, name)).alias("raw_tag"))
    return exploded.select(*keep, F.trim("raw_tag").alias(tag)).filter(F.col(tag) != "")


def nights(tag: Column) -> Column:
    """Nights named by a stay tag, NULL for any other tag."""
    return F.regexp_extract(tag, STAY_NIGHTS_REGEX, 1).try_cast("int")


def region_of(address: str, two_word_regions: dict[str, str] | None = None) -> Column:
    """Region named by the last word of an address.

    ``two_word_regions`` maps a last word to the full name it stands for.
    """
    last = F.substring_index(F.rtrim(F.col(address)), " ", -1)
    region = last
    for word, full in (TWO_WORD_REGIONS if two_word_regions is None else two_word_regions).items():
        region = F.when(last == word, full).otherwise(region)
    return region
