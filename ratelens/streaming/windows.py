"""Windows over event time, the same for a stream of files and for a table.

Every function takes a streaming or a batch DataFrame. A stream keeps its open
windows in the state store until the watermark passes their end; rows that come
a micro-batch later than that are dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.functions.checkpoints import checkpoint_folder
from ratelens.operators.history import EXACT


def _timed(events: DataFrame, at: str, delay: str) -> DataFrame:
    """With the time as a time stamp, and the watermark ``delay`` behind the latest one seen."""
    return events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay)


def _measures(value: str) -> list[Column]:
    exact = F.col(value).cast(EXACT)
    return [
        F.count("*").alias("Events"),
        F.sum(exact).cast("double").alias("Total"),
        F.min(value).alias("Lowest"),
        F.max(value).alias("Highest"),
    ]


def windowed(
    events: DataFrame,
    keys: Sequence[str],
    value: str,
    size: str,
    slide: str | None = None,
    at: str = "ts",
    delay: str = "0 seconds",
) -> DataFrame:
    """Events of each key in windows of ``size``, tumbling or one each ``slide``.

    Columns: the keys, Window_Start, Window_End, Events, Total, Lowest and
    Highest of ``value``. Rows without a time are in no window.
    """
    window = F.window(at, size, slide) if slide else F.window(at, size)
    grouped = _timed(events, at, delay).groupBy(*keys, window.alias("__window")).agg(*_measures(value))
    return _flat(grouped, keys)


def sessions(
    events: DataFrame, keys: Sequence[str], value: str, gap: str, at: str = "ts", delay: str = "0 seconds"
) -> DataFrame:
    """Events of each key that follow one another within ``gap``.

    Columns as :func:`windowed`; a session ends ``gap`` after its last event. An
    event that stands between two sessions joins them; an event exactly ``gap``
    after another one belongs to its session.
    """
    grouped = _timed(events, at, delay).groupBy(*keys, F.session_window(at, gap).alias("__window")).agg(*_measures(value))
    return _flat(grouped, keys)


def _flat(grouped: DataFrame, keys: Sequence[str]) -> DataFrame:
    return grouped.select(
        *keys,
        F.col("__window.start").alias("Window_Start"),
        F.col("__window.end").alias("Window_End"),
        "Events",
        "Total",
        "Lowest",
        "Highest",
    )


def event_files(spark: SparkSession, path: str, schema: T.StructType, files_at_once: int | None = None) -> DataFrame:
    """A parquet file, or those of a folder or pattern, as a stream, the oldest first."""
    path = path.rstrip("/")
    if not set(path) & set("*?[{"):
        path = f"{path[:-1]}[{path[-1]}]"  # Spark takes a plain path for a folder, a pattern for what it matches
    reader = spark.readStream.schema(schema)
    if files_at_once:
        reader = reader.option("maxFilesPerTrigger", files_at_once)
    return reader.parquet(path)


def run_available(stream: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Process what there is now, and return all that was closed so far.

    State, progress and results are kept in ``folder`` under ``name`` (by
    default in the session's checkpoint folder), so that a later call with the
    same name goes on where this one ended and reads no file twice. A window is
    written once, when the watermark has passed its end.
    """
    folder = f"{folder or checkpoint_folder(stream.sparkSession)}/{name}"
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{folder}/closed")
        .option("checkpointLocation", f"{folder}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/closed")
