"""Reliable checkpoints for iterative operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local session without one gets a temporary folder: on a cluster a
    machine-local folder would be lost with its machine.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not (context.master == "local" or context.master.startswith("local[")):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="ratelens-checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffles of what is planned and run meanwhile go as it ends, not when the driver happens to collect its garbage.

    For tables that are written: nothing reads their shuffles again, and those
    of all steps together may be several times the input.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the checkpoint folder of the session."""
    checkpoint_folder(df.sparkSession)
    with shuffles_dropped(df.sparkSession):
        return df.select("*").checkpoint()  # planned anew, as the setting holds from there


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a table of its own in that folder: packed more tightly than a checkpoint, and read by columns."""
    folder = f"{checkpoint_folder(df.sparkSession)}/{uuid.uuid4()}"
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def discard(df: DataFrame) -> None:
    """Remove the folders of a table that :func:`stored` wrote and that nothing reads any more."""
    spark = df.sparkSession
    for name in {file.rpartition("/")[0] for file in df.inputFiles()}:
        folder = spark._jvm.org.apache.hadoop.fs.Path(name)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
