"""From documents to token ids: five stages, each on all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again. All but the last return the columns of
documents. Stages have no SQL counterpart (models, edit distances, hashes and
merges); tests hold them against brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ratelens.functions.checkpoints import discard
from ratelens.llm.bpe import bpe_encode
from ratelens.llm.common import table, written
from ratelens.llm.decontamination import drop_contaminated
from ratelens.llm.line_dedup import Lines, drop_repeated_lines
from ratelens.llm.queries import VOCABULARY
from ratelens.llm.simhash import drop_near_duplicates
from ratelens.llm.toxicity import drop_toxic

ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't predicted toxic."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that stand before; long ones, or nearly so."""
    return drop_repeated_lines(docs, Lines(short=True))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group that fingerprints link: three-word shingles, two differing bits at most."""
    return drop_near_duplicates(docs, shingle=3, distance=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, with the digests of ids and decoded bytes."""
    return bpe_encode(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("byte_bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs)
            if before is not None:  # only this stage has read it
                discard(before)
            before = docs
    return docs
