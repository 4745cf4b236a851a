"""What steps leave on the disks: shuffles, and tables that nothing reads any more."""

import os

from pyspark.sql import functions as F

import corpus_pipeline
from ratelens.functions.checkpoints import SHUFFLE_CLEANUP, checkpointed, discard, stored
from ratelens.llm import line_dedup
from ratelens.llm.common import may_be_in


def shuffle_files(spark):
    """The shuffle files on the disks of this session, with their sizes."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    paths = [files.apply(n).getPath() for n in range(files.size())]
    return {path: os.path.getsize(path) for path in paths if os.path.basename(path).startswith("shuffle_") and os.path.exists(path)}


def test_steps_that_are_written_leave_no_shuffles(spark):
    setting = spark.conf.get(SHUFFLE_CLEANUP, None)
    for step in (stored, checkpointed):
        before = shuffle_files(spark)
        df = spark.range(1000).withColumn("k", F.col("id") % 7).groupBy("k").count()  # planned before the setting holds
        kept = step(df)
        assert not shuffle_files(spark).keys() - before.keys()
        assert kept.count() == df.count() == 7
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == setting


def test_line_dedup_leaves_only_the_shuffles_of_its_last_step(spark):
    line = "a line that is long enough to be taken up, number {:03d} of them"
    docs = spark.createDataFrame([(n, line.format(n // 2)) for n in range(1000)], "doc_id long, text string")
    before = shuffle_files(spark)
    line_dedup.drop_repeated_lines(docs)
    new = {path: size for path, size in shuffle_files(spark).items() if path not in before}
    assert sum(new.values()) < 2000  # those of counts


def test_pipeline_removes_tables_that_the_next_stage_has_read(spark, tmp_path, monkeypatch):
    spark.range(20).selectExpr("id as doc_id", "'x' as text").write.parquet(f"{tmp_path}/documents.parquet")
    read = []

    def stage(spark, docs, sf_dir):
        read.append(docs)
        return docs.filter(F.col("doc_id") >= len(read))

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(str(n), stage) for n in range(4)])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 16
    there = [all(os.path.exists(file.removeprefix("file://")) for file in docs.inputFiles()) for docs in read]
    assert there == [True, False, False, True]  # the input, two tables that are done with, and the one that is yet to be read


def test_discard(spark):
    kept, gone = (stored(spark.range(n)) for n in (5, 6))
    discard(gone)
    assert kept.count() == 5
    assert not any(os.path.exists(file.removeprefix("file://")) for file in gone.inputFiles())


def test_filter_of_keys_misses_none(spark):
    keys = [None, "", "a", "é", *(f"k{n}" for n in range(300))]
    rows = spark.createDataFrame([(key,) for key in keys + [f"other{n}" for n in range(3000)]], "key string")
    rows = rows.withColumns({"part": F.lit(1), "bitmap": F.lit(2)})
    some = spark.createDataFrame([(key,) for key in keys[1:]], "k string")
    flagged = may_be_in(rows, F.col("key"), some, "may")
    assert flagged.columns == ["key", "part", "bitmap", "may"]
    held = {r["key"]: r["may"] for r in flagged.collect()}
    assert len(held) == rows.count() and all(held[key] for key in keys[1:])
    assert sum(held.values()) < 1.2 * len(keys)
    assert not any(r["may"] for r in may_be_in(rows, F.col("key"), some.limit(0), "may").collect())


def test_lines_of_many_keys_pass_a_filter_first(spark, monkeypatch):
    """With more keys than are sent whole: the same pairs, and only lines that may meet another are shuffled."""
    lines = [f"{n * 7919:09d} stands before line number {n * 104729:09d} of them" for n in range(300)]
    lines += [line + "!" for line in lines[::50]]
    table = spark.createDataFrame([(line,) for line in lines], "line string")
    expected = {tuple(r) for r in line_dedup.candidate_pairs(table, 2).collect()}
    kept, own = [], line_dedup.may_be_in

    def seen(*args):
        out = own(*args)
        kept.append((out.count(), out.filter("may").count()))
        return out

    monkeypatch.setattr(line_dedup, "may_be_in", seen)
    monkeypatch.setattr(line_dedup, "BROADCAST_KEYS", 0)
    assert {tuple(r) for r in line_dedup.candidate_pairs(table, 2).collect()} == expected and len(expected) >= 6
    [(rows, passed)] = kept
    assert passed < rows / 2
