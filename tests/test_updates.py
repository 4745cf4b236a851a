"""Saved sums, versions of a table and functions of the user's own."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ratelens.functions.user_functions import SHAPE, aggregated, register_review_tags
from ratelens.operators.incremental import merged, tag_influence_of, tag_state, trend_state, trends_of
from ratelens.operators.tags import tag_influence
from ratelens.operators.trends import review_trends
from ratelens.operators.versions import compare_versions, rows_to_load
from ratelens.sources.schema import ReviewColumns

COLS = ReviewColumns(entity="e", date="d", score="s", tags="t", entity_score="avg", entity_reviews="none")


@pytest.fixture(scope="module")
def reviews(spark):
    rows = []
    for n in range(900):
        tags = ["[]", "[' a ', ' b ']", "[' b ']", None, "[' ', 'c']"][n % 5]
        date = None if n % 37 == 0 else dt.date(2020, 1, 1) + dt.timedelta(days=n * 37 % 500)
        rows.append((n, "hot" if n % 3 == 0 else f"e{n % 7}", date, None if n % 41 == 0 else (n * 7919 % 41) / 4.0, tags))
    rows += [(1000 + n, "flat", dt.date(2021, 1, 1), 5.0, "['same']") for n in range(60)]
    return spark.createDataFrame(rows, "id long, e string, d date, s double, t string").withColumn("avg", F.lit(8.04))


def near(rows):
    return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in row) for row in rows)


def test_incremental_equals_the_full_run(spark, reviews, tmp_path):
    parts = [reviews.filter(f"id % 3 = {n}") for n in range(3)]
    full = {"trend": (trend_state, trends_of, review_trends), "tag": (tag_state, tag_influence_of, lambda df, n, cols: tag_influence(df, n, cols, ordered=False))}
    for name, (state, analysis, whole) in full.items():
        make = (lambda df: trend_state(df, 30, COLS)) if name == "trend" else (lambda df: tag_state(df, COLS))
        make(parts[0]).write.parquet(str(tmp_path / name))
        saved = spark.read.parquet(str(tmp_path / name))
        saved = merged(saved, make(parts[1]), make(parts[2]))
        got = analysis(saved, 30, COLS) if name == "trend" else analysis(saved, 50)
        assert near(got.select(whole(reviews, 30, COLS).columns).collect()) == near(whole(reviews, 30 if name == "trend" else 50, COLS).collect())


def test_old_reviews_are_not_read(spark, reviews, tmp_path):
    trend_state(reviews.filter("id % 2 = 0"), 30, COLS).write.parquet(str(tmp_path / "state"))
    reviews.filter("id % 2 = 1").write.parquet(str(tmp_path / "new"))
    new = trend_state(spark.read.parquet(str(tmp_path / "new")), 30, COLS)
    df = trends_of(merged(spark.read.parquet(str(tmp_path / "state")), new), 30, COLS)
    files = {file.rsplit("/", 2)[1] for file in df.inputFiles()}
    assert files == {"state", "new"}


def test_compare_versions(spark):
    schema = "k long, j string, a string, b double"
    old = [(1, "x", "a", 1.0), (2, "x", None, 2.0), (3, None, "c", 3.0), (4, "x", "d", None), (5, "x", "e", 5.0), (6, "x", "f", 6.0), (6, "x", "f", 6.0)]
    new = [(1, "x", "a", 1.0), (2, "x", "", 2.0), (3, None, "c", 3.5), (4, "x", "d", None), (6, "x", "f", 6.0), (7, None, None, None), (None, "x", "g", 1.0)]
    df = compare_versions(spark.createDataFrame(old, schema), spark.createDataFrame(new, schema).select("b", "a", "j", "k"), ["k", "j"])
    got = {(r["k"], r["Occurrence"]): (r["Change"], r["Changed"]) for r in df.collect()}
    assert got == {
        (1, 1): ("same", []), (2, 1): ("changed", ["a"]), (3, 1): ("changed", ["b"]), (4, 1): ("same", []),
        (5, 1): ("removed", []), (6, 1): ("same", []), (6, 2): ("removed", []), (7, 1): ("added", []), (None, 1): ("added", []),
    }
    loaded = rows_to_load(df)
    assert loaded.columns == ["k", "j", "a", "b"]
    assert {tuple(r) for r in loaded.collect()} == {(2, "x", "", 2.0), (3, None, "c", 3.5), (7, None, None, None), (None, "x", "g", 1.0)}
    assert df.filter("k = 5").first()["old"]["a"] == "e" and df.filter("k = 5").first()["new"] is None
    with pytest.raises(ValueError):
        compare_versions(old_df := spark.createDataFrame(old, schema), old_df.drop("a"), ["k"])


def test_versions_of_shuffled_values_differ(spark):
    """Values that trade places between columns are a change."""
    old = spark.createDataFrame([(1, "a", "b"), (2, "ab", "")], "k long, a string, b string")
    new = spark.createDataFrame([(1, "b", "a"), (2, "a", "b")], "k long, a string, b string")
    assert {r["Change"] for r in compare_versions(old, new, ["k"]).collect()} == {"changed"}


def test_table_function(spark, reviews):
    register_review_tags(spark)
    reviews.select(F.col("t").alias("tags"), F.col("s").alias("score")).createOrReplaceTempView("given_reviews")
    got = spark.sql("select Single_Tag, count(*) as n, sum(Score) as total from review_tags(table(select tags, score from given_reviews)) group by 1")
    want, total = Counter(), Counter()
    for r in reviews.collect():
        for tag in (r["t"] or "").replace("[", "").replace("]", "").replace("'", "").split(","):
            if tag.strip():
                want[tag.strip()] += 1
                total[tag.strip()] += r["s"] or 0
    assert {r["Single_Tag"]: r["n"] for r in got.collect()} == want
    assert {r["Single_Tag"]: r["total"] for r in got.collect()} == pytest.approx(total)


def test_user_aggregate(reviews, monkeypatch):
    from ratelens.functions import user_functions

    monkeypatch.setattr(user_functions, "KEYS_KEPT", 3)
    got = {r["e"]: tuple(r)[1:] for r in aggregated(reviews.repartition(6), ["e"], "s", SHAPE).collect()}
    want = reviews.filter("s is not null").groupBy("e").agg(F.count("*"), F.avg("s"), F.skewness("s"), F.kurtosis("s")).collect()
    assert got.keys() == {r["e"] for r in want}
    for r in want:
        assert got[r["e"]] == pytest.approx(tuple(r)[1:])
