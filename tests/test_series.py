"""Subtotals, sketches and interval joins against brute force."""

import datetime as dt
from collections import defaultdict
from itertools import combinations
from statistics import stdev

import pytest
from pyspark.sql import functions as F

from ratelens.operators import sketches
from ratelens.operators.intervals import interval_join
from ratelens.operators.sketches import monthly_sketches, rolled_up
from ratelens.operators.subtotals import subtotals
from ratelens.sources.schema import ReviewColumns

COLS = ReviewColumns(entity="e", date="d", score="s")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def rows():
    return [
        (f"e{n % 9}", None if n % 17 == 0 else f"n{n % 3}", "hot" if n % 3 else "cold", None if n % 13 == 0 else (n * 37 % 41) / 4.0)
        for n in range(400)
    ]


@pytest.mark.parametrize("sets", ["cube", "rollup", [["n"], ["n", "t"], []]])
def test_subtotals(spark, rows, sets):
    df = spark.createDataFrame(rows, "e string, n string, t string, s double").repartition(4)
    names = {"cube": [c for k in range(3) for c in combinations(["n", "t"], k)], "rollup": [(), ("n",), ("n", "t")]}
    wanted = names[sets] if isinstance(sets, str) else [tuple(one) for one in sets]
    want = {}
    for one in wanted:
        groups = defaultdict(list)
        for e, n, t, s in rows:
            groups[(n if "n" in one else None, t if "t" in one else None)].append((e, s))
        for group, own in groups.items():
            scores = [s for _, s in own if s is not None]
            key = (*group, ("n" not in one) * 2 + ("t" not in one))
            want[key] = (len(scores), sum(scores) / len(scores), stdev(scores), min(scores), max(scores), len({e for e, _ in own}))
    result = subtotals(df, ["n", "t"], sets, distinct="e", cols=COLS)
    assert plan(result).count("Scan ExistingRDD") == 1 and plan(result).count("Expand") == 1
    got = {tuple(r)[:3]: tuple(r)[3:] for r in result.collect()}
    assert got.keys() == want.keys()
    assert all(got[key] == pytest.approx(want[key]) for key in want)


def test_subtotals_of_nothing(spark):
    df = spark.createDataFrame([], "n string, s double")
    assert subtotals(df, ["n"], "rollup", cols=COLS).filter("Review_Count > 0").count() == 0
    with pytest.raises(ValueError):
        subtotals(df, ["n"], "all", cols=COLS)


def test_sketches_are_rolled_up_from_storage(spark, tmp_path):
    rows = [(f"e{n % 3}", dt.date(2020, 1, 1) + dt.timedelta(days=n % 700), n * 7919 % 1009 / 100.0, n % 1500) for n in range(20_000)]
    reviews = spark.createDataFrame([*rows, ("e0", None, 1.0, 1), ("e0", dt.date(2020, 1, 1), None, 2)], "e string, d date, s double, who long")
    monthly_sketches(reviews, "who", COLS).write.parquet(str(tmp_path / "stored"))
    stored = spark.read.parquet(str(tmp_path / "stored"))
    whole = rolled_up(stored, ["Entity"])
    assert "who" not in plan(whole)
    for r in whole.collect():
        own = sorted((s, who) for e, _, s, who in rows if e == r["Entity"])
        exact = len({who for _, who in own})
        assert r["Review_Count"] == len(own) and r["Average_Score"] == pytest.approx(sum(s for s, _ in own) / len(own))
        assert abs(r["Distinct_Estimate"] - exact) <= 6 * sketches.DISTINCT_ERROR * exact
        for q in (50, 90):
            rank = sum(s <= r[f"Quantile_{q}"] for s, _ in own) / len(own)
            assert abs(rank - q / 100) <= 2 * sketches.RANK_ERROR + 0.01


def brute(points, intervals):
    return sorted((p[0], i[0]) for p in points for i in intervals
                  if None not in (p[1], i[1], p[2], i[2], i[3]) and p[1] == i[1] and i[2] <= p[2] <= i[3])


@pytest.mark.parametrize("kind", ["long", "double", "date", "timestamp"])
def test_interval_join(spark, kind):
    def value(x):
        if x is None or kind == "long":
            return x
        if kind == "double":
            return x / 4.0 - 10
        return dt.date(2020, 1, 1) + dt.timedelta(days=x) if kind == "date" else dt.datetime(2020, 1, 1) + dt.timedelta(seconds=x)

    points = [(n, None if n % 31 == 0 else f"k{n % 3}", value(None if n % 29 == 0 else n * 37 % 300)) for n in range(300)]
    lengths = [0, 1, 3, 5, -2, 250, 40, 2]
    intervals = [(n, f"k{n % 4}", value(n * 53 % 290), value(None if n % 27 == 0 else n * 53 % 290 + lengths[n % 8])) for n in range(80)]
    df = interval_join(
        spark.createDataFrame(points, f"p long, k string, at {kind}"),
        spark.createDataFrame(intervals, f"i long, k string, start {kind}, stop {kind}"),
        ["k"], "at", "start", "stop",
    )
    assert sorted((r["p"], r["i"]) for r in df.collect()) == brute(points, intervals)
    assert df.columns == ["p", "k", "at", "i", "start", "stop"]
    assert "NestedLoop" not in plan(df) and "Cartesian" not in plan(df)


def test_a_crowded_bin_is_parted(spark):
    """All points and a third of the intervals in one place."""
    points = [(n, "k", 5.0 if n % 2 else n / 10) for n in range(2000)]
    intervals = [(n, "k", 4.0, 6.0) if n % 3 == 0 else (n, "k", float(n), n + 1.0) for n in range(30)]
    df = interval_join(
        spark.createDataFrame(points, "p long, k string, at double"),
        spark.createDataFrame(intervals, "i long, k string, start double, stop double"),
        ["k"], "at", "start", "stop", share=0.1, parts=7,
    )
    assert sorted((r["p"], r["i"]) for r in df.collect()) == brute(points, intervals)


def test_interval_join_without_keys_and_rows(spark):
    points = spark.createDataFrame([(1, 5)], "p long, at long")
    intervals = spark.createDataFrame([(9, 4, 6)], "i long, start long, stop long")
    assert interval_join(points, intervals, [], "at", "start", "stop").collect() == [(1, 5, 9, 4, 6)]
    assert interval_join(points, intervals.filter("i < 0"), [], "at", "start", "stop").count() == 0
    with pytest.raises(ValueError):
        interval_join(points, intervals.withColumn("p", F.lit(1)), [], "at", "start", "stop")
