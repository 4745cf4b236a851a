"""Moving frames, neighbours in time and as-of joins against brute force, with one hot key."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ratelens.functions.ordered import carried, range_chunks, running_sums, with_next
from ratelens.operators.history import asof_join, moving_scores, moving_values, review_history
from ratelens.sources.schema import ReviewColumns

COLS = ReviewColumns(entity="e", date="d", score="s")
START = dt.date(2020, 1, 1)


@pytest.fixture(scope="module", autouse=True)
def many_chunks(spark):
    """Small ranges would be joined to one."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.fixture(scope="module")
def rows():
    """A third of the reviews are of one entity; some have no score or date."""
    out = []
    for n in range(900):
        entity = "hot" if n % 3 == 0 else None if n % 50 == 1 else f"e{n % 7}"
        day = None if n % 41 == 0 else START + dt.timedelta(days=n * 37 % 500)
        out.append((n, entity, day, None if n % 29 == 0 else (n * 7919 % 41) / 4.0))
    return out


@pytest.fixture(scope="module")
def reviews(spark, rows):
    return spark.createDataFrame(rows, "id long, e string, d date, s double").repartition(8)


def mean(values):
    return pytest.approx(sum(values) / len(values)) if values else None


def test_moving_scores(reviews, rows):
    used = [(e, d, s) for _, e, d, s in rows if d and s is not None]
    got = moving_scores(reviews, 90, COLS).collect()
    assert {(r["e"], r["Review_Day"]) for r in got} == {(e, d) for e, d, _ in used}
    assert len(got) == len({(e, d) for e, d, _ in used})
    for r in got:
        of_entity = [(d, s) for e, d, s in used if e == r["e"]]

        def between(first, last, of_entity=of_entity, today=r["Review_Day"]):
            return [s for d, s in of_entity if first <= (today - d).days <= last]

        assert r["Review_Count"] == len(between(0, 0)) and r["Average_Score"] == mean(between(0, 0))
        assert r["Moving_Count"] == len(between(0, 89)) and r["Moving_Average"] == mean(between(0, 89))
        assert r["Earlier_Average"] == mean(between(90, 179))
        assert r["Total_Count"] == len(between(0, 10_000))
        days = sorted({d for d, _ in of_entity})
        at = days.index(r["Review_Day"])
        assert r["Previous_Average"] == (mean([s for d, s in of_entity if d == days[at - 1]]) if at else None)
        assert r["Next_Average"] == (mean([s for d, s in of_entity if d == days[at + 1]]) if at + 1 < len(days) else None)


def test_review_history(reviews, rows):
    used = sorted((d, n, e, s) for n, e, d, s in rows if d and s is not None)
    for r in review_history(reviews, "id", COLS).collect():
        own = [(d, n, s) for d, n, e, s in used if e == r["e"]]
        at = [n for _, n, _ in own].index(r["id"])
        assert r["Review_Number"] == at + 1
        assert r["Running_Average"] == mean([s for _, _, s in own[: at + 1]])
        assert r["Previous_Score"] == (own[at - 1][2] if at else None)
        assert r["Days_Since_Previous"] == ((own[at][0] - own[at - 1][0]).days if at else None)
        assert r["Next_Score"] == (own[at + 1][2] if at + 1 < len(own) else None)


def test_moving_values_have_both_ends(spark):
    rows = [("u", f"2024-01-01 00:00:{n:02d}", float(n)) for n in (0, 5, 10, 10, 11, 21)] + [("v", "2024-01-01 00:00:10", None)]
    df = spark.createDataFrame(rows, "k string, t string, x double").withColumn("t", F.col("t").cast("timestamp"))
    got = {(r["k"], r["t"].second): (r["Moving_Count"], r["Moving_Sum"]) for r in moving_values(df, "k", "t", "x", 10).collect()}
    assert got == {("u", 0): (1, 0.0), ("u", 5): (2, 5.0), ("u", 10): (4, 25.0), ("u", 11): (4, 36.0), ("u", 21): (2, 32.0), ("v", 10): (0, 0.0)}


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("within", [None, 3])
def test_asof_join(spark, strict, within):
    left = [(n, "hot" if n % 3 else None if n % 12 == 0 else "x", None if n % 25 == 0 else n * 13 % 100) for n in range(300)]
    right = [(n, "hot" if n % 2 else None if n % 10 == 0 else "x", n * 29 % 90 + 5, f"v{n}") for n in range(60)]
    got = asof_join(
        spark.createDataFrame(left, "id long, k string, t long").repartition(5),
        spark.createDataFrame(right, "rid long, k string, at long, v string").repartition(3),
        ["k"], "t", "at", ["v", "rid"], "rid", strict=strict, within=None if within is None else F.lit(within),
    ).collect()
    assert len(got) == len(left)
    for r in got:
        assert (r["id"], r["k"], r["t"]) in left
        fits = [
            (at, rid, v) for rid, k, at, v in right
            if k is not None and k == r["k"] and r["t"] is not None and (at < r["t"] if strict else at <= r["t"])
        ]
        at, rid, v = max(fits, default=(None, None, None))
        if within is not None and at is not None and at + within < r["t"]:
            rid = v = None
        assert (r["Latest_rid"], r["Latest_v"]) == (rid, v)


def test_a_hot_key_is_in_many_chunks(spark):
    rows = spark.range(40_000, numPartitions=4).select(F.lit("hot").alias("k"), F.col("id").alias("at"), (F.col("id") % 5).alias("x"))
    chunked = range_chunks(rows, ["k", "at"])
    sizes = [r["count"] for r in chunked.groupBy("chunk").count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 20_000
    summed = running_sums(chunked, ["k"], ["at"], {"n": F.lit(1), "total": F.col("x")})
    latest = carried(summed, ["k"], ["at"], {"last": F.when(F.col("at") % 15_000 == 0, F.col("at"))})
    assert latest.filter("n <> at + 1").count() == 0
    assert latest.filter("total <> 10 * ((at + 1) div 5) + ((at + 1) % 5) * ((at + 1) % 5 - 1) div 2").count() == 0
    assert latest.filter("at > 0 and last <> 15000 * ((at - 1) div 15000)").count() == 0
    assert with_next(chunked, ["at"]).filter("next.at <> at + 1").count() == 0
