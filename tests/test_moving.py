"""Moving scores of many days: frames of any width from running sums, in two shuffles."""

import datetime as dt

import pytest

from ratelens.operators.history import moving_scores
from ratelens.sources.schema import ReviewColumns

COLS = ReviewColumns(entity="e", date="d", score="s")
START = dt.date(2020, 1, 1)


@pytest.fixture(scope="module")
def rows():
    return [(f"e{n % 3}" if n % 10 else None, START + dt.timedelta(days=n * 37 % 301), (n * 7919 % 41) / 8 + 1e-9 * (n % 5)) for n in range(400)]


@pytest.mark.parametrize("days", [1, 2, 200])
def test_frames_of_any_width(spark, rows, days):
    got = moving_scores(spark.createDataFrame(rows, "e string, d date, s double").repartition(5), days, COLS).collect()
    assert sorted(((r["e"] or "", r["Review_Day"]) for r in got)) == sorted({(e or "", d) for e, d, _ in rows})
    for r in got:
        ago = [((r["Review_Day"] - d).days, s) for e, d, s in rows if e == r["e"]]
        last, before = ([s for n, s in ago if first <= n < first + days] for first in (0, days))
        assert r["Moving_Count"] == len(last) and r["Total_Count"] == sum(n >= 0 for n, _ in ago)
        assert r["Moving_Average"] == pytest.approx(sum(last) / len(last), abs=1e-12)
        assert r["Earlier_Average"] == (pytest.approx(sum(before) / len(before), abs=1e-12) if before else None)
        assert r["Change"] == (pytest.approx(r["Moving_Average"] - r["Earlier_Average"]) if before else None)


def test_rows_are_shuffled_by_day_and_by_entity_only(spark, rows):
    moved = moving_scores(spark.createDataFrame(rows, "e string, d date, s double"), 90, COLS)
    plan = moved._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "SortMergeJoin" not in plan and "ExistingRDD" not in plan.split("Window")[0]
