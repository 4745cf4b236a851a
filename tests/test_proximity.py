"""The neighbourhood totals against brute force over all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratelens.operators.proximity import PAIR_LIMIT, local_competitiveness, totals_within

R = 6371.0


def brute_force(lat, lng, weight, km):
    lat, lng = np.radians(lat), np.radians(lng)
    h = np.sin((lat[:, None] - lat) / 2) ** 2 + np.cos(lat[:, None]) * np.cos(lat) * np.sin((lng[:, None] - lng) / 2) ** 2
    near = 2 * R * np.arcsin(np.sqrt(np.minimum(1.0, h))) <= km
    return near.sum(axis=1), near @ weight


def points(kind, rng, n):
    if kind == "world":
        return np.degrees(np.arcsin(rng.uniform(-1, 1, n))), rng.uniform(-180, 180, n)
    if kind == "pole":
        return np.concatenate([rng.uniform(89.97, 90, n // 2), rng.uniform(-90, -89.97, n - n // 2)]), rng.uniform(-180, 180, n)
    if kind == "date line":
        lng = 180 + rng.normal(0, 0.02, n)
        return rng.normal(10, 0.02, n), np.where(lng > 180, lng - 360, lng)
    if kind == "city":  # most points within a few streets, a third of them very close
        spread = np.where(rng.uniform(size=n) < 0.33, 0.0005, 0.02)
        return 48.85 + rng.normal(0, 1, n) * spread, 2.35 + rng.normal(0, 1, n) * spread
    if kind == "grid":
        side = int(math.sqrt(n))
        i = np.arange(side * side)
        return 45 + (i % side) * 0.004, 9 + (i // side) * 0.004
    raise ValueError(kind)


@pytest.mark.parametrize(
    "kind, km, limit",
    [
        ("world", 500.0, PAIR_LIMIT),
        ("world", 20_100.0, 256),
        ("pole", 1.5, 256),
        ("date line", 2.0, 256),
        ("city", 0.5, 256),
        ("city", 2.0, 500),
        ("city", 0.01, 256),
        ("grid", 1.0, 256),
        ("grid", 0.0, 256),
    ],
)
def test_totals_equal_brute_force(spark, kind, km, limit):
    rng = np.random.default_rng(7)
    lat, lng = points(kind, rng, 400)
    weight = rng.integers(1, 100, len(lat)).astype(float)
    rows = [(float(a), float(b), 1, 1, float(w)) for a, b, w in zip(lat, lng, weight)]
    places = spark.createDataFrame(rows, "lat double, lng double, n long, scored long, total double")
    found = {(r["lat"], r["lng"]): (r["n"], r["total"]) for r in totals_within(places, km, limit).collect()}
    counts, totals = brute_force(lat, lng, weight, km)
    assert found == {(a, b): (c, t) for a, b, c, t in zip(lat.tolist(), lng.tolist(), counts.tolist(), totals.tolist())}


def test_hot_spot(spark):
    """A third of the entities share one spot; some lack a score or a place."""
    rng = np.random.default_rng(3)
    n = 600
    lat, lng = points("city", rng, n)
    lat[: n // 3], lng[: n // 3] = 48.85, 2.35
    score = rng.integers(20, 100, n) / 8.0
    rows = [
        (f"H{i}", None if i % 50 == 1 else float(score[i]), None if i % 40 == 3 else float(lat[i]), float(lng[i]))
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, "Hotel_Name string, Average_Score double, lat double, lng double")
    found = {r["Hotel_Name"]: r for r in local_competitiveness(df, 0.3, 3, pair_limit=256).collect()}
    placed = [r for r in rows if r[2] is not None]
    a, b = np.array([r[2] for r in placed]), np.array([r[3] for r in placed])
    scored = np.array([0.0 if r[1] is None else 1.0 for r in placed])
    value = np.array([r[1] or 0.0 for r in placed])
    counts, totals = brute_force(a, b, value, 0.3)
    _, having = brute_force(a, b, scored, 0.3)
    expected = {r[0]: i for i, r in enumerate(placed) if counts[i] - 1 >= 3}
    assert set(found) == set(expected)
    for name, i in expected.items():
        assert found[name]["Competitor_Count"] == counts[i] - 1
        mean = (totals[i] - value[i]) / (having[i] - scored[i])
        assert found[name]["Neighborhood_Avg_Score"] == pytest.approx(mean)


def test_dense_area_is_not_compared_pair_by_pair(spark, monkeypatch):
    """Most neighbours of a dense area come from whole cells, not from pairs of places."""
    from ratelens.operators import proximity

    compared = []
    original = proximity._from_points

    def counting(pairs, places, level, km):
        compared.append(pairs.agg(F.sum("point_pairs")).first()[0] or 0)
        return original(pairs, places, level, km)

    monkeypatch.setattr(proximity, "_from_points", counting)
    rng = np.random.default_rng(1)
    n = 3000
    lat, lng = 45 + rng.uniform(0, 0.02, n), 9 + rng.uniform(0, 0.02, n)
    rows = [(float(a), float(b), 1, 1, 1.0) for a, b in zip(lat, lng)]
    places = spark.createDataFrame(rows, "lat double, lng double, n long, scored long, total double")
    found = totals_within(places, 1.0, pair_limit=256).agg(F.sum("n")).first()[0]
    counts, _ = brute_force(lat, lng, np.ones(n), 1.0)
    assert found == counts.sum()
    assert sum(compared) < n * n / 4
