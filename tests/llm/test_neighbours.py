"""Approximate neighbours: exact scores and order, recall against brute force, odd vectors."""

import numpy as np
import pytest

import __spark_entry__ as entry
from ratelens.llm import neighbours
from ratelens.llm.neighbours import CentroidGraph, Lists, balanced_centroids, nearest_neighbours


def brute(ids, vectors, k=10, every=100):
    out = {}
    for own, vector in zip(ids, vectors, strict=True):
        if own % every == 0:
            away = np.sqrt(((vectors - vector) ** 2).sum(axis=1))
            out[own] = sorted((d, i) for d, i in zip(away.tolist(), ids, strict=True) if i != own)[:k]
    return out


def found(df):
    out = {}
    for row in sorted(df.collect(), key=lambda row: (row["query_id"], row["rank"])):
        own = out.setdefault(row["query_id"], [])
        own.append((row["score"], row["vec_id"]))
        assert row["rank"] == len(own)
    return out


@pytest.mark.parametrize("sf", ["0.001", "0.1"])
def test_recall(spark, sf):
    folder = f"/root/testdata/sf{sf}"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids = [row[0] for row in rows]
    vectors = np.array([row[1] for row in rows], np.float32).astype(np.float64)
    want, got = brute(ids, vectors), found(entry.queries()["op12_nearest_neighbours"](spark, folder))
    assert want.keys() == got.keys() and all(len(got[q]) == 10 for q in got)
    hits = sum(len({i for _, i in want[q]} & {i for _, i in got[q]}) for q in want)
    assert hits >= 0.95 * 10 * len(want)
    place = {i: n for n, i in enumerate(ids)}
    for q, near in got.items():
        assert near == sorted(near)
        for score, i in near:
            assert score == pytest.approx(np.sqrt(((vectors[place[q]] - vectors[place[i]]) ** 2).sum()), abs=1e-12)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_copies_ties_and_odd_rows(spark, kind, monkeypatch):
    monkeypatch.setattr(neighbours, "MEMBERS", 16)  # lists and queries in many parts
    monkeypatch.setattr(neighbours, "ASKING", 2)
    values = np.random.default_rng(1).integers(-3, 4, (300, 3)).astype(float)
    values[np.arange(0, 300, 3)] = [1.0, 2.0, 3.0]  # a third are copies
    rows = [(n, vector.tolist(), "x") for n, vector in enumerate(values) if vector.any()]
    odd = [None, [], [0.0, 0.0, 0.0], [1.0, None, 2.0], [float("nan"), 1.0, 1.0], [float("inf"), 1.0, 1.0], [1.0, 2.0]]
    odd = [(1000 + 100 * n, vector, "x") for n, vector in enumerate(odd)] + [(None, [1.0, 2.0, 3.0], "x")]
    schema = f"vec_id long, embedding array<{kind}>, list string"
    df = nearest_neighbours(spark.createDataFrame(rows + odd + rows[:5], schema), every=10, settings=Lists(fewest=128))
    ids, vectors = [row[0] for row in rows], np.array([row[1] for row in rows])
    assert found(df) == brute(ids, vectors, every=10)  # every list is looked into


def test_few_rows_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    assert nearest_neighbours(spark.createDataFrame([], schema)).count() == 0
    assert nearest_neighbours(spark.createDataFrame([(0, [1.0])], schema)).count() == 0
    assert found(nearest_neighbours(spark.createDataFrame([(0, [1.0]), (1, [3.0])], schema))) == {0: [(2.0, 1)]}


def test_queries_that_find_too_few_look_everywhere(spark):
    """Lists of two vectors, of which a query takes one."""
    rows = [(n, [float(n), 1.0]) for n in range(64)]
    settings = Lists(lists=32, least=2, copies=1, fewest=1, most=1)
    df = nearest_neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), every=16, settings=settings)
    assert found(df) == brute([n for n, _ in rows], np.array([v for _, v in rows]), every=16)


def test_graph_finds_nearest_centroids():
    rng = np.random.default_rng(5)
    centroids = balanced_centroids(rng.normal(size=(4000, 16)), 128)
    assert len(centroids) == 128
    vectors = rng.normal(size=(200, 16))
    number, away = CentroidGraph(centroids).nearest(vectors, 10, 40)
    exact = np.sqrt(((vectors[:, None] - centroids[None]) ** 2).sum(axis=2))
    assert np.allclose(away, np.take_along_axis(exact, number, axis=1))
    assert all(len(set(row)) == 10 for row in number)
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(number, np.argsort(exact, axis=1)[:, :10], strict=True)]) > 0.95
