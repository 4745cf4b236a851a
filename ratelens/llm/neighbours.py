"""Approximate nearest neighbours by balanced posting lists, whose centroids are searched by a graph in memory."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratelens.llm.common import written

# Vectors of a list, and queries, that are compared with one another at once.
MEMBERS = 4_096
ASKING = 1_024

# Links of a centroid in the graph.
DEGREE = 16


@dataclass(frozen=True)
class Lists:
    """Settings of the index and of the search.

    The index is fitted on ``sample`` vectors at most, chosen by a hash, which
    are halved into equal parts until there are ``lists`` (a list has
    ``least`` of the sample at least). A vector is kept in up to ``copies``
    lists whose centroids are no farther than ``boundary`` times the nearest one.
    A query takes at least ``fewest`` and at most ``most`` lists, those within
    ``ratio`` times the distance of the nearest centroid.
    """

    lists: int = 128
    sample: int = 16_384
    least: int = 16
    copies: int = 4
    boundary: float = 1.2
    fewest: int = 12
    most: int = 48
    ratio: float = 1.15


def packed(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, size, vec): the usable vectors as bytes, single or double precision as given."""
    single = rows.schema[vector_col].dataType.elementType == T.FloatType()
    kind, form = (T.FloatType(), "<f4") if single else (T.DoubleType(), "<f8")
    given = rows.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast(T.ArrayType(kind)).alias("vector")
    ).filter("vec_id is not null and size(vector) > 0 and not exists(vector, x -> x is null)")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(1)
            values = np.asarray(vectors.flatten()).astype(form) + np.array(0, form)  # no negative zeros
            ends = np.concatenate([[0], np.cumsum([len(v) for v in vectors])])
            own = [values[a:b] for a, b in zip(ends, ends[1:])]  # noqa: B905
            use = [bool(np.isfinite(v).all() and v.any()) for v in own]
            chosen = [v for v, used in zip(own, use, strict=True) if used]
            columns = [
                batch.column(0).filter(pa.array(use, pa.bool_())),
                pa.array([len(v) for v in chosen], pa.int32()),
                pa.array([v.tobytes() for v in chosen], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "size", "vec"])

    return given.mapInArrow(run, "vec_id long, size int, vec binary")


def balanced_centroids(sample: np.ndarray, lists: int) -> np.ndarray:
    """Means of equal parts, by halving each part along the line between two means."""
    parts = [sample]
    while 2 * len(parts) <= lists:
        halves = []
        for part in parts:
            chosen = np.random.default_rng(len(part)).choice(len(part), 2, replace=False)
            first, second = part[chosen]
            for _ in range(8):
                order = np.argsort(part @ (second - first), kind="stable")
                near, far = part[order[: len(part) // 2]], part[order[len(part) // 2 :]]
                first, second = near.mean(axis=0), far.mean(axis=0)
            halves += [near, far]
        parts = halves
    return np.stack([part.mean(axis=0) for part in parts])


class CentroidGraph:
    """Centroids linked to their nearest ones and to a few others, searched from a fixed start for many vectors at once."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        n = len(centroids)
        near = np.argsort(self._distances(centroids, np.broadcast_to(np.arange(n), (n, n))), axis=1, kind="stable")
        links = near[:, 1 : DEGREE + 1]
        # links of a ring reach every centroid, whatever the nearest ones are
        ring = np.stack([(np.arange(n) + step) % n for step in (1, n // 2 or 1)], axis=1)
        links = np.concatenate([links, ring], axis=1)
        for row, own in enumerate(links):  # one link to each, others lead nowhere
            first = np.unique(own, return_index=True)[1]
            links[row] = np.where(np.isin(np.arange(len(own)), first), own, row)
        self.links = links

    def _distances(self, vectors: np.ndarray, at: np.ndarray) -> np.ndarray:
        away = self.centroids[at] - vectors[:, None, :]
        return np.sqrt(np.einsum("ijk,ijk->ij", away, away))

    def nearest(self, vectors: np.ndarray, count: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and distances of about the ``count`` nearest centroids of each vector, by a beam of ``width``."""
        n, total = len(vectors), len(self.centroids)
        count, width = min(count, total), min(max(count, width), total)
        rows = np.arange(n)
        start = np.zeros((n, 1), np.int64)
        beam, away = start, self._distances(vectors, start)
        seen = np.zeros((n, total), bool)
        seen[:, 0] = True
        open_ = np.ones((n, 1), bool)
        while open_.any():
            waiting = np.where(open_, away, np.inf)
            best = waiting.argmin(axis=1)
            live = rows[np.isfinite(waiting[rows, best])]
            open_[live, best[live]] = False
            found = self.links[beam[live, best[live]]]
            fresh = ~seen[live[:, None], found]
            seen[live[:, None], found] = True
            far = np.full((n, found.shape[1]), np.inf)
            far[live] = np.where(fresh, self._distances(vectors[live], found), np.inf)
            number = np.zeros((n, found.shape[1]), np.int64)
            number[live] = found
            beam, away = np.concatenate([beam, number], axis=1), np.concatenate([away, far], axis=1)
            open_ = np.concatenate([open_, np.isfinite(far)], axis=1)
            order = np.argsort(away, axis=1, kind="stable")[:, :width]
            beam, away, open_ = (np.take_along_axis(x, order, axis=1) for x in (beam, away, open_))
        return beam[:, :count], away[:, :count]


def _vectors(column: pa.Array, form: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), form).astype(np.float64).reshape(len(column), -1)


def _routed(rows: DataFrame, graph: CentroidGraph, form: str, most: int, fewest: int, ratio: float) -> DataFrame:
    """``rows`` (with vec), once for each of the lists that a vector is kept in or looked for."""
    schema = T.StructType([T.StructField("list", T.IntegerType()), *rows.schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1_024):
                part = batch.slice(at, 1_024)
                number, away = graph.nearest(_vectors(part.column("vec"), form), most, 2 * most)
                chosen = np.isfinite(away) & (away <= ratio * away[:, :1])
                chosen[:, :fewest] |= np.isfinite(away[:, :fewest])
                row, place = np.nonzero(chosen)
                made = part.take(pa.array(row))
                lists = pa.array(number[row, place].astype(np.int32))
                yield pa.RecordBatch.from_arrays([lists, *made.columns], ["list", *batch.schema.names])

    return rows.mapInArrow(run, schema)


def _found(members: DataFrame, asking: DataFrame, k: int, form: str) -> DataFrame:
    """(key, found): the ``k`` nearest ids of each asking key in the lists asked for, nearest first.

    A list is parted by its members and by its queries, so that a task compares
    a bounded number of both.
    """
    sizes = members.groupBy("list").agg(F.count("*").alias("members"))
    asked = asking.groupBy("list").agg(F.count("*").alias("asking"))
    parts = written(
        sizes.join(asked, "list").select(
            "list", F.ceil(F.col("members") / MEMBERS).cast("int").alias("m"), F.ceil(F.col("asking") / ASKING).cast("int").alias("a")
        )
    )  # a row for each list
    of_member = members.join(F.broadcast(parts), "list").select(
        "list", F.pmod(F.xxhash64("vec"), "m").alias("m"), F.explode(F.sequence(F.lit(0), F.col("a") - 1)).alias("a"), "ids", "vec"
    )
    of_query = asking.join(F.broadcast(parts), "list").select(
        "list", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)).alias("m"), F.pmod(F.xxhash64("key"), "a").cast("int").alias("a"), "key", "vec"
    )

    def compared(queries: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(held):
            have = np.stack([np.frombuffer(v, form) for v in held["vec"]]).astype(np.float64)
            first = np.array([ids[0] for ids in held["ids"]])
            lists = list(held["ids"])
            for key, vec in zip(queries["key"], queries["vec"], strict=True):
                away = np.sqrt(((have - np.frombuffer(vec, form).astype(np.float64)) ** 2).sum(axis=1))
                if len(away) > k:
                    limit = np.partition(away, k - 1)[k - 1]
                    near = np.flatnonzero(away <= limit)
                else:
                    near = np.arange(len(away))
                near = near[np.lexsort((first[near], away[near]))][:k]
                best = sorted((away[n], i) for n in near for i in lists[n])[:k]
                out += [(key, i, float(score)) for score, i in best]
        return pd.DataFrame(out, columns=["key", "id", "score"])

    of = ["list", "m", "a"]
    near = of_query.groupBy(of).cogroup(of_member.groupBy(of)).applyInPandas(compared, "key binary, id long, score double")
    once = near.groupBy("key", "id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("key").orderBy("score", "id"))
    best = once.withColumn("rank", rank).filter(F.col("rank") <= k)
    return best.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("score", "id"))).alias("found"))


def nearest_neighbours(
    rows: DataFrame,
    k: int = 10,
    every: int = 100,
    settings: Lists = Lists(),
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The ``k`` nearest vectors of each vector whose id is divisible by ``every``, among all others.

    Columns query_id, rank, vec_id and score, the Euclidean distance in double
    precision; ties go to the smaller vec_id. A query without ``k`` others
    has them all. Vectors that are NULL, empty, zero or hold a NULL or a
    number that isn't finite take no part, nor do rows without an id and vectors
    of another length than most have. Of rows that share an id one counts, that of the least bytes.
    Other columns don't matter; an empty table gives no rows.

    Equal vectors are folded before anything is compared: the k + 1 smallest ids
    of such a class can't leave out a neighbour. The class is kept in the lists
    of the nearest centroids that lie about as near; a query looks into the
    lists chosen in the same way. Only for queries that find too few
    all lists are searched.
    """
    form = "<f4" if rows.schema[vector_col].dataType.elementType == T.FloatType() else "<f8"
    usable = written(packed(rows, id_col, vector_col))
    common = usable.groupBy("size").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").first()
    usable = usable.filter(F.col("size") == (common["size"] if common else 0))
    usable = written(usable.groupBy("vec_id").agg(F.min("vec").alias("vec")))

    ranked = usable.withColumn("nth", F.row_number().over(Window.partitionBy("vec").orderBy("vec_id")))
    classes = written(
        ranked.filter(F.col("nth") <= k + 1).groupBy("vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    )
    key = F.unhex(F.md5("vec")).alias("key")
    queries = usable.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), key, "vec")
    asking = written(queries.select("key", "vec").distinct())

    count = classes.count()
    chosen = classes.orderBy(F.xxhash64("vec"), "vec").limit(settings.sample).select("vec").toPandas()["vec"]
    sample = np.stack([np.frombuffer(v, form) for v in chosen]).astype(np.float64) if count else np.zeros((1, 1))
    lists = min(settings.lists, max(1, len(sample) // settings.least))
    graph = CentroidGraph(balanced_centroids(sample, lists))

    members = written(_routed(classes.select("ids", "vec"), graph, form, settings.copies, 1, settings.boundary))
    looked = written(_routed(asking, graph, form, settings.most, settings.fewest, settings.ratio))
    found = written(_found(members, looked, k + 1, form))
    some = min(k + 1, usable.count())
    short = asking.join(found.filter(F.size("found") >= some), "key", "left_anti")
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(len(graph.centroids) - 1))).alias("list")
    rest = _found(members, written(short.select(everywhere, "key", "vec")), k + 1, form)
    found = found.join(rest.select("key"), "key", "left_anti").unionByName(rest)

    of_query = queries.select("query_id", "key").join(found, "key")
    others = F.slice(F.filter("found", lambda x: x["id"] != F.col("query_id")), 1, k)
    return of_query.select("query_id", F.posexplode(others).alias("rank", "near")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), F.col("near.id").alias("vec_id"), F.col("near.score").alias("score")
    )
