"""Comparison of each entity with its neighbours within a radius."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.functions.checkpoints import checkpointed
from ratelens.functions.geo import EARTH_RADIUS_KM, haversine_km, unit_sphere
from ratelens.functions.numeric import stable
from ratelens.operators.entities import entities
from ratelens.sources.schema import REVIEWS, ReviewColumns

AXES = ("x", "y", "z")
TOTALS = ("n", "scored", "total")  # entities, entities with a score, sum of their scores

# Pairs of cells with at most this many pairs of places are compared place by
# place: halving both would cost more. A cell meets 27 others at most, so this
# also bounds the comparisons under one join key, at any size of the data.
PAIR_LIMIT = 10_000


def _cells(places: DataFrame, level: int, prefix: str) -> DataFrame:
    """Cubes of side 2^-level that hold a place: extent, number of places and totals."""
    keyed = places.select(
        *[F.floor(F.col(a) * float(2**level)).alias(f"{prefix}cell_{a}") for a in AXES], *AXES, *TOTALS
    )
    return keyed.groupBy(*[f"{prefix}cell_{a}" for a in AXES]).agg(
        F.count("*").alias(f"{prefix}places"),
        *[F.min(a).alias(f"{prefix}min_{a}") for a in AXES],
        *[F.max(a).alias(f"{prefix}max_{a}") for a in AXES],
        *[F.sum(t).alias(f"{prefix}{t}") for t in TOTALS],
    )


def _gap_squared() -> Column:
    """Smallest possible squared distance between the extents of cells a and b."""
    out = F.lit(0.0)
    for axis in AXES:
        gap = F.greatest(
            F.lit(0.0),
            F.col(f"a_min_{axis}") - F.col(f"b_max_{axis}"),
            F.col(f"b_min_{axis}") - F.col(f"a_max_{axis}"),
        )
        out = out + gap * gap
    return out


def _reach_squared() -> Column:
    """Greatest possible squared distance between the extents of cells a and b."""
    out = F.lit(0.0)
    for axis in AXES:
        reach = F.greatest(
            F.col(f"a_max_{axis}") - F.col(f"b_min_{axis}"), F.col(f"b_max_{axis}") - F.col(f"a_min_{axis}")
        )
        out = out + reach * reach
    return out


def _width() -> Column:
    """Longest side of the extents of cells a and b."""
    return F.greatest(*[F.col(f"{p}max_{a}") - F.col(f"{p}min_{a}") for p in ("a_", "b_") for a in AXES])


def totals_within(places: DataFrame, km_radius: float, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """Totals of all places within the radius of each place, itself included.

    ``places`` has one row per distinct ``lat``, ``lng`` with the columns of
    ``TOTALS``. The result is exact and no dense area is compared pair by pair:

    1. Places become points on the unit sphere, where "within r km" is "within
       a fixed straight distance" and neither poles nor the date line are special.
       Cubes as wide as that distance make each place's candidates those of 27 cubes.
    2. Cubes are compared through the extents of their places. A pair wholly
       within the distance adds the totals of the one to the other, a pair wholly
       beyond it is dropped, and only pairs the distance cuts through are halved
       and compared again.
    3. Pairs of cubes with at most ``pair_limit`` pairs of places are compared
       place by place, all others are halved, however many there are.

    Every join is on a cube, whose matches are bounded by geometry (27 cubes or
    8 halves), not by how many entities crowd into it.
    """
    chord = 2 * math.sin(min(km_radius / (2 * EARTH_RADIUS_KM), math.pi / 2))
    side = max(chord, 1e-9) * (1 + 1e-6)
    distance, margin = chord / side, 1e-9 + 1e-12 / side
    surely, possibly = max(distance - margin, 0.0) ** 2, (distance + margin) ** 2
    # Only pairs as far apart as the radius, up to rounding, need the great circle.
    straight = sum(((F.col(a) - F.col(f"b_{a}")) ** 2 for a in AXES), F.lit(0.0))
    km = haversine_km(F.col("lat"), F.col("lng"), F.col("b_lat"), F.col("b_lng"))
    within = (straight <= surely) | ((straight <= possibly) & (km <= km_radius))
    sphere = unit_sphere(F.col("lat"), F.col("lng"))
    places = checkpointed(
        places.select("lat", "lng", *[(sphere[a] / side).alias(a) for a in AXES], *TOTALS)
    )

    cells = [f"{p}cell_{a}" for p in ("a_", "b_") for a in AXES]
    steps = F.array(*[F.lit(d) for d in (-1, 0, 1)])
    around = _cells(places, 0, "a_")
    for axis in AXES:
        around = around.withColumn(f"step_{axis}", F.explode(steps))
    pairs = around.select(
        *[c for c in around.columns if not c.startswith("step_")],
        *[(F.col(f"a_cell_{a}") + F.col(f"step_{a}")).alias(f"b_cell_{a}") for a in AXES],
    ).join(_cells(places, 0, "b_"), [f"b_cell_{a}" for a in AXES])

    parts = []
    level = 0
    while True:
        pairs = checkpointed(
            pairs.filter(_gap_squared() <= possibly)
            .withColumn("inside", _reach_squared() <= surely)
            .withColumn("point_pairs", F.col("a_places") * F.col("b_places"))
            .withColumn("small", (F.col("point_pairs") <= pair_limit) | (_width() <= margin))
            .select(*cells, *[f"b_{t}" for t in TOTALS], "inside", "point_pairs", "small")
        )
        cut, small = ~F.col("inside"), F.col("small")
        parts.append(_from_inside(pairs.filter("inside"), places, level))
        parts.append(_from_points(pairs.filter(cut & small), places, level, within))
        pairs = pairs.filter(cut & ~small)
        if pairs.isEmpty():
            break
        level += 1
        pairs = _halved(pairs, places, level)

    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.groupBy("lat", "lng").agg(*[F.sum(t).alias(t) for t in TOTALS])


def _halved(pairs: DataFrame, places: DataFrame, level: int) -> DataFrame:
    """The same pairs one level down."""
    out = pairs.select(*[f"{p}cell_{a}" for p in ("a_", "b_") for a in AXES])
    for prefix in ("a_", "b_"):
        parents = [f"{prefix}parent_{a}" for a in AXES]
        children = _cells(places, level, prefix).withColumns(
            {f"{prefix}parent_{a}": F.shiftright(f"{prefix}cell_{a}", 1) for a in AXES}
        )
        out = out.withColumnsRenamed({f"{prefix}cell_{a}": f"{prefix}parent_{a}" for a in AXES})
        out = out.join(children, parents).drop(*parents)
    return out


def _keyed(places: DataFrame, level: int, prefix: str, keep: dict[str, str]) -> DataFrame:
    """The places with their cell of that level."""
    return places.select(
        *[F.floor(F.col(a) * float(2**level)).alias(f"{prefix}cell_{a}") for a in AXES],
        *[F.col(name).alias(out) for name, out in keep.items()],
    )


def _from_inside(pairs: DataFrame, places: DataFrame, level: int) -> DataFrame:
    """Totals of cells that lie wholly within the radius, handed to each place of the other cell."""
    keys = [f"a_cell_{a}" for a in AXES]
    per_cell = pairs.groupBy(*keys).agg(*[F.sum(f"b_{t}").alias(t) for t in TOTALS])
    return per_cell.join(_keyed(places, level, "a_", {"lat": "lat", "lng": "lng"}), keys).select("lat", "lng", *TOTALS)


def _from_points(pairs: DataFrame, places: DataFrame, level: int, within: Column) -> DataFrame:
    """Totals of the single places within the radius, for pairs of cells it cuts through.

    The pairs of cells are few bytes but much work, so they are spread over all
    tasks by number: by size Spark would put them into one or two. They are
    dealt by the key of the join that follows, which then needs no exchange.
    """
    cells = [f"{p}cell_{a}" for p in ("a_", "b_") for a in AXES]
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    candidates = pairs.select(*cells).repartition(tasks, *[f"a_cell_{a}" for a in AXES])
    point = ["lat", "lng", *AXES]
    left = _keyed(places, level, "a_", {c: c for c in point})
    right = _keyed(places, level, "b_", {**{c: f"b_{c}" for c in point}, **{t: t for t in TOTALS}})
    return (
        candidates.join(left, [f"a_cell_{a}" for a in AXES])
        .join(right, [f"b_cell_{a}" for a in AXES])
        .filter(within)
        .groupBy("lat", "lng")
        .agg(*[F.sum(t).alias(t) for t in TOTALS])
    )


def local_competitiveness(
    df: DataFrame,
    km_radius: float = 2.0,
    min_competitors: int = 3,
    pair_limit: int = PAIR_LIMIT,
    cols: ReviewColumns = REVIEWS,
    ordered: bool = True,
) -> DataFrame:
    """Score of each entity against the mean score of the others within ``km_radius``.

    Entities at one and the same spot are folded to a place first. Each entity
    then takes the totals around its place, less its own share. Without
    ``ordered`` the rows come unsorted, for a report on them.
    """
    hotels = checkpointed(
        entities(df, {"Average_Score": cols.entity_score, "lat": cols.lat, "lng": cols.lng}, cols).filter(
            F.col("lat").isNotNull() & F.col("lng").isNotNull()
        )
    )
    score = F.col("Average_Score")
    places = hotels.groupBy("lat", "lng").agg(
        F.count("*").alias("n"),
        F.count(score).alias("scored"),
        F.coalesce(F.sum(score.cast("double")), F.lit(0.0)).alias("total"),
    )
    others = F.col("scored") - F.when(score.isNull(), 0).otherwise(1)
    others_total = F.col("total") - F.coalesce(score, F.lit(0.0))
    result = (
        hotels.join(totals_within(places, km_radius, pair_limit), ["lat", "lng"])
        .select(
            cols.entity,
            "Average_Score",
            F.try_divide(others_total, F.nullif(others, F.lit(0))).alias("Neighborhood_Avg_Score"),
            (F.col("n") - 1).alias("Competitor_Count"),
        )
        .filter(F.col("Competitor_Count") >= F.greatest(F.lit(min_competitors), F.lit(1)))
        .withColumn("Score_Delta", score - F.col("Neighborhood_Avg_Score"))
        .withColumn("Status", F.when(stable("Score_Delta") > 0, "Outperformer").otherwise("Underperformer"))
    )
    return result.orderBy(stable("Score_Delta").desc(), cols.entity) if ordered else result
