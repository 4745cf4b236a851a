"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.functions.checkpoints import checkpointed


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b), in rounds of contraction.

    In a round every node takes the smallest name among itself and its
    neighbours, edges are renamed, and those inside a node go. Rounds end when
    no edge is left; the driver sees only whether one is. Each round is written
    to the checkpoint folder, so a lost executor never repeats earlier rounds.
    No edges give no rows; edges of a node to itself give that node alone, and
    edges with a NULL end are none.
    """
    edges = edges.select("a", "b").filter(F.col("a").isNotNull() & F.col("b").isNotNull())
    both = checkpointed(edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    names = both.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    left = both.filter("a <> b")
    while not left.isEmpty():
        renamed = checkpointed(
            left.groupBy(F.col("a").alias("old")).agg(F.least(F.min("b"), F.first("a")).alias("new"))
        )
        names = checkpointed(
            names.join(renamed, names["component"] == renamed["old"], "left").select(
                "node", F.coalesce("new", "component").alias("component")
            )
        )
        of_a, of_b = renamed.toDF("a", "new_a"), renamed.toDF("b", "new_b")
        left = checkpointed(
            left.join(of_a, "a")
            .join(of_b, "b")
            .select(F.col("new_a").alias("a"), F.col("new_b").alias("b"))
            .filter("a <> b")
            .distinct()
        )
    return names
