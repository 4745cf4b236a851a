"""Rankings of entities within their region."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratelens.functions.parsing import region_of
from ratelens.operators.entities import entities
from ratelens.sources.schema import REVIEWS, ReviewColumns


def top_hotels_by_nation(
    df: DataFrame,
    n: int = 10,
    ties: str = "keep",
    two_word_regions: dict[str, str] | None = None,
    cols: ReviewColumns = REVIEWS,
    ordered: bool = True,
) -> DataFrame:
    """The ``n`` best entities of each region by entity score, then review count.

    ``ties="keep"`` lists every entity tied with the n-th; ``"drop"`` lists
    exactly n, by name. The rank bound lets Spark cut each region to its best
    rows before the shuffle, so a region with a third of the entities is no
    bottleneck. Without ``ordered`` the rows come unsorted, for a report on them.
    """
    if ties not in ("keep", "drop"):
        raise ValueError(f"ties must be 'keep' or 'drop', not {ties!r}")
    order = [F.col(cols.entity_score).desc(), F.col(cols.entity_reviews).desc()]
    if ties == "drop":
        order.append(F.col(cols.entity))
    window = Window.partitionBy("Nation").orderBy(*order)
    position = F.rank() if ties == "keep" else F.row_number()
    attributes = [cols.entity_score, cols.entity_reviews, cols.address]
    attributes += [name for name in (cols.lat, cols.lng) if name in df.columns]
    result = (
        entities(df, {name: name for name in attributes}, cols)
        .withColumn("Nation", region_of(cols.address, two_word_regions))
        .withColumn("position", position.over(window))
        .filter(F.col("position") <= n)
        .select("Nation", cols.entity, *attributes)
    )
    return result.orderBy("Nation", *order, cols.entity) if ordered else result
