"""Results stay whole when one entity, tag and group hold a third of all reviews."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratelens.operators.groups import local_vs_tourist, nationality_composition
from ratelens.operators.regions import top_hotels_by_nation
from ratelens.operators.tags import tag_influence
from ratelens.operators.trends import review_trends, review_trends_udf


@pytest.fixture(scope="module")
def skewed(spark):
    n = 30_000
    i = F.col("id")
    hot = i % 3 == 0
    return spark.range(n, numPartitions=8).select(
        F.when(hot, "Hot").otherwise(F.concat(F.lit("H"), i % 500)).alias("Hotel_Name"),
        F.when(hot, "1 St France").otherwise("2 St Spain").alias("Hotel_Address"),
        F.concat_ws("/", i % 12 + 1, i % 28 + 1, F.lit(2000) + i % 15).alias("Review_Date"),
        ((i * 7919) % 41 / 4.0).alias("Reviewer_Score"),
        F.lit(8.0).alias("Average_Score"),
        F.lit(n).alias("Total_Number_of_Reviews"),
        F.concat(F.lit(" "), F.when(i % 3 < 1, "France").otherwise(F.concat(F.lit("N"), i % 60)), F.lit(" ")).alias(
            "Reviewer_Nationality"
        ),
        F.lit("[' A ', ' B ']").alias("Tags"),
        F.lit("1.0").alias("lat"),
        F.lit("2.0").alias("lng"),
    )


def test_trend_of_the_hot_entity(skewed):
    pdf = skewed.filter("Hotel_Name = 'Hot'").toPandas()
    days = np.array([np.datetime64(f"{y}-{int(m):02d}-{int(d):02d}") for m, d, y in pdf["Review_Date"].str.split("/")])
    slope = np.polyfit(days.astype("datetime64[D]").astype(float), pdf["Reviewer_Score"], 1)[0]
    for analysis in (review_trends, review_trends_udf):
        row = analysis(skewed, 30).filter("Hotel_Name = 'Hot'").first()
        assert row["Review_Count"] == len(pdf) == 10_000
        assert row["Trend_Slope"] == pytest.approx(slope, rel=1e-6)


def test_counts_are_whole(skewed):
    assert {r["Count"] for r in tag_influence(skewed).collect()} == {30_000}
    texts = {r[0]: r[1] for r in nationality_composition(skewed).collect()}
    assert texts["Hot"] == "France (100%)"
    assert len(texts) == skewed.select("Hotel_Name").distinct().count()
    hot = local_vs_tourist(skewed, 0).filter("Hotel_Name = 'Hot'").collect()
    assert hot == []  # nobody but locals


def test_ties_in_a_hot_region_are_all_kept(skewed):
    rows = top_hotels_by_nation(skewed, 1)
    assert rows.filter("Nation = 'Spain'").count() == skewed.select("Hotel_Name").distinct().count() - 1
