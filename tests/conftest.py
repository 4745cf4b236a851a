import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .appName("ratelens-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def micro(spark):
    """Five reviews of three hotels, with dirty values on purpose."""
    from ratelens.sources.schema import REVIEW_SCHEMA

    def review(hotel, address, date, nation, score, average, total, given, pos, neg, tags, lat, lng):
        return {
            "Hotel_Name": hotel,
            "Hotel_Address": address,
            "Review_Date": date,
            "Reviewer_Nationality": nation,
            "Reviewer_Score": score,
            "Average_Score": average,
            "Total_Number_of_Reviews": total,
            "Total_Number_of_Reviews_Reviewer_Has_Given": given,
            "Review_Total_Positive_Word_Counts": pos,
            "Review_Total_Negative_Word_Counts": neg,
            "Tags": tags,
            "lat": lat,
            "lng": lng,
            "Additional_Number_of_Scoring": 1,
            "Positive_Review": "No Positive" if pos == 0 else "Lovely staff",
            "Negative_Review": "No Negative" if neg == 0 else " Noisy street ",
            "days_since_review": "1 days",
        }

    london, paris = "1 A St London United Kingdom", "2 Rue X Paris France"
    rows = [
        review("H1", london, "8/3/2017", " United Kingdom ", 9.0, 8.5, 100, 3, 10, 0,
               "[' Leisure trip ', ' Couple ', ' Stayed 2 nights ']", "51.50", "-0.12"),
        review("H1", london, "12/31/2016", " France ", 5.0, 8.5, 100, 30, 2, 8,
               "[' Business trip ', ' Solo traveler ', ' Stayed 1 night ']", "51.50", "-0.12"),
        review("H2", paris, "13/45/2017", " France ", 7.0, 8.5, 80, 10, 5, 5,
               "[' Leisure trip ', ' Family with young children ', ' Stayed 8 nights ']", "NA", "NA"),
        review("H2", paris, "2/1/2017", "  ", 8.0, 8.5, 80, 26, 0, 0, "[]", "NA", "NA"),
        review("H3", "3 B St London United Kingdom ", "4/10/2017", " United Kingdom ", 6.0, 8.0, 50, None, 4, 4,
               "[' Group ', ' Stayed 0 nights ']", "51.51", "-0.12"),
    ]
    return spark.createDataFrame([[row[name] for name in REVIEW_SCHEMA.names] for row in rows], REVIEW_SCHEMA)
