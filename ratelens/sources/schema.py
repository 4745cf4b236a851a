"""Schema of a review table and the role names the operators work with."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Field names, types and order of the review file.
REVIEW_SCHEMA = T.StructType(
    [
        T.StructField("Hotel_Address", T.StringType()),
        T.StructField("Additional_Number_of_Scoring", T.IntegerType()),
        T.StructField("Review_Date", T.StringType()),
        T.StructField("Average_Score", T.DoubleType()),
        T.StructField("Hotel_Name", T.StringType()),
        T.StructField("Reviewer_Nationality", T.StringType()),
        T.StructField("Negative_Review", T.StringType()),
        T.StructField("Review_Total_Negative_Word_Counts", T.IntegerType()),
        T.StructField("Total_Number_of_Reviews", T.IntegerType()),
        T.StructField("Positive_Review", T.StringType()),
        T.StructField("Review_Total_Positive_Word_Counts", T.IntegerType()),
        T.StructField("Total_Number_of_Reviews_Reviewer_Has_Given", T.IntegerType()),
        T.StructField("Reviewer_Score", T.DoubleType()),
        T.StructField("Tags", T.StringType()),
        T.StructField("days_since_review", T.StringType()),
        T.StructField("lat", T.StringType()),
        T.StructField("lng", T.StringType()),
    ]
)


@dataclass(frozen=True)
class ReviewColumns:
    """Which column of the fact table plays which role.

    The defaults are the field names of :data:`REVIEW_SCHEMA`; any other fact
    table with an entity, a score, a date, tags or a reviewer group is used by
    naming its columns here.
    """

    entity: str = "Hotel_Name"
    address: str = "Hotel_Address"
    entity_score: str = "Average_Score"
    entity_reviews: str = "Total_Number_of_Reviews"
    lat: str = "lat"
    lng: str = "lng"
    date: str = "Review_Date"
    score: str = "Reviewer_Score"
    group: str = "Reviewer_Nationality"
    history: str = "Total_Number_of_Reviews_Reviewer_Has_Given"
    tags: str = "Tags"
    positive_text: str = "Positive_Review"
    negative_text: str = "Negative_Review"
    positive_words: str = "Review_Total_Positive_Word_Counts"
    negative_words: str = "Review_Total_Negative_Word_Counts"
    additional_scores: str = "Additional_Number_of_Scoring"


REVIEWS = ReviewColumns()
