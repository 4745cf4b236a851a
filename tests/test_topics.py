import pytest
from pyspark.sql import functions as F

from ratelens.operators.topics import (
    derived_sentiment,
    entity_reviews,
    negative_topic_frequency,
    review_text,
    topic_score_impact,
    topic_tagging,
    topic_trends,
)


# Four tagged reviews with known counts.
@pytest.fixture(scope="module")
def enriched(spark):
    return spark.createDataFrame(
        [
            ("8/3/2017", 9.0, "Great location but noisy.", "Negative", ["Location", "Noise"]),
            ("7/15/2017", 5.0, "Terrible service.", "Negative", ["Service"]),
            ("6/10/2017", 10.0, "Perfect.", "Positive", ["Everything"]),
            ("8/4/2017", 8.5, "Good but expensive.", "Negative", ["Value"]),
        ],
        "Review_Date string, Reviewer_Score double, Review_Text string, Derived_Sentiment string, Topics array<string>",
    )


def test_negative_topic_frequency(enriched):
    rows = {r["Topic"]: r["Frequency"] for r in negative_topic_frequency(enriched).collect()}
    assert rows == {"Location": 1, "Noise": 1, "Service": 1, "Value": 1}


def test_topic_trends(enriched):
    rows = {(r["Month_Year"], r["Topic"]): r["Count"] for r in topic_trends(enriched).collect()}
    assert rows == {
        ("2017-08", "Location"): 1,
        ("2017-08", "Noise"): 1,
        ("2017-08", "Value"): 1,
        ("2017-07", "Service"): 1,
        ("2017-06", "Everything"): 1,
    }


def test_topic_score_impact(enriched):
    assert topic_score_impact(enriched).count() == 0
    rows = {r["Topic"]: r for r in topic_score_impact(enriched, 1).collect()}
    assert {r["Global_Average"] for r in rows.values()} == {8.125}
    assert rows["Service"]["Impact"] == -3.125
    without_topics = enriched.withColumn("Topics", F.lit(None).cast("array<string>"))
    assert topic_score_impact(without_topics, 1).count() == 0
    half = enriched.withColumn("Topics", F.when(F.col("Reviewer_Score") > 8.6, F.col("Topics")))
    assert topic_score_impact(half, 1).first()["Global_Average"] == 8.125


def test_review_text(micro):
    texts = [r["Review_Text"] for r in review_text(micro).orderBy("Reviewer_Score").collect()]
    # H1 with both halves, H3, H2, and H1 without a negative half; the silent review is dropped.
    assert texts == ["Lovely staff  Noisy street"] * 3 + ["Lovely staff"]


def test_sentiment(spark):
    scores = spark.createDataFrame([(5.9,), (6.0,), (8.0,), (8.1,), (None,)], "Reviewer_Score double")
    rows = derived_sentiment(scores).collect()
    assert [r["Derived_Sentiment"] for r in rows] == ["Negative", "Neutral", "Neutral", "Positive", "Neutral"]


def test_topic_tagging(micro):
    rows = topic_tagging(micro, keep=["Hotel_Name"]).orderBy("Reviewer_Score").collect()
    assert [r["Topics"] for r in rows] == [["Noise", "Staff"]] * 3 + [["Staff"]]
    assert rows[0]["Derived_Sentiment"] == "Negative"


def test_topics_are_whole_words_of_the_whole_text(spark):
    filler = "bla " * 50_000
    texts = spark.createDataFrame(
        [(1, "STAFF!"), (2, "staffing"), (3, filler + "breakfast"), (4, "Frühstück,noisy")], "id int, text string"
    ).select(
        "id",
        F.lit("1/1/2017").alias("Review_Date"),
        F.lit(7.0).alias("Reviewer_Score"),
        F.col("text").alias("Positive_Review"),
        F.lit("No Negative").alias("Negative_Review"),
    )
    rows = {r["id"]: r["Topics"] for r in topic_tagging(texts, keep=["id"]).collect()}
    assert rows == {1: ["Staff"], 2: [], 3: ["Breakfast"], 4: ["Noise"]}


def test_entity_reviews(micro):
    rows = entity_reviews(micro, "H1", 1).collect()
    assert [(r["Review_Date"], r["Reviewer_Score"]) for r in rows] == [("8/3/2017", 9.0)]
    assert entity_reviews(micro, "H2").count() == 2
