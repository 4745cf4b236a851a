"""Every analysis on five reviews with hand-computed results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ratelens.operators.clustering import segment_features, segment_kmeans, top_groups
from ratelens.operators.entities import entities, top_hotels
from ratelens.operators.groups import (
    local_vs_tourist,
    nationality_bias,
    nationality_composition,
    reviewer_experience,
)
from ratelens.operators.proximity import local_competitiveness
from ratelens.operators.regions import top_hotels_by_nation
from ratelens.operators.seasons import seasonal_preferences
from ratelens.operators.tags import stay_duration, tag_influence, tag_pattern_coverage, tag_pattern_sample
from ratelens.operators.trends import review_trends, review_trends_udf
from ratelens.plans import shortlists as S
from ratelens.sources.files import dataset_row_count, normalize_reviews, read_reviews


@pytest.fixture(params=["raw", "normalized"])
def reviews(request, micro):
    return micro if request.param == "raw" else normalize_reviews(micro)


def keyed(df, *keys):
    return {tuple(row[k] for k in keys) if len(keys) > 1 else row[keys[0]]: row for row in df.collect()}


@pytest.mark.parametrize("analysis", [review_trends, review_trends_udf])
def test_review_trends(reviews, analysis):
    (row,) = analysis(reviews, 2).collect()
    assert row["Hotel_Name"] == "H1"
    assert row["Trend_Slope"] == pytest.approx(4 / 215)
    assert (row["Review_Count"], row["Average_Score_Calculated"], row["Average_Score"]) == (2, 7.0, 8.5)
    assert (row["First_Review_Date"], row["Last_Review_Date"]) == (dt.date(2016, 12, 31), dt.date(2017, 8, 3))


@pytest.mark.parametrize("analysis", [review_trends, review_trends_udf])
def test_one_day_has_slope_zero(micro, analysis):
    same_day = micro.withColumn("Review_Date", F.lit("8/3/2017"))
    assert {row["Trend_Slope"] for row in analysis(same_day, 1).collect()} == {0.0}


def test_trend_small_entities_are_left_out(micro):
    assert review_trends(micro, 101).count() == 0
    assert review_trends_udf(micro, 101).count() == 0


def test_tag_influence(reviews):
    rows = keyed(tag_influence(reviews, 1), "Single_Tag")
    leisure = rows["Leisure trip"]
    assert (leisure["Count"], leisure["Average_Score"], leisure["Global_Average"]) == (2, 8.0, 7.0)
    assert leisure["StdDev_Score"] == pytest.approx(1.414214, abs=1e-6)
    assert leisure["Impact"] == pytest.approx(1.0)
    assert leisure["Reliability_Index"] == pytest.approx(0.457760, abs=1e-6)
    assert leisure["Weighted_Impact"] == pytest.approx(0.457760, abs=1e-6)
    assert "" not in rows
    others = [row for tag, row in rows.items() if tag != "Leisure trip"]
    assert len(others) == 9
    assert all(r["Count"] == 1 and r["StdDev_Score"] is None and r["Weighted_Impact"] is None for r in others)
    assert tag_influence(reviews, 2).count() == 1


def test_tag_reports(micro):
    tags = tag_influence(micro, 1)
    assert keyed(S.tag_consensus_band(tags), "Single_Tag")["Leisure trip"]["Consensus"] == "Normal"
    assert S.tag_top_positive(tags, 1).first()["Single_Tag"] == "Leisure trip"
    assert all(row["Impact"] < 0 for row in S.tag_top_negative(tags).collect())


def test_nationality_bias(reviews):
    rows = keyed(nationality_bias(reviews, 1), "Reviewer_Nationality")
    assert set(rows) == {"United Kingdom", "France"}
    uk, france = rows["United Kingdom"], rows["France"]
    assert (uk["Count"], uk["Average_Score"], uk["Score_Deviation"], uk["Total_Words_Avg"]) == (2, 7.5, 0.5, 9.0)
    assert uk["Sentiment_Ratio"] == pytest.approx(7 / 9)
    assert (france["Count"], france["Average_Score"], france["Score_Deviation"]) == (2, 6.0, -1.0)
    assert (france["Total_Words_Avg"], france["Sentiment_Ratio"]) == (10.0, 0.35)
    assert S.nationality_critics(nationality_bias(reviews, 1), 1).first()["Reviewer_Nationality"] == "France"
    assert S.nationality_generous(nationality_bias(reviews, 1), 1).first()["Reviewer_Nationality"] == "United Kingdom"


def test_no_words_has_ratio_zero(micro):
    silent = micro.withColumns(
        {c: F.lit(0) for c in ("Review_Total_Positive_Word_Counts", "Review_Total_Negative_Word_Counts")}
    )
    assert {row["Sentiment_Ratio"] for row in nationality_bias(silent, 1).collect()} == {0.0}


def test_local_competitiveness(reviews):
    rows = keyed(local_competitiveness(reviews, 2.0, 1), "Hotel_Name")
    assert set(rows) == {"H1", "H3"}
    assert (rows["H1"]["Neighborhood_Avg_Score"], rows["H1"]["Score_Delta"]) == (8.0, 0.5)
    assert (rows["H1"]["Competitor_Count"], rows["H1"]["Status"]) == (1, "Outperformer")
    assert (rows["H3"]["Score_Delta"], rows["H3"]["Status"]) == (-0.5, "Underperformer")
    assert local_competitiveness(reviews, 1.0, 1).count() == 0
    assert [r["Hotel_Name"] for r in S.local_gems(local_competitiveness(reviews, 2.0, 1)).collect()] == ["H1"]
    assert [r["Hotel_Name"] for r in S.local_underperformers(local_competitiveness(reviews, 2.0, 1)).collect()] == ["H3"]


def test_top_hotels_by_nation(reviews):
    rows = keyed(top_hotels_by_nation(reviews, 1), "Nation")
    assert {nation: row["Hotel_Name"] for nation, row in rows.items()} == {"France": "H2", "United Kingdom": "H1"}
    assert (rows["France"]["lat"], rows["France"]["lng"]) == (None, None)
    (center,) = S.map_centroid(top_hotels_by_nation(reviews, 1)).collect()
    assert (center["Center_Lat"], center["Center_Lng"], center["Point_Count"]) == (51.5, -0.12, 1)


def test_ties_are_kept_unless_dropped(micro):
    tied = micro.withColumns({"Average_Score": F.lit(8.0), "Total_Number_of_Reviews": F.lit(10)})
    assert top_hotels_by_nation(tied, 1).filter("Nation = 'United Kingdom'").count() == 2
    dropped = top_hotels_by_nation(tied, 1, ties="drop").filter("Nation = 'United Kingdom'").collect()
    assert [row["Hotel_Name"] for row in dropped] == ["H1"]
    with pytest.raises(ValueError):
        top_hotels_by_nation(tied, 1, ties="some")


def test_local_vs_tourist(reviews):
    rows = keyed(local_vs_tourist(reviews, 1), "Hotel_Name")
    assert set(rows) == {"H1", "H2"}
    h1, h2 = rows["H1"], rows["H2"]
    assert (h1["Local_Avg_Score"], h1["Local_Count"]) == (9.0, 1)
    assert (h1["Tourist_Avg_Score"], h1["Tourist_Count"], h1["Preference_Delta"]) == (5.0, 1, 4.0)
    assert (h2["Local_Avg_Score"], h2["Tourist_Avg_Score"], h2["Preference_Delta"]) == (7.0, 8.0, -1.0)
    assert h1["Top_Nationalities"] == "France (50%), United Kingdom (50%)"
    compared = local_vs_tourist(reviews, 1)
    assert S.preference_delta_mean(compared).first()[0] == 1.5
    assert [r["Hotel_Name"] for r in S.local_favourites(compared, 1).collect()] == ["H1"]
    assert [r["Hotel_Name"] for r in S.tourist_favourites(compared, 1).collect()] == ["H2"]


def test_nationality_composition(micro):
    rows = keyed(nationality_composition(micro), "Hotel_Name")
    assert rows["H1"]["Top_Nationalities"] == "France (50%), United Kingdom (50%)"
    assert rows["H2"]["Top_Nationalities"] == " (50%), France (50%)"
    assert rows["H3"]["Top_Nationalities"] == "United Kingdom (100%)"
    assert nationality_composition(micro, pct_floor=51).count() == 1


def test_nationality_shares_skip_malformed_parts(spark):
    texts = spark.createDataFrame([("H", "A (45%), odd, B C (x) (2%), D (y%)"), ("N", None)],
                                  "Hotel_Name string, Top_Nationalities string")
    rows = S.nationality_shares(texts, "c").collect()
    assert [(r["Nation"], r["Percentage"], r["Category"]) for r in rows] == [("A", 45.0, "c"), ("B C (x)", 2.0, "c")]


def test_seasonal_preferences(reviews):
    rows = keyed(seasonal_preferences(reviews, 1), "Hotel_Name", "Season", "Traveler_Type")
    expected = {
        **{("H1", "Summer", t): 9.0 for t in ("Couple", "Leisure", "Other")},
        **{("H1", "Winter", t): 5.0 for t in ("Business", "Solo", "Other")},
        **{("H2", "Unknown", t): 7.0 for t in ("Family", "Leisure", "Other")},
        ("H2", "Winter", "Other"): 8.0,
        **{("H3", "Spring", t): 6.0 for t in ("Group", "Other")},
    }
    assert {key: row["Avg_Score"] for key, row in rows.items()} == expected
    assert {row["Review_Count"] for row in rows.values()} == {1}
    assert rows["H3", "Spring", "Group"]["Nation"] == "United Kingdom"
    segments = seasonal_preferences(reviews, 1)
    assert S.seasonal_select(segments, ["Winter"], ["Other"]).count() == 2
    assert S.seasonal_select(segments).count() == 12
    grid = keyed(S.season_heatmap(segments, "H1"), "Traveler_Type")
    assert (grid["Other"]["Winter"], grid["Other"]["Summer"], grid["Other"]["Spring"]) == (5.0, 9.0, None)
    assert S.season_entities(segments).count() == 3


def test_every_month_has_its_season(spark):
    from ratelens.functions.calendar import season

    months = spark.sql("select explode(sequence(1, 12)) as m").select("m", season(F.make_date(F.lit(2020), "m", F.lit(1))))
    assert [row[1] for row in months.orderBy("m").collect()] == (
        ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Autumn"] * 3 + ["Winter"]
    )


def test_stay_duration(reviews):
    rows = keyed(stay_duration(reviews, 1), "Hotel_Name")
    assert set(rows) == {"H1", "H2"}
    h1, h2 = rows["H1"], rows["H2"]
    assert (h1["Stay_Category"], h1["Avg_Score"], h1["Review_Count"]) == ("Short Stay (1-3)", 7.0, 2)
    assert h1["Avg_Nights_Actual"] == 1.5
    assert (h2["Stay_Category"], h2["Avg_Score"], h2["Avg_Nights_Actual"]) == ("Long Stay (8+)", 7.0, 8.0)
    means = keyed(S.stay_category_delta(stay_duration(reviews, 1)), "Stay_Category")
    assert {row["Overall_Mean"] for row in means.values()} == {7.0}


def test_nights(spark):
    from ratelens.functions.parsing import nights

    tags = ["Stayed 1 night", "Stayed 3 nights", "Stayed 10 nights", "Stayed x nights", "Couple",
            "Stayed 99999999999 nights", "Stayed 3 long nights", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(tags)], "i int, t string")
    found = [r[0] for r in rows.orderBy("i").select(nights(F.col("t"))).collect()]
    assert found == [1, 3, 10, None, None, None, None, None]


def test_reviewer_experience(micro):
    (row,) = reviewer_experience(micro, 1).collect()
    assert (row["Hotel_Name"], row["Novice_Avg_Score"], row["Novice_Count"]) == ("H1", 9.0, 1)
    assert (row["Expert_Avg_Score"], row["Expert_Count"]) == (5.0, 1)
    assert (row["Intermediate_Avg_Score"], row["Intermediate_Count"]) == (0.0, 0)
    assert (row["Experience_Gap"], row["Total_Analyzed_Reviews"]) == (-4.0, 2)
    assert S.experience_gap_mean(reviewer_experience(micro, 1)).first()[0] == -4.0


def test_counts_of_missing_levels_do_not_pass_a_minimum_of_zero(micro):
    assert [r["Hotel_Name"] for r in reviewer_experience(micro, 0).collect()] == ["H1"]
    assert {r["Hotel_Name"] for r in local_vs_tourist(micro, 0).collect()} == {"H1", "H2"}


def test_tag_pattern(micro):
    (row,) = tag_pattern_coverage(micro).collect()
    assert tuple(row) == (5, 4, 80.0)
    assert tag_pattern_sample(micro, n=2).count() == 2
    (empty,) = tag_pattern_coverage(micro.limit(0)).collect()
    assert tuple(empty) == (0, 0, None)


def test_top_hotels(micro):
    assert [(r["Hotel_Name"], r["Average_Score"]) for r in top_hotels(micro, 2, 1).collect()] == [("H2", 7.5), ("H1", 7.0)]
    assert top_hotels(micro).count() == 0


def test_attributes_that_vary_resolve_to_the_greatest(micro):
    varied = micro.withColumn("Hotel_Address", F.concat("Hotel_Address", F.lit(" "), "Reviewer_Score"))
    rows = keyed(entities(varied, {"Hotel_Address": "Hotel_Address", "lat": "lat"}), "Hotel_Name")
    assert rows["H1"]["Hotel_Address"].endswith("9.0")
    assert (rows["H1"]["lat"], rows["H2"]["lat"]) == (51.5, None)


def test_segments(reviews):
    assert top_groups(reviews) == ["France", "United Kingdom"]
    rows = keyed(segment_features(reviews, groups=["France", "United Kingdom"]), "Hotel_Name")
    assert (rows["H1"]["France"], rows["H1"]["United Kingdom"], rows["H1"]["Avg_Pos_Words"]) == (1, 1, 6.0)
    assert rows["H2"]["Lat"] is None
    clustered = segment_kmeans(reviews, k=2, use_verbosity=True, use_nationality=True)
    assert clustered.select("prediction").distinct().count() == 2
    profile = S.cluster_profile(clustered)
    assert profile.agg(F.sum("Count")).first()[0] == 3
    assert {r["Cluster_Name"] for r in profile.collect()} == {"Cluster 0", "Cluster 1"}
    mix = S.cluster_nationality_mix(clustered, ["France", "United Kingdom"])
    assert {round(r[1], 9) for r in mix.groupBy("prediction").agg(F.sum("Share")).collect()} == {1.0}
    assert segment_kmeans(reviews, k=2, use_location=True).count() == 2  # H2 has no place
    with pytest.raises(ValueError):
        segment_kmeans(reviews, use_score=False, use_popularity=False)


def test_csv(spark, micro, tmp_path):
    path = str(tmp_path / "reviews")
    micro.write.csv(path, header=True)
    back = read_reviews(spark, path)
    assert back.schema == micro.schema
    assert dataset_row_count(back).first()[0] == 5
    # CSV trims nothing and keeps quotes, so the analyses agree.
    for analysis in (tag_influence, nationality_bias, review_trends):
        assert keyed(analysis(back, 1), analysis(back, 1).columns[0]) == keyed(
            analysis(micro, 1), analysis(micro, 1).columns[0]
        )


def test_csv_bad_numbers_become_null(spark, micro, tmp_path):
    path = str(tmp_path / "bad")
    micro.withColumn("Reviewer_Score", F.lit("n/a")).write.csv(path, header=True)
    assert read_reviews(spark, path).filter("Reviewer_Score is null").count() == 5
    micro.write.parquet(str(tmp_path / "parquet"))
    assert read_reviews(spark, str(tmp_path / "parquet"), "parquet").count() == 5


def test_csv_is_read_by_name(spark, tmp_path):
    from ratelens.sources.files import read_reviews
    from ratelens.sources.schema import REVIEW_SCHEMA

    names = [field.name for field in REVIEW_SCHEMA]
    values = {name: "" for name in names} | {"Hotel_Name": "H1", "Reviewer_Score": "8.5", "lat": "51.5"}
    for n, order in enumerate((names, names[::-1])):
        path = tmp_path / f"{n}.csv"
        path.write_text(",".join(order) + "\n" + ",".join(values[name] for name in order) + "\n")
        row = read_reviews(spark, str(path)).first()
        assert (row["Hotel_Name"], row["Reviewer_Score"]) == ("H1", 8.5)


def test_null_entity_and_exact_percentages(spark):
    from ratelens.operators.groups import nationality_composition, reviewer_experience
    from ratelens.sources.schema import ReviewColumns

    cols = ReviewColumns(entity="e", score="s", history="h", group="g")
    rows = [(None if n % 2 else 7, float(n % 5), n % 50, "A" if n < 29 else "B") for n in range(100)]
    df = spark.createDataFrame(rows, "e int, s double, h int, g string")
    assert {row["e"] for row in reviewer_experience(df, 1, cols=cols).collect()} == {7, None}
    whole = nationality_composition(df.withColumn("e", df["h"] * 0), cols=cols).first()
    assert whole["Top_Nationalities"] == "B (71%), A (29%)"
    with pytest.raises(ValueError):
        nationality_composition(df, 0, cols=cols)


def test_tag_pattern_takes_typed_reviews(spark, micro):
    from ratelens.operators.tags import tag_pattern_coverage
    from ratelens.sources.files import normalize_reviews

    assert tag_pattern_coverage(normalize_reviews(micro)).collect() == tag_pattern_coverage(micro).collect()


def test_places_are_pairs(spark):
    """The coordinates of an entity come from one of its rows."""

    rows = [("H", "1 St France", "1/1/2017", 8.0, 8.0, 10, "[' A ']", lat, lng) for lat, lng in (("10", "1"), ("5", "20"), ("11", "NA"), ("10", "0.5"))]
    df = spark.createDataFrame(
        rows,
        "Hotel_Name string, Hotel_Address string, Review_Date string, Reviewer_Score double, Average_Score double, "
        "Total_Number_of_Reviews int, Tags string, lat string, lng string",
    ).withColumns({"Review_Total_Positive_Word_Counts": F.lit(1), "Review_Total_Negative_Word_Counts": F.lit(1)})
    assert tuple(entities(df, {"lat": "lat", "lng": "lng"}).first()) == ("H", 10.0, 1.0)
    assert tuple(top_hotels_by_nation(df).select("lat", "lng").first()) == (10.0, 1.0)
    assert {tuple(r) for r in seasonal_preferences(df, 1).select("lat", "lng").collect()} == {(10.0, 1.0)}
    assert tuple(segment_features(df).select("Lat", "Lng").first()) == (10.0, 1.0)


def test_group_names_do_not_clash_with_features():
    from ratelens.operators.clustering import group_columns

    names = list(group_columns(["U.S.", "US", "lat", "Avg_Score"]).values())
    assert len({name.lower() for name in names}) == 4 and not {"lat", "avg_score"} & {name.lower() for name in names}
