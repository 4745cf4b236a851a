"""Registered queries: same rows as their SQL, and plans that hold at scale."""

import re

import pytest

import __spark_entry__ as entry
from tests.compare import difference, duck

SMALL = "/root/testdata/sf0.001"
# The optional operators on training text have their own tests.
OPTIONAL = re.compile(r"op\d+_|pipeline$")
QUERIES = {name: query for name, query in entry.queries().items() if not OPTIONAL.match(name)}
ORACLE = {name: sql for name, sql in entry.oracle_sql().items() if not OPTIONAL.match(name)}

# Iterative models have no SQL counterpart; their own test is test_micro.test_segments.
WITHOUT_SQL = {"segment_kmeans", "cluster_profile", "cluster_nationality_mix"}


@pytest.fixture(scope="module")
def connection():
    return duck(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) - set(ORACLE) == WITHOUT_SQL
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, connection, name):
    assert difference(QUERIES[name](spark, SMALL), connection, ORACLE[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_clusters_cover_every_entity(spark):
    from pyspark.sql import functions as F

    entities = QUERIES["segment_features"](spark, SMALL).count()
    profile = QUERIES["cluster_profile"](spark, SMALL)
    assert profile.count() == 4
    assert profile.agg(F.sum("Count")).first()[0] == entities


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


IN_PYTHON = {"review_trends_udf", "tag_table_function", "score_shape"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_nested_loops_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert bool(re.search("Python|Pandas|Arrow|UDTF", text)) == (name in IN_PYTHON)


ONE_HASH_AGGREGATE = ["review_trends", "stay_duration", "seasonal_preferences", "reviewer_experience"]


@pytest.mark.parametrize("name", ONE_HASH_AGGREGATE)
def test_reviews_are_folded_before_the_shuffle(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "SortAggregate" not in text
    assert "partial_" in text


def test_scan_reads_only_what_it_needs(spark):
    text = plan(QUERIES["top_hotels"](spark, SMALL))
    scan = next(line for line in text.splitlines() if "lineitem" in line)
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double>" in scan
    assert "IsNotNull(l_suppkey)" in scan


@pytest.mark.parametrize("name", ["top_hotels_by_nation", "top_parts_by_brand", "stay_top_per_category"])
def test_ranks_are_cut_before_the_shuffle(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "WindowGroupLimit" in text and "Partial" in text


@pytest.mark.parametrize("name", ["top_hotels", "trend_top_improving", "tag_top_positive", "entity_reviews"])
def test_shortlists_do_not_sort_everything(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "TakeOrderedAndProject" in text
    assert "rangepartitioning" not in text


# Reports that fold or rank the rows of an analysis.
REPORTS = ["preference_delta_mean", "experience_gap_mean", "map_centroid", "stay_category_delta", "stay_top_per_category"]


@pytest.mark.parametrize("name", REPORTS)
def test_reports_do_not_sort_the_analysis(spark, name):
    assert "rangepartitioning" not in plan(QUERIES[name](spark, SMALL))


LOCAL = ["local_competitiveness", "local_competitiveness_halved", "local_gems", "local_underperformers"]


@pytest.mark.parametrize("name", LOCAL)
def test_neighbours_where_there_are_some(spark, name):
    """The smallest tables have no entity with three neighbours."""
    larger = "/root/testdata/sf0.01"
    df = QUERIES[name](spark, larger)
    assert df.count() > 0
    assert difference(df, duck(larger), ORACLE[name]) is None


SHARED = ["nationality_composition", "topic_score_impact", "stay_category_delta", "tag_influence", "nationality_bias"]


@pytest.mark.parametrize("name", SHARED)
def test_shared_work_runs_once(spark, name):
    df = QUERIES[name](spark, "/root/testdata/sf0.01")
    df.collect()
    shuffles = [line for line in plan(df).splitlines() if "ReusedExchange" in line and "hashpartitioning" in line]
    assert shuffles


@pytest.mark.parametrize("name", ["negative_topic_frequency", "topic_trends", "topic_score_impact", "phrase_trends"])
def test_texts_are_tagged_before_they_are_joined(spark, name):
    """No exchange or sort has a text column."""
    lines = plan(QUERIES[name](spark, "/root/testdata/sf0.01")).splitlines()
    assert any("regexp" in line or "split(lower" in line for line in lines)
    for at, line in enumerate(lines):
        if re.search(r"Exchange|Sort \[", line):
            below = next(own for own in lines[at + 1 :] if "Project" in own or "Scan" in own or "Aggregate" in own)
            assert "text#" not in below.split("Scan")[0] or "text#" not in below.partition("[")[2].split("]")[0]


def test_regression_keeps_no_reviews(spark, monkeypatch):
    """Both sides come from one aggregate over one read."""
    from ratelens.operators import regression

    assert not hasattr(regression, "checkpointed")
    seen = []
    plain = regression.moments
    monkeypatch.setattr(regression, "moments", lambda rows, names, side: seen.append(plan(rows.groupBy(side).count())) or plain(rows, names, side))
    entry.regression(spark, SMALL)
    assert len(seen) == 1 and seen[0].count("l_quantity") > 0


def test_text_is_built_once(spark):
    text = plan(QUERIES["review_text"](spark, SMALL))
    assert text.count("concat_ws( ,") == 1
