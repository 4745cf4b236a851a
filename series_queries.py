"""Queries over reviews and events in time, with subtotals and sketches, and the same as SQL for DuckDB."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from expected_sql import expected_sql, reviews_sql
from ratelens.functions.calendar import season
from ratelens.functions.checkpoints import stored
from ratelens.functions.parsing import day, tag_list
from ratelens.functions.user_functions import SHAPE, aggregated, register_review_tags
from ratelens.operators.history import asof_join, moving_scores, moving_values, review_history
from ratelens.operators.incremental import merged, tag_influence_of, tag_state, trend_state, trends_of
from ratelens.operators.intervals import interval_join
from ratelens.operators.sketches import monthly_sketches, rolled_up, within_bounds
from ratelens.operators.subtotals import subtotals
from ratelens.operators.versions import compare_versions
from ratelens.sources.schema import ReviewColumns
from ratelens.sources.star_schema import star_reviews, table
from ratelens.streaming.windows import event_files, run_available, sessions, windowed

Query = Callable[[SparkSession, str], DataFrame]

EVENTS = ReviewColumns(entity="user_id", date="ts", score="value")
ITEMS = ReviewColumns(entity="l_suppkey", date="l_shipdate", score="l_quantity")

DAY = 86_400


def moving(spark: SparkSession, sf_dir: str) -> DataFrame:
    return moving_scores(star_reviews(spark, sf_dir, ["Hotel_Name", "Review_Date", "Reviewer_Score"]), days=90)


def event_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review_history(table(spark, sf_dir, "events"), "event_id", EVENTS)


def event_moving_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the same user in the last 24 hours."""
    return moving_values(table(spark, sf_dir, "events"), "user_id", "ts", "value", DAY)


def purchase_after_click(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """Each purchase with the same user's latest click before."""
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    purchases = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts", "value")
    clicks = events.filter("event_type = 'click'").select("event_id", "user_id", "ts", "value")
    return asof_join(purchases, clicks, ["user_id"], "ts", "ts", ["event_id", "value"], "event_id", **options).drop("ts")


def review_after_return(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each review with the last earlier day on which something of its entity was returned."""
    items = table(spark, sf_dir, "lineitem").withColumn("day", F.col("l_shipdate").cast("date"))
    returns = items.filter("l_returnflag = 'R'").groupBy("l_suppkey", "day").agg(F.count("*").alias("Returns"))
    reviews = items.select("l_suppkey", "day", "l_quantity")
    return asof_join(reviews, returns, ["l_suppkey"], "day", "day", ["day", "Returns"], "Returns", strict=True)


def score_subtotals(spark: SparkSession, sf_dir: str, sets="cube") -> DataFrame:
    """Scores by nation, season and first tag, with every subtotal."""
    reviews = star_reviews(spark, sf_dir, ["Hotel_Name", "Reviewer_Nationality", "Review_Date", "Tags", "Reviewer_Score"])
    named = reviews.select(
        "Hotel_Name",
        "Reviewer_Score",
        F.trim("Reviewer_Nationality").alias("Nation"),
        season(day(reviews, "Review_Date")).alias("Season"),
        F.trim(F.get(tag_list(reviews, "Tags"), F.lit(0))).alias("Traveler"),
    )
    return subtotals(named, ["Nation", "Season", "Traveler"], sets, distinct="Hotel_Name")


def sketch_rollup(spark: SparkSession, sf_dir: str, by: str) -> DataFrame:
    """Stored monthly sketches, added up by year or entity, against exact counts."""
    items = table(spark, sf_dir, "lineitem")
    sketches = stored(monthly_sketches(items, "l_partkey", ITEMS))
    group = {"Year": F.year("Month"), "Entity": F.col("Entity")}[by].alias(by)
    exact = items.withColumns({"Year": F.year("l_shipdate"), "Entity": F.col("l_suppkey")})
    return within_bounds(rolled_up(sketches, [group]), exact, [by], "l_partkey", "l_quantity", [0.5, 0.9])


def complaint_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews within two weeks after a return to the same entity."""
    items = table(spark, sf_dir, "lineitem").withColumn("day", F.col("l_shipdate").cast("date"))
    periods = items.filter("l_returnflag = 'R'").select(
        "l_suppkey", F.date_add("day", 1).alias("first_day"), F.date_add("day", 14).alias("last_day")
    )
    pairs = interval_join(items.select("l_suppkey", "day", "l_quantity"), periods, ["l_suppkey"], "day", "first_day", "last_day")
    return pairs.groupBy("l_suppkey").agg(
        F.count("*").alias("Pairs"),
        F.avg("l_quantity").alias("Average_Quantity"),
        F.avg(F.datediff("day", "first_day")).alias("Average_Days"),
    )


def streamed(analysis: Callable[..., DataFrame], *args, delay: str = "1 hour") -> Query:
    """What an analysis of the events as a stream of files has closed when all files are read."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        schema = table(spark, sf_dir, "events").schema
        stream = event_files(spark, f"{sf_dir}/events.parquet", schema)
        return run_available(analysis(stream, *args, delay=delay), f"events-{uuid.uuid4()}")

    return query


def _halves(reviews: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Reviews up to the last run, and those since."""
    return reviews.filter("review_id % 2 = 0"), reviews.filter("review_id % 2 = 1")


def trends_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["Hotel_Name", "Review_Date", "Reviewer_Score", "Average_Score", "Total_Number_of_Reviews", "review_id"]
    before, since = _halves(star_reviews(spark, sf_dir, columns))
    return trends_of(merged(stored(trend_state(before)), trend_state(since)))


def tags_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, since = _halves(star_reviews(spark, sf_dir, ["Tags", "Reviewer_Score", "review_id"]))
    return tag_influence_of(stored(merged(stored(tag_state(before)), tag_state(since))))


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders against a version of them with some removed, some added and some changed."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    key = F.col("o_orderkey")
    kept = orders.filter(key % 17 != 0).withColumns(
        {
            "o_totalprice": F.when(key % 7 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
            "o_orderstatus": F.when(key % 11 != 0, F.col("o_orderstatus")),
        }
    )
    added = orders.filter(key % 23 == 0).withColumn("o_orderkey", -1 - key)
    return compare_versions(orders, kept.unionByName(added), ["o_orderkey"]).drop("old", "new")


def tag_table_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of each tag, the tags taken apart by a table function in SQL."""
    register_review_tags(spark)
    reviews = star_reviews(spark, sf_dir, ["Tags", "Reviewer_Score"])
    return spark.sql(
        """select Single_Tag, count(Score) as Count, avg(Score) as Average_Score
        from review_tags(table(select Tags as tags, Reviewer_Score as score from {reviews})) group by Single_Tag""",
        reviews=reviews,
    )


def score_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moments of the scores of each entity, by an aggregate in Python."""
    shape = aggregated(star_reviews(spark, sf_dir, ["Hotel_Name", "Reviewer_Score"]), ["Hotel_Name"], "Reviewer_Score", SHAPE)
    return shape.withColumn("Review_Count", F.col("Review_Count").cast("long"))


def queries() -> dict[str, Query]:
    return {
        "event_windows": lambda spark, sf_dir: windowed(table(spark, sf_dir, "events"), ["event_type"], "value", "1 hour"),
        "event_windows_stream": streamed(windowed, ["event_type"], "value", "1 hour"),
        "event_sliding_stream": streamed(windowed, ["event_type"], "value", "6 hours", "2 hours"),
        "event_sessions": lambda spark, sf_dir: sessions(table(spark, sf_dir, "events"), ["user_id"], "value", "4 hours"),
        "event_sessions_stream": streamed(sessions, ["user_id"], "value", "4 hours"),
        "review_trends_incremental": trends_incremental,
        "tag_influence_incremental": tags_incremental,
        "order_changes": order_changes,
        "tag_table_function": tag_table_function,
        "score_shape": score_shape,
        "moving_scores": moving,
        "event_history": event_history,
        "event_moving_values": event_moving_values,
        "purchase_after_click": purchase_after_click,
        "purchase_after_click_within_a_day": lambda spark, sf_dir: purchase_after_click(
            spark, sf_dir, strict=True, within=F.expr("interval 1 day")
        ),
        "review_after_return": review_after_return,
        "score_subtotals": score_subtotals,
        "score_rollup": lambda spark, sf_dir: score_subtotals(spark, sf_dir, "rollup"),
        "sketch_rollup_by_year": lambda spark, sf_dir: sketch_rollup(spark, sf_dir, "Year"),
        "sketch_rollup_by_entity": lambda spark, sf_dir: sketch_rollup(spark, sf_dir, "Entity"),
        "complaint_periods": complaint_periods,
    }


_EVENT_ORDER = "(partition by user_id order by cast(ts as date), event_id)"


def _after_click(condition: str, within: str) -> str:
    return f"""
        with purchases as (select * from events where event_type = 'purchase'),
        clicks as (select * from events where event_type = 'click')
        select p.event_id, p.user_id, p.value, case when {within} then c.event_id end as Latest_event_id,
          case when {within} then round(c.value, 9) end as Latest_value
        from purchases p asof left join clicks c on p.user_id = c.user_id and {condition}"""


def _subtotals(sets: str) -> str:
    return reviews_sql(
        f"""select nat as Nation, season as Season, traveler as Traveler,
          cast(grouping(nat, season, traveler) as bigint) as Grouping, count(Reviewer_Score) as Review_Count,
          round(avg(Reviewer_Score), 9) as Average_Score, round(stddev_samp(Reviewer_Score), 9) as StdDev_Score,
          min(Reviewer_Score) as Lowest_Score, max(Reviewer_Score) as Highest_Score,
          count(distinct Hotel_Name) as Distinct_Count
        from (select *, case when month(d) in (12, 1, 2) then 'Winter' when month(d) in (3, 4, 5) then 'Spring'
                when month(d) in (6, 7, 8) then 'Summer' when month(d) is not null then 'Autumn' else 'Unknown' end as season,
              trim(split_part(regexp_replace(Tags, '[\\[\\]'']', '', 'g'), ',', 1)) as traveler from r)
        group by {sets}(nat, season, traveler)"""
    )


def _sketches(group: str, by: str) -> str:
    return f"""select {group} as {by}, count(*) as Review_Count, count(distinct l_partkey) as Distinct_Count,
        true as Distinct_Holds, true as Quantile_50_Holds, true as Quantile_90_Holds from lineitem group by 1"""


_MEASURES = """strftime(s, '%Y-%m-%d %H:%M:%S.%f') as Window_Start, strftime(e, '%Y-%m-%d %H:%M:%S.%f') as Window_End,
    count(*) as Events, round(sum(value), 9) as Total, round(min(value), 9) as Lowest, round(max(value), 9) as Highest"""

# A window is closed when the watermark, an hour behind the latest event, has passed its end.
_CLOSED = "e <= (select max(ts) from events) - interval 1 hour"


def _windows(size: int, slide: int, closed: str = "true") -> str:
    return f"""
        with starts as (
          select *, time_bucket(interval {slide} hours, ts, timestamp '1970-01-01') - to_hours(cast(k * {slide} as integer)) as s
          from events, (select unnest(range({size // slide})) as k) where ts is not null),
        windows as (select *, s + interval {size} hours as e from starts)
        select event_type, {_MEASURES} from windows where {closed} group by event_type, s, e"""


def _sessions(closed: str = "true") -> str:
    return f"""
        with islands as (
          select *, sum(case when ts <= before + interval 4 hours then 0 else 1 end)
            over (partition by user_id order by ts, event_id rows unbounded preceding) as island
          from (select *, lag(ts) over (partition by user_id order by ts, event_id) as before from events where ts is not null)),
        ends as (select user_id, island, min(ts) as s, max(ts) + interval 4 hours as e from islands group by 1, 2)
        select user_id, {_MEASURES} from islands join ends using (user_id, island) where {closed} group by user_id, island, s, e"""


def expected() -> dict[str, str]:
    known = expected_sql()
    moment = "sum((Reviewer_Score - mean) ** {})"
    earlier = "over (partition by Hotel_Name order by d range between interval 179 days preceding and interval 90 days preceding)"
    last = "over (partition by Hotel_Name order by d range between interval 89 days preceding and current row)"
    by_day = "over (partition by Hotel_Name order by d)"
    return {
        "event_windows": _windows(1, 1),
        "event_windows_stream": _windows(1, 1, _CLOSED),
        "event_sliding_stream": _windows(6, 2, _CLOSED),
        "event_sessions": _sessions(),
        "event_sessions_stream": _sessions(_CLOSED),
        "review_trends_incremental": known["review_trends"],
        "tag_influence_incremental": known["tag_influence"],
        "order_changes": """
            with old as (select o_orderkey as k, o_custkey as c, o_orderstatus as s, o_totalprice as p from orders),
            new as (
              select k, c, case when k % 11 <> 0 then s end as s, case when k % 7 = 0 then p + 1 else p end as p
              from old where k % 17 <> 0
              union all select -1 - k, c, s, p from old where k % 23 = 0)
            select coalesce(o.k, n.k) as o_orderkey, cast(1 as bigint) as Occurrence,
              case when o.k is null then 'added' when n.k is null then 'removed'
                when o.c is distinct from n.c or o.s is distinct from n.s or o.p is distinct from n.p then 'changed'
                else 'same' end as Change,
              case when o.k is null or n.k is null then '' else
                array_to_string(list_filter([case when o.c is distinct from n.c then 'o_custkey' end,
                  case when o.s is distinct from n.s then 'o_orderstatus' end,
                  case when o.p is distinct from n.p then 'o_totalprice' end], lambda x: x is not null), ',') end as Changed
            from old o full join new n on o.k = n.k""",
        "tag_table_function": reviews_sql(
            """select tag as Single_Tag, count(Reviewer_Score) as Count, round(avg(Reviewer_Score), 9) as Average_Score
            from tag_rows group by 1"""
        ),
        "score_shape": reviews_sql(
            f"""select Hotel_Name, n as Review_Count, round(any_value(mean), 9) as Average_Score,
              round(sqrt(n) * {moment.format(3)} / nullif({moment.format(2)}, 0) ** 1.5, 9) as Skewness,
              round(n * {moment.format(4)} / nullif({moment.format(2)}, 0) ** 2 - 3, 9) as Kurtosis
            from (select Hotel_Name, Reviewer_Score, avg(Reviewer_Score) over (partition by Hotel_Name) as mean,
                    count(*) over (partition by Hotel_Name) as n from r)
            group by Hotel_Name, n"""
        ),
        "moving_scores": reviews_sql(
            f"""select Hotel_Name, strftime(d, '%Y-%m-%d') as Review_Day, n as Review_Count, round(mean, 9) as Average_Score,
              cast(sum(n) {last} as bigint) as Moving_Count, round(sum(total) {last} / sum(n) {last}, 9) as Moving_Average,
              round(sum(total) {earlier} / sum(n) {earlier}, 9) as Earlier_Average,
              round(sum(total) {last} / sum(n) {last} - sum(total) {earlier} / sum(n) {earlier}, 9) as Change,
              round(lag(mean) {by_day}, 9) as Previous_Average, round(lead(mean) {by_day}, 9) as Next_Average,
              cast(sum(n) {by_day} as bigint) as Total_Count
            from (select Hotel_Name, d, count(*) as n, sum(Reviewer_Score) as total, avg(Reviewer_Score) as mean
                  from r where d is not null and Reviewer_Score is not null group by 1, 2)"""
        ),
        "event_history": f"""
            select user_id, event_id, strftime(cast(ts as date), '%Y-%m-%d') as Review_Day, round(value, 9) as value,
              row_number() over w as Review_Number,
              round(avg(value) over (partition by user_id order by cast(ts as date), event_id rows unbounded preceding), 9)
                as Running_Average,
              round(lag(value) over w, 9) as Previous_Score,
              date_diff('day', lag(cast(ts as date)) over w, cast(ts as date)) as Days_Since_Previous,
              round(lead(value) over w, 9) as Next_Score
            from events where ts is not null and value is not null window w as {_EVENT_ORDER}""",
        "event_moving_values": """
            select distinct user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts, count(value) over w as Moving_Count,
              round(sum(value) over w, 9) as Moving_Sum
            from events where ts is not null
            window w as (partition by user_id order by ts range between interval 24 hours preceding and current row)""",
        "purchase_after_click": _after_click("p.ts >= c.ts", "true"),
        "purchase_after_click_within_a_day": _after_click("p.ts > c.ts", "c.ts + interval 1 day >= p.ts"),
        "review_after_return": """
            with items as (select *, cast(l_shipdate as date) as day from lineitem),
            returns as (select l_suppkey, day, count(*) as n from items where l_returnflag = 'R' group by 1, 2)
            select i.l_suppkey, strftime(i.day, '%Y-%m-%d') as day, i.l_quantity, strftime(r.day, '%Y-%m-%d') as Latest_day,
              r.n as Latest_Returns
            from items i asof left join returns r on i.l_suppkey = r.l_suppkey and i.day > r.day""",
        "score_subtotals": _subtotals("cube"),
        "score_rollup": _subtotals("rollup"),
        "sketch_rollup_by_year": _sketches("year(l_shipdate)", "Year"),
        "sketch_rollup_by_entity": _sketches("l_suppkey", "Entity"),
        "complaint_periods": """
            with items as (select l_suppkey, l_quantity, l_returnflag, cast(l_shipdate as date) as day from lineitem)
            select p.l_suppkey, count(*) as Pairs, round(avg(p.l_quantity), 9) as Average_Quantity,
              round(avg(date_diff('day', i.day + 1, p.day)), 9) as Average_Days
            from items p join items i on p.l_suppkey = i.l_suppkey and p.day between i.day + 1 and i.day + 14
            where i.l_returnflag = 'R' group by 1""",
    }
