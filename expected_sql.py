"""The registered queries as SQL for DuckDB, each over the whole tables."""

from __future__ import annotations

# Line items as reviews; see ratelens/sources/star_schema.py.
REVIEWS = """
reviews as (
  select s.s_name as Hotel_Name,
    concat(cast(s.s_suppkey as string), ' Main Street ', sn.n_name, ' ', sr.r_name) as Hotel_Address,
    concat(cast(month(l.l_shipdate) as string), '/', cast(day(l.l_shipdate) as string), '/',
           cast(year(l.l_shipdate) as string)) as Review_Date,
    concat(' ', cr.r_name, ' ') as Reviewer_Nationality,
    l.l_quantity / cast(5 as double) as Reviewer_Score,
    concat('[', chr(39), ' ', split_part(p.p_name, ' ', 1), ' trip ', chr(39), ', ', chr(39), ' ',
           split_part(p.p_name, ' ', 2), ' ', chr(39), ', ', chr(39), ' Stayed ', cast(p.p_size % 12 as string),
           ' nights ', chr(39), ']') as Tags,
    h.total_reviews as Total_Number_of_Reviews, h.average_score as Average_Score,
    c.given as Total_Number_of_Reviews_Reviewer_Has_Given,
    l.l_linenumber as Review_Total_Positive_Word_Counts,
    cast(round(l.l_discount * 100) as int) as Review_Total_Negative_Word_Counts,
    p.p_size as Additional_Number_of_Scoring,
    l.l_orderkey * 7 + l.l_linenumber as review_id,
    case when s.s_suppkey % 17 = 0 then 'NA' else concat('45.0', cast(s.s_suppkey % 10 as string)) end as lat,
    case when s.s_suppkey % 17 = 0 then 'NA'
         else concat('9.', lpad(cast(cast(floor(s.s_suppkey / 10) as bigint) as string), 3, '0')) end as lng
  from lineitem l
  join orders o on l.l_orderkey = o.o_orderkey
  join customer cu on o.o_custkey = cu.c_custkey
  join nation cn on cu.c_nationkey = cn.n_nationkey join region cr on cn.n_regionkey = cr.r_regionkey
  join supplier s on l.l_suppkey = s.s_suppkey
  join nation sn on s.s_nationkey = sn.n_nationkey join region sr on sn.n_regionkey = sr.r_regionkey
  join part p on l.l_partkey = p.p_partkey
  join (select l_suppkey, count(*) as total_reviews, round(avg(l_quantity / cast(5 as double)), 1) as average_score
        from lineitem group by l_suppkey) h on h.l_suppkey = l.l_suppkey
  join (select o_custkey, count(*) as given from orders join lineitem on l_orderkey = o_orderkey
        group by o_custkey) c on c.o_custkey = o.o_custkey
),
r as (
  select *, cast(try_strptime(Review_Date, '%m/%d/%Y') as date) as d, trim(Reviewer_Nationality) as nat,
    case when split_part(Hotel_Address, ' ', -1) = 'EAST' then 'MIDDLE EAST'
         else split_part(Hotel_Address, ' ', -1) end as region,
    try_cast(nullif(lat, 'NA') as double) as lat_deg, try_cast(nullif(lng, 'NA') as double) as lng_deg
  from reviews
),
g as (select avg(Reviewer_Score) as mean from r),
tag_rows as (
  select * from (
    select Hotel_Name, Reviewer_Score,
      trim(unnest(string_split(regexp_replace(Tags, '[\\[\\]'']', '', 'g'), ','))) as tag
    from r) where tag <> ''
),
trends as (
  select Hotel_Name, coalesce(regr_slope(Reviewer_Score, date_diff('day', date '1970-01-01', d)), 0.0) as slope,
    count(*) as n, avg(Reviewer_Score) as mean, round(max(Average_Score), 1) as entity_score,
    min(d) as first_day, max(d) as last_day
  from r where Total_Number_of_Reviews >= 30 and d is not null and Reviewer_Score is not null
  group by 1 having count(*) >= 30
),
tags as (
  select tag, n, mean, sd, global_mean, mean - global_mean as impact, ln(n) / (sd + 0.1) as reliability,
    (mean - global_mean) * ln(n) / (sd + 0.1) as weighted
  from (select tag, count(Reviewer_Score) as n, avg(Reviewer_Score) as mean, stddev_samp(Reviewer_Score) as sd
        from tag_rows group by 1) t, (select mean as global_mean from g)
  where n >= 50
),
bias as (
  select nat, n, mean, pos, neg, g_mean, mean - g_mean as deviation, pos + neg as total,
    case when pos + neg > 0 then pos / (pos + neg) else 0.0 end as ratio
  from (select nat, count(Reviewer_Score) as n, avg(Reviewer_Score) as mean,
          avg(Review_Total_Positive_Word_Counts) as pos, avg(Review_Total_Negative_Word_Counts) as neg
        from r where nat is not null and nat <> '' group by 1) t, (select mean as g_mean from g)
  where n >= 50
),
hotels as (
  select Hotel_Name, max(Hotel_Address) as address, max(region) as region, max(Average_Score) as score,
    max(Total_Number_of_Reviews) as total, max(lat_deg) as lat, max(lng_deg) as lng
  from r group by 1
),
near as (
  select a.Hotel_Name, a.score, avg(b.score) as around, count(*) as n, a.score - avg(b.score) as delta
  from hotels a join hotels b on a.Hotel_Name <> b.Hotel_Name
  where 2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians(b.lat - a.lat) / 2), 2)
    + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lng - a.lng) / 2), 2)))) <= 2.0
  group by 1, 2 having count(*) >= 3
),
ranked as (
  select *, rank() over (partition by region order by score desc, total desc) as pos,
    row_number() over (partition by region order by score desc, total desc, Hotel_Name) as row_pos
  from hotels
),
composition as (
  select Hotel_Name, string_agg(nat || ' (' || pct || '%)', ', ' order by pct desc, nat) as text
  from (select Hotel_Name, nat, cast(n * 100 // sum(n) over (partition by Hotel_Name) as int) as pct
        from (select Hotel_Name, nat, count(*) as n from r where nat is not null group by 1, 2)) t
  where pct >= 2 group by 1
),
compared as (
  select t.*, local_avg - tourist_avg as delta, composition.text
  from (select Hotel_Name, region,
      avg(case when nat = region then Reviewer_Score end) as local_avg,
      count(case when nat = region then Reviewer_Score end) as local_n,
      avg(case when nat is distinct from region then Reviewer_Score end) as tourist_avg,
      count(case when nat is distinct from region then Reviewer_Score end) as tourist_n
    from r group by 1, 2) t
  left join composition using (Hotel_Name)
  where local_n >= 10 and tourist_n >= 10
),
segments as (
  select Hotel_Name, Hotel_Address, Season, Traveler_Type, avg(Reviewer_Score) as score,
    count(Reviewer_Score) as n, max(lat_deg) as lat, max(lng_deg) as lng, max(region) as region
  from (select *, case when month(d) in (12, 1, 2) then 'Winter' when month(d) in (3, 4, 5) then 'Spring'
          when month(d) in (6, 7, 8) then 'Summer' when month(d) in (9, 10, 11) then 'Autumn'
          else 'Unknown' end as Season from r) e
  join (values ('Hot', 'hot'), ('Cold', 'cold'), ('New', 'new'), ('Old', 'old'), ('Ring', 'ring'),
               ('Gear', 'gear'), ('Other', '')) kinds(Traveler_Type, mark)
    on mark = '' or contains(lower(e.Tags), mark)
  group by 1, 2, 3, 4 having count(Reviewer_Score) >= 10
),
stays as (
  select Hotel_Name, case when nights <= 3 then 'Short Stay (1-3)' when nights <= 7 then 'Medium Stay (4-7)'
      else 'Long Stay (8+)' end as category,
    avg(Reviewer_Score) as score, count(Reviewer_Score) as n, avg(nights) as nights
  from (select *, try_cast(regexp_extract(tag, 'Stayed (\\d+) night', 1) as int) as nights from tag_rows
        where tag like 'Stayed % night%') t
  where nights > 0 group by 1, 2 having count(Reviewer_Score) >= 10
),
experience as (
  select *, expert_avg - novice_avg as gap, novice_n + intermediate_n + expert_n as total
  from (select Hotel_Name,
      avg(case when level = 'Novice' then Reviewer_Score end) as novice_avg,
      count(case when level = 'Novice' then Reviewer_Score end) as novice_n,
      coalesce(avg(case when level = 'Intermediate' then Reviewer_Score end), 0) as intermediate_avg,
      count(case when level = 'Intermediate' then Reviewer_Score end) as intermediate_n,
      avg(case when level = 'Expert' then Reviewer_Score end) as expert_avg,
      count(case when level = 'Expert' then Reviewer_Score end) as expert_n
    from (select *, case when Total_Number_of_Reviews_Reviewer_Has_Given < 25 then 'Novice'
            when Total_Number_of_Reviews_Reviewer_Has_Given between 25 and 50 then 'Intermediate'
            else 'Expert' end as level from r) e
    group by 1) t
  where novice_n >= 5 and expert_n >= 5
)
"""

# Documents as review texts; see ratelens/sources/star_schema.py.
DOCUMENTS = """
docs as (
  select source as Hotel_Name,
    concat(cast(month(o_orderdate) as string), '/', cast(day(o_orderdate) as string), '/',
           cast(year(o_orderdate) as string)) as date_text,
    o_orderdate, cast(4 + 5 * quality - 3 * toxic as double) as Reviewer_Score,
    case when coalesce(quality, 1) = 1 then text else 'No Positive' end as Positive_Review,
    case when quality = 0 or toxic = 1 then text else 'No Negative' end as Negative_Review
  from documents left join labels using (doc_id) left join orders on doc_id = o_orderkey
),
dated as (select *, case when o_orderdate is not null then date_text end as Review_Date from docs),
texts as (
  select * from (
    select *, trim(concat_ws(' ', nullif(Positive_Review, 'No Positive'), nullif(Negative_Review, 'No Negative')),
                   ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as Review_Text from dated) t
  where length(Review_Text) > 0
),
sentiments as (
  select *, case when Reviewer_Score < 6 then 'Negative' when Reviewer_Score > 8 then 'Positive'
    else 'Neutral' end as Derived_Sentiment from texts
),
tagged as (
  select *, list_sort(list_filter([{topics}], lambda t: t is not null)) as Topics
  from (select *, regexp_split_to_array(lower(Review_Text), '[^\\p{{L}}\\p{{N}}]+') as words from sentiments) w
),
topic_rows as (select *, unnest(Topics) as Topic from tagged)
"""

# Topics of the documents with the words that mention them.
DOCUMENT_TOPICS = {
    "English": ("the", "and", "of"),
    "French": ("le", "la", "des"),
    "German": ("der", "die", "und"),
    "License": ("license", "licence"),
    "Spanish": ("el", "los", "para"),
    "Token": ("token", "tokens"),
}


# Phrases of the documents; any separator may stand between their words.
DOCUMENT_PHRASES = {"English": ("of the", "on the"), "French": ("dans le", "de la"), "License": ("mit license", "all rights")}


def _list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_DOCUMENTS = DOCUMENTS.format(
    topics=", ".join(
        f"case when list_has_any(words, {_list(words)}) then '{topic}' end" for topic, words in DOCUMENT_TOPICS.items()
    )
)


def _r(column: str, name: str, digits: int = 9) -> str:
    return f"round({column}, {digits}) as {name}"


_TREND = ", ".join(
    [
        "Hotel_Name",
        _r("slope", "Trend_Slope", 10),
        "n as Review_Count",
        _r("mean", "Average_Score_Calculated"),
        _r("entity_score", "Average_Score"),
        "strftime(first_day, '%Y-%m-%d') as First_Review_Date",
        "strftime(last_day, '%Y-%m-%d') as Last_Review_Date",
    ]
)
_TAG = ", ".join(
    [
        "tag as Single_Tag",
        "n as Count",
        _r("mean", "Average_Score"),
        _r("sd", "StdDev_Score"),
        _r("global_mean", "Global_Average"),
        _r("impact", "Impact"),
        _r("reliability", "Reliability_Index"),
        _r("weighted", "Weighted_Impact"),
    ]
)
_BIAS = ", ".join(
    [
        "nat as Reviewer_Nationality",
        "n as Count",
        _r("mean", "Average_Score"),
        _r("pos", "Avg_Positive_Words"),
        _r("neg", "Avg_Negative_Words"),
        _r("g_mean", "Global_Average"),
        _r("deviation", "Score_Deviation"),
        _r("total", "Total_Words_Avg"),
        _r("ratio", "Sentiment_Ratio"),
    ]
)
_NEAR = ", ".join(
    [
        "Hotel_Name",
        _r("score", "Average_Score"),
        _r("around", "Neighborhood_Avg_Score"),
        "n as Competitor_Count",
        _r("delta", "Score_Delta"),
        "case when round(delta, 9) > 0 then 'Outperformer' else 'Underperformer' end as Status",
    ]
)
_RANKED = (
    "region as Nation, Hotel_Name, round(score, 9) as Average_Score, total as Total_Number_of_Reviews, "
    "address as Hotel_Address, round(lat, 9) as lat, round(lng, 9) as lng"
)
_COMPARED = ", ".join(
    [
        "Hotel_Name",
        "region as Hotel_Nation",
        _r("local_avg", "Local_Avg_Score"),
        "local_n as Local_Count",
        _r("tourist_avg", "Tourist_Avg_Score"),
        "tourist_n as Tourist_Count",
        _r("delta", "Preference_Delta"),
        "text as Top_Nationalities",
    ]
)
_SEGMENT = ", ".join(
    [
        "Hotel_Name",
        "Hotel_Address",
        "Season",
        "Traveler_Type",
        _r("score", "Avg_Score"),
        "n as Review_Count",
        _r("lat", "lat"),
        _r("lng", "lng"),
        "region as Nation",
    ]
)
_STAY = ", ".join(
    [
        "Hotel_Name",
        "category as Stay_Category",
        _r("score", "Avg_Score"),
        "n as Review_Count",
        _r("nights", "Avg_Nights_Actual"),
    ]
)
_EXPERIENCE = ", ".join(
    ["Hotel_Name"]
    + [
        part
        for level in ("Novice", "Intermediate", "Expert")
        for part in (_r(f"{level}_avg", f"{level}_Avg_Score"), f"{level}_n as {level}_Count")
    ]
    + [_r("gap", "Experience_Gap"), "total as Total_Analyzed_Reviews"]
)


def reviews_sql(select: str) -> str:
    return f"with {REVIEWS} {select}"


def _documents(select: str) -> str:
    return f"with {_DOCUMENTS} {select}"


def _regression() -> tuple[str, str]:
    """Least squares by successive orthogonalisation: x1..x6 become r1..r6, then back substitution."""
    names = [
        "Average_Score",
        "Total_Number_of_Reviews",
        "Review_Total_Negative_Word_Counts",
        "Review_Total_Positive_Word_Counts",
        "Total_Number_of_Reviews_Reviewer_Has_Given",
        "Additional_Number_of_Scoring",
    ]
    k = len(names)
    xs = ", ".join(f"cast({name} as double) as x{i}" for i, name in enumerate(names, 1))
    ctes = [
        f"rows_ as (select {xs}, Reviewer_Score as y, review_id % 10 < 8 as in_training from r)",
        "train as (select * from rows_ where in_training)",
        "mean_ as (select " + ", ".join(f"avg(x{i}) as m{i}" for i in range(1, k + 1)) + ", avg(y) as my from train)",
        "o1 as (select train.*, x1 - m1 as r1 from train, mean_)",
    ]
    for j in range(2, k + 1):
        slopes = ", ".join(f"regr_slope(x{j}, r{i}) as a{i}_{j}" for i in range(1, j))
        ctes.append(f"s{j} as (select {slopes} from o{j - 1})")
        rest = " - ".join([f"x{j} - m{j}", *[f"a{i}_{j} * r{i}" for i in range(1, j)]])
        ctes.append(f"o{j} as (select o{j - 1}.*, {rest} as r{j} from o{j - 1}, s{j}, mean_)")
    ctes.append("gamma as (select " + ", ".join(f"regr_slope(y, r{i}) as c{i}" for i in range(1, k + 1)) + f" from o{k})")
    sources = "gamma, mean_, " + ", ".join(f"s{j}" for j in range(2, k + 1))
    previous = f"(select * from {sources})"
    for i in range(k, 0, -1):
        value = " - ".join([f"c{i}", *[f"b{j} * a{i}_{j}" for j in range(i + 1, k + 1)]])
        ctes.append(f"beta{i} as (select *, {value} as b{i} from {previous})")
        previous = f"beta{i}"
    intercept = " - ".join(["my", *[f"b{i} * m{i}" for i in range(1, k + 1)]])
    ctes.append(f"beta as (select *, {intercept} as b0 from beta1)")
    head = f"with {REVIEWS}, " + ", ".join(ctes)
    rows = [f"select '{name}' as Feature, round(b{i}, 6) as Coefficient from beta" for i, name in enumerate(names, 1)]
    rows.append("select 'Intercept' as Feature, round(b0, 6) as Coefficient from beta")
    error = "(y - b0 - " + " - ".join(f"b{i} * x{i}" for i in range(1, k + 1)) + ")"
    metrics = (
        f"select count(*) as Test_Rows, round(sqrt(avg({error} * {error})), 9) as RMSE, "
        f"round(1 - avg({error} * {error}) / var_pop(y), 9) as R2 from rows_, beta where not in_training"
    )
    return head + " " + " union all ".join(rows), head + " " + metrics


def _features(digits: int = 9) -> str:
    regions = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
    counts = ", ".join(f"count(*) filter (nat = '{name}') as \"{name}\"" for name in regions)
    return reviews_sql(
        f"""select Hotel_Name, round(max(Average_Score), {digits}) as Avg_Score, max(Total_Number_of_Reviews) as Total_Reviews,
        round(avg(Review_Total_Positive_Word_Counts), {digits}) as Avg_Pos_Words,
        round(avg(Review_Total_Negative_Word_Counts), {digits}) as Avg_Neg_Words,
        round(max(lat_deg), {digits}) as Lat, round(max(lng_deg), {digits}) as Lng, {counts},
        round(cos(radians(max(lat_deg))) * cos(radians(max(lng_deg))), {digits}) as x,
        round(cos(radians(max(lat_deg))) * sin(radians(max(lng_deg))), {digits}) as y,
        round(sin(radians(max(lat_deg))), {digits}) as z
        from r group by 1 having max(lat_deg) is not null and max(lng_deg) is not null"""
    )


def _clusters_in_all() -> dict[str, str]:
    """Invariants of a clustering into four, whatever the clusters are."""
    names = ["Avg_Score", "Total_Reviews", "Avg_Pos_Words", "Avg_Neg_Words", "Lat", "Lng"]
    sums = ", ".join(_r(f"sum(cast({name} as double))", f"Sum_{name}") for name in names)
    means = ", ".join(_r(f"avg({name})", name) for name in names)
    entities = f"({_features(digits=15)})"
    regions = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
    return {
        "segment_kmeans_in_all": f"select count(*) as Entities, cast(4 as bigint) as Clusters, {sums} from {entities}",
        "cluster_profile_in_all": f"select count(*) as Entities, {means} from {entities}",
        "cluster_nationality_mix_in_all": " union all ".join(
            f"select '{name}' as Nation, cast(sum(\"{name}\") as bigint) as Reviews from {entities}" for name in regions
        ),
    }


def expected_sql() -> dict[str, str]:
    coefficients, metrics = _regression()
    shares = """
      select Hotel_Name, regexp_extract(part, '^(.*) \\((\\d+)%\\)$', 1) as Nation,
        cast(regexp_extract(part, '^(.*) \\((\\d+)%\\)$', 2) as double) as Percentage, Category
      from (select Hotel_Name, unnest(string_split(text, ', ')) as part, '{category}' as Category
            from (select * from compared order by round(delta, 9) {order}, Hotel_Name limit 10))
      where regexp_matches(part, '^(.*) \\((\\d+)%\\)$')"""
    return {
        # trends
        "review_trends": reviews_sql(f"select {_TREND} from trends"),
        "review_trends_udf": reviews_sql(f"select {_TREND} from trends"),
        "trend_direction": reviews_sql(
            f"""select {_TREND}, case when round(slope, 12) > 0 then 'Rising' when round(slope, 12) < 0 then 'Falling'
            else 'Stable' end as Trend_Direction from trends"""
        ),
        "trend_top_improving": reviews_sql(
            f"select {_TREND} from trends where round(slope, 12) > 0 order by round(slope, 12) desc, Hotel_Name limit 10"
        ),
        "trend_top_declining": reviews_sql(
            f"select {_TREND} from trends where round(slope, 12) < 0 order by round(slope, 12), Hotel_Name limit 10"
        ),
        "user_value_trends": """
            select user_id, round(coalesce(regr_slope(value, date_diff('day', date '1970-01-01', cast(ts as date))), 0.0), 10)
                as Trend_Slope, count(*) as Review_Count, round(avg(value), 9) as Average_Score_Calculated,
              strftime(min(cast(ts as date)), '%Y-%m-%d') as First_Review_Date,
              strftime(max(cast(ts as date)), '%Y-%m-%d') as Last_Review_Date
            from events where value is not null group by 1 having count(*) >= 30""",
        # tags
        "tag_influence": reviews_sql(f"select {_TAG} from tags"),
        "tag_consensus_band": reviews_sql(
            f"""select {_TAG}, case when sd < 1 then 'Strong consensus' when sd <= 2 then 'Normal'
            when sd > 2 then 'Controversial' end as Consensus from tags"""
        ),
        "tag_top_positive": reviews_sql(
            f"""select {_TAG} from tags where round(impact, 9) > 0
            order by round(weighted, 9) desc, tag limit 10"""
        ),
        "tag_top_negative": reviews_sql(
            f"""select {_TAG} from tags where round(impact, 9) < 0
            order by round(weighted, 9) nulls last, tag limit 10"""
        ),
        "stay_duration": reviews_sql(f"select {_STAY} from stays"),
        "stay_category_delta": reviews_sql(
            """select category as Stay_Category, round(m, 9) as Avg_Score, round(avg(m) over (), 9) as Overall_Mean,
            round(m - avg(m) over (), 9) as Delta
            from (select category, avg(score) as m from stays group by 1)"""
        ),
        "stay_top_per_category": reviews_sql(
            f"""select {_STAY}, cast(pos as integer) as Position from (select *, row_number() over (partition by category
            order by round(score, 9) desc, Hotel_Name) as pos from stays) where pos <= 5"""
        ),
        "tag_pattern_coverage": reviews_sql(
            """select count(*) as Total_Rows, count(*) filter (Tags like '%Stayed % night%') as Matching_Rows,
            round(100.0 * count(*) filter (Tags like '%Stayed % night%') / count(*), 9) as Coverage_Pct from r"""
        ),
        "tag_pattern_sample": reviews_sql("select Tags from r where Tags like '%Stayed % night%' order by Tags limit 20"),
        # reviewer groups
        "nationality_bias": reviews_sql(f"select {_BIAS} from bias"),
        "nationality_critics": reviews_sql(f"select {_BIAS} from bias order by round(deviation, 9), nat limit 3"),
        "nationality_generous": reviews_sql(f"select {_BIAS} from bias order by round(deviation, 9) desc, nat limit 3"),
        "nationality_composition": reviews_sql("select Hotel_Name, text as Top_Nationalities from composition"),
        "local_vs_tourist": reviews_sql(f"select {_COMPARED} from compared"),
        "preference_delta_mean": reviews_sql("select round(avg(delta), 9) as Avg_Preference_Delta from compared"),
        "local_favourites": reviews_sql(
            f"select {_COMPARED} from compared order by round(delta, 9) desc, Hotel_Name limit 10"
        ),
        "tourist_favourites": reviews_sql(
            f"select {_COMPARED} from compared order by round(delta, 9), Hotel_Name limit 10"
        ),
        "nationality_summary_parse": reviews_sql(
            shares.format(category="Local Favorites", order="desc")
            + " union all "
            + shares.format(category="Tourist Favorites", order="asc")
        ),
        "reviewer_experience": reviews_sql(f"select {_EXPERIENCE} from experience"),
        "experience_gap_mean": reviews_sql("select round(avg(gap), 9) as Avg_Experience_Gap from experience"),
        "experience_critics": reviews_sql(
            f"select {_EXPERIENCE} from experience order by round(gap, 9), Hotel_Name limit 10"
        ),
        "experience_fans": reviews_sql(
            f"select {_EXPERIENCE} from experience order by round(gap, 9) desc, Hotel_Name limit 10"
        ),
        # neighbourhood, regions, maps
        "local_competitiveness": reviews_sql(f"select {_NEAR} from near"),
        "local_competitiveness_halved": reviews_sql(f"select {_NEAR} from near"),
        "local_gems": reviews_sql(
            f"select {_NEAR} from near where round(delta, 9) > 0 order by round(delta, 9) desc, Hotel_Name limit 10"
        ),
        "local_underperformers": reviews_sql(
            f"select {_NEAR} from near where round(delta, 9) < 0 order by round(delta, 9), Hotel_Name limit 10"
        ),
        "top_hotels_by_nation": reviews_sql(f"select {_RANKED} from ranked where pos <= 10"),
        "top_hotels_by_nation_untied": reviews_sql(f"select {_RANKED} from ranked where row_pos <= 10"),
        "map_centroid": reviews_sql(
            """select round(avg(lat), 9) as Center_Lat, round(avg(lng), 9) as Center_Lng, count(*) as Point_Count
            from ranked where pos <= 10 and lat is not null and lng is not null"""
        ),
        "top_parts_by_brand": """
            select p_brand as Nation, p_partkey, p_size, round(p_retailprice, 9) as p_retailprice, p_brand
            from (select *, rank() over (partition by p_brand order by p_size desc, p_retailprice desc) as pos
                  from part) where pos <= 10""",
        "top_hotels": reviews_sql(
            """select Hotel_Name, round(mean, 9) as Average_Score, n as Review_Count
            from (select Hotel_Name, avg(Reviewer_Score) as mean, count(Reviewer_Score) as n from r group by 1)
            where n >= 20 order by round(mean, 9) desc, Hotel_Name limit 10"""
        ),
        "dataset_row_count": "select count(*) as Row_Count from lineitem",
        # seasons
        "seasonal_preferences": reviews_sql(f"select {_SEGMENT} from segments"),
        "seasonal_select": reviews_sql(
            f"""select {_SEGMENT} from segments where Season in ('Summer', 'Winter') and Traveler_Type in ('Hot', 'Old')
            order by round(score, 9) desc, Hotel_Name, Hotel_Address, Season, Traveler_Type limit 20"""
        ),
        "season_entities": reviews_sql("select distinct Hotel_Name from segments"),
        "season_heatmap": reviews_sql(
            "select Hotel_Name, Hotel_Address, Traveler_Type, "
            + ", ".join(
                f"round(max(case when Season = '{s}' then score end), 9) as {s}"
                for s in ("Winter", "Spring", "Summer", "Autumn")
            )
            + " from segments group by 1, 2, 3"
        ),
        # models
        "segment_features": _features(),
        **_clusters_in_all(),
        "satisfaction_regression": coefficients,
        "satisfaction_metrics": metrics,
        # texts
        "entity_reviews": _documents(
            """select Review_Date, Reviewer_Score, Negative_Review, Positive_Review from dated
            where Hotel_Name = 'src1'
            order by cast(o_orderdate as date) desc nulls last, Reviewer_Score nulls first,
              Negative_Review nulls first, Positive_Review nulls first limit 50"""
        ),
        "review_text": _documents("select Review_Date, Reviewer_Score, Review_Text from texts"),
        "derived_sentiment": _documents(
            """select Derived_Sentiment, count(*) as Review_Count, round(avg(Reviewer_Score), 9) as Average_Score
            from sentiments group by 1"""
        ),
        "topic_tagging": _documents(
            """select Review_Date, Reviewer_Score, Review_Text, Derived_Sentiment,
            array_to_string(Topics, ',') as Topics from tagged"""
        ),
        "negative_topic_frequency": _documents(
            """select Topic, count(*) as Frequency from topic_rows where Derived_Sentiment = 'Negative' group by 1"""
        ),
        "topic_trends": _documents(
            """select strftime(o_orderdate, '%Y-%m') as Month_Year, Topic, count(*) as Count from topic_rows
            where o_orderdate is not null group by 1, 2"""
        ),
        "topic_score_impact": _documents(
            """select Topic, round(avg(Reviewer_Score), 9) as Average_Score, count(Reviewer_Score) as Count,
            round((select avg(Reviewer_Score) from texts), 9) as Global_Average,
            round(avg(Reviewer_Score) - (select avg(Reviewer_Score) from texts), 9) as Impact
            from topic_rows group by 1 having count(Reviewer_Score) >= 2"""
        ),
        "phrase_trends": _documents(
            "select strftime(o_orderdate, '%Y-%m') as Month_Year, Topic, count(*) as Count from ("
            + " union all ".join(
                f"select o_orderdate, '{topic}' as Topic from tagged where "
                + " or ".join(f"contains(' ' || array_to_string(words, ' ') || ' ', ' {phrase} ')" for phrase in found)
                for topic, found in DOCUMENT_PHRASES.items()
            )
            + ") where o_orderdate is not null group by 1, 2"
        ),
        "hotel_topic_impact": """
            with scored as (
              select l_quantity / cast(5 as double) as score, list_has_any(string_split(p_name, ' '), ['size', 'small', 'tiny']) as hit
              from lineitem join part on l_partkey = p_partkey)
            select 'Room Size' as Topic, round(avg(score), 9) as Average_Score, count(*) as Count,
              round((select avg(score) from scored), 9) as Global_Average,
              round(avg(score) - (select avg(score) from scored), 9) as Impact
            from scored where hit having count(*) >= 2""",
        "reviews_from_csv": reviews_sql(
            """select Hotel_Name, Hotel_Address, count(*) as Review_Count, round(avg(Reviewer_Score), 9) as Average_Score,
            count(distinct Tags) as Tag_Lists, max(lat) as lat, strftime(max(d), '%Y-%m-%d') as Last_Review_Date
            from r group by 1, 2"""
        ),
        "segment_kmeans_nearest": reviews_sql(
            """select count(distinct Hotel_Name) as Entities, count(distinct Hotel_Name) as At_Nearest_Centre
            from r where lat_deg is not null and lng_deg is not null"""
        ),
        "segment_kmeans_default_nearest": reviews_sql(
            "select count(distinct Hotel_Name) as Entities, count(distinct Hotel_Name) as At_Nearest_Centre from r"
        ),
        "event_type_trends": """
            select strftime(ts, '%Y-%m') as Month_Year, event_type as Topic, count(*) as Count
            from events where ts is not null and event_type is not null group by 1, 2""",
    }
