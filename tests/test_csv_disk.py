"""Reviews by way of a CSV: compressed, with the shuffles of its writing gone, from line items shuffled once for each large table."""

import datetime as dt
import os

import __spark_entry__ as entry
from ratelens.functions.checkpoints import checkpoint_folder
from ratelens.sources.star_schema import star_reviews

DAY = dt.datetime(2020, 1, 5)
TABLES = {
    "region": ("r_regionkey int, r_name string", [(0, "ASIA"), (1, "EUROPE")]),
    "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "JAPAN", 0), (1, "FRANCE", 1)]),
    "supplier": ("s_suppkey long, s_name string, s_nationkey int", [(1, "A", 0), (17, "B", 1), (3, "C", None), (None, "D", 0)]),
    "customer": ("c_custkey long, c_nationkey int", [(1, 1), (2, 0), (2, 1), (3, None)]),
    "part": ("p_partkey long, p_name string, p_size int", [(1, "hot bolt", 3), (2, "old gear", 12), (2, "old ring", 5)]),
    "orders": ("o_orderkey long, o_custkey long", [(1, 1), (2, 2), (3, 3), (4, None), (None, 1)]),
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_shipdate timestamp",
        [(o, p, s, n, 5.0 * n, 0.01, DAY + dt.timedelta(days=n)) for n, (o, p, s) in enumerate(
            [(1, 1, 1), (1, 2, 17), (2, 1, 1), (2, 2, 17), (3, 1, 1), (4, 1, 1), (None, 1, 1), (1, 1, 3), (1, 9, 1), (1, 1, None)]
        )],
    ),
}


def star(spark, folder):
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def reviews_of():
    """Supplier, nation of the reviewer, tags, score and day of each review, joined row by row."""
    rows = {name: rows for name, (_, rows) in TABLES.items()}
    nations = {k: (name, dict(rows["region"])[r]) for k, name, r in rows["nation"]}
    return [
        (name, f"{s} Main Street {' '.join(nations[home])}", f" {nations[nation][1]} ", f"[' {first} trip ', ' {second} ', ' Stayed {size % 12} nights ']",
         quantity / 5, at.date(), "NA" if s % 17 == 0 else f"45.0{s % 10}")
        for o, p, s, _, quantity, _, at in rows["lineitem"]
        for supplier, name, home in rows["supplier"] if supplier is not None and supplier == s and home is not None
        for part, words, size in rows["part"] if part == p
        for first, second in [words.split()]
        for order, customer in rows["orders"] if order is not None and order == o and customer is not None
        for c, nation in rows["customer"] if c == customer and nation is not None
    ]


def test_reviews_from_csv(spark, tmp_path):
    sf_dir, folder = star(spark, tmp_path), checkpoint_folder(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    got = {r["Hotel_Name"]: r for r in entry.from_csv(spark, sf_dir).collect()}
    expected = reviews_of()
    assert len(expected) > 8 and {name for name, *_ in expected} == {"A", "B"} == got.keys()
    for name, r in got.items():
        own = [x for x in expected if x[0] == name]
        assert r["Hotel_Address"] == own[0][1] and r["Review_Count"] == len(own)
        assert r["Average_Score"] == sum(x[4] for x in own) / len(own)
        assert r["Tag_Lists"] == len({x[3] for x in own}) and r["lat"] == own[0][6] and r["Last_Review_Date"] == max(x[5] for x in own)
    [written] = [name for name in set(os.listdir(folder)) - before if name.startswith("reviews-")]
    parts = [name for name in os.listdir(f"{folder}/{written}") if name.startswith("part-")]
    assert parts and all(name.endswith(".csv.gz") for name in parts)


def test_line_items_are_shuffled_once_for_each_large_table(spark, tmp_path):
    columns = ["Hotel_Name", "Hotel_Address", "Average_Score", "Tags", "lat", "Reviewer_Nationality"]
    sf_dir = star(spark, tmp_path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        reviews = star_reviews(spark, sf_dir, columns)
        plan = reviews._jdf.queryExecution().optimizedPlan().toString()
        assert len(reviews.collect()) == len(reviews_of())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # customers meet orders only: no join of the line items is on their key
    joins = [line for line in plan.split("\n") if "Join Inner" in line]
    at = next(n for n, line in enumerate(joins) if "c_custkey" in line or "o_custkey" in line)
    assert any("l_orderkey" in line for line in joins[:at])
