"""Left joins with a predicate on the left side."""

from pyspark.sql import functions as F

from pitchlens.operators.joins import left_join_where


def test_unmatched_rows_stay(spark):
    left = spark.createDataFrame([(1, "home", "a"), (1, "away", "b"), (2, "home", "c"), (None, "home", "d"), (3, None, "e")],
                                 "k long, venue string, name string")
    right = spark.createDataFrame([(1, 10), (1, 11), (3, 30), (None, 99)], "k long, v long")
    got = left_join_where(left, right, ["k"], F.col("venue") == "home", ["v"])
    assert got.columns == ["k", "venue", "name", "v"]
    assert sorted((r.name, r.v) for r in got.collect() if r.v is not None) == [("a", 10), ("a", 11)]
    assert sorted(r.name for r in got.collect()) == ["a", "a", "b", "c", "d", "e"]
    # the same name on both sides, composite keys, empty sides
    both = left.withColumn("v", F.lit(5))
    rows = left_join_where(left.select("k", "venue"), both.limit(0), ["k", "venue"], F.lit(True), ["name"])
    assert rows.count() == 5 and rows.columns == ["k", "venue", "name"] and rows.where("name is not null").count() == 0
    assert left_join_where(left.limit(0), right, ["k"], F.lit(True), ["v"]).count() == 0
