import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from normwatch.operators.joins import NO_KEY, driver_bytes, hot_keys, spread_join


def tables(spark, seed):
    rng = random.Random(seed)
    # A third of the left rows have one key, some are equal copies, some have no key.
    left = []
    for i in range(900):
        kind = rng.random()
        key = "hot" if kind < 0.34 else None if kind < 0.45 else f"k{rng.randrange(40)}"
        left.append((key, rng.randrange(3), rng.randrange(20)))
    right = [(f"k{rng.randrange(60)}", rng.randrange(3), rng.randrange(20)) for _ in range(150)]
    right += [("hot", n, v) for n in range(3) for v in range(4)] + [(None, 1, 1)]
    return (
        left,
        right,
        spark.createDataFrame(left, "a string, n long, v long").repartition(5),
        spark.createDataFrame(right, "b string, m int, w long").repartition(3),
    )


def brute_force(left, right, how):
    out = Counter()
    for row in left:
        hits = [
            r for r in right
            if None not in (row[0], r[0]) and row[:2] == r[:2] and row[2] > r[2]
        ]
        if how == "inner":
            out.update(row + r for r in hits)
        elif how == "left":
            out.update(row + r for r in hits or [(None, None, None)])
        elif (how == "left_semi") == bool(hits):
            out[row] += 1
    return out


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("way", ["broadcast", "salted", "plain"])
def test_every_way_gives_each_pair_once(spark, how, way):
    left, right, left_df, right_df = tables(spark, len(how) + 100 * len(way))
    options = {"broadcast": {"right_bytes": 10}, "plain": {}, "salted": {"hot_rows": 5}}[way]
    if way == "salted":
        options["hot"] = hot_keys(left_df, ["a", "n"], 5)
        if how == "inner":
            options["hot_right"] = hot_keys(right_df, ["b", "m"], 5)
    joined = spread_join(
        left_df, right_df, [("a", "b"), ("n", "m")], how, where=F.col("v") > F.col("w"), **options
    )
    want_columns = ["a", "n", "v"] + (["b", "m", "w"] if how in ("inner", "left") else [])
    assert joined.columns == want_columns
    assert Counter(tuple(row) for row in joined.collect()) == brute_force(left, right, how)


def tasks_of(spark, joined, condition):
    """Rows per task of a shuffled join, without help from the adaptive planner."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        where = joined.where(condition).select(F.spark_partition_id().alias("task"))
        return [row["count"] for row in where.groupBy("task").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_key_is_spread_over_tasks(spark):
    left = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("a"), "id"
    )
    right = spark.range(20000).select(F.col("id").alias("b"))
    hot = hot_keys(left, ["a"], 500)
    joined = spread_join(left, right, [("a", "b")], hot=hot, hot_rows=500)
    tasks = tasks_of(spark, joined, "a = 7")
    # Every third row, and the row whose own number is 7.
    rows = len(range(0, 20000, 3)) + 1
    assert sum(tasks) == rows
    assert len(tasks) > 2 and max(tasks) < rows / 2


def test_hot_key_of_the_right_side_is_spread(spark):
    left = spark.range(10).select(F.col("id").alias("a"))
    right = spark.range(50000).select(F.lit(7).cast("long").alias("b"), F.col("id").alias("w"))
    hot = hot_keys(right, ["b"], 1000)
    joined = spread_join(left, right, [("a", "b")], hot_right=hot, hot_rows=1000)
    tasks = tasks_of(spark, joined, "true")
    assert sum(tasks) == 50000 and len(tasks) > 2 and max(tasks) < 25000


def test_two_thousand_hot_keys_are_all_spread(spark):
    left = spark.range(20000).select((F.col("id") % 2000).alias("a"), "id")
    hot = hot_keys(left, ["a"], 10)
    assert len(hot) == 2000
    right = spark.range(3000).select(F.col("id").alias("b"))
    joined = spread_join(left, right, [("a", "b")], hot=hot, hot_rows=5)
    assert joined.count() == 20000 and joined.distinct().count() == 20000


def test_missing_keys_of_an_outer_join_are_spread_if_there_are_many(spark):
    left = spark.range(20000).select(F.when(F.col("id") % 3 != 0, F.col("id")).alias("a"), "id")
    right = spark.range(20000).select(F.col("id").alias("b"))
    hot = hot_keys(left, ["a"], 500)
    assert hot == {NO_KEY: 6667}
    joined = spread_join(left, right, [("a", "b")], "left", hot=hot, hot_rows=500)
    tasks = tasks_of(spark, joined, "a IS NULL")
    assert sum(tasks) == 6667
    assert len(tasks) > 2 and max(tasks) < 6667 / 2
    assert joined.where("b IS NOT NULL").count() == 20000 - 6667


def test_outer_join_without_hot_keys_adds_no_exchange(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(2000).select(F.col("id").alias("a"))
        grouped = spark.range(2000).groupBy((F.col("id") % 50).alias("b")).count()
        plan = spread_join(left, grouped, [("a", "b")], "left")._jdf.queryExecution()
        assert plan.executedPlan().toString().count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_map_columns_travel_through_a_salted_join(spark):
    left = spark.range(100).select(F.lit(1).alias("a"), F.create_map(F.lit("k"), "id").alias("m"))
    right = spark.createDataFrame([(1, "x")], "b int, w string")
    hot = hot_keys(left, ["a"], 10)
    assert spread_join(left, right, [("a", "b")], hot=hot, hot_rows=10).count() == 100


def test_other_joins_are_refused(spark):
    one = spark.range(1)
    with pytest.raises(ValueError):
        spread_join(one, one.withColumnRenamed("id", "b"), [("id", "b")], "full")
    with pytest.raises(ValueError):
        spread_join(one, one.withColumnRenamed("id", "b"), [("id", "b")], "left", hot_right={1: 9})
    assert driver_bytes([("a", 1), ("bb", None)]) > 0
