"""Salted joins: the rows of a left join, whatever key is hot."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from evalflow.operators.joins import left_join
from evalflow.operators.skew import hot_keys, salted_left_join


@pytest.fixture(scope="module")
def sides(spark):
    pick = random.Random(4)
    left = [("a" if i % 3 == 0 else pick.choice("bcdefgh"), i % 4 if i % 5 else None, i // 2) for i in range(300)]
    right = [("b" if i % 3 == 0 else pick.choice("acdeij"), i % 4 if i % 7 else None, i // 3) for i in range(300)]
    left += [(None, 1, 0)] * 40
    right += [(None, 1, 0)] * 40 + [("a", 0, 7)] * 60  # copies of one row
    return (
        spark.createDataFrame(left, "k string, idx int, l int"),
        spark.createDataFrame(right, "k string, idx int, r int").withColumn("v", F.parse_json(F.lit('{"a": 1}'))),
    )


def rows(df):
    return Counter(tuple(r) for r in df.select([F.col(c).cast("string") for c in sorted(df.columns)]).collect())


@pytest.mark.parametrize("keys,null_safe", [(["k"], []), (["k", "idx"], ["idx"]), (["k", "idx"], [])])
@pytest.mark.parametrize("split_rows", [5, 40, 10**6])
def test_same_rows_as_a_left_join(spark, sides, keys, null_safe, split_rows):
    left, right = sides
    found = hot_keys({"l": left, "r": right}, keys, split_rows)
    hot = [(tuple(x[k] for k in keys), x["rows_l"], x["rows_r"]) for x in found]
    assert bool(hot) == (split_rows < 10**6)
    side = right if keys == ["k", "idx"] else right.withColumnRenamed("idx", "idx2")
    salted = salted_left_join(left, side, keys, hot, null_safe=null_safe, split_rows=split_rows)
    assert rows(salted) == rows(left_join(left, side, keys, null_safe))


def test_counts_of_hot_keys_are_exact(spark, sides):
    left, right = sides
    counts = {r["k"]: (r["rows_l"], r["rows_r"]) for r in hot_keys({"l": left, "r": right}, ["k"], 60)}
    want = {
        k: tuple(sum(x["k"] == k for x in side) for side in (left.collect(), right.collect()))
        for k in {r["k"] for r in left.union(right.select("k", "idx", "r")).collect()}
    }
    assert counts == {k: v for k, v in want.items() if max(v) >= 60}


def test_hot_rows_are_dealt_over_tasks(spark):
    left = spark.range(20).select(F.lit("x").alias("k"), F.col("id").alias("l"))
    right = spark.range(4000).select(F.lit("x").alias("k"), F.col("id").alias("r"))
    (hot,) = hot_keys({"l": left, "r": right}, ["k"], 100)
    keep = {"spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keep}
    for k, v in keep.items():
        spark.conf.set(k, v)
    try:
        out = salted_left_join(left, right, ["k"], [(("x",), hot["rows_l"], hot["rows_r"])], split_rows=100)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 80_000 and len(sizes) > 8 and max(sizes) < 20_000


def test_one_join_an_artifact(spark):
    """The plan of the export grows by one join, and one read of a side, per artifact."""
    from evalflow.plans import export

    keys = "results_dir string, file_prefix string, doc_id long, task_name string"
    frames = [spark.createDataFrame([("d", "p", 1, "t", 1)], f"{keys}, {name} int") for name in "abc"]
    metrics = spark.createDataFrame([("d", "t", 1)], "results_dir string, task_name string, n int")
    plan = export.export_documents(*frames, metrics)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") <= 4 and plan.count("Join LeftAnti") == 0
