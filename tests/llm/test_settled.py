"""Stored results are leaves of the plans that read them, and are made again where they are gone."""

from pyspark.sql import functions as F

from veilwork.llm import common, repeat_removal

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_of_repeat_removal_stays_small(spark):
    df = repeat_removal.op8_suffix_array_dedup(spark, SF)
    assert plan(df).count("MapInArrow") < 20 and len(plan(df)) < 100_000
    before = sorted(df.collect())
    common.release()
    assert sorted(df.collect()) == before and len(before) == 200


def test_settled_plan_and_rows(spark):
    rows = spark.range(100).withColumn("k", F.col("id") % 7)
    for _ in range(6):
        small = common.settled(rows.groupBy("k").agg(F.count("*").alias("n")))
        rows = rows.join(small, "k").drop("n").union(rows.where("false")).repartition(3)
    assert plan(small).count("\n") == 1 and sorted(map(tuple, small.collect())) == [(k, 15 if k < 2 else 14) for k in range(7)]
    common.release()
    assert rows.count() == 100
