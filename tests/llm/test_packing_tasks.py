"""Packing groups keep to many tasks, and give the same containers however the input lies."""

from pyspark.sql import functions as F

from lexmill.llm import packing


def test_groups_are_spread(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.expr("repeat('a ', cast(1 + id % 97 as int))").alias("text"))
    table = spark.createDataFrame([(0, "a")], "token_id int, piece string")
    pack = lambda d: packing.pack(d, table, capacity=100, group_docs=200)
    got = pack(df).withColumn("task", F.spark_partition_id())
    assert got.select("task").distinct().count() > 1
    rows = lambda d: sorted(map(tuple, d.drop("task").collect()))
    assert rows(got) == rows(pack(df.repartition(9)))
    assert got.groupBy("container").agg(F.max("fill").alias("f"), F.sum("n_tokens").alias("n")).where("f <> n or f > 100").count() == 0
