"""Rows of problem 6 with nulls, repeats, clashing names and nothing at all."""

from pyspark.sql import functions as F

from lexmill.llm import language


def test_rows(spark, small):
    samples = spark.read.parquet(f"{small}/lang_samples.parquet")
    text = {r.lang: r.text for r in samples.orderBy("sample_id").collect()}
    rows = [(1, text["fr"], "en"), (1, text["fr"], "en"), (2, None, "fr"), (3, "", None), (4, "12 % -- 4", "fr"), (5, text["de"], "de, fr"), (6, text["it"], None), (None, text["es"], "??"), (7, f"<p data-x='{'a' * 900}'>{text['pt']}</p>", "pt-BR")]
    df = spark.createDataFrame(rows, "row_id long, output string, lang string").withColumn("words", F.lit("clash")).withColumn("confidence", F.lit(0))
    got = language.passages(df, samples)
    assert got.where("row_id = 1").count() == 2 and got.where("lang is null and words = 0").count() == 3
    assert sorted(map(tuple, language.mislabelled(got).collect()), key=str) == sorted([(1, "fr"), (6, "it"), (None, "es")], key=str)
    assert language.passages(df.limit(0), samples).count() == 0


def test_path_shortcut_is_the_best_path(spark, small):
    import random

    import numpy as np

    samples = spark.read.parquet(f"{small}/lang_samples.parquet").collect()
    model = language.Model({k: " ".join(r.text for r in samples if r.lang == k) for k in {r.lang for r in samples}})
    r = random.Random(4)

    def total(costs, path):
        return sum(int(costs[i, k]) for i, k in enumerate(path)) + language.SWITCH * sum(a != b for a, b in zip(path, path[1:], strict=False))

    for _ in range(300):
        costs = np.array([[r.randrange(10, 40) for _ in model.langs] for _ in range(r.randrange(1, 5))])
        path = model.path(costs)
        k = range(len(model.langs))
        best = min(total(costs, p) for p in __import__("itertools").product(k, repeat=len(costs)))
        assert total(costs, path) == best
