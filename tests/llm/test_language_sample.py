"""The rows that the dictionaries are built from: a rare language and one hot row_id among many rows."""

from lexmill.llm import language


def test_rare_languages_get_their_part(spark, small):
    samples = spark.read.parquet(f"{small}/lang_samples.parquet")
    text = {}
    for r in samples.orderBy("sample_id").collect():
        text.setdefault(r.lang, []).append(r.text)
    base = {k: " ".join(v) for k, v in text.items()}
    rows = [(1, base["fr"], "fr")] * 3000 + [(10 + i, base["fr"], "fr-FR") for i in range(1500)] + [(9000 + i, base["pt"], "Portuguese") for i in range(5)] + [(2, base["it"], "it, fr"), (3, None, "it"), (4, base["it"], None)]
    df = spark.createDataFrame(rows, "row_id long, output string, lang string")
    got = language.fit(samples, df, sample_rows=60)
    assert got == language.fit(samples, df.repartition(7), sample_rows=60)
    more = {k: (len(got[k]) - len(base[k])) / len(base[k]) for k in base}
    assert 4 < more["pt"] < 6 and 8 < more["fr"] < 11 and more["it"] == more["en"] == 0
