import json
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexmill.functions import json as J
from lexmill.functions.rows import latest
from lexmill.functions.text import WS_CHARS, first_words, strip, word_count, words
from lexmill.operators import chunking, dedup, evaluate, filters, inference, model_output, projection, prompts, quality, sampling, stats


def values(spark, data, kind, *cols):
    return [tuple(r) for r in spark.createDataFrame(data, kind).select(*cols).collect()]


def test_words_are_those_of_python(spark):
    texts = ["", "   ", "a", "mot : deux ; trois", "x\x1cy\x85z", "　a b\n\nc\t", None, "é" * 50]
    got = values(spark, [(t,) for t in texts], "t string", word_count(F.col("t")), words(F.col("t")), strip(F.col("t")))
    for t, (n, w, s) in zip(texts, got, strict=True):
        assert n == len((t or "").split())
        assert t is None or (w == t.split() and s == t.strip())
    assert len(WS_CHARS) == 29 and all(c.isspace() for c in WS_CHARS)
    assert values(spark, [("a  b c",)], "t string", first_words(F.col("t"), 2)) == [("a b",)]


def test_strict_json_is_that_of_python(spark):
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "false")
    cases = ['{"score": 3}', '{"score": "3"}', '{"score": 3', '{"score": 3} tail', '{"score": 1, "score": 2}', '{"score": "x"}', '{"score": 3.7}', "[]", "", None, '{"score": null}', '{"a":1},{"score":2}']
    got = [r[0] for r in values(spark, [(c,) for c in cases], "s string", J.score(F.col("s")))]

    def want(c):
        try:
            v = json.loads(c)
            return int(v["score"])
        except (TypeError, ValueError, KeyError):
            return None

    assert got == [want(c) for c in cases]


def test_last_object_survives_long_input(spark):
    big = "x {" + "a" * 400_000 + "}"
    got = values(spark, [(big,), ("{a} {b{c}} {",), ("none",), (None,)], "s string", J.last_object(F.col("s")))
    assert [len(g[0]) if g[0] else g[0] for g in got] == [400_002, 6, None, None]


def test_latest_breaks_ties_by_value_and_folds_copies(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 2, "b"), (2, None, "c"), (None, 1, "d"), (None, 3, "e")], "k int, t int, v string")
    assert sorted(map(tuple, latest(df, "k", ["t"], ["v"]).collect()), key=str) == [(1, "b"), (2, "c"), (None, "e")]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab .\n;!", max_size=200), st.integers(1, 30))
def test_split_loses_nothing_and_keeps_the_limit(text, limit):
    out = chunking.recursive_split(text, limit, chunking.CharTokenizer())
    assert "".join(out) == text and all(len(x) <= limit for x in out)


def test_split_fixtures():
    c = chunking.CharTokenizer()
    assert chunking.recursive_split("Hello.\n\nWorld!\nNext line.", 10_000, c) == ["Hello.\n\nWorld!\nNext line."]
    assert chunking.recursive_split("x" * 53, 10, c) == ["x" * 10] * 5 + ["x" * 3]
    assert chunking.recursive_split("", 5, c) == [""]


def test_samples_are_exact_and_repeat(spark):
    df = spark.range(5000).select(F.col("id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"))
    one = {r.id for r in sampling.exact_sample(df, 777, "id").collect()}
    assert len(one) == 777 and one == {r.id for r in sampling.exact_sample(df.repartition(9), 777, "id").collect()}
    assert sampling.exact_sample(df, 777, "id", seed=1).select("id").exceptAll(sampling.exact_sample(df, 777, "id").select("id")).count() > 0
    assert sampling.exact_sample(df, 9999, "id").count() == 5000 and sampling.exact_sample(df.limit(0), 5, "id").count() == 0
    assert sampling.capped_sample(df, "source", 800, "id").groupBy("source").count().agg(F.max("count")).first()[0] <= 200
    split = sampling.train_test(df, "id", 0.02).groupBy("split").count().collect()
    assert {r.split: r["count"] for r in split} == {"validation": 100, "train": 4900}
    shares = df.select(sampling.draw(F.col("id"), {"a": 3, "b": 1}, "x").alias("d")).groupBy("d").count().collect()
    assert abs({r.d: r["count"] for r in shares}["a"] / 5000 - 0.75) < 0.03


def test_predicates_and_nulls(spark):
    kind = "name string, num_words int, health_domain_classification_best_class string, edu_quality_normalized_score int, medical_entity_density float"
    df = spark.createDataFrame([("a", None, None, None, None), ("a_rewritten", 50, "Others", 5, 0.5), ("a", 9, "Other health", 1, 0.0), ("a_rewritten", 50, filters.CLINICAL_CLASSES[0], 4, 0.01)], kind)
    count = lambda c: df.where(c).count()
    assert count(filters.hygiene()) == 2
    assert count(filters.by_mode("edu4")) == 3 and count(filters.by_mode("subtopic_biocli5")) == 1
    assert count(filters.by_mode("union")) == 0 and count(filters.by_mode("")) == 4
    assert count(filters.by_sides("edu4_plus_rewritten_med02")) == 1
    assert count(filters.thresholds()) == 1 and count(filters.dense_and_educational(0.01, 1)) == 1  # float32 0.01 is under 0.01
    texts = [("abc 12",), ("漢字漢字",), (None,), ("",), ("« » ’ …" * 9,)]
    assert [r[0] for r in values(spark, texts, "t string", filters.quality_gate(F.col("t")))] == [True, False, False, True, False]


def test_projections_with_clashing_names(spark):
    df = spark.createDataFrame([("x", "y", (1, "z"))], "text string, output string, metadata struct<id:int,text:string>")
    assert projection.rename_with_backup(df, {"output": "text"}).columns == ["original_text", "text", "metadata"]
    assert projection.flatten(df, "metadata").columns == ["text_old", "output", "id", "text"]
    got = values(spark, [("org/a/b/",), ("b",), ("",), (None,)], "m string", projection.short_model_name(F.col("m")))
    assert [g[0] for g in got] == ["a/b", "b", "", None]
    assert projection.drop_all_null(df.withColumn("e", F.lit(None)), ["e", "nope"]).columns == df.columns


def test_half_even_and_bins(spark):
    got = values(spark, [(0.5,), (2.5,), (3.5,), (float("nan"),), (9.0,), (-1.0,), (None,)], "x double", stats.half_even_score(F.col("x")))
    assert [g[0] for g in got] == [0, 2, 4, 0, 5, 0, None]
    got = values(spark, [(0.0,), (0.05,), (0.999,), (1.0,), (-0.1,)], "x double", stats.bin_of(F.col("x")))
    assert [g[0] for g in got] == [0, 1, 4, None, None]


def test_entities(spark):
    out = '{"entities":[{"entity":"drug","text":["aa","aa","zz"]},{"entity":"disease","text":"ab"},{"entity":"nope","text":"a"}]}'
    df = spark.createDataFrame([("aaaab", out), ("aaaab", "broken"), ("abcabc", '[{"entity":"drug","text":"ab"},{"entity":"disease","text":"abc"}]')], "text string, output string")
    m = model_output.entity_map(F.col("output"), F.col("text"))
    got = df.select(m.alias("m"), model_output.density(m, F.col("text")).alias("d")).collect()
    assert got[0].m == {"disease": ["ab"], "drug": ["aa"]} and got[1].m == {} and got[1].d == 0.0
    assert abs(got[2].d - 10 / 6) < 1e-6


def test_entity_alignment():
    f = model_output._align
    drug, part = "drug", "body_part"
    assert f("L’os et l'os – os", [(part, "l'os"), (part, "l'os"), (part, "zz")]) == [(0, 2, part), (4, 6, part)]
    assert f("os et os", [(part, "os")] * 3) == [(0, 0, part), (2, 2, part)]  # a third use has no place
    assert f("os et os", [(part, "os"), (drug, "os"), (drug, " OS ")]) == [(0, 0, part), (0, 0, drug), (2, 2, drug)]  # counted by label
    assert f("os", [("unknown", "os"), (part, ""), (part, "  ")]) == [] and f("", [(part, "os")]) == []
    assert f("préos et os", [(part, "os"), (part, "os")]) == [(2, 2, part), (2, 2, part)]  # the second use takes the second place in the characters
    assert f("abc", [(part, "b")]) == [(0, 0, part)]


def test_entity_alignment_rows(spark):
    kind = "text string, e array<struct<label: string, entity: string>>"
    df = spark.createDataFrame([("L'os.", [("body_part", "os"), (None, "os"), ("drug", None)]), (None, None), ("", [("drug", "x")])], kind)
    got = [r[0] for r in df.select(model_output.align_entities(F.col("text"), F.col("e"))).collect()]
    assert got[0].tokenized_text == ["L", "'", "os", "."] and [tuple(s) for s in got[0].ner] == [(2, 2, "body_part")] and got[1].tokenized_text == got[2].ner == []


def test_dialogue_and_proposals(spark):
    got = values(spark, [("x\n## Conversation : a\n\n A: b\n\nB: c\n",), ("no header\n\nb",), (None,)], "t string", model_output.dialogue(F.col("t")))
    assert [g[0] for g in got] == ["A: b\nB: c", "no header\nb", None]
    df = spark.createDataFrame([(1, '{"has_medical_content":true,"proposals":[{"genre":"g","audience":"a"},{"genre":"h","audience":"b"}]}'), (2, "broken")], "k int, output string")
    assert model_output.sample_proposals(df, "output", "k", 1).select("sampled_from_n").collect()[0][0] == 2
    assert model_output.explode_proposals(df, "output").count() == 2


def test_reports_on_empty_and_single_class(spark):
    df = spark.createDataFrame([("a", "a"), ("a", None)], "t string, p string")
    assert {r.label: r.f1 for r in evaluate.class_report(df, "t", "p").collect()} == {"a": 1.0, "macro": 1.0, "weighted": 1.0, "accuracy": 1.0}
    assert evaluate.confusion(df.limit(0), "t", "p").count() == 0


def test_near_duplicates(spark):
    r = random.Random(3)
    base = [" ".join(r.choice("abcdefghijklmnop") * r.randrange(1, 5) for _ in range(120)) for _ in range(8)]
    rows = [(i, t) for i, t in enumerate(base)] + [(100 + i, t) for i, t in enumerate(base)] + [(200 + i, " ".join(t.split()[:-1])) for i, t in enumerate(base)] + [(900, None), (901, ""), (902, "one")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: x.cluster for x in dedup.near_duplicates(df, "doc_id", "text").collect()}
    assert all(got[i] == got[100 + i] == got[200 + i] == i for i in range(8)) and 900 not in got
    assert dedup.keep_one(df, "doc_id", dedup.near_duplicates(df, "doc_id", "text")).count() == 11
    assert dedup.exact(df, "text", "doc_id").count() == 19


def test_repetition_reasons(spark):
    df = spark.createDataFrame([(1, "a b c d e f. " * 20), (2, "x\n" * 9), (3, "all words here differ from one another entirely"), (4, None), (5, "")], "doc_id int, text string")
    got = {r.doc_id: r.drop_reason for r in quality.repetition_reason(df).collect()}
    assert got[1] and got[2] == "dup_line_frac" and got[3] is None and got[4] is None and got[5] is None
    lid = quality.identify(spark.createDataFrame([("le chat est dans la maison et il ne dort pas",), (None,)], "text string")).collect()
    assert lid[0].language == "fr" and lid[1].language is None


def test_plugins_and_prompts(spark):
    df = spark.createDataFrame([("aspirin and fever", 1), (None, 2)], "text string, length_scores int")
    out = inference.classify(df, "length", ["s", "l"], lambda: lambda ts: [[1.0, 0.0] for _ in ts])
    assert "original_length_scores" in out.columns and {r.length_best_class for r in out.collect()} == {"s"}
    ents = inference.extract_entities(df, inference.dictionary_extractor({"drug": ["aspirin"]})).collect()
    assert ents[0].entities == {"drug": ["aspirin"]} and ents[1].entities == {}
    assert [r[0] for r in df.select(prompts.render("{{{a}}}", {"a": F.col("text")})).collect()] == ["{aspirin and fever}", "{}"]
    gen = inference.generate(df.select(F.coalesce("text", F.lit("")).alias("p")), "p", lambda: lambda ps: [p.upper() for p in ps]).collect()
    assert gen[0].output == "ASPIRIN AND FEVER"


def test_filters_reach_the_scan(spark, small):
    df = spark.read.parquet(f"{small}/mds_input.parquet").where((F.col("edu_quality_normalized_score") >= 4) & (F.col("num_words") > 9)).select("row_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "IsNotNull(edu_quality_normalized_score)" in plan.split("PushedFilters")[1] and "text" not in plan.split("ReadSchema")[1]
