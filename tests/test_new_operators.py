"""Operators on small fixtures: nulls, ties, repeated rows, empty tables, clashing names."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill import session
from lexmill.operators import builders, chunking, dedup, evaluate, filters, inference, model_output, projection, prompts, quality, ranks, sampling, stats
from lexmill.sources import readers, sinks


def test_exact_keeps_one_row_per_text(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "a", 1), (1, "a", 2), (2, "b", 1), (None, "c", 1), (5, None, 1), (6, None, 1), (7, "", 1)], "k int, text string, _a int")
    got = dedup.exact(df, "text", "k").collect()
    assert sorted((r.text is None, r.text or "") for r in got) == [(False, ""), (False, "a"), (False, "b"), (False, "c"), (True, "")]
    assert {r.k for r in got if r.text == "c"} == {None} and dedup.exact(df.limit(0), "text", "k").count() == 0
    assert sorted(map(str, got)) == sorted(map(str, dedup.exact(df.repartition(5), "text", "k").collect()))


def test_quantiles_against_percentile(spark):
    df = spark.range(40_000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None)).otherwise((F.col("id") % 5).cast("string")).alias("g"), F.when(F.col("id") % 7 > 0, F.hash("id") / 1e6).alias("v"), F.lit(0).alias("n"))
    shares = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    got = {r.g: r.q for r in ranks.quantiles(df.drop("n"), ["g"], "v", shares).collect()}
    want = {r.g: r.q for r in df.groupBy("g").agg(F.percentile("v", F.array(*map(F.lit, shares))).alias("q")).collect()}
    assert got.keys() == want.keys() and all(abs(a - b) < 1e-9 for k in want for a, b in zip(got[k], want[k], strict=True))
    ints = spark.range(30_000).select((F.col("id") % 4).alias("v"))  # ties in a group with brackets
    assert ranks.quantiles(ints, [], "v", [0.25, 0.5, 0.74]).first().q == [0.75, 1.5, 2.0]
    assert ranks.quantiles(df.limit(0), ["g"], "v", [0.5]).count() == 0 and ranks.quantiles(df.where("v is null"), [], "v", [0.5]).count() == 0


def test_running_sums(spark):
    df = spark.createDataFrame([("a", 3, 1), ("a", 1, 2), ("a", 2, 4), (None, 1, 5), (None, 9, 6), ("b", 1, None)], "g string, o int, v int")
    got = {(r.g, r.o): r.running for r in ranks.running(df, ["g"], "o", "v").collect()}
    assert got == {("a", 1): 2, ("a", 2): 6, ("a", 3): 7, (None, 1): 5, (None, 9): 11, ("b", 1): None}


def test_row_numbers_shards_and_strides(spark):
    df = spark.range(1000).select((F.lit(999) - F.col("id")).alias("k"), F.lit("x").alias("row"))
    got = sampling.numbered(df.repartition(7), ["k"])
    assert got.where("k <> row_number").count() == 0 and got.count() == 1000
    assert {r.shard: r.n for r in sampling.shard_rows(df, ["k"], 300).groupBy("shard").agg(F.count("*").alias("n")).collect()} == {0: 300, 1: 300, 2: 300, 3: 100}
    parts = [sampling.strided(df, ["k"], r, 3, skip=100, limit=50) for r in range(3)]
    assert sorted(x.k for p in parts for x in p.collect()) == list(range(100, 150))
    assert sampling.numbered(df.limit(0), ["k"]).count() == 0
    one = [r.k for r in sampling.shuffled(df, "k").collect()]
    assert one == [r.k for r in sampling.shuffled(df.repartition(3), "k").collect()] and one != sorted(one) and sorted(one) == list(range(1000))
    with pytest.raises(ValueError):
        sampling.head_strict(df, "k", 1001)
    assert sampling.head_strict(df, "k", 2).count() == 2 and sampling.top(df.withColumn("v", F.when(F.col("k") > 5, F.col("k"))), "v", "k", 3).first().k == 999


def test_target_sample(spark):
    df = spark.createDataFrame([(i, "a" if i < 50 else "b" if i < 90 else None) for i in range(100)], "k int, s string")
    got = {r.s: r.n for r in sampling.target_sample(df, "s", {"b": 0.5}, "k").groupBy("s").agg(F.count("*").alias("n")).collect()}
    assert got == {"a": 50, None: 10, "b": 30}
    assert sampling.target_sample(df, "s", {"b": 5.0, "zz": 1.0}, "k").count() == 100


def test_topics_off_the_list(spark):
    df = spark.createDataFrame([("Clinical  Research",), ("telemedicine and health IT",), ("Radioprotection",), ("other HEALTH",), ("unknown",), (None,)], "t string")
    got = [r[0] for r in df.select(model_output.canonical_topic(F.col("t"))).collect()]
    assert got == ["Drugs, trials & regulation", "Health IT, telemedicine & operations", "Occupational health & safety", "Other health", "unknown", None]


def test_evaluation_texts(spark):
    assert len(builders.EVALUATION_TEXTS) == 18
    df = spark.createDataFrame([("q", "a", "b", "c", "d", "e", ["l", "'", "os", "."], "TEXT")], "question string, answer_a string, answer_b string, answer_c string, answer_d string, answer_e string, tokens array<string>, abstract string")
    at = builders.evaluation_text
    got = df.select(at("x/frenchmedmcqa/data/local_hf_None"), at("quaero/data/local_hf_emea"), at("pxcorpus/data/local_hf_None/y"), at("morfitt/data/local_hf_source")).first()
    assert tuple(got) == (" q  a  b  c  d  e ", "l'os.", "l ' os .", "TEXT")
    with pytest.raises(ValueError):
        at("elsewhere")


def test_styles_and_plans(spark):
    for dims in prompts.STYLES.values():
        assert all(abs(sum(w.values()) - 1) < 1e-9 for w in dims.values())
    assert len(prompts.GENRES) == 13 and len(prompts.AUDIENCES) == 7
    assert prompts.style_of("v3_2", None) == prompts.STYLES["v3_2"] and prompts.style_of("v4", 2) is None and prompts.style_of("v4_2", 2) == prompts.STYLES["v4_1"]
    assert prompts.rewriting_schema("v4_1", 1)["properties"]["proposals"]["maxItems"] == 3 and prompts.rewriting_schema("v4", 2) is None
    assert set(prompts.rewriting_schema("mga_official", 1)["properties"]) == {f"{k}_{i}" for k in ("genre", "audience") for i in range(1, 6)}
    df = spark.createDataFrame([(1, "t {x}", "g", None), (2, None, "h", "b")], "k int, text string, genre string, audience string")
    got = prompts.plan_rewriting(df, "k", "text", "{genre}/{audience}/{register}/{language}", "<{text}>", "v4_2", 2).orderBy("k").collect()
    assert got[0].user_prompt == "<t {x}>" and got[1].user_prompt == "<>" and got[0].system_prompt == f"g//{got[0].rewriting_style.register}/fr"
    assert prompts.plan_rewriting(df, "k", "text", "{n_stage1_pairs}", "{text}", "v4", 1, pairs=5).first().system_prompt == "5"
    gen = prompts.plan_generation(df.withColumn("labels", F.struct(F.lit(None).cast("string").alias("fr"))).withColumn("label_fr", F.lit("L")), "k", "icd", "S", "{label_fr}{skos_notation}", {"wiki": "-w", "textbook": "-t"})
    assert {r.user_prompt for r in gen.collect()} == {"L"} and {r.system_prompt[:2] for r in gen.collect()} == {"S-"}
    talk = prompts.plan_generation(df, "k", "dialogue", "S", "{text}").orderBy("k").first()
    assert talk.gen_style is None and talk.clinical_note == "t {x}" and talk.system_prompt == "S"
    with pytest.raises(ValueError):
        prompts.generation_fields(df, "poem")
    assert df.select(prompts.shuffled_block(F.array(*map(F.lit, "abc")), F.col("k")).alias("b")).where("length(b) = 5").count() == 2


def test_structs_and_casts(spark):
    rows = [('{"drug": ["a"], "disease": null, "other": 1}',), ("[1]",), ("broken",), (None,), ('{"drug": [1, {}]}',)]
    got = [r[0] for r in spark.createDataFrame(rows, "s string").select(projection.entities_from_json(F.col("s"))).collect()]
    assert got[0].drug == ["a"] and all(v == [] for g in got[1:4] for v in g) and got[0].disease == []
    df = spark.createDataFrame([((1, "x"), 3), (None, 4)], "s struct<a:int,b:string>, n int")
    cast = projection.cast_columns(df, {"s": "b string, c double", "n": T.DoubleType(), "nope": "int"})
    assert cast.dtypes == [("s", "struct<b:string,c:double>"), ("n", "double")] and cast.collect()[1].s is None and cast.collect()[0].s.b == "x"
    table = spark.createDataFrame([("x",), ("x",), (None,)], "g string")
    assert projection.members(spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "k int, g string"), "g", table).collect() == [(1, "x")]


def test_filters_by_name(spark):
    df = spark.createDataFrame([("a", True), ("", True), (None, None), ("b", False)], "t string, ok boolean")
    n = lambda c: df.where(c).count()
    assert n(filters.non_empty("t")) == 2 and n(~filters.non_empty("t")) == 2 and n(filters.rewritable("ok", "t")) == 1
    assert n(filters.equals("t", "a")) == 1 and n(filters.equals("t", None)) == 1 and n(filters.one_of("t", [])) == 0 and n(~filters.one_of("t", ["a"])) == 3


def test_rewriting_and_dialogue_rows(spark):
    out = '{"is_rewritable": true, "rewritten_text": "new", "title": "t", "format": "f"}'
    kind = "output string, text string, gen_configs struct<model: string, rewriting_style: struct<register: string>>, medical_entities struct<drug: array<string>>"
    df = spark.createDataFrame([(out, "old", ("m", ("r",)), (["a"],)), ('{"rewritten_text": ["x"]}', "old", None, None)], kind)
    got = model_output.rewriting_rows(df).collect()
    assert (got[0].text, got[0].original_text, got[0].rewriting_model, got[0].medical_entities, got[0].rewriting_format) == ("new", "old", "m", '{"drug":["a"]}', "f")
    assert got[1].text is None and got[1].is_rewritable is None and got[1].medical_entities == "{}" and got[1].original_text == "old"
    talk = model_output.dialogue_rows(spark.createDataFrame([("# Conversation\n\nA: b",)], "text string")).first()
    assert (talk.raw_text, talk.text) == ("# Conversation\n\nA: b", "A: b")
    ents = spark.createDataFrame([(1, "a drug", '{"entities":[{"entity":"drug","text":"drug"}]}'), (2, "a drug", "broken"), (3, "", "x"), (4, None, "x")], "k int, text string, output string")
    assert model_output.entity_rows(ents, "output", "text", "k").count() == 1


def test_chunks_with_a_tokenizer_that_does_not_add_up():
    class Pairs:
        def encode(self, text):
            return [text[i : i + 2] for i in range(0, len(text), 2)]

        def decode(self, ids):
            return "".join(ids)

    text = "aaa bb. c\nddd eeeee ff\n\n" * 9
    out = chunking.recursive_split(text, 7, Pairs())
    assert "".join(out) == text and all(len(Pairs().encode(x)) <= 7 and len(x.split()) <= 7 for x in out)
    assert chunking.recursive_split("a b c d e", 2, chunking.WordTokenizer()) == ["a b ", "c d ", "e"]
    assert chunking.recursive_split("x\n\ny\n\nz", 6, chunking.CharTokenizer()) == ["x\n\ny\n\n", "z"]


def test_blocks_and_windows(spark):
    df = spark.createDataFrame([("abcde",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(chunking.blocks(F.col("t"), 2)).collect()] == [["ab", "cd", "e"], [""], None]
    seen = inference.extract_entities(df.where("t <> ''"), lambda: lambda text: {"drug": [text]}, "t", block=3).first().entities
    assert seen == {"drug": ["abc", "de"]}
    assert [r[0] for r in df.select(inference.head_tokens("t", 3)).collect()] == ["abcde", "", None]


def test_languages_and_grams(spark):
    df = quality.identify(spark.createDataFrame([("le chat est dans la maison et il ne dort pas",), ("the cat is in the house and it is not asleep",), (None,)], "text string"))
    assert quality.language_filter(df).count() == 1 and quality.language_filter(df, ("fr", "en")).count() == 2
    got = spark.createDataFrame([("a b c d e " * 4,), (None,)], "t string").select(quality.gram_shares(F.col("t"))).collect()
    assert len(got[0][0]) == len(quality._NAMES) and got[1][0] == [0.0] * len(quality._NAMES) and got[0][0][0] > 0


def test_reports_with_labels_named_like_rows(spark):
    df = spark.createDataFrame([("macro", "macro"), ("b", "macro"), ("b", "b")], "t string, p string")
    got = evaluate.class_report(df, "t", "p").collect()
    assert len(got) == 5 and sum(r.label == "macro" for r in got) == 2
    pairs = spark.createDataFrame([(1, "drug", "a", True, True), (1, "drug", "b", True, False), (2, "drug", "a", False, True)], "k int, label string, entity string, in_gold boolean, in_pred boolean")
    got = {r.label: r for r in evaluate.entity_report(pairs, "k").collect()}
    assert got["micro"].precision == 0.5 and got["samples"].precision == 0.5 and got["samples"].recall == 0.25 and evaluate.entity_report(pairs.limit(0), "k").count() == 0


def test_class_orders(spark):
    df = spark.createDataFrame([("b", 5.0, 1), ("a", 1.0, 2), ("a", 9.0, 3), (None, 1.0, 0), ("c", None, 0)], "c string, v double, at int")
    order = lambda mode, **more: [r.c for r in stats.class_order(df, "c", "v", mode, **more).orderBy("place").collect()]
    assert order("appearance", seen="at") == ["b", "a"] and order("median_desc") == ["a", "b"] and order("count_desc") == ["a", "b"] and order("label_asc", top=1) == ["a"]


def test_checkpoint_folder(spark):
    class Other:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext, conf = Other(), {}

    with pytest.raises(ValueError):
        session.shared_dir(Session())
    assert session.shared_dir(spark)


def test_json_files_of_lines_and_of_arrays(spark, tmp_path):
    rows = [{"a": 1, "t": "x"}, {"a": 2, "t": "y"}, {"a": 3, "t": "z"}]
    (tmp_path / "lines.json").write_text("\n" + "\n".join(map(json.dumps, rows)))
    (tmp_path / "array.json").write_text(json.dumps(rows, indent=1))
    (tmp_path / "one.json").write_text(json.dumps(rows[0], indent=1))
    assert [readers.scan(spark, str(tmp_path / n)).count() for n in ("lines.json", "array.json", "one.json")] == [3, 3, 1]
    (tmp_path / "d" / "e").mkdir(parents=True)
    (tmp_path / "d" / "x.jsonl").write_text(json.dumps(rows[0]))
    (tmp_path / "d" / "e" / "y.jsonl").write_text(json.dumps(rows[1]))
    assert readers.scan(spark, str(tmp_path / "d"), recursive=True).count() == 2
    (tmp_path / "d" / "z.csv").write_text("a\n1")
    with pytest.raises(ValueError):
        readers.scan(spark, str(tmp_path / "d"))


def test_lines_of_large_and_many_files(spark, tmp_path):
    texts = {"a.txt": [f" line {i} " if i % 5 else "" for i in range(4000)], "b.txt": ["x", "", "y"]}
    for name, lines in texts.items():
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        got = readers.lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    for name, lines in texts.items():
        assert sorted((r.line, r.text) for r in got if r.file.endswith(name)) == [(i, x.strip()) for i, x in enumerate(lines) if x.strip()]
    assert [(r.line, r.text) for r in readers.lines(spark, str(tmp_path / "b.txt"), skip=1, limit=1).collect()] == [(2, "y")]


def test_adapted_sources_and_descriptions(spark, tmp_path):
    sinks.write_single(spark.range(3).selectExpr("cast(id as string) as body"), str(tmp_path / "a.parquet"))
    sinks.write_single(spark.range(2).selectExpr("'t' as text"), str(tmp_path / "b.parquet"))
    take = lambda df: df.withColumnRenamed("body", "text").select("text")
    got = readers.scan_many(spark, f"{tmp_path}/a.parquet,{tmp_path}/b.parquet", adapt=take)
    assert got.columns == ["text"] and got.count() == 5 and len(list((tmp_path / "a.parquet").glob("part*"))) == 1
    df = spark.createDataFrame([("drug",), ("nope",), (None,)], "label string").select(projection.describe_labels(F.col("label")).alias("d"))
    assert [bool(r.d) for r in df.collect()] == [True, False, False]


def test_shards_are_written_once(spark, tmp_path):
    df = spark.createDataFrame([(f"text {i}" * 10, "train" if i % 10 else "validation") for i in range(100)], "text string, split string")
    path = str(tmp_path / "s")
    first = sinks.write_training_shards(df.coalesce(1), path, rows=40)
    assert first["train"]["rows"] == 90 and [s["rows"] for s in first["train"]["shards"]] == [40, 40, 10] or sum(s["rows"] for s in first["train"]["shards"]) == 90
    assert sinks.write_training_shards(df.limit(0), path) == first  # complete: nothing is done
    assert sinks.write_marked(df, str(tmp_path / "m")) and not sinks.write_marked(df.limit(0), str(tmp_path / "m"))
    counts = stats.rollup_counts(spark.createDataFrame([("a", 0, 5), ("a", 1, None), ("b", 0, 1)], "name string, idx int, words int"), "name", "idx", "words")
    sinks.write_summary(counts, "name", "idx", str(tmp_path / "sum"))
    lines = [json.loads(x) for p in (tmp_path / "sum").glob("part*") for x in p.read_text().splitlines()]
    assert [(x["name"], x["parquet_idx"], x["n_docs"]) for x in lines] == [("a", 0, 1), ("a", 1, 1), ("b", 0, 1), ("a", -1, 2), ("b", -1, 1), ("total", -1, 3)]
