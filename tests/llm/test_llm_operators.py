import random
from datetime import datetime

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexmill.llm import cutoffs, language, leakage, mixing, packing, personal, personal_table, pieces, repetition, splitting, token_budget

T0, T1 = datetime(2024, 1, 1), datetime(2024, 1, 2)


# 1 mixing


def _docs(spark, rows):
    return spark.createDataFrame(rows, "row_id long, subset string, text string, annotated_at timestamp, ingested_at timestamp, words int, copies string")


def test_mix_meets_targets_with_a_hot_subset(spark):
    r = random.Random(1)
    rows = [(i, "hot" if i % 3 == 0 else f"s{i % 5}", "w " * r.randrange(1, 30), T0, T0, 1, "clash") for i in range(3000)]
    targets = spark.createDataFrame([("hot", 0.2, 2), ("S1", 0.5, 4), ("s2", 0.25, 1), ("none", 0.05, 3)], "subset string, target_share double, max_repeats int")
    mixed, report = mixing.mix(_docs(spark, rows), targets)
    total = sum(len(x[2].split()) for x in rows)
    got = {x.subset: x for x in report.collect()}
    assert abs(got["hot"].mixed_words - 0.2 * total) <= 30 and got["hot"].reachable
    assert abs(got["s1"].mixed_words - 0.5 * total) <= 30 or not got["s1"].reachable
    assert not got["none"].reachable and not got["s2"].reachable and got["s2"].mixed_words == got["s2"].words
    assert mixed.groupBy("subset").agg(F.max("copies").alias("m")).where("subset = 's1'").first().m <= 4
    again, _ = mixing.mix(_docs(spark, rows[::-1]).repartition(7), targets)
    assert mixed.exceptAll(again).count() == 0


def test_mix_of_nulls_and_nothing(spark):
    none = spark.createDataFrame([], "subset string, target_share double, max_repeats int")
    mixed, report = mixing.mix(_docs(spark, [(1, None, None, T0, T0, 1, "")]), none)
    assert mixed.count() == 0 and report.count() == 1
    mixed, report = mixing.mix(_docs(spark, []), spark.createDataFrame([("a", None, None), ("b", 1.0, 1)], none.schema))
    assert mixed.count() == 0 and report.count() == 2


# 2 repetition


def _brute(words, least=repetition.MIN_RUN):
    n, covered = len(words), set()
    for i in range(n):
        best = src = 0
        for j in range(i):
            h = 0
            while i + h < n and words[j + h] == words[i + h]:
                h += 1
            if h > best:
                best, src = h, j
        if best >= least:
            covered |= set(range(i, i + best))
    return len(covered)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("abcdef"), max_size=60))
def test_suffix_array_against_brute_force(words):
    mark, longest = repetition.repeated(words, 6)
    assert mark >= _brute(words) and mark <= max(0, len(words) - 1) and longest <= len(words)
    if words:
        ids = np.array([ord(c) for c in words])
        sa, lcp = repetition.suffix_array(ids)
        tails = ["".join(words[i:]) for i in sa]
        assert tails == sorted(tails)
        for k in range(1, len(sa)):
            a, b = tails[k - 1], tails[k]
            assert lcp[k] == next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def test_rewritten_text_from_damaged_json():
    f = repetition.rewritten_text
    assert f('{"rewritten_text": "a \\"b\\" \\u00e9", "title": "t"}') == 'a "b" é'
    assert f('```json\n{"is_rewritable": true, "rewritten_text": "a b"}\n``` bye') == "a b"
    assert f('{"rewritten_text": "broken off in the') == "broken off in the"
    assert f('{"rewritten_text": "a "quoted" b", "title": "x"}') == 'a "quoted" b'
    assert f('{"rewritten_text": null}') is None and f("") is None and f(None) is None and f("prose") is None


def test_repetition_rows(spark):
    text = "one two three four five six seven eight nine ten. "
    rows = [(1, text * 3), (2, text), (3, None), (4, ""), (5, "no no no no no no no no"), (5, "no no no no no no no no")]
    df = spark.createDataFrame(rows, "row_id long, output string").withColumn("share", F.lit("clash"))
    got = repetition.repetition(df.limit(0), df).collect()
    share = {r.row_id: r.share for r in got}
    assert len(got) == 6 and abs(share[1] - 2 / 3) < 1e-9 and share[2] == share[3] == share[4] == 0 and share[5] > 0.4


# 3 token budget, 7 packing


def test_counter_is_greedy():
    c = pieces.Counter(["ab", "abc", "d", "abcdefgh", "abcdefghi"])
    assert c.count("abcd xyz") == 2 + 3 and c.count("abcdefghi") == 2 and c.count("ab d") == 2 and c.count(None) == c.count("  ") == 0


def test_oversized_documents_are_cut_without_changing_counts(spark):
    r = random.Random(2)
    text = "".join(r.choice("ab d\n ") for _ in range(5000)) + "a" * 300 + " ab"
    rows = [(1, text, "S", "fr-FR", None, T0, T0), (1, text, "S", "fr-FR", None, T0, T0), (2, "ab", " s ", "FR", "A and B", T1, T1), (2, text, "x", "en", "c", T0, T0), (3, None, None, "", "a & b", T0, T0)]
    df = spark.createDataFrame(rows, "row_id long, text string, subset string, lang string, health_domain_classification_best_class string, annotated_at timestamp, ingested_at timestamp")
    p = ["a", "ab", "b d"]
    got = {x.row_id: x for x in token_budget.row_tokens(df, p, chunk=100).collect()}
    assert got[1].n_tokens == pieces.Counter(p).count(text) and got[2].n_tokens == 1 and got[3].n_tokens == 0
    assert got[2]["class"] == got[3]["class"] == "a & b" and got[1].lang == got[2].lang == "fr"
    table = spark.createDataFrame([(i, x) for i, x in enumerate(p)], "token_id int, piece string")
    total = token_budget.token_budget(df, table).where("slice = 'total'").first()
    assert total.n_docs == 3 and total.n_tokens == got[1].n_tokens + 1
    assert token_budget.token_budget(df.limit(0), table).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=80))
def test_sum_of_squares_fits(sizes):
    where, fill = packing.sum_of_squares(np.array(sizes), 50)
    assert fill.max() <= 50 and np.array_equal(np.bincount(where, weights=sizes).astype(int), fill)
    order = sorted(sizes, reverse=True)
    _, tight = packing.sum_of_squares(np.array(order), 50)
    assert len(tight) <= 2 * -(-sum(sizes) // 50) + 1


def test_packing_keeps_every_token(spark):
    rows = [(i, "a " * n) for i, n in enumerate([3, 10, 11, 25, 7, 0, 1])] + [(90, None)]
    table = spark.createDataFrame([(0, "a")], "token_id int, piece string")
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fill", F.lit(0))
    got = packing.pack(df, table, capacity=10).collect()
    assert sum(r.n_tokens for r in got) == 57 and max(r.fill for r in got) == 10
    assert sorted((r.piece, r.n_tokens) for r in got if r.doc_id == 3) == [(0, 10), (1, 10), (2, 5)]
    assert packing.pack(df.limit(0), table).count() == 0


def test_packing_wastes_little(spark, small):
    d = small.replace("sf0.001", "sf0.01")
    got = packing.pack(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/token_pieces.parquet"))
    c = got.select("container", "fill").distinct()
    assert c.agg(F.avg("fill")).first()[0] > 0.95 * packing.CAPACITY


# 4 cutoffs


@pytest.mark.parametrize("seed", [1, 2])
def test_cutoffs_against_brute_force(spark, seed):
    r = random.Random(seed)
    score = lambda: r.choice([None, float("nan"), -1.0, 0.0, 0.1, 0.1, 0.5, round(r.random(), 3)])
    rows = [(i, "hot" if i % 3 == 0 else "b", score(), r.choice([None, *range(6)]), T0, T0) for i in range(900)]
    late = [(i, n, score(), e, T1, T1) for i, n, _, e, *_ in rows[::7]]
    df = spark.createDataFrame(rows + late + late, "row_id long, name string, x float, e int, scored_at timestamp, ingested_at timestamp")
    slices = spark.createDataFrame([(1, "name", "hot", "x", 0.35), (2, "name", "b", "e", 0.5), (3, "name", "zz", "x", 0.5), (4, "nope", "a", "x", 0.5), (5, "name", "hot", "x", 1.0), (6, "name", "b", "x", None)], "slice_id int, slice_field string, slice_value string, score_field string, keep_fraction double")
    table, kept = cutoffs.cutoffs(df, slices)
    valid = {x[0]: x for x in rows} | {x[0]: x for x in late}
    got = {x.slice_id: x for x in table.collect()}
    for s, name, col, part in ((1, "hot", 2, 0.35), (2, "b", 3, 0.5), (5, "hot", 2, 1.0), (6, "b", 2, 0.0)):
        v = sorted((float(np.float32(x[col])) for x in valid.values() if x[1] == name and x[col] is not None and x[col] >= 0), reverse=True)
        want = v[max(1, int(-(-part * 10000 * len(v) // 10000))) - 1]
        assert got[s].cutoff == want and got[s].n_kept == sum(y >= want for y in v) == kept.where(f"slice_id = {s}").count()
    assert got[3].cutoff is None and got[4].n_kept == 0
    assert cutoffs.cutoffs(df.limit(0), slices)[1].count() == 0


# 5 splitting


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab .\n;!é", max_size=400))
def test_pieces_tile_the_text(text):
    got = splitting.pieces(text, 40, 10)
    assert all(z - lead <= 40 for lead, _, z, _ in got)
    assert "".join(text[a:z] for _, a, z, _ in got) == text
    assert all(0 <= a - lead <= 10 for lead, a, _, _ in got)


def test_pieces_prefer_strong_boundaries(spark):
    text = ("x" * 30 + ". ") * 3 + "\n\n" + ("y" * 30 + ". ") * 3
    assert [k for *_, k in splitting.pieces(text, 110, 5)] == [None, 4]
    df = spark.createDataFrame([(1, None), (2, ""), (3, "z" * 13_000), (4, "a. " * 4000), (3, "z" * 13_000)], "row_id long, text string").withColumn("piece", F.lit(9))
    got = splitting.split(df).collect()
    assert sum(r.row_id == 1 for r in got) == 1 and {r.cut for r in got if r.row_id == 4} == {None, "sentence"}
    assert max(r.longest_run for r in got if r.row_id == 3) == 13_000 and sum(r.row_id == 3 for r in got) == 2 * 4


# 6 language


def test_language_of_held_out_samples(spark, small):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{small}/lang_samples.parquet").orderBy("sample_id").collect()]
    train, held = [r for i, r in enumerate(rows) if i // 6 % 4], [r for i, r in enumerate(rows) if not i // 6 % 4]
    model = language.Model({k: " ".join(t for lang, t in train if lang == k) for k in {lang for lang, _ in rows}})
    assert len({lang for lang, _ in held}) == 6
    hits = [max(model.passages(t), key=lambda p: p[2])[3] == lang for lang, t in held]
    assert sum(hits) >= 0.9 * len(hits)
    fr, en = (" ".join(t for lang, t in held if lang == k) for k in ("fr", "en"))
    assert [p[3] for p in model.passages(f"{fr}\n{en}") if p[2] >= 20] == ["fr", "en"]
    assert model.passages(None) == model.passages("12 % -- 4") == []


def test_labels_name_languages():
    assert language.named("fr-FR") == {"fr"} and language.named("es/en/fr") == {"es", "en", "fr"} and language.named("français") == {"fr"}
    assert language.named("und") == language.named(None) == language.named("??") == set()


# 8 leakage


def _items():
    r = random.Random(5)
    word = lambda: "".join(r.choice("bcdlmnrst") + r.choice("aeiou") for _ in range(r.choice([1, 2, 3])))
    stems = [" ".join(". " * (i and i % 13 == 0) + word() for i in range(45)).replace(" . ", ". ") for _ in range(30)]
    return r, word, stems


def test_leaks_against_planted_copies(spark):
    r, word, stems = _items()
    noise = lambda n: " ".join(word() for _ in range(n))
    docs, want = [], set()
    for i, s in enumerate(stems):
        w = s.split()
        kind = i % 5
        if kind == 0:
            t = s.upper()
        elif kind == 1:
            t = " ".join(w[5:25])
        elif kind == 2:
            t = " ".join(x if k % 7 else word() for k, x in enumerate(w[:28], 1))
        elif kind == 3:
            parts = s.split(". ")
            t = ". ".join(parts[::-1])
        else:
            t = " ".join(w[3:15])  # too short
        docs += [(i, f"{noise(60)}. {t}. {noise(40)}"), (100 + i, noise(150))]
        if kind < 4:
            want.add((i, i))
    docs += [(900, None), (901, ""), (0, docs[0][1])]
    items = spark.createDataFrame(list(enumerate(stems)) + [(50, stems[0]), (51, None), (52, "")], "item_id long, stem string")
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(1))
    got = {(x.doc_id, x.item_id) for x in leakage.leaks(df, items).collect()}
    assert got == want | {(0, 50)}
    assert {(x.doc_id, x.item_id) for x in leakage.leaks(df, items, block=7).collect()} == got
    assert leakage.leaks(df, items.limit(0)).count() == 0 and leakage.leaks(df.limit(0), items).count() == 0


def test_alignment_counts_edits():
    a = np.arange(20)
    b = np.concatenate([[99, 98], a[:6], [77], a[7:12], a[13:], [97]])
    assert leakage.longest_kept(leakage.align(a, b)) == (20, 2)


def test_plain_words_ignore_layout():
    assert leakage.plain_words(leakage.repaired("<b>L'Œdème</b> &eacute;t\xadé")) == ["l", "oedeme", "ete"]
    assert leakage.plain_words(leakage.repaired("Ã©tude dÃ©jÃ\xa0")) == ["etude", "deja"]


# 9 personal information


@pytest.fixture(scope="module")
def crf():
    return personal.train()


def test_table_of_another_seed(crf):
    tagger = personal.Tagger(crf)
    rows = personal_table.table(seed=99, each=4)
    found = tagger.spans([t for t, _ in rows])
    want = {(i, a, k) for i, (_, s) in enumerate(rows) for a, _, k in s}
    got = {(i, a, k) for i, s in enumerate(found) for a, _, k in s}
    assert len(want & got) >= 0.9 * len(want) and len(want & got) >= 0.9 * len(got)


def test_islands_give_the_whole_viterbi_path(crf):
    tagger = personal.Tagger(crf)
    lines = [t for t, _ in personal_table.table(seed=5, each=2)][:150]
    found = tagger.spans(lines)
    for line, got in zip(lines, found, strict=True):
        words = [line[a:z] for c in [line] for a, z in ((c_.start() + m.start(), c_.start() + m.end()) for c_ in __import__("re").finditer(r"\S+", c) for m in personal.TOKEN.finditer(c_.group()))]
        n = len(words)
        rows = np.stack([np.zeros((len(personal.ROLES), personal.K), np.float32), *(crf.row(w) for w in words)], 1)
        e = crf.scores(np.arange(1, n + 1), rows, np.array([0, *(personal.COARSE.index(personal.coarse(w)) for w in words)]))
        whole = personal.viterbi(crf, e, np.array([0]), np.array([n]), crf.first[None], crf.last[None])
        starts = {i for i in range(n) if whole[i] and not (whole[i] % 2 == 0 and i and (whole[i - 1] + 1) // 2 == whole[i] // 2)}
        assert len(got) <= len(starts)  # invalid spans are dropped after decoding
        assert all(k in personal.KINDS for *_, k in got)
        assert bool(got) <= bool(whole.any())


def test_find_and_redact(spark, crf):
    text = "Signé : Dr Camille Fontaine\nContact : a.b@example.org, tél. 06 12 34 56 78.\nLe dosage reste stable."
    df = spark.createDataFrame([(1, text), (2, None), (3, ""), (1, text), (4, "x " * 50_000)], "doc_id long, text string").withColumn("kind", F.lit("clash"))
    got = personal.find(df).collect()
    assert {(r.kind, r.start_pos) for r in got if r.doc_id == 1} == {("name", text.index("Camille")), ("email", text.index("a.b@")), ("phone", text.index("06"))}
    assert all(text[r.start_pos : r.end_pos] == r.found for r in got)
    red = {r.doc_id: r.text for r in personal.redact(df).collect()}
    assert red[1].splitlines()[1] == "Contact : [EMAIL], tél. [PHONE]." and red[2] is None and red[3] == ""
