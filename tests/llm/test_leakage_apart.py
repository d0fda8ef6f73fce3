"""Stems whose sentences occur in another order, with all edits the whole stem may have, unevenly over its sentences."""

import random

import pytest
from pyspark.sql import functions as F

from lexmill.llm import leakage


def _word(r):
    return "".join(r.choice("bcdlmnrst") + r.choice("aeiou") for _ in range(r.choice([2, 3])))


def _copy(r, sentences, edits):
    """The sentences in reverse order between other words, with exactly so many words changed."""
    flat = [(i, k) for i, s in enumerate(sentences) for k in range(len(s))]
    changed = set(r.sample(flat, edits))
    parts = [" ".join("zz" + _word(r) if (i, k) in changed else w for k, w in enumerate(s)) for i, s in enumerate(sentences)]
    return " ".join(f"{p}. {' '.join('q' + _word(r) for _ in range(25))}." for p in parts[::-1])


@pytest.mark.parametrize("sizes", [(11, 13, 14, 16), (3, 8, 9, 10, 12, 7), (5, 5, 5, 5, 4), (3, 4, 3, 4, 3, 4), (2, 1, 2, 2, 1, 2), (2, 2, 2, 2, 3)])
def test_edits_count_over_the_whole_stem(spark, sizes):
    r = random.Random(sum(sizes))
    stems = [[[_word(r) for _ in range(n)] for n in sizes] for _ in range(60)]
    most = sum(sizes) // leakage.EDIT_SHARE
    docs = [(i, _copy(r, s, most)) for i, s in enumerate(stems)] + [(100 + i, _copy(r, s, most + 1)) for i, s in enumerate(stems)]
    items = spark.createDataFrame([(i, " ".join(f"{' '.join(x)}." for x in s)) for i, s in enumerate(stems)], "item_id long, stem string")
    got = leakage.leaks(spark.createDataFrame(docs, "doc_id long, text string"), items).where("kind = 'sentences'").select("doc_id", "item_id")
    assert sorted(map(tuple, got.orderBy(F.col("doc_id")).collect())) == [(i, i) for i in range(len(stems))]


@pytest.mark.parametrize("sizes", [(40, 5, 9), (19, 37), (50,)])
def test_long_sentences(spark, sizes):
    r = random.Random(sum(sizes))
    stems = [[[_word(r) for _ in range(n)] for n in sizes] for _ in range(60)]
    docs = [(i, _copy(r, s, sum(sizes) // leakage.EDIT_SHARE)) for i, s in enumerate(stems)]
    items = spark.createDataFrame([(i, " ".join(f"{' '.join(x)}." for x in s)) for i, s in enumerate(stems)], "item_id long, stem string")
    got = leakage.leaks(spark.createDataFrame(docs, "doc_id long, text string"), items).select("doc_id", "item_id")
    assert sorted(map(tuple, got.collect())) == [(i, i) for i in range(len(stems))]


def test_parts_are_proven():
    for spans in ([(0, 11), (11, 24)], [(0, 5), (5, 8)], [(0, 50)], [(0, 2), (2, 9)], [(0, 37), (37, 39), (39, 60)]):
        parts = leakage.shares(spans)
        assert sum(e + 1 for *_, e in parts) > spans[-1][1] // leakage.EDIT_SHARE
        assert all(z - a <= leakage.WINDOW and z - a - leakage.GRAM + 1 > leakage.GRAM * e >= 0 for a, z, e in parts)
    assert leakage.shares([(0, 2), (2, 4), (4, 6)]) is None


def test_long_tags_are_layout():
    assert leakage.plain_words(leakage.repaired(f"un <span data-x='{'y' * 3000}'>deux</span> si x < 3 et y > 4")) == "un deux si x 3 et y 4".split()
