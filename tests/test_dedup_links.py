"""Near-duplicate clusters against brute force over all pairs, with similarities close to the limit."""

import random

from lexmill.operators import dedup


def _runs(text):
    w = text.split()
    k = min(dedup.SHINGLE, len(w))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def _links(texts):
    sets = [_runs(t) for t in texts]
    return {(i, j) for i, a in enumerate(sets) for j in range(i) if 5 * len(a & sets[j]) >= 4 * len(a | sets[j])}


def _clusters(texts):
    up = list(range(len(texts)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, j in _links(texts):
        x, y = sorted((root(i), root(j)))
        up[y] = x
    return {i: root(i) for i in range(len(texts))}


def _frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_no_link_is_lost_or_made_up(spark):
    r = random.Random(11)
    word = lambda: "".join(r.choice("bcdlmnrst") + r.choice("aeiou") for _ in range(3))
    texts = []
    for _ in range(80):
        base = [word() for _ in range(r.randrange(40, 120))]
        texts.append(base)
        for _ in range(2):  # each a neighbour of the base, seldom of the other
            w = list(base)
            for _ in range(max(1, len(w) // 40)):
                w[r.randrange(len(w))] = word()
            texts.append(w)
    r.shuffle(texts)
    texts = [" ".join(t) for t in texts]
    got = {x.doc_id: x.cluster for x in dedup.near_duplicates(_frame(spark, texts), "doc_id", "text").collect()}
    assert len(_links(texts)) > 40 and got == _clusters(texts)


def test_texts_that_share_boilerplate(spark):
    r = random.Random(12)
    word = lambda: "".join(r.choice("bcdlmnrst") + r.choice("aeiou") for _ in range(3))
    common = [word() for _ in range(70)]  # two thirds of each text
    own = [[word() for _ in range(35)] for _ in range(60)]
    texts = [" ".join([*common, *w]) for w in own] + [" ".join([*common, *w[:-2], word()]) for w in own[::4]]
    got = {x.doc_id: x.cluster for x in dedup.near_duplicates(_frame(spark, texts), "doc_id", "text").collect()}
    assert got == _clusters(texts) and len(set(got.values())) == 60


def test_rare_runs_find_every_pair(spark):
    r = random.Random(13)
    word = lambda: r.choice("abcdefgh") + r.choice("abcd")
    base = [[word() for _ in range(r.randrange(5, 60))] for _ in range(60)]
    texts = [" ".join(b) for b in base] + [" ".join(b[: len(b) - r.randrange(0, 1 + len(b) // 8)] + [word()] * r.randrange(2)) for b in base]
    nodes = spark.createDataFrame([(i, len(_runs(t)), i) for i, t in enumerate(texts)], "node long, n int, cluster long")
    got = {(x.node, x.c) for x in dedup.rare_pairs(nodes, _frame(spark, texts).withColumnRenamed("doc_id", "node"), 0.8).collect()}
    assert _links(texts) <= got and len(got) < len(texts) * (len(texts) - 1) / 8
    assert dedup.rare_pairs(nodes.limit(0), _frame(spark, texts).withColumnRenamed("doc_id", "node"), 0.8).count() == 0
