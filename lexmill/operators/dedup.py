"""Exact and near-duplicate removal."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.functions.text import words
from lexmill.operators.model_output import without_accents
from lexmill.session import bounded_batches, cut_lineage

SHINGLE, BANDS, ROWS, SIMILARITY = 5, 30, 5, 0.8


def exact(df: DataFrame, field: str, key: str, seed: int = 42) -> DataFrame:
    """One row per value of field: the one whose key hashes lowest, of rows with equal keys the one whose other values do. Texts are told
    apart by two 64-bit hashes and their length. A null field is a value, a null key a key. One aggregation: copies fold where they are
    read, so a text that fills a third of all rows is one row per task before the shuffle."""
    ident = [F.xxhash64(field).alias("_a"), F.xxhash64(F.lit(7), F.col(field)).alias("_b"), F.length(field).alias("_l")]
    rank = F.struct(F.xxhash64(F.col(key), F.lit(seed)), F.col(key), F.xxhash64(F.to_json(F.struct(*df.columns))))
    return df.groupBy(*ident).agg(F.min_by(F.struct(*df.columns), rank).alias("_row")).select("_row.*")


def word_hashes(text: Column) -> Column:
    """Hashes of the lower-cased words without punctuation, in order; null for null text."""
    return F.transform(words(F.lower(F.regexp_replace(text, r"[\p{Punct}«»“”’…]+", " "))), lambda w: F.xxhash64(w))


def run_hashes(row, mult: np.ndarray) -> np.ndarray:
    """The distinct hashes of all runs of SHINGLE words; a shorter text is one run."""
    x = np.asarray(row).astype(np.int64).view(np.uint64)
    size = min(SHINGLE, len(x))
    run = np.zeros(len(x) - size + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            run = (run ^ x[k : len(x) - size + 1 + k]) * mult[k]
            run ^= run >> np.uint64(31)
    return np.unique(run)


def multipliers() -> np.ndarray:
    return np.random.default_rng(7).integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@F.pandas_udf(T.ArrayType(T.LongType()))
def signature(hashes: pd.Series) -> pd.Series:
    """The number of distinct runs, then BANDS hashes of ROWS minima of seeded hashes over all runs each; a text without words has none. In
    numpy, because Spark interprets lambdas, and one inside another re-evaluates what it refers to."""
    mult = multipliers()

    def one(row) -> np.ndarray | None:
        if row is None or not len(row):
            return None
        run = run_hashes(row, mult)
        low = np.full(len(mult), np.iinfo(np.uint64).max, np.uint64)
        with np.errstate(over="ignore"):
            for i in range(0, len(run), 256):  # a product of mixed 64-bit hashes needs no further mixing; blocks stay in the cache
                low = np.minimum(low, (run[i : i + 256, None] * mult).min(0))
            band = np.arange(1, BANDS + 1).astype(np.uint64)  # so that bands differ, and need not be told apart further on
            for k in range(ROWS):
                band = (band ^ low[k::ROWS]) * mult[k]
                band ^= band >> np.uint64(31)
        return np.concatenate([[len(run)], band.view(np.int64)])

    return hashes.map(one)


@F.pandas_udf(T.ArrayType(T.LongType()))
def run_set(hashes: pd.Series) -> pd.Series:
    mult = multipliers()
    return hashes.map(lambda row: None if row is None or not len(row) else run_hashes(row, mult).view(np.int64))


def similar(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (node, c) whose sets of runs have at least this Jaccard similarity, counted exactly. texts: node, text."""
    wanted = pairs.select("node").union(pairs.select("c")).distinct()
    runs = cut_lineage(texts.join(wanted, "node", "left_semi").select("node", run_set(word_hashes(F.col("text"))).alias("runs")))
    both = pairs.join(runs, "node").join(runs.select(F.col("node").alias("c"), F.col("runs").alias("cruns")), "c")
    shared = F.size(F.array_intersect("runs", "cruns"))
    return both.where(shared >= similarity * (F.size("runs") + F.size("cruns") - shared) - 1e-9).select("node", "c")


def components(label: DataFrame, links: DataFrame, rounds: int) -> DataFrame:
    """label (node, cluster) with the least cluster that links lead to: least labels pass along links, with pointer jumping."""
    both = links.unionByName(links.select(F.col("c").alias("node"), F.col("node").alias("c")))
    for _ in range(rounds):
        least = both.join(label.select(F.col("node").alias("c"), F.col("cluster").alias("l")), "c").groupBy("node").agg(F.min("l").alias("l"))
        moved = label.join(least, "node", "left").select("node", F.least("cluster", F.coalesce("l", "cluster")).alias("cluster"), F.col("cluster").alias("old"))
        # pointer jumping: take the label of the label
        jump = moved.select(F.col("node").alias("cluster"), F.col("cluster").alias("l2"))
        moved = cut_lineage(moved.join(jump, "cluster", "left").select("node", F.least("cluster", F.coalesce("l2", "cluster")).alias("cluster"), "old"))
        label = moved.select("node", "cluster")
        if moved.where("cluster <> old").isEmpty():
            return label
    raise RuntimeError("components did not converge")


def rare_pairs(nodes: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """(node, c) of all pairs of nodes in different clusters that may have this Jaccard similarity. Two such sets of runs share one of the
    1 - similarity rarest parts of either (and one run more), whatever the order of runs, as the rest alone is too small; so only these runs,
    rarest first among the nodes, bring texts together. nodes: node, n (runs), cluster."""
    runs = texts.join(nodes, "node", "left_semi").select("node", F.explode(run_set(word_hashes(F.col("text")))).alias("r"))
    runs = cut_lineage(runs)
    counts = runs.groupBy("r").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    shared = runs.join(counts, "r").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("m", "r"))).alias("common"))  # a text's own runs
    lone = F.col("n") - F.size("common")  # runs of no other node come first and bring nothing together
    most = F.col("n") - F.ceil(F.col("n") * similarity - 1e-9) + 1
    prefix = nodes.join(shared, "node").withColumn("k", F.greatest(F.lit(0), most - lone).cast("int"))
    keyed = prefix.where("k > 0").select("node", "n", "cluster", F.explode(F.slice("common", F.lit(1), F.col("k"))).alias("x")).select("node", "n", "cluster", "x.r")
    several = keyed.groupBy("r").agg(F.min("cluster").alias("a"), F.max("cluster").alias("z")).where("a < z").select("r")
    keyed = cut_lineage(keyed.join(several, "r", "left_semi"))
    other = keyed.select(F.col("node").alias("c"), F.col("n").alias("cn"), F.col("cluster").alias("cc"), "r")
    near = (F.least("n", "cn") >= similarity * F.greatest("n", "cn") - 1e-9) & (F.col("node") > F.col("c")) & (F.col("cluster") != F.col("cc"))
    return keyed.join(other, "r").where(near).select("node", "c").distinct()


def near_duplicates(df: DataFrame, key: str, text: str, similarity: float = SIMILARITY, rounds: int = 30) -> DataFrame:
    """key, cluster (the least key of its component) of every row with words. Exact copies are folded first, so a class of copies is one
    node. Nodes that share a MinHash band are candidates; a link is one whose sets of runs are similar, counted exactly. First every node
    is tried with the least node of each of its bands, so that a band of near copies costs its rows once. Nodes of bands that still hold
    different components then go through rare_pairs, since a link inside a component changes nothing: texts that share boilerplate fill
    whole bands without being similar, but no rare runs."""
    folded = df.select(key, F.xxhash64(text).alias("_t"), F.length(text).alias("_l"), F.col(text).alias("_x"))
    bounded_batches(df.sparkSession)
    node = folded.withColumn("s", signature(word_hashes(F.col("_x")))).groupBy("_t", "_l").agg(F.min(key).alias("node"), F.first("s").alias("s"))
    signed = cut_lineage(node.select("node", "s").where("s is not null"))
    texts = df.select(F.col(key).alias("node"), F.col(text).alias("text"))
    close = lambda: F.least("n", "cn") >= similarity * F.greatest("n", "cn") - 1e-9  # noqa: E731  sets of other sizes cannot be similar
    member = signed.select("node", F.element_at("s", 1).alias("n"), F.explode(F.slice("s", 2, BANDS)).alias("h"))
    centre = member.groupBy("h").agg(F.min_by(F.struct(F.col("node").alias("c"), F.col("n").alias("cn")), "node").alias("_c"), F.count(F.lit(1)).alias("m")).where("m > 1").select("h", "_c.*")
    tried = cut_lineage(member.join(centre, "h"))
    first = cut_lineage(tried.where((F.col("node") != F.col("c")) & close()).select("node", "c").distinct())
    links = cut_lineage(similar(first, texts, similarity))
    label = components(signed.select("node", F.col("node").alias("cluster")), links, rounds)
    left = tried.select("node", "n", "h").join(label, "node")
    several = left.groupBy("h").agg(F.min("cluster").alias("a"), F.max("cluster").alias("z")).where("a < z").select("h")
    left = cut_lineage(left.join(several, "h", "left_semi").select("node", "n", "cluster").distinct())
    across = rare_pairs(left, texts, similarity)
    more = cut_lineage(similar(cut_lineage(across.join(first, ["node", "c"], "left_anti")), texts, similarity))
    if not more.isEmpty():
        label = components(label, links.unionByName(more), rounds)
    members = folded.join(node.select("_t", "_l", "node"), ["_t", "_l"])
    return members.join(label, "node").select(key, "cluster")


def keep_one(df: DataFrame, key: str, clusters: DataFrame) -> DataFrame:
    """All rows but those that are not the least of their cluster."""
    return df.join(clusters.where(F.col(key) != F.col("cluster")).select(key), key, "left_anti")


def normal_text(text: Column) -> Column:
    """Lower case without accents, for comparing across spellings."""
    return without_accents(F.lower(text))
