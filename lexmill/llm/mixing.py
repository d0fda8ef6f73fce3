"""Problem 1: mixing sources to target weights by hash-threshold histograms.

Each row has a fixed 64-bit hash. A subset that needs q copies of its words gets floor(q) copies of every row and one more of the
rows below a hash threshold. The threshold comes from sums of words per (subset, hash bucket): the boundary bucket is found, and
only that bucket is summed again with finer buckets, until it holds one row. Nothing is sorted and no rows reach the driver but one
per target subset and level. Thresholds for growing budgets are nested: a larger mix contains the smaller one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.functions.rows import bounded_broadcast, latest
from lexmill.functions.text import strip, word_count
from lexmill.session import cut_lineage

LEVEL_BITS = 12


def subset_key(c):
    return F.lower(strip(c))


def sizes(docs: DataFrame) -> DataFrame:
    """row_id, subset key, words of the valid row of each row_id. The text is counted before the shuffle and not shuffled."""
    lean = docs.select("row_id", "annotated_at", "ingested_at", subset_key(F.col("subset")).alias("subset"), word_count(F.col("text")).cast("long").alias("words"))
    return latest(lean, "row_id", ["annotated_at", "ingested_at"], ["subset", "words"])


def _thresholds(rows: DataFrame, budgets: dict[str, int], seed: int) -> dict[str, int]:
    """Per subset the unsigned hash below which rows sum to the budget as closely as whole rows allow."""
    spark = rows.sparkSession
    hashed = rows.select("subset", "words", F.xxhash64("row_id", F.lit(seed)).alias("h"))
    state = {s: (0, b) for s, b in budgets.items() if b > 0}
    found = {s: 0 for s in budgets}
    used = 0
    while state and used < 64:
        bits = min(LEVEL_BITS, 64 - used)
        frame = spark.createDataFrame([(s, p - 2**64 if p >= 2**63 else p, b) for s, (p, b) in state.items()], "subset string, prefix long, budget long")
        prefix = F.shiftrightunsigned("h", 64 - used) if used else F.lit(0).cast("long")
        inside = hashed.join(bounded_broadcast(frame), "subset").where(prefix == F.col("prefix"))
        bucket = F.shiftrightunsigned("h", 64 - used - bits) if used + bits < 64 else F.col("h")
        hist = inside.groupBy("subset", "budget", bucket.bitwiseAND(2**bits - 1).alias("bucket")).agg(F.sum("words").alias("w"), F.count(F.lit(1)).alias("n"))
        cum = F.sum("w").over(Window.partitionBy("subset").orderBy("bucket"))
        edge = hist.withColumn("cum", cum).where(F.col("cum") > F.col("budget")).groupBy("subset").agg(F.min(F.struct("bucket", "cum", "w", "n")).alias("e")).select("subset", "e.*")
        edges = {r.subset: r for r in edge.collect()}
        used += bits
        after = {}
        for s, (p, b) in state.items():
            if s not in edges:  # all rows inside the prefix fit
                found[s] = (p + 1) << (64 - used + bits)
                continue
            e = edges[s]
            left, at = b - (e.cum - e.w), (p << bits) | e.bucket
            if e.n == 1 or used == 64:
                found[s] = (at + (1 if e.w - left < left else 0)) << (64 - used)
            else:
                after[s] = (at, left)
        state = after
    return found


def mix(docs: DataFrame, targets: DataFrame, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """The mix (row_id, subset, words, copies > 0) and the report, one row per subset of either table: rows, words, target_share,
    target_words, max_repeats, reachable, mixed_words, share.

    docs: row_id, subset, text, annotated_at, ingested_at; other columns are ignored. targets: subset, target_share, max_repeats.
    The wanted size is the words of all valid rows. A subset whose words times max_repeats fall short of its target is used
    max_repeats times throughout and reported as not reachable; its deficit is not given to others. Subsets without target, rows
    with null subset, and null or negative shares or repeats get no copies; null text counts 0 words; empty tables give an empty mix.
    """
    spark = docs.sparkSession
    rows = cut_lineage(sizes(docs))
    wanted = targets.select(subset_key(F.col("subset")).alias("subset"), F.col("subset").alias("spelling"), "target_share", "max_repeats").where("subset is not null").dropDuplicates(["subset"])
    have = rows.groupBy("subset").agg(F.count(F.lit(1)).alias("rows"), F.sum("words").alias("words"))
    total = rows.agg(F.coalesce(F.sum("words"), F.lit(0))).first()[0]
    plan = wanted.join(have, "subset", "left").na.fill(0, ["rows", "words"]).collect()  # one row per target
    budgets, full, lines = {}, {}, []
    for r in plan:
        share, most = max(r.target_share or 0.0, 0.0), max(r.max_repeats or 0, 0)
        goal = share * total
        whole = min(most, int(goal // r.words)) if r.words else most
        full[r.subset], budgets[r.subset] = whole, int(round(goal - whole * r.words)) if whole < most else 0
        lines.append((r.subset, r.spelling, share, goal, most, not r.words * most < goal))
    cut = _thresholds(rows, budgets, seed)
    signed = lambda u: min(u, 2**64 - 1) - 2**63
    table = spark.createDataFrame([(s, full[s], signed(cut[s]), cut[s] > 0) for s in full], "subset string, whole int, cut long, some boolean")
    h = F.xxhash64("row_id", F.lit(seed)).bitwiseXOR(F.lit(-(2**63)))
    copies = F.col("whole") + (F.col("some") & (h < F.col("cut"))).cast("int")
    mixed = rows.join(bounded_broadcast(table), "subset").select("row_id", "subset", "words", copies.alias("copies")).where("copies > 0")
    kind = "subset string, spelling string, target_share double, target_words double, max_repeats int, reachable boolean"
    goals = spark.createDataFrame(lines, kind)
    got = mixed.groupBy("subset").agg(F.sum(F.col("words") * F.col("copies")).alias("mixed_words"), F.sum("copies").alias("mixed_rows"))
    report = (
        have.join(goals, "subset", "full").join(got, "subset", "left").na.fill(0, ["rows", "words", "mixed_words", "mixed_rows"])
        .withColumn("share", F.col("mixed_words") / F.nullif(F.sum("mixed_words").over(Window.partitionBy()), F.lit(0)))
        .select("subset", "spelling", "rows", "words", "target_share", "target_words", "max_repeats", "reachable", "mixed_rows", "mixed_words", "share")
    )
    return mixed, report
