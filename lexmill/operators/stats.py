"""Summaries, pivots, bins, retention curves and roll-ups. All are plain aggregations with map-side partial results."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.text import word_count
from lexmill.operators.ranks import quantiles, running, same
from lexmill.session import cut_lineage

# The density bins and summary quantiles.
BINS = (0.0, 0.05, 0.1, 0.2, 0.3, 1.0)
QUANTILES = (0.25, 0.5, 0.75, 0.9, 0.95, 0.99)


def summary(df: DataFrame, columns: Sequence[str], shares: Sequence[float] = QUANTILES) -> DataFrame:
    """One row per column with any value: n, sum, mean, population std, min, max, exact quantiles and the share of positive values; nulls
    are dropped, absent columns skipped."""
    have = [c for c in columns if c in df.columns]
    lean = cut_lineage(df.select(*have))  # numbers only, so that texts they are derived from are read once
    packed = lean.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in have])).alias("p")).select("p.*").where("x is not null")
    facts = packed.groupBy("column").agg(F.count("x").alias("n"), F.sum("x").alias("sum"), F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"), F.min("x").alias("min"), F.max("x").alias("max"), F.avg((F.col("x") > 0).cast("double")).alias("share_positive"))
    out = facts.join(quantiles(packed, ["column"], "x", shares).select("column", "q"), "column")
    return out.select("column", "n", "sum", "mean", "std", "min", "max", *[F.col("q")[i].alias(f"q{round(p * 100):02d}") for i, p in enumerate(shares)], "share_positive")


def with_medians(groups: DataFrame, df: DataFrame, by: Sequence[str], values: dict[str, str]) -> DataFrame:
    """groups, one row per group, and the exact median of each column in values under its new name; null for groups without values."""
    for column, name in values.items():
        medians = quantiles(df, by, column, [0.5]).select(*by, F.col("q")[0].alias(name))
        groups = groups.join(medians, same(groups, medians, by), "left").select(*[groups[c] for c in groups.columns], name)
    return groups


def by_class(df: DataFrame, cls: str, words: str, numerics: Sequence[str] = ()) -> DataFrame:
    """Documents, words, their shares in percent, mean and exact median of numerics, per class; null is a class of its own."""
    df = cut_lineage(df.select(*dict.fromkeys([cls, words, *numerics])))  # numbers only, so that texts they are derived from are read once
    groups = df.groupBy(cls).agg(F.count(words).alias("n_docs"), F.sum(words).alias("n_words"), *[F.avg(c).alias(f"mean_{c}") for c in numerics])
    everything = Window.partitionBy()  # over one row a class
    share = lambda c: F.coalesce(F.try_divide(F.col(c) * 100.0, F.nullif(F.sum(c).over(everything), F.lit(0))), F.lit(0.0))
    groups = groups.withColumns({"share_docs": share("n_docs"), "share_words": share("n_words")})
    return with_medians(groups, df, [cls], {c: f"median_{c}" for c in numerics})


def corpus_counts(frames: dict[str, DataFrame], text: str) -> DataFrame:
    """stage, n_docs, n_words of each frame, as before and after a filter; null texts are documents without words."""
    one = lambda name, df: df.agg(F.lit(name).alias("stage"), F.count(F.lit(1)).alias("n_docs"), F.coalesce(F.sum(word_count(F.col(text)).cast("long")), F.lit(0)).alias("n_words"))
    return reduce(lambda a, b: a.unionByName(b), [one(name, df) for name, df in frames.items()])


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def half_even_score(c: Column, low: int = 0, high: int = 5) -> Column:
    """Clamp, then round half to even; NaN is low, null stays null."""
    return F.when(F.isnan(c), low).when(c.isNotNull(), F.rint(F.greatest(F.lit(float(low)), F.least(c.cast("double"), F.lit(float(high)))))).cast("int")


def score_pivot(df: DataFrame, cls: str, score: str, weight: str | None = None) -> DataFrame:
    """Per class the weight of each score 0..5 and its share of the class; rows without class or score are dropped."""
    s = half_even_score(F.col(score))
    w = F.coalesce(F.col(weight).cast("double"), F.lit(0.0)) if weight else F.lit(1.0)
    base = df.where(F.col(cls).isNotNull() & F.col(score).isNotNull())
    sums = base.groupBy(cls).agg(*[F.sum(F.when(s == i, w).otherwise(0.0)).alias(f"s{i}") for i in range(6)])
    total = sum((F.col(f"s{i}") for i in range(1, 6)), F.col("s0"))
    return sums.withColumns({f"p{i}": F.coalesce(F.try_divide(F.col(f"s{i}"), total), F.lit(0.0)) for i in range(6)})


def class_order(df: DataFrame, cls: str, value: str, mode: str = "median_desc", top: int | None = None, seen: str | None = None) -> DataFrame:
    """mean, median, n per class with its place in the wanted order (median_desc, median_asc, mean_desc, count_desc, label_asc, or
    appearance, the least value of column seen); ties by label. top keeps the largest classes only."""
    x = df.where(F.col(cls).isNotNull() & F.col(value).isNotNull())
    g = x.groupBy(cls).agg(F.avg(value).alias("mean"), F.count(F.lit(1)).alias("n"), (F.min(seen) if seen else F.lit(0)).alias("_seen"))
    if top is not None:
        g = g.orderBy(F.desc("n"), cls).limit(top)
    g = with_medians(g, x, [cls], {value: "median"})
    order = {"median_desc": F.desc("median"), "median_asc": F.asc("median"), "mean_desc": F.desc("mean"), "count_desc": F.desc("n"), "label_asc": F.asc(cls), "appearance": F.asc("_seen")}[mode]
    return g.withColumn("place", F.row_number().over(Window.orderBy(order, F.asc(cls)))).select(cls, "mean", "median", "n", "place")


def bin_of(value: Column, bins: Sequence[float] = BINS) -> Column:
    """Index of the left-closed right-open bin, the last included; null outside."""
    out = None
    for i, (a, z) in enumerate(zip(bins, bins[1:], strict=False)):
        test = (value >= a) & (value < z)
        out = F.when(test, i) if out is None else out.when(test, i)
    return out


def bins_cumulative(df: DataFrame, value: str, bins: Sequence[float] = BINS) -> DataFrame:
    """Count, share and running share of each bin; shares are of all rows with a value, those outside the bins too."""
    x = df.where(F.col(value).isNotNull()).select(bin_of(F.col(value).cast("double"), bins).alias("bin"))
    n = x.groupBy("bin").agg(F.count(F.lit(1)).alias("n")).withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))
    return n.where("bin is not null").withColumn("cumulative", F.sum("share").over(Window.orderBy("bin")))


def bins_by_class(df: DataFrame, cls: str, value: str, weight: str | None = None, bins: Sequence[float] = BINS) -> DataFrame:
    """Weight and share of each bin per class, and the class's place; rows outside the bins are dropped, a null weight counts 0. Without
    weight, classes are in the order of the count of the last bin but one, with weight in that of the share of the last bin; ties by
    class."""
    w = F.coalesce(F.col(weight).cast("double"), F.lit(0.0)) if weight else F.lit(1.0)
    x = df.where(F.col(cls).isNotNull()).select(cls, bin_of(F.col(value).cast("double"), bins).alias("bin"), w.alias("w")).where("bin is not null")
    k = range(len(bins) - 1)
    g = x.groupBy(cls).agg(*[F.sum(F.when(F.col("bin") == i, F.col("w")).otherwise(0.0)).alias(f"b{i}") for i in k])
    total = sum((F.col(f"b{i}") for i in k[1:]), F.col("b0"))
    g = g.withColumns({f"p{i}": F.coalesce(F.try_divide(F.col(f"b{i}"), total), F.lit(0.0)) for i in k})
    return g.withColumn("place", F.row_number().over(Window.orderBy(F.desc(f"p{k[-1]}" if weight else f"b{k[-2]}"), F.asc(cls))))


def retention(df: DataFrame, subset: str, value: str) -> DataFrame:
    """ECDF and retention per subset at each distinct finite value: shares of rows at or below, and at or above it. One row per value, from
    counts; the running sums are spread over tasks, so that no task sees all values of a large subset."""
    x = df.where(F.col(value).isNotNull() & ~F.isnan(value) & (F.abs(F.col(value)) != float("inf")))
    c = x.groupBy(subset, F.col(value).cast("double").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    totals = x.groupBy(subset).agg(F.count(F.lit(1)).alias("_total"))
    run = running(c, [subset], "value", "n", "_below")
    total, below = F.col("_total"), F.col("_below")
    return run.join(totals, same(run, totals, [subset])).select(run[subset], "value", "n", (below / total).alias("ecdf"), (1 - (below - F.col("n")) / total).alias("retained"))


def retention_at(df: DataFrame, subset: str, value: str, thresholds: Sequence[float]) -> DataFrame:
    """P(value >= t) per subset for given thresholds."""
    x = df.where(F.col(value).isNotNull() & ~F.isnan(value))
    return x.groupBy(subset).agg(*[F.avg((F.col(value).cast("double") >= t).cast("double")).alias(f"at_{i}") for i, t in enumerate(thresholds)])


def plot_limits(df: DataFrame, value: str, pad: float = 0.05) -> DataFrame:
    """low, high: the 1 % and 99 % quantiles with padding, the extremes where they coincide; low is not under 0 if no value is."""
    x = df.where(F.col(value).isNotNull() & ~F.isnan(value) & (F.abs(F.col(value)) != float("inf")))
    q = quantiles(x, [], value, [0.0, 0.01, 0.99, 1.0])
    x = q.select(F.array(F.col("q")[1], F.col("q")[2]).alias("q"), F.col("q")[0].alias("a"), F.col("q")[3].alias("z"))
    lo, hi = F.when(F.col("q")[1] > F.col("q")[0], F.col("q")[0]).otherwise(F.col("a")), F.when(F.col("q")[1] > F.col("q")[0], F.col("q")[1]).otherwise(F.col("z"))
    margin = (hi - lo) * pad
    return x.select(F.when(F.col("a") >= 0, F.greatest(F.lit(0.0), lo - margin)).otherwise(lo - margin).alias("low"), (hi + margin).alias("high"))


def rollup_counts(df: DataFrame, name: str, file: str, words: str) -> DataFrame:
    """Rows and words per (name, file), per name and in total (level 0, 1, 2); missing words count 0."""
    lvl = F.expr(f"case grouping_id(`{name}`, `{file}`) when 0 then 0 when 1 then 1 else 2 end")
    return df.groupingSets([[name, file], [name], []], name, file).agg(lvl.alias("level"), F.count(F.lit(1)).alias("n_docs"), F.coalesce(F.sum(words), F.lit(0)).alias("n_words"))


def before_after_summary(df: DataFrame, signed: Sequence[str] = ("density_diff", "edu_diff"), columns: Sequence[str] = ("char_ratio", "word_ratio", "density_diff", "density_ratio", "edu_diff")) -> DataFrame:
    """column, n, mean, std (population), q25, q50, q75, q90 of each column of before_after that df has with any value, and for signed
    ones the share of values over 0, null for the others."""
    got = summary(df, columns, (0.25, 0.5, 0.75, 0.9))
    return got.select("column", "n", "mean", "std", "q25", "q50", "q75", "q90", F.when(F.col("column").isin(*signed), F.col("share_positive")).alias("share_positive"))


def softmax(scores: Column) -> Column:
    top = F.array_max(scores)
    e = F.transform(scores, lambda x: F.exp(x - top))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))


def argmax(scores: Column) -> Column:
    """Index from 0 of the first greatest score."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")
