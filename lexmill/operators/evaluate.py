"""Evaluation: classification reports, entity-set metrics, tokenizer statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.rows import bounded_broadcast


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), F.nullif(b.cast("double"), F.lit(0.0))), F.lit(0.0))


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """truth, predicted, n and its share of the truth's row; rows with a null side are left out."""
    c = df.where(F.col(truth).isNotNull() & F.col(predicted).isNotNull()).groupBy(truth, predicted).agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("share", F.col("n") / F.greatest(F.sum("n").over(Window.partitionBy(truth)), F.lit(1)))


def class_report(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """label, precision, recall, f1, support for every class of either side, and the rows 'macro', 'weighted' and 'accuracy' (accuracy in
    f1). Divisions by zero give 0."""
    pairs = df.where(F.col(truth).isNotNull() & F.col(predicted).isNotNull()).groupBy(F.col(truth).cast("string").alias("t"), F.col(predicted).cast("string").alias("p")).agg(F.count(F.lit(1)).alias("n"))
    sides = pairs.select(F.explode(F.array(F.struct(F.col("t").alias("label"), F.col("n").alias("true"), F.lit(0).cast("long").alias("pred"), F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0).alias("tp")), F.struct(F.col("p").alias("label"), F.lit(0).cast("long").alias("true"), F.col("n").alias("pred"), F.lit(0).cast("long").alias("tp")))).alias("s")).select("s.*")
    c = sides.groupBy("label").agg(F.sum("true").alias("support"), F.sum("pred").alias("pred"), F.sum("tp").alias("tp"))
    p, r = _ratio(F.col("tp"), F.col("pred")), _ratio(F.col("tp"), F.col("support"))
    per = c.select("label", p.alias("precision"), r.alias("recall"), _ratio(2 * F.col("tp"), F.col("pred") + F.col("support")).alias("f1"), "support", "tp")
    each = per.withColumn("row", F.explode(F.array(F.col("label"), F.lit("\0macro"), F.lit("\0weighted"), F.lit("\0accuracy"))))  # a label may have such a name
    kinds = ("precision", "recall", "f1")
    weigh = lambda k: _ratio(F.sum(F.col(k) * F.col("support")), F.sum("support"))
    g = each.groupBy("row").agg(*[F.avg(k).alias(k) for k in kinds], *[weigh(k).alias(f"w_{k}") for k in kinds], _ratio(F.sum("tp"), F.sum("support")).alias("a"), F.sum("support").alias("support"))
    pick = lambda k: F.when(F.col("row") == "\0accuracy", F.col("a")).when(F.col("row") == "\0weighted", F.col(f"w_{k}")).otherwise(F.col(k)).alias(k)
    return g.select(F.ltrim("row", F.lit("\0")).alias("label"), *[pick(k) for k in kinds], "support")


def entity_pairs(df: DataFrame, key: str, gold: str, predicted: str) -> DataFrame:
    """One row per (key, label, entity) of either side with in_gold and in_pred. Both columns are map<label, array<string>>; entities are
    stripped, lower-cased and counted once."""

    def side(c: str, flag: str) -> DataFrame:
        one = df.select(key, F.explode(c).alias("label", "items")).select(key, "label", F.explode("items").alias("entity"))
        return one.select(key, "label", F.lower(F.trim("entity")).alias("entity")).where("entity <> ''").distinct().withColumn(flag, F.lit(True))

    both = side(gold, "in_gold").join(side(predicted, "in_pred"), [key, "label", "entity"], "full")
    return both.na.fill(False, ["in_gold", "in_pred"])


def entity_report(pairs: DataFrame, key: str | None = None) -> DataFrame:
    """label, precision, recall, f1, support per label and for 'micro', 'macro', 'weighted' and, with a key, 'samples': the means over
    documents of their own rates. The pairs are counted once, per label (and key); what follows is a few rows per label."""
    counts = [F.sum(x.cast("long")).alias(n) for n, x in (("tp", F.col("in_gold") & F.col("in_pred")), ("gold", F.col("in_gold")), ("pred", F.col("in_pred")))]
    c = pairs.groupBy("label").agg(*counts)
    p, r, f = _ratio(F.col("tp"), F.col("pred")), _ratio(F.col("tp"), F.col("gold")), _ratio(2 * F.col("tp"), F.col("pred") + F.col("gold"))
    rates = [p.alias("precision"), r.alias("recall"), f.alias("f1")]
    per = c.select(F.array(F.lit("label"), F.lit("macro"), F.lit("weighted"), F.lit("micro")).alias("kinds"), "label", *rates, F.col("gold").alias("support"), "tp", "gold", "pred")
    each = per.select(F.explode("kinds").alias("kind"), "*").withColumn("label", F.when(F.col("kind") == "label", F.col("label")).otherwise(F.col("kind")))
    sums = [F.sum(k).alias(k) for k in ("tp", "gold", "pred")]
    kinds = ("precision", "recall", "f1")
    mean = [F.avg(k).alias(k) for k in kinds]
    weight = [_ratio(F.sum(F.col(k) * F.col("support")), F.sum("support")).alias(f"w_{k}") for k in kinds]
    g = each.groupBy("kind", "label").agg(*mean, *weight, F.sum("support").alias("support"), *sums)
    micro = dict(zip(kinds, (p, r, f), strict=True))
    pick = lambda k: F.when(F.col("kind") == "micro", micro[k]).when(F.col("kind") == "weighted", F.col(f"w_{k}")).otherwise(F.col(k)).alias(k)
    out = g.select("label", *[pick(k) for k in kinds], "support")
    if key is None:
        return out
    own = pairs.groupBy(key).agg(*counts).select(*rates, "gold").agg(*mean, F.sum("gold").alias("support")).where("support is not null")
    return out.unionByName(own.select(F.lit("samples").alias("label"), *kinds, "support"))


def entity_counts(df: DataFrame, pairs: DataFrame, key: str) -> DataFrame:
    """label, avg_gold, avg_pred, mae, bias per label and TOTAL over all documents, those without entities included; no rows at all
    without any entity. df: the documents, one row per key."""
    n = df.count()
    per = pairs.groupBy(key, "label").agg(F.sum(F.col("in_gold").cast("long")).alias("g"), F.sum(F.col("in_pred").cast("long")).alias("p"))
    total = per.groupBy(key).agg(F.sum("g").alias("g"), F.sum("p").alias("p")).withColumn("label", F.lit("TOTAL"))
    both = per.unionByName(total.select(key, "label", "g", "p"))
    sums = both.groupBy("label").agg(F.sum("g").alias("g"), F.sum("p").alias("p"), F.sum(F.abs(F.col("p") - F.col("g"))).alias("d"))
    x = sums.withColumn("docs", F.lit(n))
    return x.select("label", (F.col("g") / F.col("docs")).alias("avg_gold"), (F.col("p") / F.col("docs")).alias("avg_pred"), (F.col("d") / F.col("docs")).alias("mae"), ((F.col("p") - F.col("g")) / F.col("docs")).alias("bias"))


def regression_metrics(df: DataFrame, truth: str, predicted: str, rounded: Column, low: int = 0, high: int = 5) -> DataFrame:
    """mse of raw values, accuracy and micro F1 (equal for single labels) of rounded ones; null sides are left out."""
    x = df.where(F.col(truth).isNotNull() & F.col(predicted).isNotNull())
    hit = F.avg((rounded == F.col(truth)).cast("double"))
    return x.agg(F.avg(F.pow(F.col(predicted) - F.col(truth), 2)).alias("mse"), hit.alias("accuracy"), hit.alias("micro_f1"), F.count(F.lit(1)).alias("n"))


def fertility(df: DataFrame, group: str, tokens: str, words: str) -> DataFrame:
    """Tokens per word (0 without words) and averages per example."""
    return df.groupBy(group).agg(_ratio(F.sum(tokens), F.sum(words)).alias("fertility"), F.avg(tokens).alias("mean_tokens"), F.avg(words).alias("mean_words"), F.count(F.lit(1)).alias("n"))


def mean_row(df: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """The rows and one more, 'mean', with the unweighted mean of each column."""
    mean = df.agg(*[F.avg(c).alias(c) for c in columns]).select(F.lit("mean").alias(name), *columns)
    return df.select(F.col(name).cast("string").alias(name), *columns).unionByName(mean)


def token_frequency(df: DataFrame, tokens: str, k: int = 20) -> DataFrame:
    """The k most and k least frequent tokens with counts and their side; ties by token."""
    c = df.select(F.explode(tokens).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    top = c.orderBy(F.desc("n"), "token").limit(k).withColumn("side", F.lit("top"))
    return top.unionByName(c.orderBy("n", "token").limit(k).withColumn("side", F.lit("bottom")))


def vocabulary_coverage(df: DataFrame, tokens: str, vocabulary: DataFrame) -> DataFrame:
    """used, unused, size, coverage of a vocabulary (column token) by the tokens of a corpus."""
    seen = df.select(F.explode(tokens).alias("token")).distinct().withColumn("_s", F.lit(1))
    v = vocabulary.select("token").distinct().join(seen, "token", "left")
    return v.agg(F.count("_s").alias("used"), (F.count(F.lit(1)) - F.count("_s")).alias("unused"), F.count(F.lit(1)).alias("size"), _ratio(F.count("_s"), F.count(F.lit(1))).alias("coverage"))


def token_ids(df: DataFrame, key: str, tokens: str, vocabulary: DataFrame, known: str = "token", number: str = "token_id") -> DataFrame:
    """key, position, token, token_id of each token of a list column; null ids for tokens that the vocabulary lacks. A token listed twice
    has its least id. Null and empty lists give no rows."""
    table = vocabulary.where(F.col(known).isNotNull()).groupBy(F.col(known).alias("token")).agg(F.min(number).alias("token_id"))
    return df.select(key, F.posexplode(tokens).alias("position", "token")).join(bounded_broadcast(table), "token", "left").select(key, "position", "token", "token_id")


def label_ids(df: DataFrame, label: str, *splits: DataFrame) -> DataFrame:
    """Distinct non-null labels of df and the other splits in order with ids from 0. The labels of a classifier are few; they are numbered
    in one task."""
    one = lambda d: d.select(F.col(label).cast("string").alias("label")).where("label is not null").distinct()
    return reduce(lambda a, b: a.union(b), [one(d) for d in (df, *splits)]).distinct().withColumn("id", F.row_number().over(Window.orderBy("label")) - 1)


def multi_hot(labels: Column, vocabulary: list[str]) -> Column:
    return F.array(*[F.coalesce(F.array_contains(labels, v), F.lit(False)).cast("int") for v in vocabulary])


def over_limit(df: DataFrame, tokens: str, limit: int) -> DataFrame:
    """Documents over a model's limit and the tokens they would lose."""
    return df.where(F.col(tokens) > limit).agg(F.count(F.lit(1)).alias("n_over"), F.coalesce(F.sum(F.col(tokens) - limit), F.lit(0)).alias("n_lost"))
