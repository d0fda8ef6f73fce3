"""Sampling and splitting by seeded hashes of a row id: exact sizes, the same rows on every run and partitioning.

Ranks are taken per stratum. A stratum may be huge, so its rows are first cut down by a hash threshold that keeps a little more than is
wanted (found from counts), and only those are ranked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.rows import bounded_broadcast
from lexmill.session import cut_lineage

BUCKETS = 4096


def order_hash(key: str, seed: int = 42) -> Column:
    return F.xxhash64(F.col(key), F.lit(seed))


def _threshold_rank(df: DataFrame, strata: Sequence[str], key: str, quotas: DataFrame, seed: int) -> DataFrame:
    """The quota rows of lowest hash in each stratum. quotas: strata columns and _quota. Only rows up to the hash bucket in which the
    quota is reached are ranked."""
    # rows without key are told apart by their values, so that they don't share a bucket
    h = F.when(F.col(key).isNull(), F.xxhash64(F.to_json(F.struct(*df.columns)), F.lit(seed))).otherwise(order_hash(key, seed))
    bucket = F.shiftrightunsigned(h.bitwiseXOR(F.lit(-(2**63))), 52)  # in the order of the signed hash
    keyed = df.withColumns({"_h": h, "_b": bucket})
    hist = keyed.groupBy(*strata, "_b").agg(F.count(F.lit(1)).alias("_n"))
    joined = hist.join(bounded_broadcast(quotas), list(strata))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*strata).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    edge = joined.withColumn("_before", before).where("_before < _quota").groupBy(*strata, "_quota").agg(F.max(F.struct("_b", "_before")).alias("_e"))
    edge = edge.select(*strata, F.col("_e._b").alias("_edge"), (F.col("_quota") - F.col("_e._before")).alias("_left"))
    near = keyed.join(bounded_broadcast(edge), list(strata))
    near = near.where("_b <= _edge")
    rank = F.row_number().over(Window.partitionBy(*strata, "_b").orderBy("_h", key))
    sure, boundary = near.where("_b < _edge"), near.where("_b = _edge").withColumn("_rank", rank).where("_rank <= _left").drop("_rank")
    return sure.unionByName(boundary).select(*df.columns)


def exact_sample(df: DataFrame, k: int, key: str, seed: int = 42) -> DataFrame:
    """Exactly min(k, n) rows. Rows with equal keys are told apart only by their hash order; a null key is a key like others."""
    one = df.withColumn("_all", F.lit(0))
    return _threshold_rank(one, ["_all"], key, df.sparkSession.createDataFrame([(0, max(k, 0))], "_all int, _quota long"), seed).drop("_all")


def capped_sample(df: DataFrame, source: str, max_samples: int, key: str, seed: int = 42) -> DataFrame:
    """At most max_samples // sources * 2 rows of each source, then exactly max_samples in all if there are more."""
    counts = df.groupBy(source).agg(F.count(F.lit(1)).alias("_c")).where(F.col(source).isNotNull())
    n = max(1, counts.count())
    cap = max_samples // n * 2
    return exact_sample(_threshold_rank(df, [source], key, counts.select(source, F.lit(cap).cast("long").alias("_quota")), seed), max_samples, key, seed)


def ratio_sample(df: DataFrame, source: str, ratios: dict[str, float], key: str, seed: int = 42) -> DataFrame:
    """int(rows * ratio) rows of each source named in ratios, all rows of the others."""
    counts = df.where(F.col(source).isin(*ratios)).groupBy(source).agg(F.count(F.lit(1)).alias("_c"))
    ratio = F.create_map(*[x for k, v in ratios.items() for x in (F.lit(k), F.lit(float(v)))])
    quotas = counts.select(source, F.floor(F.col("_c") * ratio[F.col(source)]).cast("long").alias("_quota"))
    rest = df.where(F.coalesce(~F.col(source).isin(*ratios), F.lit(True)))
    return rest.unionByName(_threshold_rank(df.where(F.col(source).isin(*ratios)), [source], key, quotas, seed))


def target_sample(df: DataFrame, source: str, ratios: dict[str, float], key: str, seed: int = 42) -> DataFrame:
    """All rows of the sources without a ratio, which are the target, and int(rows of the target * ratio) rows of each other source, or
    all of them if it has no more. A null source is part of the target."""
    rest = df.where(F.coalesce(~F.col(source).isin(*ratios), F.lit(True)))
    size = rest.count()
    quotas = df.sparkSession.createDataFrame([(s, int(size * r)) for s, r in ratios.items()], f"`{source}` string, _quota long")
    return rest.unionByName(_threshold_rank(df.where(F.col(source).isin(*ratios)), [source], key, quotas, seed))


def length_quotas(df: DataFrame, file: str, alpha: float = 0.2, floor: int = 128, long: int = 2700, long_share: float = 0.8) -> DataFrame:
    """Per file: rows, rows at or over floor words, the target size round(alpha * n), and how many long and short rows make it up.
    Rounding is half to even. Null word counts are under the floor."""
    ok = F.col("num_words") >= floor
    n = df.groupBy(file).agg(F.count(F.lit(1)).alias("n_all"), F.count_if(ok).alias("n"), F.count_if(ok & (F.col("num_words") >= long)).alias("n_long_rows"))
    target = F.bround(F.col("n") * F.lit(float(alpha))).cast("long")
    n = n.withColumn("target", target).withColumn("n_long", F.least("n_long_rows", F.bround(F.col("target") * F.lit(float(long_share))).cast("long")))
    return n.withColumn("n_short", F.greatest(F.lit(0).cast("long"), F.least(F.col("target") - F.col("n_long"), F.col("n") - F.col("n_long_rows"))))


def length_aware(df: DataFrame, file: str, key: str, alpha: float = 0.2, floor: int = 128, long: int = 2700, seed: int = 42) -> DataFrame:
    """The long and short rows that length_quotas asks for in each file."""
    q = length_quotas(df, file, alpha, floor, long)
    quotas = q.select(file, F.lit(True).alias("_long"), F.col("n_long").alias("_quota")).unionByName(q.select(file, F.lit(False).alias("_long"), F.col("n_short").alias("_quota")))
    rows = df.where(F.col("num_words") >= floor).withColumn("_long", F.col("num_words") >= long)
    return _threshold_rank(rows, [file, "_long"], key, quotas, seed).drop("_long")


def train_test(df: DataFrame, key: str, test_size: float = 0.05, seed: int = 42) -> DataFrame:
    """A split column: exactly ceil(n * min(test_size, 0.05)) rows are validation, the rest train; test_size <= 0 means train only."""
    share = min(test_size, 0.05)
    if share <= 0:
        return df.withColumn("split", F.lit("train"))
    n = -(-df.count() * share // 1)
    test = exact_sample(df.select(key).distinct(), int(n), key, seed).withColumn("split", F.lit("validation"))
    return df.join(test, key, "left").withColumn("split", F.coalesce("split", F.lit("train")))


def choose(array: Column, key: Column, k: int, seed: int = 42) -> Column:
    """min(k, size) elements of an array, the same ones for the same key."""
    ranked = F.array_sort(F.transform(array, lambda x, i: F.struct(F.xxhash64(key, i, F.lit(seed)).alias("h"), x.alias("x"))))
    return F.transform(F.slice(ranked, 1, k), lambda r: r.x)


def draw(key: Column, weights: dict[str, float], salt: str, seed: int = 42) -> Column:
    """A weighted draw per row: a uniform number from a hash against cumulative weights."""
    u = F.pmod(F.xxhash64(key, F.lit(salt), F.lit(seed)), F.lit(1_000_003)) / 1_000_003.0
    total, run, out = sum(weights.values()), 0.0, None
    for name, w in weights.items():
        run += w / total
        out = F.when(u < run, name) if out is None else out.when(u < run, name)
    return out.otherwise(name)


def shuffled(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """All rows in an order fixed by the key and the seed: a range-partitioned sort on a hash, the same on every run and partitioning."""
    return df.orderBy(order_hash(key, seed), key)


def numbered(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """df sorted by the columns of order, with row_number from 0. The sort is range-partitioned and written once; numbers are places in a
    partition plus the sizes of those before it, of which one row a partition reaches the driver. Rows equal in order have any order."""
    place = F.monotonically_increasing_id()
    held = cut_lineage(df.orderBy(*order).withColumn("_id", place))
    part, inside = F.shiftrightunsigned("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = held.groupBy(part.cast("int").alias("p")).agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect()
    starts, total = {}, 0
    for r in sizes:
        starts[r.p], total = total, total + r.n
    table = F.array(*[F.lit(starts.get(p, 0)).cast("long") for p in range(max(starts, default=0) + 1)])
    return held.withColumn("row_number", table[part.cast("int")] + inside).drop("_id")


def shard_rows(df: DataFrame, order: Sequence[str], size: int) -> DataFrame:
    """df with shard: runs of `size` rows in the order of the columns, the last one shorter."""
    return numbered(df, order).withColumn("shard", F.floor(F.col("row_number") / size).cast("int")).drop("row_number")


def strided(df: DataFrame, order: Sequence[str], rank: int, world: int, skip: int = 0, limit: int | None = None) -> DataFrame:
    """Every world-th row from `rank` on, after the first `skip` and of at most `limit` rows of df in the order of the columns."""
    n = F.col("row_number") - skip
    keep = (n >= 0) & (F.pmod(n, F.lit(world)) == rank)
    return numbered(df, order).where(keep & (n < limit) if limit is not None else keep).drop("row_number")


def top(df: DataFrame, column: str, key: str, k: int = 5000) -> DataFrame:
    """The k rows with the largest values of a column, ties by key; nulls and NaN are left out. Each task hands on its own k rows."""
    return df.where(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double"))).orderBy(F.desc(column), key).limit(k)


def head_strict(df: DataFrame, order: str, n: int) -> DataFrame:
    """The first n rows; fewer rows are an error."""
    if (have := df.limit(n).count()) < n:
        raise ValueError(f"{n} rows wanted of {have}")
    return head(df, order, n)


def head(df: DataFrame, order: str, n: int, offset: int = 0) -> DataFrame:
    """Rows offset .. offset + n in the order of a column, clamped to what there is."""
    return df.orderBy(order).offset(offset).limit(n)
