"""Exact quantiles and running sums without one task or one buffer that grows with a group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.session import cut_lineage

ACCURACY = 10_000
FEW = 15_000  # values of a group that are ordered without brackets, whose ends could lie closer than a rank


def same(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> Column:
    """Equality of the columns, nulls included; true for no columns."""
    return reduce(and_, [a[c].eqNullSafe(b[c]) for c in columns], F.lit(True))


def quantiles(df: DataFrame, by: Sequence[str], value: str, shares: Sequence[float], accuracy: int = ACCURACY) -> DataFrame:
    """by, n, q (array of double, one per share): the exact quantiles of the values that are not null, interpolated linearly, per group
    (one group in all without by); a null key is a group. NaN is the largest value. No rows for groups without values.

    In groups of FEW values and more an approximate summary brackets each wanted rank between two values that are at most four times n / accuracy ranks apart; only the
    distinct values inside the brackets are then counted and put in order. So the input is read three times, but no aggregation buffer
    holds the values of a group, as it would with percentile."""
    k, gap = len(shares), 2.0 / accuracy
    if not by:
        return quantiles(df.withColumn("_all", F.lit(0)), ["_all"], value, shares, accuracy).drop("_all")
    x = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    ends = [max(0.0, p - gap) for p in shares] + [min(1.0, p + gap) for p in shares]
    marks = x.groupBy(*by).agg(F.percentile_approx("_v", [float(p) for p in ends], accuracy).alias("_m"), F.count(F.lit(1)).alias("n"), F.min("_v").alias("_a"), F.max("_v").alias("_z"))
    whole = F.array(*[F.col(c) for c in ("_a", "_z") for _ in range(k)])
    marks = marks.select(*by, "n", F.when(F.col("n") < max(FEW, FEW * accuracy // ACCURACY), whole).otherwise(F.col("_m")).alias("_m"))
    near = marks.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)], "_m")
    key = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(by)])
    placed = x.join(near, key)
    under = placed.groupBy(*by).agg(F.array(*[F.count_if(F.col("_v") < F.col("_m")[i]) for i in range(k)]).alias("_under"))
    index = F.filter(F.array(*map(F.lit, range(k))), lambda i: (F.col("_v") >= F.element_at("_m", i + 1)) & (F.col("_v") <= F.element_at("_m", i + 1 + k)))
    counted = placed.select(*by, "_v", F.explode(index).alias("_i")).groupBy(*by, "_i", "_v").agg(F.count(F.lit(1)).alias("_c"))
    run = F.sum("_c").over(Window.partitionBy(*by, "_i").orderBy("_v"))
    facts = marks.join(under, same(marks, under, by)).select(*[marks[c].alias(f"_g{i}") for i, c in enumerate(by)], "n", "_under")
    ranked = counted.withColumn("_run", run).join(facts, key)
    rank = (F.col("n") - 1) * F.element_at(F.array(*[F.lit(float(p)) for p in shares]), F.col("_i") + 1)
    upto = F.element_at("_under", F.col("_i") + 1) + F.col("_run")
    holds = lambda r: (r < upto) & (r >= upto - F.col("_c"))
    low, high = F.floor(rank), F.ceil(rank)
    per = ranked.withColumns({"_low": F.when(holds(low), F.col("_v")), "_high": F.when(holds(high), F.col("_v")), "_part": rank - low})
    one = per.groupBy(*by, "n", "_i").agg(F.max("_low").alias("_low"), F.max("_high").alias("_high"), F.max("_part").alias("_part"))
    got = F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_part"))
    sure = F.coalesce(got, F.raise_error(F.lit("a bracket misses its rank")).cast("double"))
    return one.groupBy(*by, "n").agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", sure.alias("q")))), lambda s: s["q"]).alias("q"))  # k entries


def running(df: DataFrame, by: Sequence[str], order: str, value: str, name: str = "running") -> DataFrame:
    """df with the sum of value over the rows of the group up to and with this one, in the order of a column that differs within a group.
    The rows are range-partitioned by group and order and written once; sums inside a partition are moved by those of the partitions
    before it, so a group of any size is spread over many tasks."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    held = cut_lineage(df.repartitionByRange(parts, *by, order).withColumn("_p", F.spark_partition_id()))
    sums = held.groupBy(*by, "_p").agg(F.sum(value).alias("_s"))  # a row a partition and group
    before = sums.withColumn("_before", F.coalesce(F.sum("_s").over(Window.partitionBy(*by).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    before = before.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)], F.col("_p").alias("_q"), "_before")
    inside = held.withColumn("_run", F.sum(value).over(Window.partitionBy(*by, "_p").orderBy(order)))
    key = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(by)], F.col("_p") == F.col("_q"))
    return inside.join(before, key).withColumn(name, F.col("_run") + F.col("_before")).select(*df.columns, name)
