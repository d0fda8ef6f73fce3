"""Row-level helpers shared by operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, key: str, order: Sequence[str], keep: Sequence[str | Column]) -> DataFrame:
    """The latest delivery of each key: one row of key and keep. Order columns compare in turn, nulls first; what still ties is
    decided by the kept values, so the result does not depend on row order. Pre-aggregates map-side; identical deliveries fold.
    A null key is one group of its own."""
    cols = [F.col(c) if isinstance(c, str) else c for c in keep]
    best = F.max(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], F.struct(*cols).alias("_v")))
    return df.groupBy(key).agg(best.alias("_b")).select(key, "_b._v.*")


def read(spark, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def bounded_broadcast(df: DataFrame, limit: int = 100_000) -> DataFrame:
    """Mark df for broadcast only if it has at most limit rows; beyond that Spark plans a shuffled join."""
    return F.broadcast(df) if len(df.limit(limit + 1).select(F.lit(1)).collect()) <= limit else df
