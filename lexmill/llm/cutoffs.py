"""Problem 4: the score cutoff per slice that keeps a target fraction, by distributed quickselect.

All slices are searched at once. Each partition holds its scores as distinct values with counts. In each round the weighted median of
the partition medians is a slice's pivot, counts above and at the pivot discard one side, and the medians of both remaining sides come
with the same pass, so a round is one job. One row per slice and round reaches the driver. Ranks are exact; ties share their value.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions.rows import bounded_broadcast, latest
from lexmill.session import bounded_batches, cut_lineage

CHUNK_VALUES = 65_536


def slice_rows(rows: DataFrame, slices: DataFrame) -> DataFrame:
    """slice_id, row_id, score (double): the valid row of each row_id in each slice it belongs to, if scored. Null, NaN and negative
    scores mean not scored. A slice names a column by slice_field and a score by score_field; unknown columns match nothing."""
    cols = set(rows.columns)
    named = slices.select("slice_field", "score_field").distinct().collect()  # column names: bounded by the schema
    fields = sorted({r.slice_field for r in named} & cols)
    scores = sorted({r.score_field for r in named} & cols)
    if not fields or not scores:
        return rows.sparkSession.createDataFrame([], "slice_id int, row_id long, score double")
    valid = latest(rows, "row_id", ["scored_at", "ingested_at"], fields + [F.col(s).cast("double").alias(s) for s in scores])
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).cast("string").alias("v")) for f in fields]))
    long = valid.select("row_id", *[F.col(s).alias(f"_s_{s}") for s in scores], pairs.alias("p"))
    asked = slices.select("slice_id", F.col("slice_field").alias("f"), F.col("slice_value").alias("v"), F.col("score_field").alias("sf")).dropDuplicates(["slice_id"])
    score = F.coalesce(*[F.when(F.col("sf") == s, F.col(f"_s_{s}")) for s in scores])
    hit = long.select("*", "p.*").join(bounded_broadcast(asked), ["f", "v"]).select("slice_id", "row_id", score.alias("score"))
    return hit.where("score >= 0 and not isnan(score)")


def _compact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's scores as rows of (slice, sorted distinct values, counts)."""
    held: dict[int, list] = {}
    size = 0

    def flush():
        for s, parts in held.items():
            v, c = (np.concatenate(x) for x in zip(*parts, strict=True))
            u, at = np.unique(v, return_inverse=True)
            n = np.bincount(at, weights=c).astype(np.int64)
            for i in range(0, len(u), CHUNK_VALUES):
                yield pa.RecordBatch.from_pydict({"slice_id": pa.array([s], pa.int32()), "v": pa.array([u[i : i + CHUNK_VALUES]], pa.list_(pa.float64())), "c": pa.array([n[i : i + CHUNK_VALUES]], pa.list_(pa.int64()))})

    for b in batches:
        ids, vals = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
        for s in np.unique(ids):
            u, n = np.unique(vals[ids == s], return_counts=True)
            held.setdefault(int(s), []).append((u, n))
            size += len(u)
        if size > 1_000_000:
            yield from flush()
            held, size = {}, 0
    yield from flush()


def _median(v: np.ndarray, c: np.ndarray) -> tuple[float | None, int]:
    if not len(v):
        return None, 0
    cum = np.cumsum(c)
    return float(v[np.searchsorted(cum, (cum[-1] + 1) // 2)]), int(cum[-1])


def _round(state: dict[int, tuple[float, float, float]]):
    """Per chunk of a slice still searched in (lo, hi) with a pivot: counts above and at the pivot, medians and sizes of both sides."""
    names = ["slice_id", "gt", "eq", "m_lo", "w_lo", "m_hi", "w_hi"]

    def run(batches):
        for b in batches:
            out = []
            for s, v, c in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
                if s in state:
                    lo, hi, pivot = state[s]
                    v, c = v.values.to_numpy(zero_copy_only=False), c.values.to_numpy(zero_copy_only=False)
                    a, z = np.searchsorted(v, lo, "right"), np.searchsorted(v, hi, "left")
                    left, right = np.searchsorted(v, pivot, "left"), np.searchsorted(v, pivot, "right")
                    out.append((s, int(c[right:].sum()), int(c[left:right].sum()), *_median(v[a:left], c[a:left]), *_median(v[right:z], c[right:z])))
            if out:
                types = [pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.float64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names)

    return run


def _ask(compact: DataFrame, state: dict) -> dict:
    kind = "slice_id int, gt bigint, eq bigint, m_lo double, w_lo bigint, m_hi double, w_hi bigint"
    part = compact.mapInArrow(_round(state), kind)
    # The weighted median of the medians, low end: an observed value, so every round discards at least the pivot.
    mid = lambda m, w: F.expr(f"percentile({m}, 0.5, if({m} is null, 0, {w}))")
    got = part.groupBy("slice_id").agg(F.sum("gt").alias("gt"), F.sum("eq").alias("eq"), mid("m_lo", "w_lo").alias("lo"), mid("m_hi", "w_hi").alias("hi"))
    return {r.slice_id: r for r in got.collect()}  # one row per slice still searched


def cutoffs(rows: DataFrame, slices: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The cutoffs (slice_id, n_scored, wanted, cutoff, n_kept, kept_fraction) and the rows (slice_id, row_id, score) they keep.

    rows: row_id, scored_at, ingested_at and the columns named in slices; other columns are ignored. The cutoff is the highest score
    at which at least keep_fraction of the slice's scored rows have that score or more; the fraction is taken as the decimal it prints
    as, and null or out-of-range fractions are clamped to 0..1 (0 still keeps the top score's rows). A slice without scored rows has a
    null cutoff and keeps none.
    """
    spark = rows.sparkSession
    bounded_batches(spark)
    base = cut_lineage(slice_rows(rows, slices))
    compact = cut_lineage(base.select("slice_id", "score").mapInArrow(_compact, "slice_id int, v array<double>, c array<bigint>"))
    inf = float("inf")
    asked = slices.select("slice_id", "keep_fraction").dropDuplicates(["slice_id"]).collect()
    first = _ask(compact, {r.slice_id: (-inf, inf, -1.0) for r in asked})
    rank, lines, state = {}, [], {}
    for r in asked:
        part = Fraction(str(min(max(r.keep_fraction or 0.0, 0.0), 1.0)))
        n = first[r.slice_id].gt if r.slice_id in first else 0
        rank[r.slice_id] = max(1, -(-part * n // 1))
        if n:
            state[r.slice_id] = (-1.0, inf, first[r.slice_id].hi)
        else:
            lines.append((r.slice_id, 0, 0, None, 0))
    total = {s: first[s].gt for s in state}
    while state:
        got = _ask(compact, state)
        after = {}
        for s, (lo, hi, pivot) in state.items():
            g = got[s]
            if g.gt >= rank[s]:
                after[s] = (pivot, hi, g.hi)
            elif g.gt + g.eq >= rank[s]:
                lines.append((s, total[s], int(rank[s]), pivot, g.gt + g.eq))
            else:
                after[s] = (lo, pivot, g.lo)
        state = after
    table = spark.createDataFrame(lines, "slice_id int, n_scored long, wanted long, cutoff double, n_kept long").withColumn("kept_fraction", F.col("n_kept") / F.nullif("n_scored", F.lit(0)))
    kept = base.join(bounded_broadcast(table.select("slice_id", "cutoff")), "slice_id").where("score >= cutoff").select("slice_id", "row_id", "score")
    return table, kept
