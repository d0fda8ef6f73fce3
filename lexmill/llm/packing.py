"""Problem 7: filling containers of fixed capacity by sum-of-squares packing.

Tokens are counted where texts are read; only (doc_id, tokens) is shuffled, to packing groups of bounded size chosen by hash. Inside a
group, documents go one by one, longest first, where the sum over residual gaps of the squared number of open containers with that gap
becomes smallest. A document over the capacity fills whole containers and its rest is packed like any other item.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.pieces import load
from lexmill.llm.token_budget import count_tokens

CAPACITY = 2048
GROUP_DOCS = 20_000


def sum_of_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Container number of each item (0 < size <= capacity) in the given order, and each container's filled size."""
    count = np.zeros(capacity + 1, np.int64)  # open containers by residual gap
    open_by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    where, fill = np.empty(len(sizes), np.int64), []
    for i, s in enumerate(sizes.tolist()):
        # Moving a container from gap g to g - s changes the sum by 2 (N[g-s] - N[g] + 1); closed ones (gap 0) don't count.
        have = count[s:capacity]
        if s < capacity:
            delta = 2 * (count[: capacity - s] - have + 1)
            delta[0] = 1 - 2 * have[0]
            delta[have == 0] = 1 << 40
            g = int(delta.argmin())
            best, new = int(delta[g]), 2 * int(count[capacity - s]) + 1
        else:
            best, new, g = 1 << 40, 0, 0
        if best <= new:
            gap = g + s
            bin_ = open_by_gap[gap].pop()
            count[gap] -= 1
        else:
            gap, bin_ = capacity, len(fill)
            fill.append(0)
        rest = gap - s
        if rest:
            count[rest] += 1
            open_by_gap[rest].append(bin_)
        fill[bin_] += s
        where[i] = bin_
    return where, np.asarray(fill, np.int64)


def _pack(capacity: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        tokens, docs = pdf["n_tokens"].to_numpy(), pdf["doc_id"].to_numpy()
        whole, rest = tokens // capacity, tokens % capacity
        full = np.repeat(np.arange(len(pdf)), whole)
        nth = np.arange(len(full)) - np.repeat(np.cumsum(whole) - whole, whole)
        part = np.flatnonzero(rest)
        part = part[np.lexsort((docs[part], -rest[part]))]
        where, fill = sum_of_squares(rest[part], capacity)
        base = int(key[0]) << 32
        return pd.DataFrame({
            "container": base + np.concatenate([np.arange(len(full)), len(full) + where]),
            "doc_id": docs[np.concatenate([full, part])],
            "piece": np.concatenate([nth, whole[part]]).astype("int32"),
            "pieces": (whole + (rest > 0))[np.concatenate([full, part])].astype("int32"),
            "n_tokens": np.concatenate([np.full(len(full), capacity, np.int64), rest[part]]),
            "fill": np.concatenate([np.full(len(full), capacity, np.int64), fill[where]]),
        })

    return run


def pack(docs: DataFrame, token_pieces: DataFrame, capacity: int = CAPACITY, group_docs: int = GROUP_DOCS) -> DataFrame:
    """container, doc_id, piece (from 0), pieces, n_tokens of the piece, fill of the container.

    docs: doc_id, text; other columns are ignored. Documents without tokens (null, blank) take no room and no row. Equal doc_ids are
    packed as separate items."""
    if capacity < 1:
        raise ValueError("capacity must be positive")
    tokens = count_tokens(docs.select("doc_id", "text"), load(token_pieces)).where("n_tokens > 0")
    groups = max(1, -(-docs.count() // group_docs))
    grouped = tokens.withColumn("_g", F.pmod(F.xxhash64("doc_id"), F.lit(groups)).cast("int"))
    # an explicit number of partitions, as groups are small in bytes but not in work, and would be coalesced to one task
    tasks = min(groups, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    grouped = grouped.repartition(tasks, "_g")
    return grouped.groupBy("_g").applyInPandas(_pack(capacity), "container bigint, doc_id bigint, piece int, pieces int, n_tokens bigint, fill bigint")
