"""Problem 5: splitting oversized texts at natural boundaries by recursive bisection.

A text over the limit is cut at the strongest boundary near its middle (paragraph, line, sentence, word, any character), halves over
the limit less the overlap are cut again, and each piece but the first then begins with the end of the one before.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from lexmill.session import bounded_batches, spread

LIMIT, OVERLAP = 6000, 200
KINDS = ("character", "word", "sentence", "line", "paragraph")
_PARAGRAPH = re.compile(r"(?:\r\n|[\n\r])[^\S\n\r]*(?:(?:\r\n|[\n\r])[^\S\n\r]*)+")
_LINE = re.compile(r"\r\n|[\n\r]")
_SENTENCE = re.compile(r"[.!?;…]+[\"'»”’)\]]*\s+")
_WORD = re.compile(r"\s+")
_RUN = re.compile(r"[\n\r]|[.!?;…](?=\s)")


def bisect(text: str, most: int) -> list[tuple[int, int]]:
    """Cuts (position, kind) in order such that no part is longer than most."""
    ends = [None, None, *([m.end() for m in p.finditer(text)] for p in (_SENTENCE, _LINE, _PARAGRAPH))]
    cuts: list[tuple[int, int]] = []

    def near(kind: int, a: int, z: int, mid: int) -> int | None:
        at = ends[kind]
        i, j = bisect_right(at, a), bisect_left(at, z)
        k = bisect_left(at, mid, i, j)
        return min((at[x] for x in (k - 1, k) if i <= x < j), key=lambda p: abs(p - mid), default=None)

    todo = [(0, len(text))]
    while todo:
        a, z = todo.pop()
        if z - a <= most:
            continue
        mid, quarter = (a + z) // 2, (z - a) // 4
        at, kind = None, 0
        for lo, hi in ((a + quarter, z - quarter), (a, z)):  # near the middle first, then wherever there is a natural one
            for kind in (4, 3, 2):
                if (at := near(kind, lo, hi, mid)) is not None:
                    break
            if at is not None:
                break
        if at is None:
            if ends[1] is None:
                ends[1] = [m.end() for m in _WORD.finditer(text)]
            at, kind = near(1, a, z, mid), 1
        if at is None:
            at, kind = mid, 0
        cuts.append((at, kind))
        todo += [(a, at), (at, z)]
    return sorted(cuts)


def pieces(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, int, int | None]]:
    """(start, body start, end, kind of the cut before) of each piece; pieces are text[start:end] and bodies tile the text."""
    if len(text) <= limit:
        return [(0, 0, len(text), None)]
    cuts = bisect(text, limit - overlap)
    starts, out = [0, *(c for c, _ in cuts), len(text)], []
    for i in range(len(starts) - 1):
        a, z = starts[i], starts[i + 1]
        lead = a
        if i:
            lead = max(starts[i - 1], a - overlap)
            if lead > starts[i - 1] and not text[lead - 1].isspace() and (m := _WORD.search(text, lead, a)):
                lead = m.end() if m.end() < a else lead
        out.append((lead, a, z, cuts[i - 1][1] if i else None))
    return out


def longest_unbroken(text: str) -> int:
    """Characters of the longest run without a line break or sentence end."""
    last = most = 0
    for m in _RUN.finditer(text):
        most, last = max(most, m.start() - last), m.end()
    return max(most, len(text) - last)


def _split(limit: int, overlap: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            size = 0
            for row_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if text is None:
                    out.append((row_id, 0, 0, 0, 0, None, None, 0))
                    continue
                got = pieces(text, limit, overlap)
                run_ = longest_unbroken(text) if len(text) > limit else 0
                for n, (lead, a, z, k) in enumerate(got):
                    out.append((row_id, n, lead, a - lead, z, None if k is None else KINDS[k], text[lead:z] if with_text else None, run_))
                    size += z - lead
                if size > 4_000_000:
                    yield _batch(out)
                    out, size = [], 0
            if out:
                yield _batch(out)

    return run


_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.int64()]
_NAMES = ["row_id", "piece", "start_pos", "overlap", "end_pos", "cut", "text", "longest_run"]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], _NAMES)


def split(docs: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP, with_text: bool = True) -> DataFrame:
    """row_id, piece (from 0), start_pos, overlap, end_pos, cut (kind of the boundary it starts at, null for the first), text,
    longest_run (set where a text is longer than limit). No shuffle; columns other than row_id and text are ignored.

    A null text gives one row with null text and no extent, an empty one one empty piece; repeated rows are split each time."""
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be smaller than limit")
    bounded_batches(docs.sparkSession)
    kind = "row_id bigint, piece int, start_pos bigint, overlap int, end_pos bigint, cut string, text string, longest_run bigint"
    return spread(docs.select("row_id", "text")).mapInArrow(_split(limit, overlap, with_text), kind)
