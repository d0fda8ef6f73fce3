"""Problem 2: repetition inside one document by suffix arrays.

Words are compared without case, punctuation, spacing and numbers. A suffix array with its longest-common-prefix intervals gives, for
every position, the longest passage that occurs earlier in the same text; maximal repeated passages of at least MIN_RUN words, and
immediate repetitions of shorter ones, mark their later copies, and the union of these spans over all words is the repeated share.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.session import bounded_batches, spread

MIN_RUN = 6
# Occurrences from which a run shorter than MIN_RUN counts, by its words; shorter ones recur by chance.
TIMES = {3: 5, 4: 3, 5: 3}
SHARE = 0.40
SHORT = 2_000  # words of a text whose suffixes are sorted as bytes; longer ones would take quadratic room
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_FIELD = re.compile(r'\\*"rewritten_text\\*"\s*:\s*')
_NEXT = re.compile(r'"\s*(?:,\s*"(?:is_rewritable|format|title)"\s*:|\}|,?\s*$)')
_ESCAPE = re.compile(r'\\(u[0-9a-fA-F]{4}|.)', re.S)
# JSON's one-letter escapes.
_LETTERS = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "f": "\f"}


def rewritten_text(output: str | None) -> str | None:
    """The value of rewritten_text, as far as it can be read however the JSON around it is damaged; None if there is none."""
    if not output:
        return None
    at = output.find("{")
    if at >= 0:
        try:
            got = json.JSONDecoder(strict=False).raw_decode(output, at)[0]
            if isinstance(got, dict) and "rewritten_text" in got:
                v = got["rewritten_text"]
                return v if isinstance(v, str) else None
        except ValueError:
            pass
    m = None
    for m in _FIELD.finditer(output):
        pass
    if not m:
        return None
    rest = output[m.end() :]
    if not rest.startswith(('"', "'", '\\"')):
        return None if rest.startswith(("null", "true", "false", "{", "[")) or not rest else rest
    rest = rest[2:] if rest[0] == "\\" else rest[1:]
    end = next((x.start() for x in _NEXT.finditer(rest) if x.start() == 0 or rest[x.start() - 1] != "\\"), len(rest))

    def plain(x: re.Match) -> str:
        e = x.group(1)
        return chr(int(e[1:], 16)) if len(e) == 5 else _LETTERS.get(e, e)

    return _ESCAPE.sub(plain, rest[:end])


def suffix_array(ids: np.ndarray) -> tuple[list[int], list[int]]:
    """Suffix array and its longest common prefixes (lcp[i] of suffixes i-1 and i): by sorting the suffixes' bytes where they are short,
    by prefix doubling else."""
    n = len(ids)
    if n <= SHORT and int(ids.max()) < 1 << 16:
        data = ids.astype(">u2").tobytes()  # compares as the numbers do
        order = sorted(range(n), key=lambda i: data[2 * i :])
    else:
        order = _doubling(ids)
    rank = [0] * n
    for r, i in enumerate(order):
        rank[i] = r
    lcp, h, seq = [0] * n, 0, [*ids.tolist(), -1]
    for i, r in enumerate(rank):
        if r == 0:
            h = 0
            continue
        j = order[r - 1]
        a, b = (i + h, j + h) if i > j else (j + h, i + h)  # only the later suffix can end
        while a < n and seq[a] == seq[b]:
            a, b = a + 1, b + 1
        lcp[r] = h = a - max(i, j)
        if h:
            h -= 1
    return order, lcp


def _doubling(ids: np.ndarray) -> list[int]:
    n, step = len(ids), 1
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    while True:
        second = np.full(n, -1, np.int64)
        second[: n - step] = rank[step:] if step < n else second[:0]
        key = rank * (n + 1) + second + 1
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank, step = new, step * 2
        if rank.max() == n - 1 or step >= n:
            return order.tolist()


def earlier_lengths(sa: list[int], lcp: list[int]) -> tuple[list[int], list[int]]:
    """For each position the longest passage that begins earlier too, and where. Positions leave the suffix array from the last to the
    first, so that the neighbours of the one leaving are the nearest suffixes of smaller position; their lcp intervals then merge."""
    n = len(sa)
    rank = [0] * n
    for r, i in enumerate(sa):
        rank[i] = r
    before, after, common = list(range(-1, n)), list(range(1, n + 2)), [*lcp, 0, 0]
    best, source = [0] * n, [-1] * n
    for p in range(n - 1, -1, -1):
        r = rank[p]
        a, z = before[r], after[r]
        left, right = common[r], common[z]
        if left >= right:
            if left:
                best[p], source[p] = left, sa[a]
            common[z] = right
        else:
            best[p], source[p] = right, sa[z]
            common[z] = left
        before[z] = a
        if a >= 0:
            after[a] = z
    return best, source


def recurs(lcp: list[int], r: int, h: int, times: int) -> bool:
    """Whether the first h words of the suffix at place r of the suffix array occur so many times; looks at no more than these."""
    n, a, z = 1, r, r + 1
    while n < times and a > 0 and lcp[a] >= h:
        n, a = n + 1, a - 1
    while n < times and z < len(lcp) and lcp[z] >= h:
        n, z = n + 1, z + 1
    return n >= times


def repeated(words: list[str], min_run: int = MIN_RUN) -> tuple[int, int]:
    """Words covered by copies of earlier wording, and the length of the longest copy."""
    n = len(words)
    if n < 2:
        return 0, 0
    if len(set(zip(words, words[1:], words[2:]))) == max(0, n - 2) and not any(a == c and (a == b or b == d) for a, b, c, d in zip(words, words[1:], words[2:], [*words[3:], None])):
        return 0, 0  # nothing of three words recurs, and nothing of two right behind itself
    table: dict[str, int] = {}
    ids = np.array([table.setdefault(w, len(table)) for w in words])
    sa, lcp = suffix_array(ids)
    best, source = earlier_lengths(sa, lcp)
    rank = [0] * n
    for r, i in enumerate(sa):
        rank[i] = r
    mark, longest, end = 0, 0, 0
    for i, h in enumerate(best):
        if h < 2:
            continue
        j = source[i]
        # a copy right behind its original (words or short phrases said over and over) counts from two words said at least twice more
        # a phrase with other words between its copies counts if it recurs
        if h >= min_run or (h >= 2 and i - j <= h) or (h >= min(TIMES) and recurs(lcp, rank[i], h, TIMES.get(h, min(TIMES.values())))):
            longest = max(longest, h)
            mark += max(0, i + h - max(i, end))
            end = max(end, i + h)
    return mark, longest


def _measure(min_run: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for key, table, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                if table == "rewrite_output":
                    text = rewritten_text(text)
                words = _WORD.findall(text.lower()) if text else []
                mark, longest = repeated(words, min_run)
                out.append((table, key, len(words), mark, longest, mark / len(words) if words else 0.0))
            if out:
                types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], ["record_table", "row_id", "words", "repeated_words", "longest_repeat", "share"])

    return run


def repetition(rewrites: DataFrame, generated: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """record_table, row_id, words, repeated_words, longest_repeat, share for every delivered row of both tables; no shuffle.

    Both need row_id and output. Null, empty and unreadable outputs have 0 words and share 0; repeated rows come out as often."""
    bounded_batches(rewrites.sparkSession)
    one = lambda df, name: df.select("row_id", F.lit(name).alias("record_table"), "output")
    both = one(rewrites, "rewrite_output").unionByName(one(generated, "generate_output"))
    kind = "record_table string, row_id bigint, words bigint, repeated_words bigint, longest_repeat bigint, share double"
    return spread(both).mapInArrow(_measure(min_run), kind)


def keep(scores: DataFrame, max_share: float = SHARE, max_longest: int = 100) -> DataFrame:
    """Rows within both limits: the covered fraction and the longest single repeat."""
    return scores.where((F.col("share") < max_share) & (F.col("longest_repeat") <= max_longest))
