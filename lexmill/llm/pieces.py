"""The existing tokenizer: greedy longest pieces inside white-space words. White space is the boundary at which texts may be cut
without changing the count, because no piece spans it."""

from __future__ import annotations

from pyspark.sql import DataFrame

MAX_PIECE = 8
MAX_TABLE = 1_000_000
CACHE = 500_000


class Counter(dict):
    """word -> number of tokens, remembered for up to CACHE words."""

    def __init__(self, pieces):
        self.pieces = frozenset(pieces)

    def __missing__(self, word: str) -> int:
        pieces, at, n, size = self.pieces, 0, 0, len(word)
        while at < size:
            step = min(MAX_PIECE, size - at)
            while step > 1 and word[at : at + step] not in pieces:
                step -= 1
            at += step
            n += 1
        if len(self) >= CACHE:
            self.clear()
        if size <= 64:
            self[word] = n
        return n

    def count(self, text: str | None) -> int:
        return sum(map(self.__getitem__, text.split())) if text else 0

    def ends(self, text: str) -> list[int]:
        """Running token counts after each word."""
        total, out = 0, []
        for w in text.split():
            total += self[w]
            out.append(total)
        return out


def load(table: DataFrame) -> list[str]:
    """The pieces, to ship with a function. A tokenizer's table is bounded; more than MAX_TABLE entries are refused."""
    rows = table.select("piece").where("length(piece) > 0").limit(MAX_TABLE + 1).collect()
    if len(rows) > MAX_TABLE:
        raise ValueError(f"more than {MAX_TABLE} pieces")
    return sorted({r.piece for r in rows})
