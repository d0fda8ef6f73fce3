"""Token-bounded recursive splitting of documents, and windows of words."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from itertools import chain
from typing import NamedTuple, Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.text import word_count, words

# Separators from coarse to fine.
SEPARATORS = (r"\n{2,}", r"\n", r"(?<=[.!?;])\s+", r"\s+")


class Tokenizer(Protocol):
    """Optional methods: count(text) where that is cheaper than encoding; joined(a, b, touching) where the tokens of two neighbouring
    texts follow from theirs, touching meaning that no white space stands between them."""

    def encode(self, text: str) -> list: ...
    def decode(self, ids: Sequence) -> str: ...


class CharTokenizer:
    """A token per character; decode restores the text."""

    def encode(self, text: str) -> list[str]:
        return list(text)

    def count(self, text: str) -> int:
        return len(text)

    def joined(self, a: int, b: int, touching: bool) -> int:
        return a + b

    def decode(self, ids: Sequence[str]) -> str:
        return "".join(ids)


class WordTokenizer:
    """White-space words; decode joins them by single spaces."""

    def encode(self, text: str) -> list[str]:
        return text.split()

    def count(self, text: str) -> int:
        return len(text.split())

    def joined(self, a: int, b: int, touching: bool) -> int:
        return a + b - touching

    def decode(self, ids: Sequence[str]) -> str:
        return " ".join(ids)


def keep_separator(text: str, pattern: str) -> list[str]:
    """Parts of a text, each with the separator that follows it."""
    cuts = [0, *(m.end() for m in re.finditer(pattern, text)), len(text)]
    return [text[a:z] for a, z in zip(cuts, cuts[1:], strict=False) if z > a]


class Part(NamedTuple):
    """A stretch of text with its words and tokens, counted once; those of neighbours follow from theirs."""

    text: str
    words: int
    tokens: int


class Sizes:
    """Counts parts against a limit on tokens, which words may not exceed either."""

    def __init__(self, tokenizer: Tokenizer, limit: int):
        self.tokenizer, self.limit = tokenizer, limit
        self.count = getattr(tokenizer, "count", None) or (lambda t: len(tokenizer.encode(t)))
        self.sum = getattr(tokenizer, "joined", None)

    def part(self, text: str) -> Part:
        words = len(text.split())
        return Part(text, words, self.count(text) if words <= self.limit else words)  # beyond the limit anyway

    def fits(self, p: Part) -> bool:
        return p.words <= self.limit and p.tokens <= self.limit

    def both(self, a: Part, b: Part) -> Part | None:
        """The two as one part if that fits."""
        touching = bool(a.text and b.text) and not a.text[-1].isspace() and not b.text[0].isspace()
        words = a.words + b.words - touching
        if words > self.limit:
            return None
        text = a.text + b.text
        p = Part(text, words, self.sum(a.tokens, b.tokens, touching) if self.sum else self.count(text))
        return p if self.fits(p) else None

    def packed(self, parts: Iterable[Part]) -> list[Part]:
        """Neighbours joined from the left as long as they fit."""
        out: list[Part] = []
        for p in parts:
            if out and (more := self.both(out[-1], p)):
                out[-1] = more
            else:
                out.append(p)
        return out

    def cut(self, p: Part, separators: Sequence[str]) -> list[Part]:
        """A part that does not fit as parts that do: at the first separator, what is still too large at the next ones, what none of
        them divides by tokens."""
        if self.fits(p):
            return [p]
        if not separators:
            ids = self.tokenizer.encode(p.text)
            return [self.part(self.tokenizer.decode(ids[i : i + self.limit])) for i in range(0, len(ids), self.limit)]
        smaller = (self.cut(self.part(t), separators[1:]) for t in keep_separator(p.text, separators[0]))
        return self.packed(chain.from_iterable(smaller))


def recursive_split(text: str, limit: int, tokenizer: Tokenizer, separators: Sequence[str] = SEPARATORS) -> list[str]:
    """Chunks of at most limit tokens, cut as coarsely as possible and packed at every level. Texts within the limit, and empty ones, come
    back whole."""
    sizes = Sizes(tokenizer, limit)
    return [p.text for p in sizes.cut(sizes.part(text), separators)]


def split_udf(limit: int, make: Callable[[], Tokenizer] = WordTokenizer) -> Callable[[Column], Column]:
    @F.pandas_udf("array<string>")
    def run(texts: pd.Series) -> pd.Series:
        tokenizer = make()
        return pd.Series([None if t is None else recursive_split(t, limit, tokenizer) for t in texts])

    return run


def split_documents(df: DataFrame, limit: int, make: Callable[[], Tokenizer] = WordTokenizer, text: str = "text") -> DataFrame:
    """One row per chunk with its number as chunk and num_words counted anew; other columns are repeated. A null text stays one row."""
    rest = [c for c in df.columns if c not in (text, "num_words", "chunk")]
    cut = df.withColumn("_c", split_udf(limit, make)(F.col(text))).select(*rest, F.posexplode_outer("_c").alias("chunk", text))
    return cut.withColumn("num_words", word_count(F.col(text)))


def blocks(text: Column, size: int = 1_000_000) -> Column:
    """A text in blocks of at most size characters; an empty text is one."""
    starts = F.sequence(F.lit(0), F.greatest(F.ceil(F.length(text) / size).cast("int") - 1, F.lit(0)))
    return F.when(text.isNotNull(), F.transform(starts, lambda i: F.substr(text, i * size + 1, F.lit(size))))


def word_windows(text: Column, n: int) -> Column:
    """Non-overlapping windows of n words, joined by single spaces."""
    cut = lambda w: F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size(w) / n).cast("int") - 1, F.lit(0))), lambda i: F.array_join(F.slice(w, i * n + 1, n), " "))
    return F.element_at(F.transform(F.array(words(text)), cut), 1)  # binds the words, which an inner lambda would split again each time


def middle_words(text: Column, n: int) -> Column:
    """The n words in the middle; the whole text's words if there are no more."""
    cut = lambda w: F.array_join(F.slice(w, F.greatest(F.floor((F.size(w) - n) / 2).cast("int"), F.lit(0)) + 1, F.lit(n)), " ")
    return F.element_at(F.transform(F.array(words(text)), cut), 1)
