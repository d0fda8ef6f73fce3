"""Repetition filters on lines, paragraphs and word n-grams, and a pluggable language filter."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.functions.text import strip

# Published limits of the repetition rules, in the order in which they are tested.
LIMITS = {
    "dup_para_frac": 0.30, "dup_para_char_frac": 0.20, "dup_line_frac": 0.30, "dup_line_char_frac": 0.20,
    "top_2_gram": 0.20, "top_3_gram": 0.18, "top_4_gram": 0.16,
    "dup_5_gram": 0.15, "dup_6_gram": 0.14, "dup_7_gram": 0.13, "dup_8_gram": 0.12, "dup_9_gram": 0.11, "dup_10_gram": 0.10,
}
# Frequent short words of each language.
STOP_WORDS = {
    "fr": "le la les des une du au et est dans pour par sur avec que qui ne pas ce cette",
    "en": "the of and to in is that for with on as was by this are at from",
    "es": "el los las del una y es en por con que para se su al como",
    "de": "der die das und ist den dem ein eine mit von zu nicht auf für bei",
    "it": "il gli della una e è di che per con non dal alla nel si",
    "pt": "o os as do da uma e é em por com que para não ao na no",
}


def duplicate_shares(text: Column, separator: str) -> tuple[Column, Column]:
    """Shares of parts, and of their characters, that repeat an earlier part; parts are stripped and blank ones ignored."""
    parts = F.filter(F.transform(F.split(text, separator), strip), lambda p: F.length(p) > 0)
    chars = lambda a: F.aggregate(a, F.lit(0), lambda n, p: n + F.length(p))
    n, total = F.size(parts), chars(parts)
    once = F.array_distinct(parts)
    share = F.coalesce(F.try_divide((n - F.size(once)).cast("double"), F.nullif(n, F.lit(0))), F.lit(0.0))
    return share, F.coalesce(F.try_divide((total - chars(once)).cast("double"), F.nullif(F.length(text), F.lit(0))), F.lit(0.0))


def _gram_shares(text: str) -> dict[str, float]:
    words, size = text.split(), max(1, len(text))
    out = {}
    for n in (2, 3, 4):
        grams = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
        top = Counter(grams).most_common(1)
        out[f"top_{n}_gram"] = len(top[0][0]) * top[0][1] / size if top and top[0][1] > 1 else 0.0
    for n in range(5, 11):
        seen, dup, i = set(), 0, 0
        while i <= len(words) - n:
            g = tuple(words[i : i + n])
            if g in seen:
                dup += sum(map(len, g))
                i += n
            else:
                seen.add(g)
                i += 1
        out[f"dup_{n}_gram"] = dup / size
    return out


_NAMES = [k for k in LIMITS if "gram" in k]


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def gram_shares(text: pd.Series) -> pd.Series:
    """Character shares of the most frequent 2- to 4-grams and of repeated 5- to 10-grams, consumed from left to right."""
    return text.map(lambda t: [got[k] for got in (_gram_shares(t or ""),) for k in _NAMES])


def repetition_reason(df: DataFrame, text: str = "text") -> DataFrame:
    """The columns of df and drop_reason: the first limit exceeded, or null. Null and blank texts have none."""
    para, para_chars = duplicate_shares(F.col(text), r"\n{2,}")
    line, line_chars = duplicate_shares(F.col(text), r"\n+")
    made = df.withColumns({"_p": para, "_pc": para_chars, "_l": line, "_lc": line_chars, "_g": gram_shares(F.col(text))})
    tests = [("dup_para_frac", F.col("_p")), ("dup_para_char_frac", F.col("_pc")), ("dup_line_frac", F.col("_l")), ("dup_line_char_frac", F.col("_lc"))] + [(k, F.col("_g")[i]) for i, k in enumerate(_NAMES)]
    reason = F.coalesce(*[F.when(c > LIMITS[k], k) for k, c in tests])
    return made.withColumn("drop_reason", reason).drop("_p", "_pc", "_l", "_lc", "_g")


def stop_word_scorer(text: str) -> tuple[str | None, float]:
    """Language whose stop words are the most frequent, with its share of all stop words found."""
    n = Counter(text.lower().split())
    scores = {k: sum(n[w] for w in v.split()) for k, v in STOP_WORDS.items()}
    total = sum(scores.values())
    best = max(sorted(scores), key=scores.__getitem__)
    return (best, scores[best] / total) if total else (None, 0.0)


def identify(df: DataFrame, text: str = "text", scorer: Callable[[str], tuple[str | None, float]] = stop_word_scorer) -> DataFrame:
    """Adds language and language_score by a plug-in scorer; null or blank text has none."""

    @F.pandas_udf("struct<language: string, language_score: double>")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([scorer(t) if t else (None, 0.0) for t in texts], columns=["language", "language_score"])

    return df.withColumn("_lid", run(F.col(text))).select(*df.columns, "_lid.*")


def language_filter(df: DataFrame, languages: tuple[str, ...] = ("fr",), least: float = 0.5) -> DataFrame:
    return df.where(F.col("language").isin(*languages) & (F.col("language_score") >= least))
