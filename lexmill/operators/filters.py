"""Predicates. Each returns a Column that is never null, so that it can be negated and reaches the Parquet scan."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The subdomain selection.
CLINICAL_CLASSES = (
    "Biomedical & mechanistic science",
    "Clinical cases & vignettes",
    "Clinical guidelines & pathways",
    "Drugs, trials & regulation",
    "Medical devices, diagnostics & imaging",
)
EDU, DENSITY, CLASS = "edu_quality_normalized_score", "medical_entity_density", "health_domain_classification_best_class"


def _or_null(c: Column, default: bool) -> Column:
    return F.coalesce(c, F.lit(default))


def hygiene(min_words: int = 10) -> Column:
    """At least min_words words and not class Others; nulls pass."""
    return _or_null(F.col("num_words") >= min_words, True) & _or_null(F.col(CLASS) != "Others", True)


def knobs() -> dict[str, Column]:
    """Named quality predicates; add one entry to extend. Null scores pass, a null class fails."""
    return {
        "edu2": _or_null(F.col(EDU) >= 2, True),
        "edu4": _or_null(F.col(EDU) >= 4, True),
        "med01": _or_null(F.col(DENSITY).cast("double") >= 0.1, True),
        "med02": _or_null(F.col(DENSITY).cast("double") >= 0.2, True),
        "subtopic_biocli5": _or_null(F.col(CLASS).isin(*CLINICAL_CLASSES), False),
    }


def by_mode(mode: str) -> Column:
    """AND of the knobs named in mode, OR if it says union; without knobs a plain mode keeps all, a union nothing."""
    active = [c for name, c in knobs().items() if name in mode]
    if "union" in mode:
        return reduce(or_, active, F.lit(False))
    return reduce(and_, active, F.lit(True))


def by_sides(mode: str, source: str = "name") -> Column:
    """The left side of _plus_rewritten for raw sources, the right one for those whose name contains 'rewritten'; hygiene for both."""
    left, _, right = mode.partition("_plus_rewritten")
    rewritten = _or_null(F.contains(source, F.lit("rewritten")), False)
    return hygiene() & F.when(rewritten, by_mode(right)).otherwise(by_mode(left))


def thresholds(edu: float | None = 4, density: float | None = 0.1, classes: Sequence[str] | None = CLINICAL_CLASSES, min_words: int | None = 10) -> Column:
    """Optional thresholds; every null passes."""
    tests = [
        _or_null(F.col("num_words") >= min_words, True) if min_words is not None else None,
        _or_null(F.col(EDU) >= edu, True) if edu is not None else None,
        _or_null(F.col(DENSITY).cast("double") >= density, True) if density is not None else None,
        _or_null(F.col(CLASS).isin(*classes), True) if classes is not None else None,
    ]
    return reduce(and_, [t for t in tests if t is not None], F.lit(True))


def equals(column: str, value) -> Column:
    """Rows with this value; a null value selects the null rows."""
    return F.col(column).eqNullSafe(F.lit(value))


def one_of(column: str, values: Sequence) -> Column:
    """Rows whose value is in the list; nulls are not."""
    return _or_null(F.col(column).isin(*values), False) if values else F.lit(False)


def valid_annotation(topic: str, score: str, topics: Sequence[str], low: int = 0, high: int = 5) -> Column:
    """A topic of the list and a score within its bounds."""
    return one_of(topic, topics) & _or_null(F.col(score).between(low, high), False)


def non_empty(column: str) -> Column:
    """A string of at least one character, white space included."""
    return _or_null(F.length(column) > 0, False)


def rewritable(flag: str, text: str) -> Column:
    """Marked as rewritable and with a text that is not empty."""
    return _or_null(F.col(flag), False) & non_empty(text)


def dense_and_educational(density: float = 0.1, edu: float = 4) -> Column:
    """Both scores at or over their thresholds; nulls fail. The density is compared as double, never rounded first."""
    return _or_null((F.col(DENSITY).cast("double") >= density) & (F.col(EDU) >= edu), False)


def cheap_prefilter(stage: int | None = None, density: float = 0.01, edu: float = 1) -> Column:
    """What is worth a model call; second-stage rows come from rows that passed already, so all are kept."""
    return F.lit(True) if stage == 2 else dense_and_educational(density, edu)


def quality_gate(text: Column, script_share: float = 0.01, other_share: float = 0.02) -> Column:
    """False for null text, for more than script_share East Asian or Cyrillic characters, or more than other_share characters that are
    not Latin, Greek, digits, ASCII punctuation or plain white space."""
    t = F.replace(text, F.lit("\r\n"), F.lit("\n"))
    n = F.greatest(F.length(t), F.lit(1))
    script = F.regexp_count(t, F.lit(r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}\p{IsCyrillic}]"))
    other = F.regexp_count(t, F.lit(r"[^\p{IsLatin}\p{IsGreek}\p{Nd}\p{Punct} \t\n\r\xa0 ]"))
    return _or_null((script <= n * script_share) & (other <= n * other_share), False)


def finite(c: str) -> Column:
    return _or_null(~F.isnan(c) & (F.abs(c) != float("inf")), False)


def spans_in_text(spans: str, text: str) -> Column:
    """The distinct, non-empty spans that occur literally in the text, in order."""
    return F.array_distinct(F.filter(F.col(spans), lambda s: (F.length(s) > 0) & F.contains(F.col(text), s)))
