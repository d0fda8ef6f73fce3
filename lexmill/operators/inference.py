"""Model surfaces: batch scorers, extractors and generators are plug-ins; what follows them is expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions.text import word_count, words
from lexmill.operators.stats import argmax, half_even_score, softmax

Scorer = Callable[[list[str]], list[list[float]]]
Extractor = Callable[[str], dict[str, list[str]]]


def classify(df: DataFrame, task: str, labels: Sequence[str], load: Callable[[], Scorer], text: str = "text", longest_first: bool = True) -> DataFrame:
    """Adds <task>_scores (softmax), _best_class and _best_score, and num_words. The scorer is loaded once per worker; existing columns of
    these names are kept as original_*. Rows are ordered by length inside partitions to even out batches."""

    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = load()
        for texts in batches:
            yield pd.Series(scorer([t or "" for t in texts]))

    made = [f"{task}_scores", f"{task}_best_class", f"{task}_best_score"]
    df = df.withColumnsRenamed({c: f"original_{c}" for c in made if c in df.columns})
    df = df.withColumn("num_words", word_count(F.col(text)))
    if longest_first:
        df = df.sortWithinPartitions(F.desc("num_words"))
    scored = df.withColumn("_raw", run(F.coalesce(F.col(text), F.lit("")))).withColumn(made[0], softmax(F.col("_raw"))).drop("_raw")
    best = argmax(F.col(made[0]))
    return scored.withColumns({made[1]: F.array(*[F.lit(x) for x in labels])[best], made[2]: F.array_max(made[0])})


def regress(df: DataFrame, task: str, load: Callable[[], Scorer], text: str = "text") -> DataFrame:
    """Adds <task>_score and <task>_normalized_score (0..5, half to even)."""

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = load()
        for texts in batches:
            yield pd.Series([s[0] for s in scorer([t or "" for t in texts])])

    return df.withColumn(f"{task}_score", run(F.coalesce(F.col(text), F.lit("")))).withColumn(f"{task}_normalized_score", half_even_score(F.col(f"{task}_score")))


def extract_entities(df: DataFrame, load: Callable[[], Extractor], text: str = "text", window: int = 256, block: int = 1_000_000) -> DataFrame:
    """Adds entities, map<label, array<string>>: the extractor sees windows of `window` words of each block of characters, and their finds
    are merged per label."""

    @F.pandas_udf("map<string, array<string>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        extractor = load()
        for texts in batches:
            out = []
            for t in texts:
                merged = {}
                for b in range(0, len(t or ""), block):
                    w = t[b : b + block].split()
                    for i in range(0, len(w), window):
                        for k, v in extractor(" ".join(w[i : i + window])).items():
                            merged.setdefault(k, set()).update(x for x in v if x)
                out.append({k: sorted(v) for k, v in merged.items() if v})
            yield pd.Series(out)

    return df.withColumn("entities", run(F.col(text)))


def dictionary_extractor(table: dict[str, list[str]]) -> Callable[[], Extractor]:
    """A plug-in that finds listed terms literally."""

    def load() -> Extractor:
        return lambda text: {k: [x for x in v if x in text] for k, v in table.items()}

    return load


def generate(df: DataFrame, prompt: str, load: Callable[[], Callable[[list[str]], list[str | None]]]) -> DataFrame:
    """Adds output from a plug-in generator over the prompt column, in Arrow batches."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for p in batches:
            yield pd.Series(model(list(p)))

    return df.withColumn("output", run(F.col(prompt)))


def head_tokens(text: str, limit: int):
    """The first `limit` words, for prompts that must leave half of the context to the answer."""
    return F.array_join(F.slice(words(F.col(text)), 1, limit), " ")
