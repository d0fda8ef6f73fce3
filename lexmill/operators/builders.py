"""Text builders for evaluation tasks, augmentation, judge summaries and file assignment."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.text import squeeze
from lexmill.operators.model_output import french_spacing
from lexmill.operators.projection import ENTITY_LABELS
from lexmill.operators.stats import with_medians
from lexmill.session import cut_lineage


def pair(a: str, b: str) -> Column:
    return F.concat_ws(" ", squeeze(F.col(a)), squeeze(F.col(b)))


def question(stem: str, choices: Sequence[str]) -> Column:
    """A question and its numbered choices."""
    return F.concat_ws(" ", squeeze(F.col(stem)), *[F.concat(F.lit(f"({i}) "), squeeze(F.col(c))) for i, c in enumerate(choices, 1)])


def token_list(tokens: str, repair: bool = False) -> Column:
    """Tokens joined by spaces; with repair, spaces before full stops and around apostrophes are taken out."""
    text = F.array_join(tokens, " ")
    return french_spacing(text) if repair else text


def lowered(text: str) -> Column:
    return F.lower(squeeze(F.col(text)))


def segments(left: str, right: str) -> Column:
    """Two segments three spaces apart."""
    return F.concat(F.col(left), F.lit("   "), F.col(right))


def choices(stem: str, answers: Sequence[str], numbered: bool = False) -> Column:
    """A question and its answers, each two spaces after what precedes it, with a space at either end."""
    marked = [F.concat(F.lit(f"({i}) "), F.col(c)) if numbered else F.col(c) for i, c in enumerate(answers, 1)]
    return F.concat(F.lit(" "), F.col(stem), *[x for m in marked for x in (F.lit("  "), m)], F.lit(" "))


# Evaluation sets by a part of their path, the form of their text and the columns it is made of.
EVALUATION_TEXTS = (
    ("deft2020/data/local_hf_task_1", "segments", ("source", "cible")),
    ("deft2020/data/local_hf_task_2", "numbered", ("source", "cible_1", "cible_2", "cible_3")),
    ("frenchmedmcqa/data/local_hf_None", "choices", ("question", "answer_a", "answer_b", "answer_c", "answer_d", "answer_e")),
    ("clister/data/local_hf_None", "segments", ("text_1", "text_2")),
    ("pxcorpus/data/local_hf_None", "tokens", ("tokens",)),
    ("cas/data/local_hf_pos", "tokens", ("tokens",)),
    ("essai/data/local_hf_pos", "tokens", ("tokens",)),
    ("deft2021/data/local_hf_ner", "repaired", ("tokens",)),
    ("deft2021/data/local_hf_cls", "text", ("text",)),
    ("diamed/data/local_hf_None", "lower", ("clinical_case",)),
    ("mantragsc/data/local_hf_fr_medline", "repaired", ("tokens",)),
    ("mantragsc/data/local_hf_fr_patents", "repaired", ("tokens",)),
    ("mantragsc/data/local_hf_fr_emea", "repaired", ("tokens",)),
    ("morfitt/data/local_hf_source", "text", ("abstract",)),
    ("e3c/data/local_hf_French_clinical", "repaired", ("tokens",)),
    ("e3c/data/local_hf_French_temporal", "repaired", ("tokens",)),
    ("quaero/data/local_hf_medline", "repaired", ("tokens",)),
    ("quaero/data/local_hf_emea", "repaired", ("tokens",)),
)
FORMS: dict[str, Callable[..., Column]] = {
    "segments": segments,
    "numbered": lambda stem, *answers: choices(stem, answers, numbered=True),
    "choices": lambda stem, *answers: choices(stem, answers),
    "tokens": lambda c: token_list(c),
    "repaired": lambda c: token_list(c, repair=True),
    "text": lambda c: F.col(c),
    "lower": lambda c: F.lower(c),
}


def evaluation_text(path: str) -> Column:
    """The text of an evaluation set's rows, by the first entry whose key is part of the path; null where a column is. Unknown paths are
    an error."""
    return build(path, [(key, lambda form=form, columns=columns: FORMS[form](*columns)) for key, form, columns in EVALUATION_TEXTS])


def build(path: str, registry: Sequence[tuple[str, Callable[[], Column]]]) -> Column:
    """The first builder whose key is part of the path; none is an error."""
    for key, make in registry:
        if key in path:
            return make()
    raise ValueError(f"no text builder for {path}")


def assign_in_order(df: DataFrame, file: str, parts: Sequence[str]) -> DataFrame:
    """file, part: the sorted distinct files cut into as many equal runs as there are parts. Files are few against rows."""
    n = F.ntile(len(parts)).over(Window.orderBy(file))
    return df.select(file).distinct().select(file, F.array(*[F.lit(p) for p in parts])[n - 1].alias("part"))


def extracted_density(entities: Column, text: Column) -> Column:
    """Characters of all extracted strings over those of the text; empty text is 0."""
    chars = F.aggregate(F.flatten(F.array(*[F.coalesce(entities[k], F.array().cast("array<string>")) for k in ENTITY_LABELS])), F.lit(0).cast("long"), lambda a, e: a + F.coalesce(F.length(e), F.lit(0)).cast("long"))
    return F.coalesce(F.try_divide(chars.cast("double"), F.nullif(F.length(text), F.lit(0))), F.lit(0.0))


def augment_order(df: DataFrame, labels: str, key: str, seed: int = 42) -> DataFrame:
    """The rows and, for those with more than one label, a second copy with the labels in another hashed order."""
    ranked = F.array_sort(F.transform(labels, lambda x: F.struct(F.xxhash64(F.col(key), x, F.lit(seed)).alias("h"), x.alias("x"))))
    return df.unionByName(df.where(F.size(labels) > 1).withColumn(labels, F.transform(ranked, lambda r: r.x)))


def judge_summary(df: DataFrame, group: str, scores: Sequence[str]) -> DataFrame:
    """Mean of each judge score in 1..5 per group, others ignored, and how many were valid."""
    valid = lambda c: F.when(F.col(c).between(1, 5), F.col(c))
    return df.groupBy(group).agg(*[f for c in scores for f in (F.avg(valid(c)).alias(f"mean_{c}"), F.count(valid(c)).alias(f"n_{c}"))])


def paired_medians(df: DataFrame, cls: str, before: str, after: str) -> DataFrame:
    """Exact medians and counts of two columns per class; a row goes only if both are null."""
    x = cut_lineage(df.where(F.col(cls).isNotNull() & F.coalesce(F.col(before), F.col(after)).isNotNull()).select(cls, before, after))
    g = x.groupBy(cls).agg(F.count(before).alias("n_before"), F.count(after).alias("n_after"))
    return with_medians(g, x, [cls], {before: "median_before", after: "median_after"})


def labels_missing(train: DataFrame, validation: DataFrame, label: str) -> DataFrame:
    """Labels of the validation rows that no training row has."""
    return validation.select(label).where(F.col(label).isNotNull()).distinct().join(train.select(label).distinct(), label, "left_anti")


def model_config(model: str, temperature: float, top_p: float, max_tokens: int, **more: str) -> Column:
    """The settings of a generation as a struct column."""
    known = {"model": F.lit(model), "temperature": F.lit(float(temperature)), "top_p": F.lit(float(top_p)), "max_tokens": F.lit(max_tokens)}
    return F.struct(*[c.alias(k) for k, c in (known | {k: F.lit(v) for k, v in more.items()}).items()])


def valid_utf8(text: Column) -> Column:
    return F.make_valid_utf8(text)
