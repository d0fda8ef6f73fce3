"""Parsing of structured model outputs: labels, scores, rewrites, dialogues, proposals, entities."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.functions import json
from lexmill.functions.text import LINE_END, WS, squeeze, strip
from lexmill.operators.projection import ENTITY_LABELS

# The canonical topics.
TOPICS = (
    "Clinical cases & vignettes",
    "Clinical guidelines & pathways",
    "Patient education & lifestyle",
    "Wellness, supplements & CAM",
    "Public health, policy & programs",
    "Commercial & promotional",
    "Drugs, trials & regulation",
    "Biomedical & mechanistic science",
    "Medical devices, diagnostics & imaging",
    "Health IT, telemedicine & operations",
    "Occupational health & safety",
    "Health workforce education & training",
    "Health services & facilities",
    "Other health",
    "Others",
)
# Labels outside the list and the topics they stand for.
OFF_LIST = {
    "clinical trials & regulation": "Drugs, trials & regulation",
    "clinical trials & research": "Drugs, trials & regulation",
    "clinical trials & pathways": "Drugs, trials & regulation",
    "clinical research & trials": "Drugs, trials & regulation",
    "clinical research & studies": "Drugs, trials & regulation",
    "clinical research": "Drugs, trials & regulation",
    "clinical diagnostics & imaging": "Medical devices, diagnostics & imaging",
    "clinical diagnostics & testing": "Medical devices, diagnostics & imaging",
    "telemedicine & operations": "Health IT, telemedicine & operations",
    "telemedicine & remote care": "Health IT, telemedicine & operations",
    "telemedicine & digital health": "Health IT, telemedicine & operations",
    "telemedicine & health it": "Health IT, telemedicine & operations",
    "telemedicine & health services": "Health IT, telemedicine & operations",
    "telemedicine & virtual care": "Health IT, telemedicine & operations",
    "clinical services & facilities": "Health services & facilities",
    "clinical procedures & interventions": "Clinical guidelines & pathways",
    "clinical procedures & techniques": "Clinical guidelines & pathways",
    "clinical definitions & terminology": "Health workforce education & training",
    "clinical anatomy & morphology": "Health workforce education & training",
    "clauses de conscience": "Public health, policy & programs",
    "radioprotection": "Occupational health & safety",
    "addictions comportementales": "Other health",
}


@F.pandas_udf(T.StringType())
def without_accents(s: pd.Series) -> pd.Series:
    """NFKD without combining marks; Spark has no built-in for it."""
    return s.map(lambda t: None if t is None else "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)))


def normal_label(label: Column) -> Column:
    """Stripped, lower case, without accents, single spaces, ' and ' as ' & '. The UDF sees labels only, never texts."""
    return F.replace(squeeze(without_accents(F.lower(strip(label)))), F.lit(" and "), F.lit(" & "))


def canonical_topic(label: Column, extra: dict[str, str] | None = None) -> Column:
    """The canonical topic of a label: one of the list, or one that OFF_LIST or extra names, in any spelling; other labels stay."""
    key = normal_label(label)
    table = {k.lower(): v for k, v in (OFF_LIST | (extra or {})).items()} | {t.lower(): t for t in TOPICS}
    return F.coalesce(F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[key], label)


def rewriting(output: Column) -> Column:
    """is_rewritable, format, text, title of a JSON-wrapped rewrite (strict, else the last object in the text). All null unless the
    text is a string and the title a string or absent."""
    v = F.coalesce(json.strict(output), json.strict(json.last_object(json.after_final_marker(output))))
    text, title = json.string_field(v, "rewritten_text"), json.string_field(v, "title")
    raw = F.try_variant_get(v, "$[0].title", "variant")
    ok = text.isNotNull() & (title.isNotNull() | raw.isNull() | F.is_variant_null(raw))
    return F.struct(F.when(ok, json.field(v, "is_rewritable", "boolean")).alias("is_rewritable"), F.when(ok, json.string_field(v, "format")).alias("format"), F.when(ok, text).alias("text"), F.when(ok, title).alias("title"))


def rewriting_rows(df: DataFrame, output: str = "output") -> DataFrame:
    """df with is_rewritable, rewriting_format, rewriting_title, rewriting_text and text of its rewrites, the style and model of gen_configs
    where it has them, and entity structs as JSON strings. Columns of these names are replaced, a text there was is kept as original_text."""
    r, have = F.col("_r"), df.columns
    made = {"is_rewritable": r["is_rewritable"], "rewriting_format": r["format"], "rewriting_title": F.make_valid_utf8(r["title"]), "rewriting_text": F.make_valid_utf8(r["text"]), "text": F.make_valid_utf8(r["text"])}
    if "gen_configs" in have:
        ok = r["text"].isNotNull()
        made |= {"rewriting_style": F.when(ok, F.col("gen_configs.rewriting_style")), "rewriting_model": F.when(ok, F.col("gen_configs.model"))}
    made |= {c: F.coalesce(F.to_json(c), F.lit("{}")) for c in ("medical_entities", "original_medical_entities", "original_medical_entities_pretrained") if c in have}
    kept = df.withColumn("_r", rewriting(F.col(output)))
    if "text" in have and "original_text" not in have:
        kept = kept.withColumn("original_text", F.col("text"))
    return kept.withColumns(made).drop("_r")


def dialogue_rows(df: DataFrame, text: str = "text") -> DataFrame:
    """df with the dialogue of its text, which is kept as raw_text."""
    return df.withColumn("raw_text", F.col(text)).withColumn(text, dialogue(F.col("raw_text")))


def straight_marks(text: Column) -> Column:
    """Typographic apostrophes and dashes as plain ones, for comparing."""
    return F.translate(text, "’‘‛–—", "'''--")


def dialogue(text: Column) -> Column:
    """The part after the first conversation header with blank lines dropped; the whole text so treated if there is no header."""
    parts = F.split(text, r"(?im)^[ \t]*#{1,6}[ \t]*conversation\b[^\n\r]*$", 2)
    lines = F.split(F.element_at(parts, -1), LINE_END)
    return strip(F.array_join(F.filter(lines, lambda x: F.length(strip(x)) > 0), "\n"))


def explode_proposals(df: DataFrame, output: str) -> DataFrame:
    """One row per (genre, audience) proposal; unreadable outputs give none."""
    return df.withColumn("_p", F.explode(json.proposals(F.col(output)))).select(*df.columns, F.col("_p.genre").alias("genre"), F.col("_p.audience").alias("audience"))


def sample_proposals(df: DataFrame, output: str, key: str, k: int, seed: int = 42) -> DataFrame:
    """min(k, n) proposals per document, with n as sampled_from_n."""
    from lexmill.operators.sampling import choose

    p = json.proposals(F.col(output))
    picked = df.withColumns({"_all": p}).where(F.size("_all") > 0).withColumn("_p", F.explode(choose(F.col("_all"), F.col(key), k, seed)))
    return picked.select(*df.columns, F.col("_p.genre").alias("genre"), F.col("_p.audience").alias("audience"), F.size("_all").alias("sampled_from_n"))


def entity_map(output: Column, text: Column) -> Column:
    """map<label, array<string>> of an entity extraction ([{entity, text}] or {entities: [...]}, text a string or a list of strings):
    known labels, stripped non-empty spans that occur literally in the text, once per label, in order. Empty for unreadable output."""
    item = "array<struct<entity string, text variant>>"
    v = json.strict(output)
    items = F.coalesce(F.try_variant_get(v, "$[0].entities", item), F.try_variant_get(v, "$[0]", item), F.array().cast(item))

    def spans(x: Column) -> Column:
        one = F.when(F.schema_of_variant(x["text"]) == "STRING", F.array(F.try_variant_get(x["text"], "$", "string")))
        many = F.transform(F.try_variant_get(x["text"], "$", "array<variant>"), lambda y: F.when(F.schema_of_variant(y) == "STRING", F.try_variant_get(y, "$", "string")))
        return F.coalesce(one, many, F.array().cast("array<string>"))

    def of(label: str) -> Column:
        found = F.flatten(F.transform(F.filter(items, lambda x: x["entity"] == label), lambda x: F.transform(spans(x), lambda y: strip(y))))
        return F.array_distinct(F.filter(found, lambda s: (F.length(s) > 0) & F.contains(text, s)))

    entries = F.filter(F.array(*[F.struct(F.lit(k).alias("key"), of(k).alias("value")) for k in ENTITY_LABELS]), lambda e: F.size(e["value"]) > 0)
    return F.map_from_entries(entries)


def entity_rows(df: DataFrame, output: str, text: str, key: str) -> DataFrame:
    """key, text, entities of the rows with text, one row per text (of equal texts the one whose key hashes lowest), as training data for
    entity extraction; unreadable outputs have no entities."""
    from lexmill.operators.dedup import exact

    some = df.where(F.length(text) > 0).select(key, text, output)
    return exact(some, text, key).select(key, text, entity_map(F.col(output), F.col(text)).alias("entities"))


def density(entities: Column, text: Column) -> Column:
    """Characters of the text covered by occurrences of the distinct entities of all types; nested ones count twice. Empty text is 0."""
    every = F.array_distinct(F.filter(F.flatten(F.map_values(entities)), lambda e: F.length(e) > 0))
    covered = F.aggregate(every, F.lit(0).cast("long"), lambda a, e: a + (F.length(text) - F.length(F.replace(text, e, F.lit("")))).cast("long"))
    return F.coalesce(F.try_divide(covered.cast("double"), F.nullif(F.length(text), F.lit(0))), F.lit(0.0)).cast("float")


def merge_entities(maps: Column) -> Column:
    """The union of an array of maps per label: falsy dropped, sorted by code point."""
    labels = F.array_sort(F.array_distinct(F.flatten(F.transform(maps, lambda m: F.map_keys(m)))))
    one = lambda k: F.array_sort(F.array_distinct(F.filter(F.flatten(F.transform(maps, lambda m: F.coalesce(m[k], F.array().cast("array<string>")))), lambda e: F.length(e) > 0)))
    return F.map_from_entries(F.filter(F.transform(labels, lambda k: F.struct(k.alias("key"), one(k).alias("value"))), lambda e: F.size(e["value"]) > 0))


_SAME = str.maketrans({"’": "'", "‘": "'", "‛": "'", "–": "-", "—": "-"})
_TOKEN = re.compile(r"\w+|[^\w\s]")


def _places(inside: list[str], wanted: list[str]) -> list[tuple[int, int]]:
    """First and last index of every occurrence of a run of tokens, overlapping ones too."""
    n = len(wanted)
    return [(i, i + n - 1) for i, x in enumerate(inside) if x == wanted[0] and inside[i : i + n] == wanted]


def _align(text: str, entities: list[tuple[str, str]]) -> list[tuple[int, int, str]]:
    """(first token, last token, label) of the entities that have a place left. The uses of an entity under a label are numbered: the
    n-th takes the n-th place among the tokens; where there are fewer, the n-th among the characters; where there is none either, it is
    left out and its number stays free. Labels not in the list and empty entities are left out."""
    found = list(_TOKEN.finditer(text))
    plain = text.translate(_SAME).lower()
    inside = [m.group().translate(_SAME).lower() for m in found]
    uses: Counter[tuple[str, str]] = Counter()
    seen: dict[str, list[tuple[int, int]]] = {}
    out = []
    for label, entity in entities:
        wanted = entity.strip().translate(_SAME).lower()
        parts = _TOKEN.findall(wanted)
        if label not in ENTITY_LABELS or not parts:
            continue
        if wanted not in seen:
            seen[wanted] = _places(inside, parts)
        n = uses[label, wanted]
        if n < len(seen[wanted]):
            span = seen[wanted][n]
        else:
            at = next(islice((m.start() for m in re.finditer(re.escape(wanted), plain)), n, None), None)
            near = [] if at is None else [i for i, m in enumerate(found) if m.start() < at + len(wanted) and m.end() > at]
            if not near:
                continue
            span = near[0], near[-1]
        out.append((*span, label))
        uses[label, wanted] += 1
    return out


_SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("label", T.StringType())])
_ALIGNED = T.StructType([T.StructField("tokenized_text", T.ArrayType(T.StringType())), T.StructField("ner", T.ArrayType(_SPAN))])


@F.pandas_udf(_ALIGNED)
def align_entities(text: pd.Series, entities: pd.Series) -> pd.DataFrame:
    """The tokens of a text (runs of word characters, single marks) and the inclusive token spans of its entities, an
    array<struct<label, entity>>; stateful per document, hence a UDF. Null text has no tokens, null entities give no spans."""
    get = lambda e: [(x["label"], x["entity"]) for x in e if x and x["label"] and x["entity"]] if e is not None else []
    rows = [(_TOKEN.findall(t or ""), [{"start": a, "end": z, "label": k} for a, z, k in _align(t or "", get(e))]) for t, e in zip(text, entities, strict=True)]
    return pd.DataFrame(rows, columns=["tokenized_text", "ner"])


def valid_score(output: Column, low: int = 0, high: int = 5) -> Column:
    s = json.score(output)
    return F.when(s.between(low, high), s)


def french_spacing(text: Column) -> Column:
    """No space before full stops or around apostrophes, single spaces."""
    t = F.regexp_replace(text, rf"[{WS}]+\.", ".")
    return squeeze(F.regexp_replace(t, rf"[{WS}]*'[{WS}]*", "'"))
