"""Prompt templates, style draws and output schemas."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.operators.sampling import draw


# The dimensions of a rewriting style by version, with the weights of their values.
STYLES = {
    "v3": {
        "register": {"formal": 0.5, "telegraphic": 0.5},
        "abbreviation": {"expanded": 0.3, "moderate": 0.4, "heavy": 0.3},
        "structure": {"prose": 0.6, "bullets": 0.1, "key_value": 0.1, "hybrid": 0.2},
        "verbosity": {"compressed": 0.2, "standard": 0.6, "expanded": 0.2},
        "noise": {"clean": 0.7, "realistic": 0.3},
    },
    "v3_1": {
        "register": {"formal": 0.5, "telegraphic": 0.5},
        "abbreviation": {"expanded": 0.3, "moderate": 0.4, "heavy": 0.3},
        "view": {"entity_centric": 0.28, "temporal": 0.22, "causal": 0.18, "decision": 0.18, "natural": 0.14},
    },
    "v3_2": {
        "register": {"formal": 0.5, "telegraphic": 0.5},
        "abbreviation": {"expanded": 1 / 3, "moderate": 1 / 3, "heavy": 1 / 3},
        "verbosity": {"compressed": 0.20, "standard": 0.45, "expanded": 0.35},
        "view": {"entity_centric": 0.28, "temporal": 0.22, "causal": 0.18, "decision": 0.18, "natural": 0.14},
    },
    "v4_1": {
        "register": {"formal": 0.5, "telegraphic": 0.5},
        "abbreviation": {"expanded": 1 / 3, "moderate": 1 / 3, "heavy": 1 / 3},
    },
}
# Genres and audiences of the closed lists.
GENRES = (
    "clinical_note", "discharge_summary", "case_report", "consultation_letter", "diagnostic_report", "prescription", "drug_information_sheet", "patient_leaflet",
    "research_abstract", "clinical_guideline", "patient_education", "medical_qa", "natural",
)
AUDIENCES = ("medical_specialist", "general_practitioner", "nurse_or_allied_health", "medical_student", "researcher", "patient_or_layperson", "public_health_official")
# What a generation's style is drawn from.
GENERATION_STYLES = {
    "clinical_case": {"report": 0.2, "note": 0.8},
    "icd": {"wiki": 0.2, "textbook": 0.8},
    "vocabulary": {"wiki": 0.2, "textbook": 0.8},
    "ehr": None,
    "dialogue": None,
}


def style_of(version: str, stage: int | None) -> dict[str, dict[str, float]] | None:
    """The style dimensions drawn for a call: in one-stage versions their own (v3 unless v3_1 or v3_2), in the second stage of v4_1 and
    v4_2 those of v4_1, else none."""
    if stage is None:
        return STYLES[version if version in ("v3_1", "v3_2") else "v3"]
    return STYLES["v4_1"] if stage == 2 and version in ("v4_1", "v4_2") else None


def rewriting_schema(version: str, stage: int | None, pairs: int = 3) -> dict | None:
    """The schema of a call's answer; null where it is plain text. Proposals are nested and at most `pairs`, but flat and five in
    mga_official; v4_1 takes genre and audience from the closed lists."""
    if stage is None and version in ("v3", "v3_1", "v3_2"):
        fields = {"is_rewritable": "boolean", "rewritten_text": "string"}
        return json_schema(fields | ({"format": "string", "title": "string"} if version == "v3" else {}))
    if stage == 1 and version == "mga_official":
        return json_schema({f"{k}_{i}": "string" for i in range(1, 6) for k in ("audience", "genre")})
    if stage == 1 and version in ("v4", "v4_1", "v4_2"):
        out = json_schema({"genre": "string", "audience": "string"}, "proposals", pairs)
        if version == "v4_1":
            for k, v in (("genre", GENRES), ("audience", AUDIENCES)):
                out["properties"]["proposals"]["items"]["properties"][k]["enum"] = list(v)
        out["properties"] = {"has_medical_content": {"type": "boolean"}} | out["properties"]
        out["required"] = list(out["properties"])
        return out
    return None


def plan_rewriting(df: DataFrame, key: str, text: str, system: str, user: str, version: str, stage: int | None = None, pairs: int = 3, language: str = "fr", seed: int = 42) -> DataFrame:
    """df with rewriting_style (a struct of draws, where the version has any), system_prompt and user_prompt. The user's template has the
    place {text}; the system's has {n_stage1_pairs} in stage 1, {genre} and {audience} (columns of df) in stage 2, and the names of the
    style dimensions, {language} always. Null text is empty text. Columns of these names are replaced."""
    dims = style_of(version, stage)
    if dims:
        df = df.withColumn("rewriting_style", draw_styles(F.col(key), dims, seed))
    fields = {"language": F.lit(language)} | {d: F.col(f"rewriting_style.{d}") for d in dims or {}}
    if stage == 1:
        fields["n_stage1_pairs"] = F.lit(pairs)
    if stage == 2:
        fields |= {"genre": F.col("genre"), "audience": F.col("audience")}
    return df.withColumns({"system_prompt": render(system, fields), "user_prompt": render(user, {"text": F.col(text)})})


def generation_fields(df: DataFrame, kind: str, text: str = "text") -> dict[str, Column]:
    """The places of a generation's template: the text for cases, records and dialogues; code, definition and label for a classification
    (the French label of labels, else label_fr); term, definition, synonyms and category for a vocabulary. Absent columns are empty."""
    have = lambda c: F.col(c) if c in df.columns else F.lit("")
    if kind in ("clinical_case", "ehr", "dialogue"):
        return {"text": F.col(text)}
    if kind == "icd":
        nested = "labels" in df.columns and "fr" in df.schema["labels"].dataType.fieldNames()
        return {"definition_fr": have("definition_fr"), "label_fr": F.coalesce("labels.fr", have("label_fr")) if nested else have("label_fr"), "skos_notation": have("skos_notation")}
    if kind == "vocabulary":
        synonyms = F.array_join("synonyms", ", ") if "synonyms" in df.columns and df.schema["synonyms"].dataType.typeName() == "array" else have("synonyms")
        return {"term": have("term"), "definition": have("definition"), "synonyms": synonyms, "grammatical_category": have("grammatical_category")}
    raise ValueError(f"unknown generation: {kind}")


def plan_generation(df: DataFrame, key: str, kind: str, system: str, user: str, suffixes: dict[str, str] | None = None, text: str = "text", seed: int = 42) -> DataFrame:
    """df with gen_style (drawn; null for records and dialogues), system_prompt with the style's suffix, and user_prompt; dialogues keep
    the text as clinical_note."""
    fields, weights = generation_fields(df, kind, text), GENERATION_STYLES[kind]
    df = df.withColumn("gen_style", draw(F.col(key), weights, kind, seed) if weights else F.lit(None).cast("string"))
    tail = F.create_map(*[F.lit(x) for kv in (suffixes or {"": ""}).items() for x in kv])[F.col("gen_style")]
    df = df.withColumns({"system_prompt": F.concat(F.lit(system), F.coalesce(tail, F.lit(""))), "user_prompt": render(user, fields)})
    return df.withColumn("clinical_note", F.col(text)) if kind == "dialogue" else df


def render(template: str, fields: dict[str, Column]) -> Column:
    """str.format with named places; {{ and }} are braces; a null field is empty. An unknown place is an error."""
    parts, i, held = [], 0, ""
    while i < len(template):
        if template[i : i + 2] in ("{{", "}}"):
            held += template[i]
            i += 2
        elif template[i] == "{":
            end = template.index("}", i)
            parts += [F.lit(held), F.coalesce(fields[template[i + 1 : end]].cast("string"), F.lit(""))]
            held, i = "", end + 1
        else:
            held += template[i]
            i += 1
    return F.concat(*parts, F.lit(held))


def load_template(path: str) -> tuple[str, dict[str, str]]:
    """A template and its siblings <stem>_style_<name><suffix> by name."""
    p = Path(path)
    styles = {s.stem.rpartition("_style_")[2]: s.read_text(encoding="utf-8") for s in sorted(p.parent.glob(f"{p.stem}_style_*{p.suffix}"))}
    return p.read_text(encoding="utf-8"), styles


def draw_styles(key: Column, dimensions: dict[str, dict[str, float]], seed: int = 42) -> Column:
    """A struct with one weighted draw per dimension, the same for the same key."""
    return F.struct(*[draw(key, w, d, seed).alias(d) for d, w in dimensions.items()])


def shuffled_block(items: Column, key: Column, seed: int = 42) -> Column:
    """The items of a prompt block in an order fixed by the row's key."""
    ranked = F.array_sort(F.transform(items, lambda x, i: F.struct(F.xxhash64(key, i, F.lit(seed)).alias("h"), x.alias("x"))))
    return F.array_join(F.transform(ranked, lambda r: r.x), "\n")


def json_schema(fields: dict[str, str], list_field: str | None = None, max_items: int | None = None) -> dict:
    """A JSON schema for guided decoding: an object of typed fields, or a list of such objects under list_field."""
    item = {"type": "object", "properties": {k: {"type": t} for k, t in fields.items()}, "required": list(fields)}
    if list_field is None:
        return item
    items = {"type": "array", "items": item} | ({"maxItems": max_items} if max_items else {})
    return {"type": "object", "properties": {list_field: items}, "required": [list_field]}
