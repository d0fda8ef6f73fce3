"""Strict JSON on strings: what json.loads refuses is null here (VARIANT alone accepts trailing text)."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.text import JSON_OBJECT, lstrip

# The reference's bound on the pairs of the flat form.
MOST_PAIRS = 99


def strict(s: Column) -> Column:
    """The value as a one-element array VARIANT, or null unless s is exactly one JSON value; of repeated keys the last counts. Read fields
    at $[0]. How VARIANT takes repeated keys is a setting of the session, which is made here so that no result depends on other queries."""
    if (session := SparkSession.getActiveSession()) is not None:
        session.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    v = F.try_parse_json(F.concat(F.lit("["), s, F.lit("]")))
    return F.when(F.size(F.try_variant_get(v, "$", "array<variant>")) == 1, v)


def last_object(s: Column) -> Column:
    """The last balanced object, up to three levels deep, in free text; null if there is none."""
    found = F.regexp_extract_all(s, F.lit(JSON_OBJECT), F.lit(0))
    return F.when(F.size(found) > 0, F.element_at(found, -1))


def field(v: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(v, f"$[0].{path}", kind)


def string_field(v: Column, path: str) -> Column:
    """The field if it is a JSON string; null for other types."""
    raw = F.try_variant_get(v, f"$[0].{path}", "variant")
    return F.when(F.schema_of_variant(raw) == "STRING", F.try_variant_get(v, f"$[0].{path}", "string"))


def after_final_marker(s: Column, marker: str = "assistantfinal") -> Column:
    """Text after the first marker, left-stripped; the whole text if there is none."""
    at = F.instr(s, marker)
    return F.when(at > 0, lstrip(F.substr(s, at + len(marker)))).otherwise(s)


def score(s: Column) -> Column:
    """int(score) of a strict object; decimals in strings and other values are null."""
    return field(strict(s), "score", "int")


def proposals(s: Column) -> Column:
    """array<struct<genre, audience>> of a first-stage output: strict JSON, else the last object in the text. The nested form needs a
    true has_medical_content; the flat form counts genre_1/audience_1 upwards to the first gap. Null if nothing can be read."""
    v = F.coalesce(strict(s), strict(last_object(s)))
    pair = "array<struct<genre string, audience string>>"
    nested = F.when(field(v, "has_medical_content", "boolean"), F.filter(field(v, "proposals", pair), lambda p: p.genre.isNotNull() & p.audience.isNotNull()))
    pair_of = lambda m, i: F.struct(F.element_at(m, F.concat(F.lit("genre_"), i)).alias("genre"), F.element_at(m, F.concat(F.lit("audience_"), i)).alias("audience"))
    fields = F.array(F.try_variant_get(v, "$[0]", "map<string,string>"))  # bound once by the outer lambda
    flat = F.flatten(F.transform(fields, lambda m: F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.lit(MOST_PAIRS), F.size(m)))), lambda i: pair_of(m, i.cast("string")))))
    whole = F.transform(flat, lambda p: p.genre.isNotNull() & p.audience.isNotNull())
    gap = F.coalesce(F.nullif(F.array_position(whole, False), F.lit(0)) - 1, F.size(flat).cast("long"))
    counted = F.slice(flat, F.lit(1), gap.cast("int"))
    got = F.when(F.size(nested) > 0, nested).when(F.size(counted) > 0, counted)
    return got
