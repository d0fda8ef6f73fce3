"""Projections and column operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.functions import json

# The entity labels.
ENTITY_LABELS = ("disease", "drug", "body_part", "medical_procedure", "molecular_marker", "clinical_device", "vital_function", "living_beings")

# What each entity label stands for.
ENTITY_DESCRIPTIONS = {
    "disease": "Pathological condition: disease, syndrome, infection, cancer, injury, symptom, clinical finding, mental disorder",
    "drug": "Chemical substance for therapy: prescription medication, vaccine, therapeutic compound, drug class, contrast agent",
    "body_part": "Anatomical structure: organ, tissue, bone, muscle, blood vessel, nerve, cell, body fluid, anatomical region",
    "medical_procedure": "Clinical action with methodology: surgery, diagnostic test, medical examination, laboratory test, imaging procedure",
    "molecular_marker": "Molecular entity or biochemical substance: gene, protein, enzyme, receptor, genetic variant, biochemical analyte",
    "clinical_device": "Manufactured medical object: surgical tool, implant, prosthetic, diagnostic scanner, monitoring equipment",
    "vital_function": "Physiological parameter name: heart rate, blood pressure, respiratory rate, temperature, oxygen saturation",
    "living_beings": "Non-human organism in biomedical context: bacterium, virus, fungus, parasite, pathogen, model organism",
}


def describe_labels(label: Column) -> Column:
    """The description of an entity label; null for others."""
    return F.create_map(*[F.lit(x) for kv in ENTITY_DESCRIPTIONS.items() for x in kv])[label]


def keep_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in that order."""
    return df.select(*[c for c in wanted if c in df.columns])


def rename_with_backup(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Rename columns that exist; a column already under the new name is kept as original_<name>."""
    for old, new in renames.items():
        if old in df.columns and old != new:
            if new in df.columns:
                df = df.withColumnRenamed(new, f"original_{new}")
            df = df.withColumnRenamed(old, new)
    return df


def drop_all_null(df: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """Drop the candidates without any value; one aggregate over the table."""
    have = [c for c in candidates if c in df.columns]
    if not have:
        return df
    counts = df.agg(*[F.count(c).alias(c) for c in have]).first()
    return df.drop(*[c for c in have if counts[c] == 0])


def flatten(df: DataFrame, struct: str, drop: Sequence[str] = ()) -> DataFrame:
    """The fields of a struct column as columns; an existing column of that name is kept as <name>_old."""
    fields = [f.name for f in df.schema[struct].dataType.fields if f.name not in drop]
    rest = [F.col(c).alias(f"{c}_old" if c in fields else c) for c in df.columns if c != struct]
    return df.select(*rest, *[F.col(f"{struct}.{f}").alias(f) for f in fields])


def short_model_name(name: Column) -> Column:
    """The last two path parts; a single part or empty name stays."""
    bare = F.regexp_replace(name, "/+$", "")
    parts = F.split(bare, "/")
    return F.when(F.length(name) == 0, name).when(F.size(parts) < 2, bare).otherwise(F.array_join(F.slice(parts, -2, 2), "/"))


def pack_config(config: str) -> Column:
    """model, genre, audience, abbreviation, register of a generation config; nulls where any level is null."""
    c = F.col(config)
    style = c["rewriting_style"]
    return F.struct(short_model_name(c["model"]).alias("model"), c["genre"].alias("genre"), c["audience"].alias("audience"), style["abbreviation"].alias("abbreviation"), style["register"].alias("register"))


def entity_struct(entities: Column) -> Column:
    """All entity labels as non-null arrays."""
    none = F.array().cast("array<string>")
    return F.struct(*[F.coalesce(entities[k], none).alias(k) for k in ENTITY_LABELS])


def entities_to_json(entities: Column) -> Column:
    """The struct as a JSON string, with null lists as empty ones."""
    return F.to_json(entity_struct(entities))


def entities_from_json(text: Column) -> Column:
    """The struct of a JSON string; labels that are absent or no lists of strings are empty, all of them where the string is no object."""
    v = json.strict(text)
    none = F.array().cast("array<string>")
    return F.struct(*[F.coalesce(F.try_variant_get(v, f"$[0].{k}", "array<string>"), none).alias(k) for k in ENTITY_LABELS])


def cast_columns(df: DataFrame, kinds: Mapping[str, str | T.DataType]) -> DataFrame:
    """Columns cast to declared types, structs by field name: fields that are missing become null, others are dropped. Columns that don't
    exist are skipped."""

    def cast(c: Column, have: T.DataType, want: T.DataType) -> Column:
        if isinstance(want, T.StructType) and isinstance(have, T.StructType):
            names = have.fieldNames()
            made = [(cast(c[f.name], have[f.name].dataType, f.dataType) if f.name in names else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields]
            return F.when(c.isNotNull(), F.struct(*made))
        if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
            return F.transform(c, lambda x: cast(x, have.elementType, want.elementType))
        return c.cast(want)

    for name, kind in kinds.items():
        if name in df.columns:
            want = T.DataType.fromDDL(kind) if isinstance(kind, str) else kind
            df = df.withColumn(name, cast(F.col(name), df.schema[name].dataType, want))
    return df


def fill_sentinels(df: DataFrame, numbers: Sequence[str] = (), strings: Sequence[str] = ()) -> DataFrame:
    """Null numbers become -1, null strings become empty; columns that don't exist are skipped."""
    df = df.na.fill(-1, [c for c in numbers if c in df.columns])
    return df.na.fill("", [c for c in strings if c in df.columns])


def before_after(df: DataFrame) -> DataFrame:
    """char_ratio and word_ratio of text against original_text, with density_diff and density_ratio, and edu_diff, where df has the
    scores; null where a base is null or 0."""
    if {"edu_quality_score", "original_edu_quality_score"} <= set(df.columns):
        df = df.withColumn("edu_diff", F.col("edu_quality_score") - F.col("original_edu_quality_score"))
    a, b = F.length("text"), F.length("original_text")
    if "medical_entity_density" in df.columns:
        df = df.withColumns({
            "density_diff": F.col("medical_entity_density") - F.col("original_medical_entity_density"),
            "density_ratio": F.try_divide(F.col("medical_entity_density"), F.nullif(F.col("original_medical_entity_density"), F.lit(0.0))),
        })
    return df.withColumns({
        "char_ratio": F.when((a > 0) & (b > 0), a / b),
        "word_ratio": F.try_divide(F.col("num_words").cast("double"), F.nullif(F.col("original_num_words"), F.lit(0))),
    })


def join_columns(columns: Sequence[str], delimiter: str = " ") -> Column:
    """Text columns joined; null ones are left out."""
    return F.concat_ws(delimiter, *columns)


def members(df: DataFrame, column: str, table: DataFrame) -> DataFrame:
    """Rows whose value stands in the column of the same name of a table; a semi-join, so repeated entries repeat nothing. A null is in no
    table."""
    return df.join(table.select(column).where(F.col(column).isNotNull()), column, "left_semi").select(*df.columns)


def union_intersection(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL on the columns all frames share, in the first frame's order."""
    shared = [c for c in frames[0].columns if all(c in f.columns for f in frames)]
    out = frames[0].select(*shared)
    for f in frames[1:]:
        out = out.unionByName(f.select(*shared))
    return out


def union_aligned(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name; missing columns are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
