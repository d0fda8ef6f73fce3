"""Problem 3: token counts per document under an existing tokenizer, rolled up by slices.

Short texts are counted where they are read. Oversized ones are cut at white space, which the tokenizer never spans, into chunks
that are salted over all workers and counted apart; a document's count is the exact sum of its chunks. Only numbers are shuffled for
short texts. Chunks are keyed by their content's hash, so identical deliveries fold instead of counting twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions.rows import latest
from lexmill.functions.text import WS, label_key
from lexmill.llm.pieces import Counter, load
from lexmill.session import bounded_batches

CHUNK = 200_000
MISSING = "(missing)"


def lang_key(label):
    """Code without region, in lower case; blank is null."""
    key = F.regexp_extract(F.lower(F.trim(label)), r"^([a-z]+)", 1)
    return F.when(F.length(key) > 0, key)


def _count(pieces: list[str], drop: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(pieces)
        for b in batches:
            n = pa.array([counter.count(t) for t in b.column(drop).to_pylist()], pa.int64())
            keep = [i for i, name in enumerate(b.schema.names) if name != drop]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in keep), n], [*(b.schema.names[i] for i in keep), "n_tokens"])

    return run


def count_tokens(texts: DataFrame, pieces: list[str], text: str = "text") -> DataFrame:
    """All columns but text, plus n_tokens; no shuffle. Null and blank text count 0."""
    bounded_batches(texts.sparkSession)
    fields = [f for f in texts.schema.fields if f.name != text]
    kind = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "n_tokens bigint"])
    return texts.mapInArrow(_count(pieces, text), kind)


def row_tokens(docs: DataFrame, pieces: list[str], chunk: int = CHUNK) -> DataFrame:
    """row_id, subset, lang, class (null where missing), n_tokens of the valid row of each row_id."""
    lean = docs.select(
        "row_id", "annotated_at", "ingested_at", "subset", "lang", F.col("health_domain_classification_best_class").alias("class"), "text",
        F.xxhash64("text").alias("_h"), F.lit(0).alias("_c"),
    )
    short = count_tokens(lean.where(f"text is null or length(text) <= {chunk}"), pieces)
    cut = F.regexp_extract_all("text", F.lit(rf"(?s)[{WS}]*+(?:.{{1,{chunk}}}(?=[{WS}]|$)|[^{WS}]++)"), F.lit(0))
    long = lean.where(f"length(text) > {chunk}").select(*[c for c in lean.columns if c not in ("text", "_c")], F.posexplode(cut).alias("_c", "text"))
    long = count_tokens(long.repartition(F.xxhash64("_h", "_c")), pieces)
    keys = ["row_id", "annotated_at", "ingested_at", "subset", "lang", "class", "_h"]
    whole = long.groupBy(*keys, "_c").agg(F.max("n_tokens").alias("n_tokens")).groupBy(*keys).agg(F.sum("n_tokens").alias("n_tokens"))
    both = short.select(*keys, "n_tokens").union(whole.select(*keys, "n_tokens"))
    kept = latest(both, "row_id", ["annotated_at", "ingested_at"], ["subset", "lang", "class", "n_tokens"])
    return kept.select("row_id", label_key(F.col("subset")).alias("subset"), lang_key(F.col("lang")).alias("lang"), label_key(F.col("class")).alias("class"), "n_tokens")


def token_budget(docs: DataFrame, token_pieces: DataFrame) -> DataFrame:
    """slice, subset, lang, class, n_docs, n_tokens, mean_tokens: one row per combination (slice 'all'), per subset, per lang, per
    class, and the total. Spellings of a value count as one; missing ones are the group '(missing)'; dimensions a row sums over are
    null. Empty input gives no rows."""
    rows = row_tokens(docs, load(token_pieces)).na.fill(MISSING, ["subset", "lang", "class"])
    fine = rows.groupBy("subset", "lang", "class").agg(F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("t"))
    name = F.expr("case grouping_id(subset, lang, class) when 0 then 'all' when 3 then 'subset' when 5 then 'lang' when 6 then 'class' else 'total' end")
    sums = fine.groupingSets([["subset", "lang", "class"], ["subset"], ["lang"], ["class"], []], "subset", "lang", "class").agg(
        name.alias("slice"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_docs"), F.coalesce(F.sum("t"), F.lit(0)).alias("n_tokens")
    )
    return sums.select("slice", "subset", "lang", "class", "n_docs", "n_tokens", F.round(F.col("n_tokens") / F.nullif("n_docs", F.lit(0)), 6).alias("mean_tokens"))
