"""The registered queries of the core operators, each over its whole tables, with the SQL that must give the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import json as J
from lexmill.functions.rows import latest, read
from lexmill.functions.text import WORD_RE2, WS_RE2, first_words, label_key, regular_words, url_prefixed, word_count, words
from lexmill.operators import builders, chunking, dedup, evaluate, filters, inference, model_output, projection, prompts, quality, sampling, stats
from lexmill.session import shared_dir
from lexmill.sources import readers, sinks

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}
EDU, DENSITY, CLASS = filters.EDU, filters.DENSITY, filters.CLASS
N_WORDS = f"len(regexp_extract_all(coalesce(text, ''), '{WORD_RE2}'))"


def query(sql: str | None = None):
    def add(f):
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that the order of summation does not show."""
    return df.select(*[F.round(c, digits).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes])


def docs_with_words(spark, d):
    return read(spark, d, "documents").withColumn("n_words", word_count(F.col("text")).cast("long"))


def scored(spark, d):
    return read(spark, d, "scored_docs").select("row_id", "subset", "text", "num_words", "edu_quality_score", EDU, CLASS, "url", "annotated_at", "ingested_at")


def shards(spark, d):
    return read(spark, d, "mds_input")


# statistics


@query(f"""with w as (select lang, {N_WORDS} as n from documents), g as (select lang, count(n) as n_docs, sum(n) as n_words, avg(n) as mean_n_words, quantile_cont(n, 0.5) as median_n_words from w group by lang)
select lang, n_docs, n_words::bigint as n_words, round(mean_n_words, 6) as mean_n_words, round(median_n_words, 6) as median_n_words,
round(n_docs * 100.0::double / sum(n_docs) over (), 6) as share_docs, round(n_words * 100.0::double / sum(n_words) over (), 6) as share_words from g""")
def corpus_stats_by_lang(spark, d):
    return rounded(stats.by_class(docs_with_words(spark, d), "lang", "n_words", ["n_words"]))


@query(f"""with w as (select source, {N_WORDS} as n, n_chars from documents), g as (select source, count(n) as n_docs, sum(n) as n_words, avg(n_chars) as mean_n_chars, quantile_cont(n_chars, 0.5) as median_n_chars from w group by source)
select source, n_docs, n_words::bigint as n_words, round(mean_n_chars, 6) as mean_n_chars, round(median_n_chars, 6) as median_n_chars,
round(n_docs * 100.0::double / sum(n_docs) over (), 6) as share_docs, round(n_words * 100.0::double / sum(n_words) over (), 6) as share_words from g""")
def corpus_stats_by_source(spark, d):
    return rounded(stats.by_class(docs_with_words(spark, d), "source", "n_words", ["n_chars"]))


def _summary_sql(table: str, columns: dict[str, str]) -> str:
    one = """select '{c}' as "column", count(x) as n, round(sum(x), 6) as sum, round(avg(x), 6) as mean, round(stddev_pop(x), 6) as std, round(min(x), 6) as min, round(max(x), 6) as max,
{q}, round(avg((x > 0)::int), 6) as share_positive from (select ({e})::double as x from {t}) where x is not null having count(x) > 0"""
    q = ", ".join(f"round(quantile_cont(x, {p}), 6) as q{round(p * 100):02d}" for p in stats.QUANTILES)
    return " union all ".join(one.format(c=c, e=e, t=table, q=q) for c, e in columns.items())


@query(_summary_sql("documents", {"n_chars": "n_chars", "n_words": N_WORDS}))
def numeric_summary_documents(spark, d):
    return rounded(stats.summary(docs_with_words(spark, d), ["n_chars", "n_words", "absent"]))


@query(_summary_sql("mds_input", {"num_words": "num_words", EDU: EDU}))
def numeric_summary_nulls(spark, d):
    return rounded(stats.summary(shards(spark, d), ["num_words", EDU]))


@query("select lang, count(*) as n from extract_input group by lang")
def value_counts_label(spark, d):
    return stats.value_counts(read(spark, d, "extract_input"), "lang")


@query("select event_type, count(*) as n from events group by event_type")
def value_counts_event_type(spark, d):
    return stats.value_counts(read(spark, d, "events"), "event_type")


@query("""select name, parquet_idx, case grouping(name, parquet_idx) when 0 then 0 when 1 then 1 else 2 end as level, count(*) as n_docs, coalesce(sum(num_words), 0)::bigint as n_words
from mds_input group by grouping sets ((name, parquet_idx), (name), ())""")
def summary_rollup(spark, d):
    return stats.rollup_counts(shards(spark, d), "name", "parquet_idx", "num_words")


def _pivot_sql(weight: str) -> str:
    s = f"round_even(least(greatest({EDU}, 0), 5), 0)"
    sums = ", ".join(f"sum(case when {s} = {i} then {weight} else 0 end)::double as s{i}" for i in range(6))
    total = " + ".join(f"s{i}" for i in range(6))
    return f"with g as (select {CLASS}, {sums} from mds_input where {CLASS} is not null and {EDU} is not null group by {CLASS}) select *, " + ", ".join(f"round(coalesce(s{i} / nullif({total}, 0), 0), 6) as p{i}" for i in range(6)) + " from g"


@query(_pivot_sql("1"))
def class_score_pivot_docs(spark, d):
    return rounded(stats.score_pivot(shards(spark, d), CLASS, EDU))


@query(_pivot_sql("coalesce(num_words, 0)"))
def class_score_pivot_words(spark, d):
    return rounded(stats.score_pivot(shards(spark, d), CLASS, EDU, "num_words"))


_ORDER = """with g as (select {c}, avg({v}) as mean, quantile_cont({v}, 0.5) as median, count(*) as n from mds_input where {c} is not null and {v} is not null group by {c} {top})
select {c}, round(mean, 6) as mean, round(median, 6) as median, n, row_number() over (order by {o}, {c}) as place from g"""


@query(_ORDER.format(c=CLASS, v=EDU, o="median desc", top=""))
def class_order_median(spark, d):
    return rounded(stats.class_order(shards(spark, d), CLASS, EDU))


@query(f"with g as (select {CLASS}, avg(num_words) as mean, quantile_cont(num_words, 0.5) as median, count(*) as n, min(row_id) as seen from mds_input where {CLASS} is not null and num_words is not null group by {CLASS}) select {CLASS}, round(mean, 6) as mean, round(median, 6) as median, n, row_number() over (order by seen, {CLASS}) as place from g")
def class_order_appearance(spark, d):
    return rounded(stats.class_order(shards(spark, d), CLASS, "num_words", "appearance", seen="row_id"))


@query(_ORDER.format(c=CLASS, v="num_words", o="mean desc", top=""))
def class_order_mean(spark, d):
    return rounded(stats.class_order(shards(spark, d), CLASS, "num_words", "mean_desc"))


@query(_ORDER.format(c="name", v="num_words", o="n desc", top="order by n desc, name limit 8"))
def class_order_top_count(spark, d):
    return rounded(stats.class_order(shards(spark, d), "name", "num_words", "count_desc", top=8))


_BIN = "case " + " ".join(f"when x >= {a} and x < {z} then {i}" for i, (a, z) in enumerate(zip(stats.BINS, stats.BINS[1:], strict=False))) + " end"


@query(f"""with b as (select {_BIN} as bin from (select {DENSITY}::double as x from mds_input where {DENSITY} is not null)), g as (select bin, count(*) as n from b group by bin), s as (select bin, n, n / sum(n) over ()::double as share from g)
select bin, n, round(share, 6) as share, round(sum(share) over (order by bin), 6) as cumulative from s where bin is not null""")
def density_bins_cumulative(spark, d):
    return rounded(stats.bins_cumulative(shards(spark, d), DENSITY))


def _bins_sql(weight: str, order: str) -> str:
    k = range(len(stats.BINS) - 1)
    sums = ", ".join(f"sum(case when bin = {i} then w else 0 end)::double as b{i}" for i in k)
    total = " + ".join(f"b{i}" for i in k)
    return f"with b as (select c, {_BIN} as bin, w from (select {CLASS} as c, {DENSITY}::double as x, {weight} as w from mds_input where {CLASS} is not null)), g as (select c, {sums} from b where bin is not null group by c) select c as {CLASS}, " + ", ".join([f"b{i}" for i in k] + [f"round(coalesce(b{i} / nullif({total}, 0), 0), 6) as p{i}" for i in k]) + f", row_number() over (order by {order.format(total=total)}, c) as place from g"


@query(_bins_sql("1", "b3 desc"))
def density_bins_by_class(spark, d):
    return rounded(stats.bins_by_class(shards(spark, d), CLASS, DENSITY))


@query(_bins_sql("coalesce(num_words, 0)", "coalesce(b4 / nullif({total}, 0), 0) desc"))
def density_bins_by_class_words(spark, d):
    return rounded(stats.bins_by_class(shards(spark, d), CLASS, DENSITY, "num_words"))


@query(f"""with c as (select name, {DENSITY}::double as value, count(*) as n from mds_input where {DENSITY} is not null and not isnan({DENSITY}) and not isinf({DENSITY}) group by all)
select name, round(value, 6) as value, n, round(sum(n) over (partition by name order by c.value) / sum(n) over (partition by name)::double, 6) as ecdf,
round(1 - (sum(n) over (partition by name order by c.value) - n) / sum(n) over (partition by name)::double, 6) as retained from c""")
def retention_curve(spark, d):
    return rounded(stats.retention(shards(spark, d), "name", DENSITY))


@query("select name, " + ", ".join(f"round(avg(({DENSITY}::double >= {t})::int), 6) as at_{i}" for i, t in enumerate((0.01, 0.1, 0.2))) + f" from mds_input where {DENSITY} is not null and not isnan({DENSITY}) group by name")
def retention_thresholds(spark, d):
    return rounded(stats.retention_at(shards(spark, d), "name", DENSITY, (0.01, 0.1, 0.2)))


@query(f"""with x as (select quantile_cont(v, 0.01) as a1, quantile_cont(v, 0.99) as z1, min(v) as a, max(v) as z from (select {EDU}::double as v from mds_input where {EDU} is not null)),
y as (select a, case when z1 > a1 then a1 else a end as lo, case when z1 > a1 then z1 else z end as hi from x)
select round(case when a >= 0 then greatest(0, lo - (hi - lo) * 0.05) else lo - (hi - lo) * 0.05 end, 6) as low, round(hi + (hi - lo) * 0.05, 6) as high from y""")
def plot_limits(spark, d):
    return rounded(stats.plot_limits(shards(spark, d), EDU))


_WORDS_OF = lambda c: f"len(regexp_extract_all(coalesce({c}, ''), '{WORD_RE2}'))"
_STATS = "count(x) as n, round(avg(x), 6) as mean, round(stddev_pop(x), 6) as std, " + ", ".join(f"round(quantile_cont(x, {q}), 6) as q{round(q * 100)}" for q in (0.25, 0.5, 0.75, 0.9))


@query(f"""with v as (select length(output)::double / nullif(length(text), 0) as c, {_WORDS_OF('output')}::double / nullif({_WORDS_OF('text')}, 0) as w, output, text from extract_input),
m as (select 'char_ratio' as "column", case when length(output) > 0 then c end as x from v union all select 'word_ratio', w from v where text is not null and output is not null union all select 'edu_diff', edu_quality_score - edu_quality_normalized_score from scored_docs where not isnan(edu_quality_score) or edu_quality_score is null)
select "column", {_STATS}, case when "column" = 'edu_diff' then round(avg((x > 0)::int), 6) end as share_positive from m where x is not null group by 1""")
def before_after_summary(spark, d):
    e = read(spark, d, "extract_input").where("text is not null and output is not null").select(F.col("output").alias("text"), F.col("text").alias("original_text"))
    v = projection.before_after(e.withColumns({"num_words": word_count(F.col("text")), "original_num_words": word_count(F.col("original_text"))}))
    edu = read(spark, d, "scored_docs").where("not isnan(edu_quality_score) or edu_quality_score is null")
    e2 = projection.before_after(edu.select("edu_quality_score", F.col(EDU).alias("original_edu_quality_score"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("original_text"), F.lit(None).cast("int").alias("num_words"), F.lit(None).cast("int").alias("original_num_words")))
    columns = ["char_ratio", "word_ratio", "edu_diff"]
    both = v.select("char_ratio", "word_ratio", F.lit(None).cast("double").alias("edu_diff")).unionByName(e2.select(*columns))
    return rounded(stats.before_after_summary(both))


@query()
def before_after_rewritten(spark, d):
    """Each original against the rewritten text parsed from its output: words, and density of the row's entities, counted on either."""
    r = read(spark, d, "rewrite_output").select("row_id", "medical_entities", F.col("text").alias("original_text"), model_output.rewriting(F.col("output"))["text"].alias("text"))
    r = r.where("text is not null and original_text is not null")
    found = F.create_map(*[x for k in projection.ENTITY_LABELS for x in (F.lit(k), F.array_compact(F.coalesce(F.col(f"medical_entities.{k}"), F.array().cast("array<string>"))))])
    dens = lambda t: F.when(F.col("medical_entities").isNotNull(), model_output.density(found, F.col(t)).cast("double"))
    v = r.select("row_id", "text", "original_text", word_count(F.col("text")).alias("num_words"), word_count(F.col("original_text")).alias("original_num_words"), dens("text").alias(DENSITY), dens("original_text").alias(f"original_{DENSITY}"))
    return rounded(projection.before_after(v).select("row_id", "char_ratio", "word_ratio", "density_diff", "density_ratio"), 5)


# projections and unions


@query("select doc_id, text, 'documents' as subset from documents")
def keep_list_with_source(spark, d):
    return projection.keep_columns(read(spark, d, "documents"), ["doc_id", "text", "absent"]).withColumn("subset", F.lit("documents"))


@query("select row_id, output as text, text as original_text from generate_output")
def rename_with_backup(spark, d):
    g = read(spark, d, "generate_output").select("row_id", "text", "output")
    return projection.rename_with_backup(g, {"output": "text"})


@query("select doc_id, source, url from documents")
def drop_all_null_columns(spark, d):
    df = read(spark, d, "documents").select("doc_id", "source", "url", F.lit(None).cast("string").alias("empty"))
    return projection.drop_all_null(df, ["url", "empty", "absent"])


@query("select row_id, genre as genre_old, gen_configs.model as model, gen_configs.genre as genre, gen_configs.audience as audience from rewrite_output")
def flatten_struct(spark, d):
    r = read(spark, d, "rewrite_output").select("row_id", "genre", F.struct("gen_configs.model", "gen_configs.genre", "gen_configs.audience", F.lit(1).alias("dataset")).alias("metadata"))
    return projection.flatten(r, "metadata", drop=["dataset"])


@query("""with m as (select row_id, rtrim(gen_configs.model, '/') as bare, gen_configs as g from rewrite_output), p as (select *, string_split(bare, '/') as parts from m)
select row_id, case when g.model = '' then g.model when len(parts) < 2 then bare else array_to_string(parts[-2:], '/') end as model, g.genre as genre, g.audience as audience, g.rewriting_style.abbreviation as abbreviation, g.rewriting_style.register as register from p""")
def rewriting_config_pack(spark, d):
    return read(spark, d, "rewrite_output").select("row_id", projection.pack_config("gen_configs").alias("c")).select("row_id", "c.*")


@query("select row_id, " + ", ".join(f"coalesce(len(medical_entities.{k}), 0)::int as n_{k}" for k in projection.ENTITY_LABELS) + " from rewrite_output")
def entity_struct_normal(spark, d):
    r = read(spark, d, "rewrite_output").select("row_id", projection.entity_struct(F.col("medical_entities")).alias("e"))
    return r.select("row_id", *[F.size(f"e.{k}").alias(f"n_{k}") for k in projection.ENTITY_LABELS])


@query("select row_id, coalesce(num_words, -1)::int as num_words, coalesce(genre, '') as genre from rewrite_output")
def sentinel_nulls(spark, d):
    return projection.fill_sentinels(read(spark, d, "rewrite_output").select("row_id", "num_words", "genre"), ["num_words", "absent"], ["genre"])


@query("select doc_id, case when length(url) > 0 then url || chr(10) || chr(10) || coalesce(text, '') else coalesce(text, '') end as text from documents")
def url_prefix(spark, d):
    return read(spark, d, "documents").select("doc_id", url_prefixed(F.col("url"), F.col("text")).alias("text"))


@query("select row_id, concat_ws(' : ', term, definition) as text from generate_output")
def joined_columns(spark, d):
    return read(spark, d, "generate_output").select("row_id", projection.join_columns(["term", "definition"], " : ").alias("text"))


@query("select row_id, text, lang from scored_docs union all select row_id, text, null from mds_input")
def union_allow_missing(spark, d):
    return projection.union_aligned([read(spark, d, "scored_docs").select("row_id", "text", "lang"), shards(spark, d).select("row_id", "text")])


@query("select row_id, text, num_words from scored_docs union all select row_id, text, num_words from extract_input")
def union_intersection(spark, d):
    return projection.union_intersection([read(spark, d, "scored_docs").select("row_id", "subset", "text", "num_words"), read(spark, d, "extract_input").select("row_id", "text", "num_words", "genre")])


# filters

_HYGIENE = f"coalesce(num_words >= 10, true) and coalesce({CLASS} <> 'Others', true)"
_IN5 = ", ".join("'" + c + "'" for c in filters.CLINICAL_CLASSES)


@query(f"select row_id, num_words, {CLASS} from mds_input where {_HYGIENE}")
def filter_hygiene(spark, d):
    return shards(spark, d).where(filters.hygiene()).select("row_id", "num_words", CLASS)


@query(f"select row_id from mds_input where coalesce({EDU} >= 2, true) and coalesce({DENSITY}::double >= 0.1, true) and coalesce({CLASS} in ({_IN5}), false)")
def filter_knobs_and(spark, d):
    return shards(spark, d).where(filters.by_mode("edu2_med01_subtopic_biocli5")).select("row_id")


@query(f"select row_id from mds_input where coalesce({EDU} >= 4, true) or coalesce({DENSITY}::double >= 0.2, true)")
def filter_knobs_or(spark, d):
    return shards(spark, d).where(filters.by_mode("union_edu4_med02")).select("row_id")


@query(f"select row_id, name from mds_input where {_HYGIENE} and case when contains(name, 'rewritten') then coalesce({DENSITY}::double >= 0.2, true) else coalesce({EDU} >= 4, true) end")
def filter_per_side(spark, d):
    return shards(spark, d).where(filters.by_sides("edu4_plus_rewritten_med02")).select("row_id", "name")


@query(f"select row_id from mds_input where coalesce(num_words >= 10, true) and coalesce({EDU} >= 4, true) and coalesce({DENSITY}::double >= 0.1, true) and coalesce({CLASS} in ({_IN5}), true)")
def filter_thresholds_domains(spark, d):
    return shards(spark, d).where(filters.thresholds()).select("row_id")


@query(f"select row_id from mds_input where {DENSITY}::double >= 0.1 and {EDU} >= 4")
def filter_dense_and_educational(spark, d):
    return shards(spark, d).where(filters.dense_and_educational()).select("row_id")


@query(f"select row_id from mds_input where {DENSITY}::double >= 0.01 and {EDU} >= 1")
def filter_prefilter(spark, d):
    return shards(spark, d).where(filters.dense_and_educational(0.01, 1)).select("row_id")


@query(f"select row_id, {CLASS} from mds_input where {CLASS} in ({', '.join(repr(t) for t in model_output.TOPICS)}) and {EDU} between 0 and 5")
def filter_valid_labels(spark, d):
    return shards(spark, d).where(filters.valid_annotation(CLASS, EDU, model_output.TOPICS)).select("row_id", CLASS)


@query(f"select row_id from mds_input where {CLASS} is not distinct from 'Others'")
def filter_equals(spark, d):
    return shards(spark, d).where(filters.equals(CLASS, "Others")).select("row_id")


@query("select row_id from generate_output where length(output) > 0")
def filter_non_empty(spark, d):
    return read(spark, d, "generate_output").where(filters.non_empty("output")).select("row_id")


@query("select row_id from rewrite_output where case when json_valid(output) then json_extract_string(output, '$.is_rewritable') = 'true' and json_type(output, '$.rewritten_text') = 'VARCHAR' and json_extract_string(output, '$.rewritten_text') <> '' and coalesce(json_type(output, '$.title'), 'NULL') in ('VARCHAR', 'NULL') end")
def filter_rewritable(spark, d):
    r = read(spark, d, "rewrite_output").select("row_id", F.when(J.strict(F.col("output")).isNotNull(), model_output.rewriting(F.col("output"))).alias("r"))
    return r.select("row_id", "r.is_rewritable", "r.text").where(filters.rewritable("is_rewritable", "text")).select("row_id")


@query(f"select row_id from mds_input where {DENSITY}::double >= 0.01 and {EDU} >= 1 union all select row_id from scored_docs")
def filter_stage_prefilter(spark, d):
    first = shards(spark, d).where(filters.cheap_prefilter()).select("row_id")
    return first.unionAll(read(spark, d, "scored_docs").where(filters.cheap_prefilter(2)).select("row_id"))


@query("select row_id, list_distinct(list_filter(synonyms, lambda x: length(x) > 0 and contains(output, x))) as spans from generate_output where synonyms is not null and output is not null")
def filter_spans_in_text(spark, d):
    g = read(spark, d, "generate_output").where("synonyms is not null and output is not null")
    return g.select("row_id", filters.spans_in_text("synonyms", "output").alias("spans"))


@query("select doc_id from documents where source in (select subset from mix_targets)")
def members_of_table(spark, d):
    t = read(spark, d, "mix_targets").select(F.col("subset").alias("source"))
    return projection.members(read(spark, d, "documents").select("doc_id", "source"), "source", t).select("doc_id")


@query(r"""with t as (select doc_id, replace(text, chr(13) || chr(10), chr(10)) as t from documents)
select doc_id, coalesce(len(regexp_extract_all(t, '[\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}\p{Cyrillic}]')) <= greatest(length(t), 1) * 0.01::double
 and len(regexp_extract_all(t, '[^\p{Latin}\p{Greek}\p{Nd}[:punct:] \t\n\r\x{a0}\x{202f}]')) <= greatest(length(t), 1) * 0.02::double, false) as ok from t""")
def quality_gate(spark, d):
    return read(spark, d, "documents").select("doc_id", filters.quality_gate(F.col("text")).alias("ok"))


@query(f"select row_id from mds_input where {DENSITY} is not null and not isnan({DENSITY}) and not isinf({DENSITY})")
def filter_finite(spark, d):
    return shards(spark, d).where(filters.finite(DENSITY)).select("row_id")


# sampling: SQL checks sizes, tests check determinism


@query("select least(1500, count(*)) as n, least(1500, count(*)) as n_distinct from documents")
def exact_k_sample_count(spark, d):
    s = sampling.exact_sample(read(spark, d, "documents").select("doc_id", "source"), 1500, "doc_id")
    return s.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("n_distinct"))


@query("with c as (select source, count(*) as n from documents where source is not null group by source), k as (select 600 // count(*) * 2 as cap from c) select least(600, sum(least(n, cap)))::bigint as n from c, k")
def per_source_cap_count(spark, d):
    return sampling.capped_sample(read(spark, d, "documents").select("doc_id", "source"), "source", 600, "doc_id").agg(F.count(F.lit(1)).alias("n"))


@query("select source, case source when 'medweb_fr' then floor(count(*) * 0.3::double)::bigint when 'theses_sante' then floor(count(*) * 0.5::double)::bigint else count(*) end as n from documents group by source")
def ratio_downsample_count(spark, d):
    s = sampling.ratio_sample(read(spark, d, "documents").select("doc_id", "source"), "source", {"medweb_fr": 0.3, "theses_sante": 0.5}, "doc_id")
    return s.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


_QUOTA = """with v as (select distinct row_id, name, num_words from mds_input), c as (select name, count(*) as n_all, count_if(num_words >= 20) as n, count_if(num_words >= 40) as n_long_rows from v group by name),
t as (select *, round_even(n * 0.5, 0)::bigint as target from c), l as (select *, least(n_long_rows, round_even(target * 0.8, 0)::bigint) as n_long from t)
select {} from l"""


@query(_QUOTA.format("name, n_all, n, n_long_rows, target, n_long, greatest(0, least(target - n_long, n - n_long_rows))::bigint as n_short"))
def length_aware_quota(spark, d):
    return sampling.length_quotas(shards(spark, d).select("row_id", "name", "num_words").distinct(), "name", 0.5, 20, 40)


@query(_QUOTA.format("name, n_long + greatest(0, least(target - n_long, n - n_long_rows))::bigint as n") + " where n_long + greatest(0, least(target - n_long, n - n_long_rows)) > 0")
def length_aware_count(spark, d):
    v = shards(spark, d).select("row_id", "name", "num_words").distinct()
    return sampling.length_aware(v, "name", "row_id", 0.5, 20, 40).groupBy("name").agg(F.count(F.lit(1)).alias("n"))


@query("with n as (select count(*) as c from documents) select 'validation' as split, ceil(c * 0.05::double)::bigint as n from n union all select 'train', c - ceil(c * 0.05::double)::bigint from n")
def split_sizes(spark, d):
    return sampling.train_test(read(spark, d, "documents").select("doc_id"), "doc_id", 0.3).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("select doc_id, source from documents order by doc_id limit 50 offset 100")
def offset_head(spark, d):
    return sampling.head(read(spark, d, "documents").select("doc_id", "source"), "doc_id", 50, 100)


@query(f"select row_id, {DENSITY}::double as density from (select distinct row_id, {DENSITY} from mds_input where {DENSITY} is not null and not isnan({DENSITY})) order by density desc, row_id limit 5000")
def top_by_density(spark, d):
    x = sampling.top(shards(spark, d).select("row_id", DENSITY).distinct(), DENSITY, "row_id")
    return x.select("row_id", F.col(DENSITY).cast("double").alias("density"))


@query("select count(*) as n, count(distinct doc_id) as n_distinct, sum(doc_id)::bigint as total, ceil(count(*) / 1000.0::double)::bigint as shards from documents")
def full_shuffle(spark, d):
    s = sampling.numbered(sampling.shuffled(read(spark, d, "documents").select("doc_id"), "doc_id").withColumn("h", sampling.order_hash("doc_id")), ["h", "doc_id"])
    return s.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("row_number").alias("n_distinct"), F.sum("doc_id").alias("total"), F.count_distinct(F.floor(F.col("row_number") / 1000)).alias("shards"))


@query("select doc_id, ((row_number() over (order by doc_id) - 1) // 700)::int as shard from documents")
def row_shards(spark, d):
    return sampling.shard_rows(read(spark, d, "documents").select("doc_id"), ["doc_id"], 700)


@query("select doc_id from (select doc_id, row_number() over (order by doc_id) - 11 as n from documents) where n >= 0 and n < 600 and n % 4 = 1")
def strided_reader(spark, d):
    return sampling.strided(read(spark, d, "documents").select("doc_id"), ["doc_id"], 1, 4, skip=10, limit=600)


@query("with c as (select source, count(*) as n from documents group by source), t as (select sum(n) as target from c where source is null or source not in ('medweb_fr', 'theses_sante')) select source, case source when 'medweb_fr' then least(n, floor(target * 0.05::double)::bigint) when 'theses_sante' then least(n, floor(target * 0.01::double)::bigint) else n end as n from c, t where case source when 'medweb_fr' then floor(target * 0.05::double) when 'theses_sante' then floor(target * 0.01::double) else n end > 0")
def target_downsample_count(spark, d):
    s = sampling.target_sample(read(spark, d, "documents").select("doc_id", "source"), "source", {"medweb_fr": 0.05, "theses_sante": 0.01}, "doc_id")
    return s.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query("select row_id, least(2, len(list_distinct(synonyms)))::int as n from generate_output where len(list_distinct(synonyms)) > 0")
def choice_count(spark, d):
    g = read(spark, d, "generate_output").select("row_id", F.array_distinct("synonyms").alias("s")).where(F.size("s") > 0)
    picked = sampling.choose(F.col("s"), F.col("row_id"), 2)
    return g.select("row_id", F.size(F.array_intersect(picked, F.col("s"))).alias("n"))


@query()
def style_sampling(spark, d):
    """The style draws of every version."""
    docs = read(spark, d, "documents").select("doc_id")
    return docs.select("doc_id", *[prompts.draw_styles(F.col("doc_id"), dims).alias(v) for v, dims in prompts.STYLES.items()]).select("doc_id", *[F.concat_ws("/", *[f"{v}.{x}" for x in dims]).alias(v) for v, dims in prompts.STYLES.items()])


@query("select row_id, 'Réécris en fr pour ' || coalesce(audience, '') || ' : ' || coalesce(genre, '') as system_prompt, coalesce(text, '') || chr(10) || 'Fin' as user_prompt from rewrite_output")
def rewriting_plan(spark, d):
    r = read(spark, d, "rewrite_output").select("row_id", "text", "genre", "audience")
    return prompts.plan_rewriting(r, "row_id", "text", "Réécris en {language} pour {audience} : {genre}", "{text}\nFin", "v4", 2).select("row_id", "system_prompt", "user_prompt")


@query("select row_id, coalesce(term, '') || ' = ' || coalesce(definition, '') || ' (' || coalesce(array_to_string(synonyms, ', '), '') || ')' as user_prompt from generate_output")
def generation_plan(spark, d):
    g = read(spark, d, "generate_output").select("row_id", "term", "definition", "synonyms")
    return prompts.plan_generation(g, "row_id", "vocabulary", "Dictionnaire.", "{term} = {definition} ({synonyms})", {"wiki": " W", "textbook": " T"}).select("row_id", "user_prompt")


# text functions


@query(f"select doc_id, {N_WORDS}::bigint as n_words, length(coalesce(text, ''))::bigint as n_chars from documents")
def word_counts(spark, d):
    return read(spark, d, "documents").select("doc_id", word_count(F.col("text")).cast("long").alias("n_words"), F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"))


@query(f"select doc_id, array_to_string(regexp_extract_all(text, '{WORD_RE2}')[1:12], ' ') as head from documents")
def first_n_words(spark, d):
    return read(spark, d, "documents").select("doc_id", first_words(F.col("text"), 12).alias("head"))


@query(f"with w as (select doc_id, regexp_extract_all(text, '{WORD_RE2}') as w from documents) select doc_id, array_to_string(w[greatest((len(w) - 20) // 2, 0) + 1 : greatest((len(w) - 20) // 2, 0) + 20], ' ') as middle from w")
def middle_window(spark, d):
    return read(spark, d, "documents").select("doc_id", chunking.middle_words(F.col("text"), 20).alias("middle"))


@query(f"""with w as (select doc_id, regexp_extract_all(text, '{WORD_RE2}') as w from documents where text is not null), i as (select doc_id, w, unnest(range(0, greatest(ceil(len(w) / 100.0)::int, 1))) as i from w)
select doc_id, i::int as i, array_to_string(w[i * 100 + 1 : i * 100 + 100], ' ') as chunk from i""")
def chunk_words(spark, d):
    return read(spark, d, "documents").where("text is not null").select("doc_id", F.posexplode(chunking.word_windows(F.col("text"), 100)).alias("i", "chunk"))


@query(f"select row_id, nullif(replace(lower(regexp_replace(regexp_replace({CLASS}, '^[{WS_RE2}]+|[{WS_RE2}]+$', '', 'g'), '[{WS_RE2}]+', ' ', 'g')), ' and ', ' & '), '') as topic from scored_docs")
def label_normalise(spark, d):
    return read(spark, d, "scored_docs").select("row_id", label_key(F.col(CLASS)).alias("topic"))


@query("with t(canonical) as (values " + ", ".join("('" + t + "')" for t in model_output.TOPICS) + f""")
select row_id, coalesce(canonical, {CLASS}) as topic from scored_docs left join t on lower(canonical) = replace(lower(regexp_replace(regexp_replace({CLASS}, '^[{WS_RE2}]+|[{WS_RE2}]+$', '', 'g'), '[{WS_RE2}]+', ' ', 'g')), ' and ', ' & ')""")
def topic_normalise(spark, d):
    return read(spark, d, "scored_docs").select("row_id", model_output.canonical_topic(F.col(CLASS)).alias("topic"))


@query("select l_orderkey, l_linenumber, round_even(least(greatest(l_discount * 50, 0), 5), 0)::int as score from lineitem")
def regression_clamp(spark, d):
    return read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", stats.half_even_score(F.col("l_discount").cast("double") * 50).alias("score"))


@query("""with e as (select vec_id, list_transform(embedding[1:8], lambda x: x::double) as s from embeddings), m as (select vec_id, s, list_max(s) as top from e)
select vec_id, list_position(s, top)::int - 1 as best, round(1 / list_sum(list_transform(s, lambda x: exp(x - top))), 6) as score from m""")
def argmax_softmax(spark, d):
    s = F.transform(F.slice("embedding", 1, 8), lambda x: x.cast("double"))
    return read(spark, d, "embeddings").select("vec_id", stats.argmax(s).alias("best"), F.round(F.array_max(stats.softmax(s)), 6).alias("score"))


@query("select row_id, 'Genre: ' || coalesce(genre, '') || ' {x} ' || coalesce(audience, '') as prompt from rewrite_output")
def prompt_render(spark, d):
    return read(spark, d, "rewrite_output").select("row_id", prompts.render("Genre: {genre} {{x}} {audience}", {"genre": F.col("genre"), "audience": F.col("audience")}).alias("prompt"))


@query(f"select row_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(output, '[{WS_RE2}]+\\.', '.', 'g'), '[{WS_RE2}]*''[{WS_RE2}]*', '''', 'g'), '^[{WS_RE2}]+|[{WS_RE2}]+$', '', 'g'), '[{WS_RE2}]+', ' ', 'g'), '^$', '') as text from generate_output")
def french_spacing(spark, d):
    return read(spark, d, "generate_output").select("row_id", model_output.french_spacing(F.col("output")).alias("text"))


# structured outputs

_CASES = """case doc_id % 6 when 0 then '{"score": ' || (doc_id % 7) || '}' when 1 then '{"score": "' || (doc_id % 6) || '"}' when 2 then '{"score": 3} tail' when 3 then '{"score": 3' when 4 then '{"score": 2, "score": 4}' else '{"score": "x"}' end"""


@query(f"""select row_id, {EDU} as score, case when {EDU} between 0 and 5 then {EDU} end as valid from mds_input""")
def json_strict_score(spark, d):
    """Scores written as a model writes them, as numbers or strings, and read again."""
    s = F.when(F.col("row_id") % 2 == 0, F.to_json(F.struct(F.col(EDU).alias("score")))).otherwise(F.to_json(F.struct(F.col(EDU).cast("string").alias("score"))))
    return shards(spark, d).select("row_id", J.score(s).alias("score"), model_output.valid_score(s).alias("valid"))


@query("select row_id, json_valid(output) as strict, case when json_valid(output) then json_extract_string(output, '$.format') end as format from rewrite_output where output is not null")
def json_strict_fields(spark, d):
    v = J.strict(F.col("output"))
    return read(spark, d, "rewrite_output").where("output is not null").select("row_id", v.isNotNull().alias("strict"), J.string_field(v, "format").alias("format"))


_OBJECT_RE2 = r"\{(?:[^{}]|\{(?:[^{}]|\{[^{}]*\})*\})*\}"


@query(f"select row_id, list_last(regexp_extract_all(output, '{_OBJECT_RE2}')) as last from rewrite_output")
def json_last_object(spark, d):
    return read(spark, d, "rewrite_output").select("row_id", J.last_object(F.col("output")).alias("last"))


_FLAT = range(1, 9)


@query("""with p as (select row_id, case when row_id % 2 = 0 then [genre, 'h'] else list_transform(range(1, 9), lambda i: genre || i) end as genre, case when row_id % 2 = 0 then [audience, 'b'] else list_transform(range(1, 9), lambda i: audience || i) end as audience from rewrite_output)
select row_id, g as genre, a as audience from (select row_id, unnest(genre) as g, unnest(audience) as a from p) where g is not null and a is not null""")
def proposals_explode(spark, d):
    """Genres and audiences written as a first stage writes them, nested after a prefix or as eight flat pairs, and read again."""
    r = read(spark, d, "rewrite_output").select("row_id", "genre", "audience")
    nested = F.concat(F.lit("analysis assistantfinal"), F.to_json(F.struct(F.lit(True).alias("has_medical_content"), F.array(F.struct("genre", "audience"), F.struct(F.lit("h").alias("genre"), F.lit("b").alias("audience"))).alias("proposals"))))
    flat = F.to_json(F.struct(*[x for i in _FLAT for x in (F.concat("genre", F.lit(str(i))).alias(f"genre_{i}"), F.concat("audience", F.lit(str(i))).alias(f"audience_{i}"))]))
    out = model_output.explode_proposals(r.select("row_id", F.when(F.col("row_id") % 2 == 0, nested).otherwise(flat).alias("output")), "output")
    return out.drop("output")


@query(f"""with t as (select row_id, output, case when contains(output, 'assistantfinal') then regexp_replace(substr(output, instr(output, 'assistantfinal') + 14), '^[{WS_RE2}]+', '') else output end as tail from rewrite_output),
v as (select row_id, case when json_valid(output) then output else list_last(regexp_extract_all(tail, '{_OBJECT_RE2}')) end as v from t)
select row_id, json_extract_string(v, '$.rewritten_text') as text, json_extract_string(v, '$.title') as title from (select row_id, case when json_valid(v) then v end as v from v)
where json_type(v, '$.rewritten_text') = 'VARCHAR' and coalesce(json_type(v, '$.title'), 'NULL') in ('VARCHAR', 'NULL')""")
def rewriting_extract(spark, d):
    """Rewrites of strict, wrapped, prefixed and followed JSON, over every row."""
    r = read(spark, d, "rewrite_output").select("row_id", model_output.rewriting(F.col("output")).alias("r"))
    return r.where("r.text is not null").select("row_id", "r.text", "r.title")


@query("select row_id, coalesce(gen_configs.model, '') as model, to_json(medical_entities)::varchar as entities from rewrite_output where json_valid(output) and json_type(output, '$.rewritten_text') = 'VARCHAR' and coalesce(json_type(output, '$.title'), 'NULL') in ('VARCHAR', 'NULL') and medical_entities is not null and len(list_filter([medical_entities.disease, medical_entities.drug, medical_entities.body_part, medical_entities.medical_procedure, medical_entities.molecular_marker, medical_entities.clinical_device, medical_entities.vital_function, medical_entities.living_beings], lambda x: x is null)) = 0")
def rewriting_rows(spark, d):
    r = read(spark, d, "rewrite_output").where(J.strict(F.col("output")).isNotNull())
    whole = F.col("medical_entities").isNotNull()
    for k in projection.ENTITY_LABELS:
        whole = whole & F.col(f"medical_entities.{k}").isNotNull()
    out = model_output.rewriting_rows(r.where(whole)).where("text is not null")
    return out.select("row_id", F.coalesce("rewriting_model", F.lit("")).alias("model"), F.col("medical_entities").alias("entities"))


@query(f"""with t as (select row_id, case when regexp_matches(output, '(?im)^[ \\t]*#{{1,6}}[ \\t]*conversation\\b[^\\n\\r]*$') then regexp_replace(output, '(?ims)^.*?^[ \\t]*#{{1,6}}[ \\t]*conversation\\b[^\\n\\r]*$', '') else output end as t from generate_output),
l as (select row_id, t, list_filter(string_split_regex(t, '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x{{85}}\\x{{2028}}\\x{{2029}}]'), lambda x: regexp_replace(x, '[{WS_RE2}]+', '', 'g') <> '') as l from t)
select row_id, case when t is not null then regexp_replace(coalesce(array_to_string(l, chr(10)), ''), '^[{WS_RE2}]+|[{WS_RE2}]+$', '', 'g') end as text from l""")
def dialogue_extract(spark, d):
    return model_output.dialogue_rows(read(spark, d, "generate_output").select("row_id", F.col("output").alias("text"))).select("row_id", "text")


_EVERY = "list_distinct(list_filter(flatten([" + ", ".join(f"coalesce(medical_entities.{k}, [])" for k in projection.ENTITY_LABELS) + "]), lambda x: length(x) > 0))"


def _items(make: Callable[[str, Column], Column], *more: Column) -> Column:
    """One array of what make gives for each entity of medical_entities and its label."""
    none = F.array().cast("array<string>")
    return F.concat(*[F.transform(F.coalesce(F.col(f"medical_entities.{k}"), none), partial(make, k)) for k in projection.ENTITY_LABELS], *more)


def entity_columns() -> Column:
    """medical_entities as map<label, array<string>>."""
    none = F.array().cast("array<string>")
    return F.map_from_entries(F.array(*[F.struct(F.lit(k).alias("key"), F.filter(F.coalesce(F.col(f"medical_entities.{k}"), none), lambda x: x.isNotNull()).alias("value")) for k in projection.ENTITY_LABELS]))


@query(f"""with e as (select row_id, text, {_EVERY} as e from rewrite_output where text is not null)
select row_id, round(coalesce(list_sum([length(text) - length(replace(text, x, '')) for x in e]), 0)::double / greatest(length(text), 1), 5) as density from e""")
def entities_density(spark, d):
    r = read(spark, d, "rewrite_output").where("text is not null")
    return r.select("row_id", F.round(model_output.density(entity_columns(), F.col("text")).cast("double"), 5).alias("density"))


@query("with i as (" + " union all ".join(f"select row_id, text, '{k}' as label, list_distinct(list_filter(list_transform(medical_entities.{k}, lambda x: trim(x)), lambda x: length(x) > 0 and contains(text, x))) as spans from rewrite_output where text is not null" for k in projection.ENTITY_LABELS) + ") select row_id, label, len(spans)::int as n from i where len(spans) > 0")
def entities_parse(spark, d):
    """The entities of each row written as a model writes them, with a label and a text that are not its own, and read again."""
    items = _items(lambda k, x: F.struct(F.lit(k).alias("entity"), F.array(x, F.concat(x, F.lit("\u2603"))).alias("text")), F.array(F.struct(F.lit("unknown").alias("entity"), F.array(F.lit("a")).alias("text"))))
    r = read(spark, d, "rewrite_output").where("text is not null").select("row_id", "text", F.to_json(F.struct(items.alias("entities"))).alias("output"))
    m = r.select("row_id", F.explode(model_output.entity_map(F.col("output"), F.col("text"))).alias("label", "spans"))
    return m.select("row_id", "label", F.size("spans").alias("n"))


@query("with i as (" + " union all ".join(f"select row_id, '{k}' as label, list_sort(list_distinct(list_filter(list_concat(coalesce(medical_entities.{k}, []), list_transform(coalesce(medical_entities.{k}, []), lambda x: x || '*')), lambda x: length(x) > 0))) as merged from rewrite_output" for k in projection.ENTITY_LABELS) + ") select row_id, label, array_to_string(merged, '|') as merged from i where len(merged) > 0")
def entity_merge(spark, d):
    """The entities of each row merged with the same under a mark, as finds of two windows are."""
    m = entity_columns()
    other = F.transform_values(m, lambda k, v: F.transform(v, lambda x: F.concat(x, F.lit("*"))))
    r = read(spark, d, "rewrite_output").select("row_id", F.explode(model_output.merge_entities(F.array(m, other))).alias("label", "merged"))
    return r.select("row_id", "label", F.array_join("merged", "|").alias("merged"))


@query("select row_id, " + ", ".join(f"coalesce(len(medical_entities.{k}), 0)::int as {k}" for k in projection.ENTITY_LABELS) + " from rewrite_output")
def entities_json_roundtrip(spark, d):
    r = read(spark, d, "rewrite_output").select("row_id", projection.entities_from_json(projection.entities_to_json(F.col("medical_entities"))).alias("e"))
    return r.select("row_id", *[F.size(f"e.{k}").alias(k) for k in projection.ENTITY_LABELS])


@query("select row_id, gen_configs.model as model, gen_configs.temperature::float as temperature, null::varchar as added, num_words::bigint as num_words from rewrite_output")
def cast_declared(spark, d):
    r = projection.cast_columns(read(spark, d, "rewrite_output").select("row_id", "gen_configs", "num_words"), {"gen_configs": "model string, temperature float, added string", "num_words": "bigint", "absent": "int"})
    return r.select("row_id", "gen_configs.*", "num_words")


@query()
def ner_align(spark, d):
    """Token spans of the entities of each row in its original and rewritten text; a row without spans where there is none."""
    items = _items(lambda k, x: F.struct(F.lit(k).alias("label"), x.alias("entity")))
    both = F.concat_ws("\n", "text", model_output.rewriting(F.col("output"))["text"])
    r = read(spark, d, "rewrite_output").select("row_id", model_output.align_entities(both, items).alias("a"))
    return r.select("row_id", F.size("a.tokenized_text").alias("n_tokens"), F.explode_outer("a.ner").alias("s")).select("row_id", "n_tokens", "s.*")


@query("select row_id, translate(output, '’‘‛–—', '--') as text from extract_input")
def straight_marks(spark, d):
    return read(spark, d, "extract_input").select("row_id", model_output.straight_marks(F.col("output")).alias("text"))


# corpus operators


@query("select count(distinct text) + max((text is null)::int) as n from documents")
def exact_dedup(spark, d):
    return dedup.exact(read(spark, d, "documents").select("doc_id", "text"), "text", "doc_id").agg(F.count(F.lit(1)).alias("n"))


@query()
def minhash_clusters(spark, d):
    return dedup.near_duplicates(read(spark, d, "documents").select("doc_id", "text"), "doc_id", "text")


@query(f"""with l as (select doc_id, text, list_filter(list_transform(string_split_regex(text, '\n+'), lambda x: regexp_replace(x, '^[{WS_RE2}]+|[{WS_RE2}]+$', '', 'g')), lambda x: x <> '') as l from documents where text is not null)
select doc_id, round(coalesce((len(l) - len(list_distinct(l)))::double / nullif(len(l), 0), 0), 6) as share,
round(coalesce((coalesce(list_sum([length(x) for x in l]), 0) - coalesce(list_sum([length(x) for x in list_distinct(l)]), 0))::double / nullif(length(text), 0), 0), 6) as char_share from l""")
def duplicate_line_fraction(spark, d):
    share, chars = quality.duplicate_shares(F.col("text"), r"\n+")
    return rounded(read(spark, d, "documents").where("text is not null").select("doc_id", share.alias("share"), chars.alias("char_share")))


@query()
def repetition_reasons(spark, d):
    return quality.repetition_reason(read(spark, d, "documents").select("doc_id", "text")).select("doc_id", "drop_reason")


@query()
def language_identity(spark, d):
    return quality.identify(read(spark, d, "documents").select("doc_id", "text")).select("doc_id", "language", "language_score")


@query("select row_id, length(text)::bigint as n_chars, 0::bigint as n_over from split_input where text is not null")
def chunk_invariants(spark, d):
    """Chunks give back their text, and none is over the limit."""
    s = read(spark, d, "split_input").select("row_id", "text", F.xxhash64("ingested_at", "crawled_at").alias("delivery")).where("text is not null")
    c = chunking.split_documents(s, 4000, chunking.CharTokenizer)
    return c.groupBy("row_id", "delivery").agg(F.sum(F.length("text")).cast("long").alias("n_chars"), F.count_if(F.length("text") > 4000).alias("n_over")).drop("delivery")


@query()
def chunk_documents(spark, d):
    return chunking.split_documents(read(spark, d, "split_input").select("row_id", "text", "lang"), 512).select("row_id", "chunk", "num_words")


# inference plug-ins


@query(f"select doc_id, {N_WORDS}::int as num_words, case when {N_WORDS} > 200 then 'long' else 'short' end as length_best_class from documents")
def classify_plugin(spark, d):
    def load():
        return lambda texts: [[1.0, 0.0] if len(t.split()) > 200 else [0.0, 1.0] for t in texts]

    return inference.classify(read(spark, d, "documents").select("doc_id", "text"), "length", ["long", "short"], load).select("doc_id", "num_words", "length_best_class")


@query("select doc_id, round_even(least(greatest(length(coalesce(text, '')) / 1000.0::double, 0), 5), 0)::int as edu_normalized_score from documents")
def regress_plugin(spark, d):
    return inference.regress(read(spark, d, "documents").select("doc_id", "text"), "edu", lambda: lambda texts: [[len(t) / 1000] for t in texts]).select("doc_id", "edu_normalized_score")


@query("select doc_id, contains(coalesce(text, ''), 'patient') as has_patient from documents")
def extract_plugin(spark, d):
    df = inference.extract_entities(read(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text")), inference.dictionary_extractor({"living_beings": ["patient"]}))
    return df.select("doc_id", (F.size(F.coalesce(F.col("entities")["living_beings"], F.array())) > 0).alias("has_patient"))


# evaluation

_TP = f"select round_even(least(greatest({EDU}, 0), 5), 0)::int as t, case when {DENSITY}::double >= 0.4 then 4 when {DENSITY}::double >= 0.2 then 3 else 2 end as p from mds_input where {EDU} is not null"


def _truth(spark, d):
    p = F.when(F.col(DENSITY).cast("double") >= 0.4, 4).when(F.col(DENSITY).cast("double") >= 0.2, 3).otherwise(2)
    return shards(spark, d).where(f"{EDU} is not null").select(stats.half_even_score(F.col(EDU)).alias("t"), p.alias("p"))


@query(f"with x as ({_TP}) select t, p, count(*) as n, round(count(*) / sum(count(*)) over (partition by t)::double, 6) as share from x group by t, p")
def confusion_matrix(spark, d):
    return rounded(evaluate.confusion(_truth(spark, d), "t", "p"))


@query(f"""with x as ({_TP}), l as (select distinct unnest([t, p]) as label from x), c as (select label::varchar as label, (select count(*) from x where t = label) as support, (select count(*) from x where p = label) as pred, (select count(*) from x where t = label and p = label) as tp from l),
r as (select label, coalesce(tp / nullif(pred, 0)::double, 0) as precision, coalesce(tp / nullif(support, 0)::double, 0) as recall, 2.0::double * tp / (pred + support) as f1, support, tp from c)
select label, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, support from r
union all select 'macro', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support)::bigint from r
union all select 'weighted', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), sum(support)::bigint from r
union all select 'accuracy', round(sum(tp) / sum(support)::double, 6), round(sum(tp) / sum(support)::double, 6), round(sum(tp) / sum(support)::double, 6), sum(support)::bigint from r""")
def classification_report(spark, d):
    return rounded(evaluate.class_report(_truth(spark, d), "t", "p"))


@query(f"with x as ({_TP}) select round(avg(pow(p - t, 2)), 6) as mse, round(avg((p = t)::int), 6) as accuracy, round(avg((p = t)::int), 6) as micro_f1, count(*) as n from x")
def mse_accuracy_f1(spark, d):
    return rounded(evaluate.regression_metrics(_truth(spark, d), "t", "p", F.col("p")))


def _pairs(spark, d):
    m = latest(read(spark, d, "rewrite_output"), "row_id", ["finished_at", "ingested_at"], ["medical_entities"])
    e = projection.entity_struct(F.col("medical_entities"))
    side = lambda keep: F.map_from_entries(F.array(*[F.struct(F.lit(k).alias("key"), F.filter(e[k], keep).alias("value")) for k in projection.ENTITY_LABELS]))
    df = m.select("row_id", side(lambda x: x.isNotNull()).alias("gold"), side(lambda x: F.length(x) % 2 == 0).alias("pred"))
    return df, evaluate.entity_pairs(df, "row_id", "gold", "pred")


_NER = (
    "with m as (select row_id, medical_entities as e from (select *, row_number() over (partition by row_id order by finished_at desc, ingested_at desc, medical_entities desc nulls last) as rn from rewrite_output) where rn = 1), l as ("
    + " union all ".join(f"select row_id, '{k}' as label, unnest(e.{k}) as x from m" for k in projection.ENTITY_LABELS)
    + """), g as (select distinct row_id, label, lower(trim(x)) as x from l where trim(x) <> ''), p as (select distinct row_id, label, lower(trim(x)) as x from l where trim(x) <> '' and length(x) % 2 = 0),
b as (select row_id, label, true as in_gold, (row_id, label, x) in (select (row_id, label, x) from p) as in_pred from g)"""
)


@query(_NER + """, c as (select label, count_if(in_pred) as tp, count(*) as gold, count_if(in_pred) as pred from b group by label), r as (select label, coalesce(tp / nullif(pred, 0)::double, 0) as precision, tp / gold::double as recall, 2.0::double * tp / (gold + pred) as f1, gold as support, tp, pred from c)
select label, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, support from r
union all select 'micro', round(coalesce(sum(tp) / nullif(sum(pred), 0)::double, 0), 6), round(sum(tp) / sum(support)::double, 6), round(2.0::double * sum(tp) / (sum(support) + sum(pred)), 6), sum(support)::bigint from r
union all select 'macro', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support)::bigint from r
union all select 'weighted', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), sum(support)::bigint from r
union all select 'samples', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), sum(g)::bigint from (select coalesce(count_if(in_pred) / nullif(count_if(in_pred), 0)::double, 0) as p, count_if(in_pred) / count(*)::double as r, 2.0::double * count_if(in_pred) / (count(*) + count_if(in_pred)) as f, count(*) as g from b group by row_id)""")
def ner_report(spark, d):
    return rounded(evaluate.entity_report(_pairs(spark, d)[1], "row_id"))


@query(_NER + """, n as (select count(*)::double as docs from m), per as (select row_id, label, count(*) as g, count_if(in_pred) as p from b group by row_id, label), u as (select * from per union all select row_id, 'TOTAL', sum(g), sum(p) from per group by row_id)
select label, round(sum(g) / any_value(docs), 6) as avg_gold, round(sum(p) / any_value(docs), 6) as avg_pred, round(sum(abs(p - g)) / any_value(docs), 6) as mae, round(sum(p - g) / any_value(docs), 6) as bias from u, n group by label""")
def ner_count_metrics(spark, d):
    df, pairs = _pairs(spark, d)
    return rounded(evaluate.entity_counts(df, pairs, "row_id"))


@query(f"select lang, round(coalesce(sum(length(coalesce(text, ''))) / nullif(sum({N_WORDS}), 0)::double, 0), 6) as fertility, round(avg(length(coalesce(text, ''))), 6) as mean_tokens, round(avg({N_WORDS}), 6) as mean_words, count(*) as n from documents group by lang")
def fertility(spark, d):
    x = docs_with_words(spark, d).select("lang", F.length(F.coalesce("text", F.lit(""))).alias("tokens"), "n_words")
    return rounded(evaluate.fertility(x, "lang", "tokens", "n_words"))


@query("with g as (select lang, avg(n_chars) as mean from documents group by lang) select lang, round(mean, 6) as mean from g union all select 'mean', round(avg(mean), 6) from g")
def dataset_mean_row(spark, d):
    g = read(spark, d, "documents").groupBy("lang").agg(F.avg("n_chars").alias("mean"))
    return rounded(evaluate.mean_row(g, "lang", ["mean"]))


@query(f"""with c as (select token, count(*) as n from (select unnest(regexp_extract_all(text, '{WORD_RE2}')) as token from documents) group by token)
(select token, n, 'top' as side from c order by n desc, token limit 20) union all (select token, n, 'bottom' from c order by n, token limit 20)""")
def token_frequency_topk(spark, d):
    return evaluate.token_frequency(read(spark, d, "documents").select(words(F.col("text")).alias("tokens")), "tokens")


@query("with v as (select distinct piece from token_pieces), t as (select distinct unnest(regexp_extract_all(lower(text), '[a-z]+')) as token from documents) select count_if(piece in (select token from t)) as used, count_if(piece not in (select token from t)) as unused, count(*) as size, round(count_if(piece in (select token from t)) / count(*)::double, 6) as coverage from v")
def vocabulary_coverage(spark, d):
    t = read(spark, d, "documents").where("text is not null").select(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)).alias("tokens"))
    return rounded(evaluate.vocabulary_coverage(t, "tokens", read(spark, d, "token_pieces").select(F.col("piece").alias("token"))))


@query("select label, row_number() over (order by label) - 1 as id from (select source as label from documents where source is not null union select subset from scored_docs where subset is not null)")
def label_ids(spark, d):
    return evaluate.label_ids(read(spark, d, "documents"), "source", read(spark, d, "scored_docs").select(F.col("subset").alias("source")))


@query("select row_id, " + ", ".join(f"(len(coalesce(medical_entities.{k}, [])) > 0)::int as {k}" for k in projection.ENTITY_LABELS) + " from rewrite_output")
def multi_hot(spark, d):
    """The entity types of each rewrite over the fixed list of types."""
    labels = F.array_compact(F.array(*[F.when(F.size(f"medical_entities.{k}") > 0, F.lit(k)) for k in projection.ENTITY_LABELS]))
    hot = read(spark, d, "rewrite_output").select("row_id", evaluate.multi_hot(labels, list(projection.ENTITY_LABELS)).alias("h"))
    return hot.select("row_id", *[F.col("h")[i].alias(k) for i, k in enumerate(projection.ENTITY_LABELS)])


@query(f"select count(*) as n_over, coalesce(sum({N_WORDS} - 512), 0)::bigint as n_lost from documents where {N_WORDS} > 512")
def over_limit(spark, d):
    return evaluate.over_limit(docs_with_words(spark, d), "n_words", 512)


@query(f"""with d as (select text, {N_WORDS} as n from documents) select 'before' as stage, count(*) as n_docs, sum(n)::bigint as n_words from d union all select 'after', count(*), sum(n)::bigint from (select distinct text, n from d)""")
def corpus_counts(spark, d):
    """Documents and words before and after exact deduplication."""
    x = read(spark, d, "documents").select("doc_id", "text")
    return stats.corpus_counts({"before": x, "after": dedup.exact(x, "text", "doc_id")}, "text")


@query("""select row_id, subset, annotated_at from (select *, row_number() over (partition by row_id order by annotated_at desc, ingested_at desc, subset desc) as rn from scored_docs) where rn = 1""")
def latest_delivery(spark, d):
    return latest(scored(spark, d), "row_id", ["annotated_at", "ingested_at"], ["subset", "annotated_at"])


# builders


def _squeezed(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^[{WS_RE2}]+|[{WS_RE2}]+$', '', 'g'), '[{WS_RE2}]+', ' ', 'g')"


@query(f"select row_id, concat_ws(' ', {_squeezed('term')}, {_squeezed('definition')}) as text from generate_output")
def text_pairs(spark, d):
    return read(spark, d, "generate_output").select("row_id", builders.build("x/pairs", [("pairs", lambda: builders.pair("term", "definition"))]).alias("text"))


@query("select row_id, array_to_string(synonyms, ' ') as text from generate_output")
def text_token_list(spark, d):
    return read(spark, d, "generate_output").select("row_id", builders.token_list("synonyms").alias("text"))


@query("""select row_id, term || '   ' || definition as segments, ' ' || term || '  (1) ' || definition || '  (2) ' || text || '  (3) ' || output || ' ' as numbered, lower(output) as lowered, array_to_string(synonyms, ' ') as tokens from generate_output""")
def evaluation_texts(spark, d):
    g = read(spark, d, "generate_output")
    names = {"source": "term", "cible": "definition", "cible_1": "definition", "cible_2": "text", "cible_3": "output", "clinical_case": "output", "tokens": "synonyms"}
    g = g.select("row_id", *[F.col(old).alias(new) for new, old in names.items()])
    at = builders.evaluation_text
    return g.select("row_id", at("/x/deft2020/data/local_hf_task_1").alias("segments"), at("/x/deft2020/data/local_hf_task_2").alias("numbered"), at("/x/diamed/data/local_hf_None").alias("lowered"), at("/x/essai/data/local_hf_pos").alias("tokens"))


@query("select source, case when n <= 2 then 'a' else 'b' end as part from (select source, ntile(4) over (order by source) as n from (select distinct source from documents where source is not null))")
def model_assignment(spark, d):
    df = read(spark, d, "documents").where("source is not null")
    return builders.assign_in_order(df, "source", ["a", "a", "b", "b"])


@query("select row_id, round(coalesce((" + " + ".join(f"coalesce(list_sum(list_transform(medical_entities.{k}, lambda x: length(x))), 0)" for k in projection.ENTITY_LABELS) + ")::double / nullif(length(text), 0), 0), 6) as density from rewrite_output")
def density_by_extracted(spark, d):
    return rounded(read(spark, d, "rewrite_output").select("row_id", builders.extracted_density(F.col("medical_entities"), F.col("text")).alias("density")))


@query(f"""with v as (select genre, case when text is not null then {_WORDS_OF('text')} end as b, case when output is not null then {_WORDS_OF('output')} end as a from extract_input)
select genre, round(quantile_cont(b, 0.5), 6) as median_before, round(quantile_cont(a, 0.5), 6) as median_after, count(b) as n_before, count(a) as n_after from v where genre is not null and coalesce(a, b) is not null group by genre""")
def paired_medians(spark, d):
    n = lambda c: F.when(F.col(c).isNotNull(), word_count(F.col(c)))
    return rounded(builders.paired_medians(read(spark, d, "extract_input").select("genre", n("text").alias("before"), n("output").alias("after")), "genre", "before", "after"))


@query("select distinct lang from extract_input where lang is not null and lang not in (select lang from documents where lang is not null)")
def labels_missing(spark, d):
    return builders.labels_missing(read(spark, d, "documents"), read(spark, d, "extract_input"), "lang")


@query(f"select name, round(avg(case when {EDU} between 1 and 5 then {EDU} end), 6) as mean_{EDU}, count(case when {EDU} between 1 and 5 then 1 end) as n_{EDU} from mds_input group by name")
def judge_summary(spark, d):
    return rounded(builders.judge_summary(shards(spark, d), "name", [EDU]))


@query("select count(*) + count_if(len(synonyms) > 1) as n from generate_output where synonyms is not null")
def augmented_count(spark, d):
    g = read(spark, d, "generate_output").where("synonyms is not null").select("row_id", "synonyms")
    return builders.augment_order(g, "synonyms", "row_id").agg(F.count(F.lit(1)).alias("n"))


@query("select doc_id, len(regexp_extract_all(text, '[\\p{L}\\p{M}\\p{N}_]+|[^\\p{L}\\p{M}\\p{N}_" + WS_RE2 + "]'))::int as n from documents where text is not null")
def ner_token_count(spark, d):
    return read(spark, d, "documents").where("text is not null").select("doc_id", F.size(regular_words(F.col("text"))).alias("n"))


@query("select doc_id, w.i::int as position, w.token, v.token_id from (select doc_id, unnest(list_zip(range(0, len(t)), t)) as z, z[1] as i, z[2] as token from (select doc_id, regexp_extract_all(text, '" + WORD_RE2 + "') as t from documents)) w left join (select piece, min(token_id) as token_id from token_pieces group by piece) v on v.piece = w.token")
def token_id_map(spark, d):
    docs = read(spark, d, "documents").select("doc_id", words(F.col("text")).alias("tokens"))
    return evaluate.token_ids(docs, "doc_id", "tokens", read(spark, d, "token_pieces"), "piece")


@query(f"select doc_id, array_to_string(regexp_extract_all(text, '{WORD_RE2}')[1:2048], ' ') as prompt, len(regexp_extract_all(text, '{WORD_RE2}')[1:2048])::varchar as output from documents where text is not null")
def generate_plugin(spark, d):
    """Texts cut to half of a context of 4,096 tokens, and a generator that answers with their number of words."""
    df = read(spark, d, "documents").where("text is not null").select("doc_id", inference.head_tokens("text", 4096 // 2).alias("prompt"))
    return inference.generate(df, "prompt", lambda: lambda prompts_: [str(len(p.split())) for p in prompts_])


@query("select row_id, 'm/a' as model, 0.7::double as temperature, 0.9::double as top_p, 512 as max_tokens, genre from rewrite_output")
def generation_config(spark, d):
    c = builders.model_config("m/a", 0.7, 0.9, 512).alias("c")
    return read(spark, d, "rewrite_output").select("row_id", c, "genre").select("row_id", "c.*", "genre")


@query("select doc_id, text from documents")
def valid_text(spark, d):
    return read(spark, d, "documents").select("doc_id", builders.valid_utf8(F.col("text")).alias("text"))


@query()
def language_kept(spark, d):
    """Documents that the scorer finds to be French with a share of a half or more."""
    return quality.language_filter(quality.identify(read(spark, d, "documents").select("doc_id", "text"))).select("doc_id", "language")


@query()
def shuffled_blocks(spark, d):
    return read(spark, d, "generate_output").where("synonyms is not null").select("row_id", prompts.shuffled_block(F.col("synonyms"), F.col("row_id")).alias("block"))


# sinks and sources: what was written comes back


def _aside(spark) -> str:
    return f"{shared_dir(spark)}/{uuid.uuid4().hex}"


_GENERATED = "select row_id, gen_name, term, synonyms, output from generate_output"


def _generated(spark, d):
    return read(spark, d, "generate_output").select("row_id", "gen_name", "term", "synonyms", "output")


@query(_GENERATED)
def roundtrip_jsonl(spark, d):
    path = f"{_aside(spark)}.jsonl"
    sinks.write_jsonl(_generated(spark, d), path)
    return readers.scan(spark, path, _generated(spark, d).schema)


@query(_GENERATED)
def roundtrip_parquet_shards(spark, d):
    path = _aside(spark)
    sinks.write_shards(_generated(spark, d), path, 500)
    return readers.scan(spark, path)


@query("select subset, count(*) as n from (select 'a' as subset from generate_output union all select 'b' from rewrite_output) group by subset")
def roundtrip_joined_paths(spark, d):
    got = readers.scan_many(spark, f"{d}/generate_output.parquet+{d}/rewrite_output.parquet", tag=True)
    return got.groupBy(F.when(F.col("subset").contains("generate"), "a").otherwise("b").alias("subset")).agg(F.count(F.lit(1)).alias("n"))


@query(f"select row_id, replace(lower({CLASS}), ' ', '_') as label_slug from mds_input where {CLASS} is not null and {CLASS} <> ''")
def roundtrip_by_label(spark, d):
    path = _aside(spark)
    sinks.write_by_label(shards(spark, d).where(f"{CLASS} <> ''").select("row_id", CLASS), CLASS, path)
    return spark.read.parquet(path).select("row_id", "label_slug")


@query("select row_id, case when num_words >= 10 then null else 'short' end as reason from mds_input")
def roundtrip_reasons(spark, d):
    kept, dropped = _aside(spark), _aside(spark)
    df = shards(spark, d).select("row_id", F.when(F.col("num_words") >= 10, F.lit(None)).otherwise(F.lit("short")).alias("reason"))
    sinks.write_reasons(df, "reason", kept, dropped)
    back = spark.read.schema("row_id long, reason string").json(dropped)
    return spark.read.parquet(kept).select("row_id", F.lit(None).cast("string").alias("reason")).unionByName(back)


@query("select row_id, name from mds_input")
def roundtrip_batches(spark, d):
    """Written in four batches, after a run that broke off behind the first."""
    path, df = _aside(spark), shards(spark, d).select("row_id", "name")
    seen = []

    def once(part):
        if seen:
            raise RuntimeError("broken off")
        seen.append(1)
        return part

    try:
        sinks.write_batches(df, "row_id", 4, path, once)
    except RuntimeError:
        pass
    if sinks.write_batches(df, "row_id", 4, path) != 3:
        raise AssertionError("three batches were left")
    return reduce(lambda a, b: a.unionByName(b), [spark.read.parquet(f"{path}/batch={b}") for b in range(4)]).select("row_id", "name")


@query("select split, count(*) as n, sum(length(text))::bigint as chars from (select coalesce(text, '') as text, case when doc_id % 20 = 0 then 'validation' else 'train' end as split from documents) group by split")
def roundtrip_training_shards(spark, d):
    path = _aside(spark)
    df = read(spark, d, "documents").select("text", F.when(F.col("doc_id") % 20 == 0, "validation").otherwise("train").alias("split"))
    index = sinks.write_training_shards(df, path, rows=400)
    back = spark.read.schema("text string, split string").json([f"{path}/split={s}/{f['file']}" for s, v in index.items() for f in v["shards"]])
    back = back.withColumn("split", F.regexp_extract(F.input_file_name(), "split=([a-z]+)", 1))
    return back.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))


@query("select name, parquet_idx, n_docs, n_words from (select coalesce(name, 'null') as name, parquet_idx, count(*) as n_docs, coalesce(sum(num_words), 0)::bigint as n_words from mds_input group by name, parquet_idx union all select coalesce(name, 'null'), -1, count(*), coalesce(sum(num_words), 0)::bigint from mds_input group by name union all select 'total', -1, count(*), coalesce(sum(num_words), 0)::bigint from mds_input)")
def roundtrip_summary(spark, d):
    path = _aside(spark)
    named = shards(spark, d).withColumn("name", F.coalesce("name", F.lit("null")))
    sinks.write_summary(stats.rollup_counts(named, "name", "parquet_idx", "num_words"), "name", "parquet_idx", path)
    return spark.read.schema("name string, parquet_idx int, n_docs long, n_words long").json(path)


@query("select doc_id::varchar as text from documents")
def roundtrip_text(spark, d):
    path = f"{_aside(spark)}.txt"
    sinks.write_text(read(spark, d, "documents").select(F.col("doc_id").cast("string").alias("text")), path, shards=3)
    return readers.scan(spark, path)


@query("select line, text from (select doc_id, row_number() over (order by doc_id) - 1 as line, doc_id::varchar as text from documents where doc_id % 3 > 0) where line >= 5")
def roundtrip_lines(spark, d):
    path = f"{_aside(spark)}.txt"
    sinks.write_text(read(spark, d, "documents").where("doc_id % 3 > 0").orderBy("doc_id").coalesce(1).select(F.concat(F.lit(" "), F.col("doc_id").cast("string")).alias("text")), path)
    return readers.lines(spark, path, skip=5).select("line", "text")
