"""DuckDB statements for the pN_ queries that SQL can express. The rest are tested against brute force or round trips."""

from __future__ import annotations

from lexmill.functions.text import WORD_RE2, WS_RE2

_STRIP = rf"regexp_replace(%s, '^[{WS_RE2}]+|[{WS_RE2}]+$', '', 'g')"
_WORDS = f"len(regexp_extract_all(coalesce(text, ''), '{WORD_RE2}'))"


def _key(col: str) -> str:
    return f"nullif(replace(lower(regexp_replace({_STRIP % col}, '[{WS_RE2}]+', ' ', 'g')), ' and ', ' & '), '')"


P1_FOUND = f"""
with v as (
  select lower({_STRIP % 'subset'}) as subset, {_WORDS} as words,
         row_number() over (partition by row_id order by annotated_at desc, ingested_at desc) as rn
  from scored_docs
), w as (select subset, sum(words) as words from v where rn = 1 group by subset),
t as (select sum(words) as total from w)
select distinct m.subset from mix_targets m left join w on w.subset = lower({_STRIP % 'm.subset'}), t
where coalesce(w.words, 0) * m.max_repeats < m.target_share * t.total
"""

P1_SIZES = f"""
with v as (
  select lower({_STRIP % 'subset'}) as subset, {_WORDS} as words,
         row_number() over (partition by row_id order by annotated_at desc, ingested_at desc) as rn
  from scored_docs
), w as (select subset, sum(words) as words from v where rn = 1 group by subset),
t as (select sum(words) as total from w),
r as (select m.subset, coalesce(w.words, 0)::bigint as words, m.max_repeats, coalesce(w.words, 0) * m.max_repeats >= m.target_share * t.total as reachable
      from mix_targets m left join w on w.subset = lower({_STRIP % 'm.subset'}), t)
select subset, words, reachable, case when not reachable then words * max_repeats end as all_words, true as near, true as within from r
"""

P4 = """
with v as (
  select *, row_number() over (partition by row_id order by scored_at desc, ingested_at desc) as rn from mds_input
), l as (
  select s.slice_id, v.row_id, s.keep_fraction,
         case s.score_field when 'medical_entity_density' then v.medical_entity_density::double else v.edu_quality_normalized_score::double end as score
  from v join keep_slices s on s.slice_value = case s.slice_field when 'name' then v.name else v.health_domain_classification_best_class end
  where rn = 1
), k as (
  select *, count(*) over (partition by slice_id) as n, count(*) over (partition by slice_id order by score desc) as above
  from l where score >= 0 and not isnan(score)
), c as (select slice_id, max(score) as cutoff from k where above >= keep_fraction::decimal(18, 9) * n group by slice_id)
"""
P4_FOUND = P4 + "select distinct slice_id, row_id from k join c using (slice_id) where score >= cutoff"
P4_CUTOFFS = P4 + """
select s.slice_id, count(k.row_id) as n_scored, greatest(1, ceil(any_value(s.keep_fraction)::decimal(18, 9) * count(k.row_id)))::bigint * (count(k.row_id) > 0)::bigint as wanted,
       any_value(c.cutoff) as cutoff, count(k.row_id) filter (score >= cutoff) as n_kept,
       count(k.row_id) filter (score >= cutoff) / nullif(count(k.row_id), 0)::double as kept_fraction
from keep_slices s left join k using (slice_id) left join c using (slice_id) group by s.slice_id
"""

_CUT = f"""
with recursive words as (
  select distinct unnest(regexp_extract_all(text, '{WORD_RE2}')) as word from %s
), cut(word, rest, n) as (
  select word, word, 0 from words
  union all
  select word, substr(rest, 1 + case
    when length(rest) >= 8 and substr(rest, 1, 8) in (select piece from token_pieces) then 8
    when length(rest) >= 7 and substr(rest, 1, 7) in (select piece from token_pieces) then 7
    when length(rest) >= 6 and substr(rest, 1, 6) in (select piece from token_pieces) then 6
    when length(rest) >= 5 and substr(rest, 1, 5) in (select piece from token_pieces) then 5
    when length(rest) >= 4 and substr(rest, 1, 4) in (select piece from token_pieces) then 4
    when length(rest) >= 3 and substr(rest, 1, 3) in (select piece from token_pieces) then 3
    when length(rest) >= 2 and substr(rest, 1, 2) in (select piece from token_pieces) then 2
    else 1 end), n + 1
  from cut where rest <> ''
), size as (select word, max(n) as n from cut group by word)
"""

P3_ROWS = _CUT % "scored_docs" + f""", v as (
  select *, row_number() over (partition by row_id order by annotated_at desc, ingested_at desc) as rn from scored_docs
), t as (
  select row_id, unnest(regexp_extract_all(text, '{WORD_RE2}')) as word from v where rn = 1
), r as (
  select v.row_id, any_value({_key('subset')}) as subset, any_value(nullif(regexp_extract(lower(trim(lang)), '^([a-z]+)', 1), '')) as lang,
         any_value({_key('health_domain_classification_best_class')}) as class, any_value(c.n) as n_tokens
  from v left join (select row_id, sum(n) as n from t join size using (word) group by row_id) c using (row_id) where rn = 1 group by v.row_id
)
"""
P3_ROW_TOKENS = P3_ROWS + "select row_id, coalesce(n_tokens, 0)::bigint as n_tokens from r"
P3_TOKEN_BUDGET = P3_ROWS + """, g as (
  select coalesce(subset, '(missing)') as subset, coalesce(lang, '(missing)') as lang, coalesce(class, '(missing)') as class, coalesce(n_tokens, 0) as n_tokens from r
)
select case grouping(subset, lang, class) when 0 then 'all' when 3 then 'subset' when 5 then 'lang' when 6 then 'class' else 'total' end as slice,
       subset, lang, class, count(*)::bigint as n_docs, coalesce(sum(n_tokens), 0)::bigint as n_tokens, round(sum(n_tokens) / nullif(count(*), 0)::double, 6) as mean_tokens
from g group by grouping sets ((subset, lang, class), (subset), (lang), (class), ())
"""

P5_FOUND = r"""
with s as (
  select row_id, text, list_max([length(x) for x in string_split_regex(regexp_replace(text, '([.!?;…])(\s|[\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}])', E'\1\n', 'g'), '[\n\r]')]) as run
  from split_input where length(text) > 6000
)
select distinct row_id, 'oversized' as kind from s union select distinct row_id, 'unbroken' from s where run > 6000
"""

P5_TILING = "select row_id, length(text)::bigint as n_chars, 0::bigint as n_over, 0::bigint as n_wrong from (select distinct row_id, text from split_input) where text is not null"

P7_TOKENS = _CUT % "documents" + f""", t as (select doc_id, unnest(regexp_extract_all(text, '{WORD_RE2}')) as word from documents)
select doc_id, sum(n)::bigint as n_tokens from t join size using (word) group by doc_id
"""
P7_FILL = _CUT % "documents" + f""", t as (select unnest(regexp_extract_all(text, '{WORD_RE2}')) as word from documents)
select sum(n)::bigint as n_tokens, 0::bigint as n_wrong, true as tight from t join size using (word)
"""
P7_FOUND = _CUT % "documents" + f""", t as (select doc_id, unnest(regexp_extract_all(text, '{WORD_RE2}')) as word from documents)
select doc_id from t join size using (word) group by doc_id having sum(n) > 2048
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": P1_FOUND, "p1_sizes": P1_SIZES, "p5_tiling": P5_TILING, "p7_tokens": P7_TOKENS, "p7_fill": P7_FILL, "p3_token_budget": P3_TOKEN_BUDGET, "p3_row_tokens": P3_ROW_TOKENS, "p4_found": P4_FOUND,
        "p4_cutoffs": P4_CUTOFFS, "p5_found": P5_FOUND, "p7_found": P7_FOUND,
    }
