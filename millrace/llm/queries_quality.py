"""op6: quality measures and verdicts of the documents table, with their SQL."""

from .common import read
from .quality import estimate, measures


def op6_quality_rules(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    rows = measures(docs, estimate(docs))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


OP6_SQL = r"""
with d as (
  select row_number() over () as r, doc_id, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from documents),
runs as (
  select r, i, w[i:i+4] as run
  from (select r, w, unnest(range(1, greatest(len(w) - 3, 1))) as i from d where len(w) >= 5)),
twice as (select r, i from (select r, i, count(*) over (partition by r, run) as n from runs) where n > 1),
repeated as (
  select r, count(distinct i + k) as n_repeat_words from twice, (select unnest(range(5)) as k) group by r),
m as (
  select doc_id, t, len(lines) as n_lines, len(w)::bigint as n_words,
         (length(t) - length(regexp_replace(t, '[^\x20\x09-\x0D]', '', 'g')))::bigint as word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
         (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
         coalesce(n_repeat_words, 0)::bigint as n_repeat_words
  from d left join repeated using (r)),
b as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not (base_failed or 10 * n_symbols > n_words or word_chars < 2 * n_words or word_chars > 15 * n_words
            or 2 * n_dup_lines > n_lines or 10 * length(regexp_replace(t, '[^\p{Lu}]', '', 'g')) > 4 * length(t)
            or 2 * length(regexp_replace(t, '[^0-9]', '', 'g')) > length(t)) as kept
from b
"""
