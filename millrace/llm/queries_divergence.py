"""op11: divergence of the sources of the documents table, with its SQL."""

from .common import read
from .divergence import audit


def op11_source_divergence(spark, sf_dir):
    return audit(read(spark, sf_dir, "documents").select("text", "lang", "source"))


OP11_SQL = r"""
with d as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as words
  from documents),
w as (select r, lang, source, unnest(words) as term from d),
kept as (select lang, term, count(*) as total from w group by all having count(distinct r) >= 3),
c as (select lang, source, term, count(*) as n from w semi join kept using (lang, term) group by all),
v as (select lang, count(*) as v, sum(total) as lang_n from kept group by all),
g as (
  select lang, source, coalesce(s.n, 0)::hugeint as n, coalesce(v.v, 0)::hugeint as v, coalesce(v.lang_n, 0)::hugeint as lang_n
  from (select distinct lang, source from d)
  left join (select lang, source, sum(n) as n from c group by all) s using (lang, source) left join v using (lang)),
p as (
  select lang, source, term, coalesce(c.n, 0) as n, 1 + (1000000000::hugeint * (coalesce(c.n, 0) + 1)) // (g.n + g.v) as p,
         1 + (1000000000::hugeint * (kept.total + 1)) // (g.lang_n + g.v) as q
  from g join kept using (lang) left join c using (lang, source, term)),
pairs as (
  select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) as value
  from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
found as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(pairs.value, 0)::bigint as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
  left join pairs on pairs.lang = a.lang and pairs.source = a.source and pairs.item = b.source
  union all
  select lang, source, 'term', term, (((p - q) * (p - q)) // q)::bigint from p where n > 0 and p > q)
select lang, source, part, item, value, rank::integer as rank
from (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from found)
where part = 'pair' or rank <= 200
"""
