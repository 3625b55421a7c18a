"""op12: prefix trie of the conversations table, with its SQL."""

from .common import read
from .prefix_trie import prefix_trie


def op12_prefix_trie(spark, sf_dir):
    return prefix_trie(read(spark, sf_dir, "conversations"))


OP12_SQL = """
with t as (
  select conv_id as c, md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) as dig, turn,
         octet_length(encode(coalesce(text, ''))) as size
  from conversations where conv_id is not null),
o as (select *, row_number() over (partition by c order by turn nulls first, dig) as pos from t),
ids as (select distinct c, c - c % 5 as head from o),
hs as (
  select c, head, xor(list_reduce(
    list_prepend(4294967295::bigint, list_transform(range(1, length(c::varchar) + 1), lambda i: ord(substr(c::varchar, i, 1))::bigint)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda v, _: case when v % 2 = 1 then xor(v // 2, 3988292384) else v // 2 end)
  ), 4294967295) % 9 as h
  from ids),
g as (select hs.*, least(h, coalesce(n, 0)) as given from hs left join (select c as head, count(*) as n from o group by 1) using (head)),
rebuilt as (
  select g.c, o.pos, o.dig, o.size from g join o on o.c = g.head and o.pos <= g.given
  union all select g.c, o.pos - g.h + g.given, o.dig, o.size from g join o on o.c = g.c and o.pos > g.h),
seqs as (select ids.c, coalesce(list(dig order by pos) filter (dig is not null), []) as path, coalesce(list(size order by pos) filter (dig is not null), []) as sizes
  from ids left join rebuilt using (c) group by 1),
m as (select c, d, array_to_string(path[1:d], '') as node, array_to_string(path[1:d-1], '') as parent, len(path) = d as ended,
        case when d > 0 then sizes[d] else 0 end as size
  from (select *, unnest(range(0, len(path) + 1)) as d from seqs)),
n as (select d, node, any_value(parent) as parent, min(c) as conv_id, count(*) as n_convs, any_value(size) as size,
        sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (ended), '')) as ends from m group by 1, 2),
kids as (select d - 1 as d, parent as node, count(*) as n_children from n where d > 0 group by 1, 2),
own as (select n.*, coalesce(n_children, 0) as n_children from n left join kids using (d, node)),
-- each node under every node on the path of its least conversation
below as (select a.d, a.node, count(*) filter (b.n_children = 0) as n_leaves, sum((b.n_convs - 1) * b.size) as saved
  from own b join m a on a.c = b.conv_id and a.d <= b.d group by 1, 2)
select own.conv_id, own.d::bigint as depth, case when own.d > 0 then up.conv_id end as parent_conv_id, own.n_convs::bigint as n_convs,
  own.n_children::bigint as n_children, n_leaves::bigint as n_leaves, saved::bigint as saved_tokens, own.ends as ends_sha256
from own join below using (d, node) left join own up on up.d = own.d - 1 and up.node = own.parent
"""
