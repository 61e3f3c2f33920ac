"""One query for each operator of this subpackage, over whole tables, and its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, decontaminate, filter_audit, language_id, line_dedup, lm, mixing, prefix_trie, quality, token_counts, topk, toxicity
from .common import read
from .near_dup import SketchSpec, near_duplicates

LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORD = r"[^\x20\x09-\x0D]+"


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), SketchSpec(words=3, percent=85))


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(read(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.report(read(spark, sf_dir, "conversations"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.report(read(spark, sf_dir, "embeddings"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.report(read(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(read(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(read(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.report(read(spark, sf_dir, "conversations"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.report(read(spark, sf_dir, "documents"))


OP1 = f"""
with recursive w as (select doc_id, regexp_extract_all({LOWER.format("text")}, '{WORD}') as ws from documents),
d as (select doc_id, case when len(ws) >= 3 then list_distinct(list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' ')))
  when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end as sh from w),
n as (select doc_id, len(sh) as n from d),
s as (select doc_id, unnest(sh) as g from d),
common as (select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
e as (select x, y from common join n p on p.doc_id = x join n q on q.doc_id = y where 100 * c >= 85 * (p.n + q.n - c)),
both_ways as (select x, y from e union all select y, x from e),
r(x, y) as (select doc_id, doc_id from n union select r.x, b.y from r join both_ways b on r.y = b.x),
least as (select x, min(y) as component_id from r group by x)
select doc_id, n as n_shingles, component_id, doc_id = component_id as kept from n join least on x = doc_id
"""

HIT_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OP4 = f"""
with d as (select row_number() over () as row, doc_id, regexp_extract_all({LOWER.format("text")}, '{HIT_WORD}') as ws, regexp_split_to_array({LOWER.format("text")}, '{HIT_WORD}') as gaps from documents),
b as (select item_id, regexp_extract_all({LOWER.format("text")}, '{HIT_WORD}') as ws from benchmark),
w as (select distinct item_id, least(10, len(ws)) as k, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') as win
  from (select item_id, ws, unnest(range(1, greatest(1, len(ws) - 9) + 1)) as i from b where len(ws) > 0)),
k as (select distinct k from w),
p as (select row, k, i, array_to_string(ws[i:i + k - 1], ' ') as win from (select row, ws, k, unnest(range(1, len(ws) - k + 2)) as i from d, k where len(ws) >= k)),
m as (select row, i, p.k, item_id from p join w using (k, win)),
h as (select row, count(distinct pos) as n_hit, min(pos) as lo, max(pos) as hi from (select row, unnest(range(i, i + k)) as pos from m) group by 1),
t as (select row, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct row, item_id::varchar as item from m where item_id is not null) group by 1)
select doc_id, len(ws) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated,
  case when lo is not null then list_sum(list_transform(gaps[1:lo], lambda x: length(x))) + coalesce(list_sum(list_transform(ws[1:lo - 1], lambda x: length(x))), 0) end::bigint as first_char,
  case when hi is not null then list_sum(list_transform(gaps[1:hi], lambda x: length(x))) + list_sum(list_transform(ws[1:hi], lambda x: length(x))) end::bigint as end_char
from d left join h using (row) left join t using (row)
"""

OP5 = """
with t as (select conv_id, turn, coalesce(role, 'unknown') as role, coalesce(text, '') as text from conversations),
c as (select conv_id, list({'r': role, 't': text} order by turn) as ts, string_agg('<|' || role || '|>' || chr(10) || text || chr(10) || '<|end|>' || chr(10), '' order by turn) as doc from t group by 1),
g as (select ts, min(conv_id) as conv_id, count(*) as logged, min(doc) as doc from c group by ts)
select conv_id, len(ts) as n_turns, logged, length(doc) as n_chars, sha256(doc) as text_sha256 from g a
where not exists (select 1 from g b where len(b.ts) > len(a.ts) and b.ts[1:len(a.ts)] = a.ts)
"""

OP6 = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as q from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as query_id, b.vec_id, list_inner_product(a.q, b.q)::bigint as score from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= 5
"""

OP8 = f"""
with d as (select row_number() over () as row, doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents),
l as (select row, doc_id, unnest(ls) as line, unnest(range(len(ls))) as pos from d),
k as (select *, {LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} as key from l),
n as (select key, count(distinct doc_id) + max((doc_id is null)::int) as n, max(doc_id) as top from k where length(key) >= 20 group by 1),
f as (select row, doc_id, pos, line, coalesce(n >= 3, false) and doc_id is distinct from top as lost from k left join n using (key))
select doc_id, count(*) as n_lines, count(*) filter (lost) as n_dropped, sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not lost), '')) as kept_sha256 from f group by row, doc_id
"""


OP11 = f"""
with d as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as text, min(doc_id) over (partition by coalesce(text, '')) as least from documents),
w as (select *, regexp_extract_all(text, '{WORD}') as ws from d),
l as (select doc_id, max((coalesce(quality, 0) = 1)::int) as q, max((coalesce(toxic, 0) = 1)::int) as t from labels group by 1),
m as (select part, coalesce(q, 0) as q, coalesce(t, 0) as t, (len(ws) < 50)::int as a, (100 * len(list_distinct(ws)) < 65 * len(ws))::int as b, (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text))::int as c,
  regexp_matches(text, '[#$%&*|]')::int as d, coalesce(doc_id > least, false)::int as e from w left join l using (doc_id)),
g as (select part, q, t, map {{'A': a, 'B': b, 'C': c, 'D': d, 'E': e}} as mask, a + b + c + d + e as failed, count(*) as n from m group by all),
x as (select unnest(['A', 'B', 'C', 'D', 'E']) as f),
o as (select concat(p.f, q.f, r.f, s.f, t.f) as filter_order from x p, x q, x r, x s, x t where len(list_distinct([p.f, q.f, r.f, s.f, t.f])) = 5),
st as (select filter_order, unnest(range(1, 6))::int as step from o),
k as (select filter_order, step, filter_order[step] as f, string_split(filter_order[1:step - 1], '') as before from st),
c as (select part, filter_order, step, k.f as filter, n, q, t, failed, mask[k.f] as fails, coalesce(list_max(list_transform(list_filter(before, lambda y: y <> ''), lambda y: mask[y])), 0) as gone from g, k),
s as (select part, filter_order, step, filter, sum(n) filter (fails = 0 and gone = 0) as kept, sum(n) filter (fails = 1 and gone = 0) as removed, sum(n) filter (fails = 1 and gone = 1) as redundant, sum(n) filter (fails = 1 and failed = 1) as unique_fails,
  sum(n) filter (fails = 1 and gone = 0 and q = 1) as good_lost, sum(n) filter (fails = 1 and gone = 0 and t = 1) as toxic_lost from c group by all)
select part, filter_order, step, coalesce(kept, 0)::bigint as kept, coalesce(removed, 0)::bigint as removed, coalesce(redundant, 0)::bigint as redundant, coalesce(unique_fails, 0)::bigint as unique_fails,
  coalesce(good_lost, 0)::bigint as good_lost, coalesce(toxic_lost, 0)::bigint as toxic_lost, coalesce(sum(removed) over (partition by part, filter), 0)::bigint as shapley from s
"""


OP12 = """
with t as (select conv_id as c, turn, {'r': coalesce(role, ''), 't': coalesce(text, '')} as x from conversations where conv_id is not null),
o as (select c, list(x order by turn nulls first) as ts, list_transform(range(1, length(c::varchar) + 1), lambda i: ord((c::varchar)[i])::bigint) as digits from t group by c),
h as (select c, ts, c - c % 100 as g, xor(list_reduce(list_prepend(4294967295, digits), lambda crc, d: list_reduce(list_prepend(xor(crc, d), range(8)), lambda y, k: xor(y >> 1, (y & 1) * 3988292384))), 4294967295) % 6 as h from o),
r as (select a.c, list_concat(coalesce(b.ts[1:a.h], []), a.ts[a.h + 1:]) as ts from h a left join o b on b.c = a.g),
p as (select c, ts, unnest(range(0, len(ts) + 1)) as depth from r),
n as (select ts[1:depth] as pre, depth, min(c) as conv_id, count(*) as n_convs, sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (depth = len(ts)), '')) as ends_sha256 from p group by 1, 2),
k as (select a.pre, a.depth, count(b.pre) as n_children from n a left join n b on b.depth = a.depth + 1 and b.pre[1:a.depth] = a.pre group by 1, 2),
s as (select a.pre, a.depth, count(*) filter (n_children = 0) as n_leaves, sum((b.n_convs - 1) * coalesce(length(b.pre[b.depth].t), 0))::bigint as saved_tokens
  from n a join n b on b.depth >= a.depth and b.pre[1:a.depth] = a.pre join k on k.depth = b.depth and k.pre = b.pre group by 1, 2)
select a.conv_id, a.depth, b.conv_id as parent_conv_id, a.n_convs, n_children, n_leaves, saved_tokens, a.ends_sha256
from n a join k on k.depth = a.depth and k.pre = a.pre join s on s.depth = a.depth and s.pre = a.pre left join n b on b.depth = a.depth - 1 and a.pre[1:b.depth] = b.pre
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (op1_minhash, op2_lm_score, op3_toxicity, op4_decontaminate, op5_chat_format, op6_topk, op7_token_counts, op8_line_dedup, op9_mixing, op10_quality, op11_filter_audit, op12_prefix_trie, op13_language_id)
    return {q.__name__: q for q in every}


def oracle_sql() -> dict[str, str]:
    return {"op1_minhash": OP1, "op4_decontaminate": OP4, "op5_chat_format": OP5, "op6_topk": OP6, "op8_line_dedup": OP8, "op11_filter_audit": OP11, "op12_prefix_trie": OP12}
