"""The queries that SQL can express, in plain SQL for a check by another engine.

Tokenizers, models and approximate searches have no SQL form; tests compare those with brute force.
"""

from __future__ import annotations

ORACLES = {
    "op6_minhash": r"""
with recursive w as (
  select doc_id, list_filter(
    string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws
  from documents),
shingles as (
  select doc_id, unnest(list_distinct(case when len(ws) = 0 then [] when len(ws) < 5 then [ws]
    else list_transform(range(1, len(ws) - 3), lambda i: ws[i:i + 4]) end)) as shingle
  from w),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
pairs as (
  select a.doc_id as a, b.doc_id as b, count(*) as common
  from shingles a join shingles b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all),
links as (
  select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * common >= 85 * (x.n + y.n - common)),
edges as (select a, b from links union all select b, a from links),
reached(doc_id, other) as (
  select a, b from edges union select r.doc_id, l.b from reached r join edges l on l.a = r.other),
least as (select doc_id, min(other) as other from reached group by doc_id)
select doc_id, coalesce(n, 0) as n_shingles, least(doc_id, coalesce(other, doc_id)) as component_id,
  doc_id <= coalesce(other, doc_id) as kept
from documents left join sizes using (doc_id) left join least using (doc_id)""",
    "op9_suffix": """
with d as (
  select doc_id, hex(encode(coalesce(text, ''))) as h,
    octet_length(encode(coalesce(text, ''))) as n_bytes from documents),
windows as (
  select doc_id, spot, md5(substr(h, 2 * spot + 1, 200)) as k
  from (select doc_id, h, unnest(range(0, n_bytes - 99)) as spot from d where n_bytes >= 100)),
again as (
  select doc_id, spot from windows
  qualify row_number() over (partition by k order by doc_id, spot) > 1),
marked as (
  select doc_id, spot, case when spot <= lag(spot) over (partition by doc_id order by spot) + 100
    then 0 else 1 end as opens from again),
numbered as (
  select doc_id, spot, sum(opens) over (partition by doc_id order by spot) as span from marked),
spans as (
  select doc_id, span, min(spot) as start_at, max(spot) + 100 as end_at from numbered group by all),
edges as (
  select doc_id, h, n_bytes, list_prepend(0, coalesce(ends, [])) as starts,
    list_append(coalesce(begins, []), n_bytes) as stops, removed, n_spans
  from d left join (
    select doc_id, list(start_at order by start_at) as begins, list(end_at order by start_at) as ends,
      sum(end_at - start_at) as removed, count(*) as n_spans from spans group by doc_id)
  using (doc_id))
select doc_id, n_bytes, cast(coalesce(removed, 0) as bigint) as n_removed,
  coalesce(n_spans, 0) as n_spans,
  sha256(unhex(list_aggregate(list_transform(range(1, len(starts) + 1), lambda i:
    substr(h, 2 * starts[i] + 1, 2 * (stops[i] - starts[i]))), 'string_agg', ''))) as kept_sha256
from edges""",
    "op11_lexical": r"""
with words as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from documents),
postings as (select doc_id, term, count(*) as tf from words group by all),
lengths as (select doc_id, sum(tf)::bigint as n from postings group by doc_id),
totals as (select count(*) as docs, sum(n)::bigint as terms from lengths),
normalised as (select doc_id, 100 - 50 + (50 * n * docs) // terms as m from lengths, totals),
weights as (
  select term, cast(floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double)) as bigint) as w
  from (select term, count(*) as df from postings group by term), totals),
queries as (
  select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark),
scored as (
  select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::bigint as score
  from queries join weights using (term) join postings using (term) join normalised using (doc_id)
  group by item_id, doc_id having score > 0)
select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer)
  as rank, doc_id, score
from scored qualify rank <= 50""",
    "op12_linededup": r"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as spot
  from documents),
keyed as (
  select doc_id, spot, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12)
    || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from lines),
common as (
  select k from keyed where length(k) >= 1 group by k having count(distinct doc_id) >= 10),
marked as (
  select doc_id, spot, line, k in (select k from common) as gone from keyed)
select doc_id, count(*) as n_lines, cast(count(*) filter (gone) as bigint) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by spot) filter (not gone), '')) as kept_sha256
from marked group by doc_id""",
    "op13_periodic": r"""
with crc_table as (
  select list(c order by i) as t from (
    select i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, b:
      case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c
    from range(256) r(i))),
hashed as (
  select doc_id, xor(4294967295, list_reduce(list_prepend(4294967295,
      list_transform(string_split(cast(doc_id as varchar), ''), lambda s: cast(ascii(s) as bigint))),
      lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]))) as h,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents, crc_table),
sized as (
  select doc_id, h, h // 10 as g, w, len(w) as n,
    case when len(w) > 0 then (h // 10) % len(w) end as a from hashed),
periods as (select *, 1 + (n - a) // (3 + g % 8) as p from sized),
texts as (
  select doc_id, n, case when h % 10 = 0 and n > 0 then list_transform(range(n), lambda i:
    case when i < a then w[i + 1] else w[a + (i - a) % p + 1] end) else w end as w
  from periods),
words as (
  select doc_id, n, unnest(w) as word, generate_subscripts(w, 1) - 1 as i from texts),
pairs as (
  select x.doc_id, y.i - x.i as d, x.i from words x join words y
  on x.doc_id = y.doc_id and x.word = y.word and y.i > x.i and 4 * (y.i - x.i) <= x.n),
marked as (
  select doc_id, d, i, i - row_number() over (partition by doc_id, d order by i) as stretch
  from pairs),
stretches as (
  select doc_id, d, min(i) as start, count(*) + d as length from marked
  group by doc_id, d, stretch having count(*) + d >= greatest(6, 4 * d)),
runs as (
  select doc_id, start, length, min(d) as period from stretches group by doc_id, start, length),
listed as (
  select doc_id, count(*) as n_runs, string_agg(start || ',' || length || ',' || period || chr(10),
      '' order by start, period) as lines,
    first(struct_pack(s := start, l := length, p := period)
      order by length desc, start, period) as longest
  from runs group by doc_id),
gone as (
  select distinct doc_id, unnest(range(start + period, start + length)) as i from runs),
collapsed as (
  select w.doc_id, string_agg(word, ' ' order by w.i) filter (g.i is null) as text
  from words w left join gone g on g.doc_id = w.doc_id and g.i = w.i group by w.doc_id)
select d.doc_id, coalesce(n_runs, 0) as n_runs, longest.s as start, longest.l as length,
  longest.p as period, 1000 * longest.l // longest.p as exponent_milli,
  sha256(coalesce(lines, '')) as runs_sha256, sha256(coalesce(c.text, '')) as collapsed_sha256
from documents d left join listed using (doc_id) left join collapsed c using (doc_id)""",
}
