"""Queries of this package and, where SQL can state them, their SQL."""

from __future__ import annotations

from cohortwise.llm import (
    alignment,
    blocks,
    decontaminate,
    hosts,
    jaccard,
    language,
    packing,
    quality,
    sharding,
    substring,
    tokens,
    urls,
    warc,
)

QUERIES = {
    "op1_host_rules": hosts.op1_host_rules,
    "op2_string_kernel_language": language.op2_string_kernel_language,
    "op3_jaccard_components": jaccard.op3_jaccard_components,
    "op4_maglev_sharding": sharding.op4_maglev_sharding,
    "op5_token_rows": tokens.op5_token_rows,
    "op6_flexible_packing": packing.op6_flexible_packing,
    "op7_quality_classifier": quality.op7_quality_classifier,
    "op8_warc_round_trip": warc.op8_warc_round_trip,
    "op9_debruijn_dedup": substring.op9_debruijn_dedup,
    "op10_bm25_decontaminate": decontaminate.op10_bm25_decontaminate,
    "op11_url_filters": urls.op11_url_filters,
    "op12_vector_codes": blocks.op12_vector_codes,
    "op13_token_alignment": alignment.op13_token_alignment,
}

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLE_SQL = {
    "op1_host_rules": rf"""
with d as (
  select doc_id, source, coalesce(text, '') as t, {WORDS} as w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from documents),
three as (
  select doc_id, i, w[i] as a, w[i + 1] as b, w[i + 2] as c
  from d, lateral unnest(range(1, greatest(len(w) - 1, 1))) as r(i)),
marked as (select doc_id, i, count(*) over (partition by doc_id, a, b, c) as n from three),
places as (select doc_id, i, lag(i) over (partition by doc_id order by i) as j from marked where n > 1),
rep as (select doc_id, sum(least(3, coalesce(i - j, 3))) as n from places group by doc_id),
f as (
  select d.doc_id, d.source, cast(len(w) as bigint) as n_words,
         cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
         cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
         cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines, len(lines) as n_lines,
         cast(coalesce(rep.n, 0) as bigint) as n_repeat_words
  from d left join rep using (doc_id)),
g as (
  select *, [n_words < 50, 100 * n_repeat_words > 50 * n_words, 100 * n_symbols > 10 * n_words, 100 * n_dup_lines > 30 * n_lines] as bad
  from f),
host as (
  select source, r.rule, count(*) as n, sum(cast(bad[r.rule] as int)) as k
  from g, (values (1), (2), (3), (4)) r(rule) where source is not null group by all),
moment as (
  select rule, sum(cast(k * 1000000 // n as hugeint)) / count(*) / 1e6 as m, sum(n) as total,
         cast(sum(1000000 // n) as double) / count(*) / 1e6 as h,
         (sum(cast(k * 1000000 // n as hugeint) * cast(k * 1000000 // n as hugeint))
          - sum(cast(k * 1000000 // n as hugeint)) * 1.0 * sum(cast(k * 1000000 // n as hugeint)) / count(*)) / count(*) / 1e12 as v
  from host group by rule),
spread as (select *, case when m > 0 and m < 1 and h < 1 then (v / (m * (1 - m)) - h) / (1 - h) end as rho from moment),
verdict as (
  select source, max((k + m * weight) / (n + weight)) <= 0.5 as ok
  from host join (select *, case when rho > 0 then greatest(1.0, least(total, 1 / rho - 1)) else total end as weight from spread) using (rule)
  group by source)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, bad[1] or bad[2] as base_failed,
       not (bad[1] or bad[2]) and coalesce(ok, true) as kept
from g left join verdict using (source)""",
    "op3_jaccard_components": rf"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') as w
  from documents),
s as (
  select distinct doc_id, array_to_string(w[i : i + 4], ' ') as g
  from d, lateral unnest(range(1, greatest(len(w) - 4, 1) + 1)) as r(i) where len(w) > 0),
n as (select doc_id, count(*) as m from s group by doc_id),
both_ as (
  select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
links as (
  select x, y from both_ join n p on p.doc_id = x join n q on q.doc_id = y where 100 * c >= 80 * (p.m + q.m - c)),
edges as (select x, y from links union select y, x from links),
reach as (select doc_id as a, doc_id as b from d union select reach.a, edges.y from reach join edges on edges.x = reach.b)
select d.doc_id, coalesce(any_value(n.m), 0) as n_shingles, min(reach.b) as component_id
from d left join n using (doc_id) join reach on reach.a = d.doc_id group by d.doc_id""",
    "op8_warc_round_trip": """
with p as (
  select page_id, coalesce(html, '') as h from pages),
q as (select page_id, h, max(page_id) over (partition by h) as last, cast(strlen(h) as bigint) as payload_bytes from p)
select page_id, payload_bytes, sha1(h) as payload_digest,
       case when payload_bytes >= 1000 and page_id <> last then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 1000 and page_id <> last then last end as refers_to
from q""",
    "op9_debruijn_dedup": rf"""
with d as (select doc_id, {WORDS} as w from documents),
win as (
  select doc_id, i, array_to_string(w[i : i + 12], ' ') as g
  from d, lateral unnest(range(1, greatest(len(w) - 11, 1))) as r(i)),
late as (select doc_id, i from (select doc_id, i, min(doc_id) over (partition by g) as first_doc from win) where first_doc < doc_id),
gone as (select distinct doc_id, i + j as p from late, range(0, 13) as r(j)),
word as (select doc_id, i as p, w[i] as x from d, lateral unnest(range(1, len(w) + 1)) as r(i)),
kept as (
  select doc_id, string_agg(x, ' ' order by p) as t, count(*) as n
  from word anti join gone using (doc_id, p) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed,
       sha256(coalesce(t, '')) as kept_sha256
from d left join kept using (doc_id)""",
    "op11_url_filters": urls.ORACLE_SQL,
    "op12_vector_codes": blocks.ORACLE_SQL,
}
