"""DuckDB counterparts of the queries that SQL can express, over whole tables and whole texts.

The rule ensemble is fitted by MLlib, checksums and the tokenizer have no SQL function, and page layout is a
state machine: op1, op5, op8 and op10 are tested against plain Python, held-out labels and the library.
"""

from __future__ import annotations

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP2_SQL = r"""
with recursive d as (
  select row_number() over () as row, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
), g as (
  select distinct row, unnest(case when len(w) = 1 then w else [w[s] || ' ' || w[s + 1] for s in range(1, len(w))] end) as gram from d
), n as (
  select row, count(*) as n from g group by row
), pair as (
  select a.row as a, b.row as b, count(*) as same from g a join g b on a.gram = b.gram and a.row < b.row group by a.row, b.row
), link as (
  select a, b from pair join n x on x.row = a join n y on y.row = b where 100 * same >= 80 * (x.n + y.n - same)
), edge as (
  select a, b from link union all select b, a from link
), reach(row, other) as (
  select row, row from d union select r.row, e.b from reach r join edge e on r.other = e.a
)
select d.doc_id, any_value(coalesce(n.n, 0)) as n_shingles, min(o.doc_id) as component_id, d.doc_id = min(o.doc_id) as kept
from d left join n using (row) join reach using (row) join d o on o.row = other group by d.row, d.doc_id
"""

OP3_SQL = r"""
with d as (
  select row_number() over () as row, doc_id, hex(encode(coalesce(text, ''))) as h from documents
), starts as (
  select row, unnest(range(0, len(h) // 2 - 199)) as s, unnest([md5(substr(h, 2 * i + 1, 400)) for i in range(0, len(h) // 2 - 199)]) as k
  from d where len(h) >= 400
), twice as (
  select row, s from (select row, s, count(*) over (partition by k) as times from starts) where times > 1
), marked as (
  select row, s, coalesce(s > lag(s) over (partition by row order by s) + 200, true)::int as fresh from twice
), numbered as (
  select row, s, sum(fresh) over (partition by row order by s) as span from marked
), span as (
  select row, min(s) as a, max(s) + 200 as b from numbered group by row, span
), piece as (
  select row, coalesce(lag(b) over (partition by row order by a), 0) as a, a as b from span
  union all
  select row, max(b), null from span group by row
), kept as (
  select row, string_agg(substr(h, (2 * a + 1)::bigint, (2 * (coalesce(b, len(h) // 2) - a))::bigint), '' order by a) as k
  from piece join d using (row) group by row
), sums as (
  select row, sum(b - a)::bigint as n_removed, count(*) as n_spans from span group by row
)
select doc_id, (len(h) // 2)::bigint as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
  sha256(unhex(coalesce(k, h))) as kept_sha256
from d left join sums using (row) left join kept using (row)
"""

OP4_SQL = r"""
with recursive d as (
  select row_number() over () as row, doc_id, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), lines as (
  select row, count(*) - count(distinct line) as n_dup_lines from (select row, unnest(string_split(t, chr(10))) as line from d)
  where regexp_matches(line, '[^\x20\x09-\x0D]') group by row
), runs as (
  select row, unnest([array_to_string(w[s : s + 4], ' ') for s in range(1, len(w) - 3)]) as run,
    unnest(range(1, len(w) - 3)) as s from d where len(w) >= 5
), covered as (
  select row, count(distinct p) as n_repeat_words from (
    select row, unnest(range(s, s + 5)) as p from (select *, count(*) over (partition by row, run) as times from runs) where times > 1
  ) group by row
), s as (
  select row, doc_id, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
    len(list_distinct(w)) as n_distinct, length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) as n_upper,
    length(t) - length(regexp_replace(t, '[!?]', '', 'g')) as n_shouts,
    length(t) - length(regexp_replace(t, '[.,;:]', '', 'g')) as n_stops,
    greatest(len(w), 1)::double as n, greatest(length(array_to_string(w, '')), 1)::double as c
  from d left join lines using (row) left join covered using (row)
), v as (
  select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed, [
    case when n_symbols / n > 0.15e0 then -1 else 0 end, case when n_symbols / c > 0.03e0 then -1 else 0 end,
    case when n_upper / c > 0.3e0 then -1 else 0 end, case when n_shouts / n > 0.2e0 then -1 else 0 end,
    case when n_repeat_words / n > 0.15e0 then -1 else 0 end,
    case when n_distinct::double * n_distinct::double * n_distinct::double * n_distinct::double
      < n_words::double * n_words::double * n_words::double then -1 else 0 end,
    case when n_dup_lines / n > 0.02e0 then -1 else 0 end,
    case when word_chars / n > 9.5e0 or word_chars / n < 2.5e0 then -1 else 0 end,
    case when n_symbols / c < 0.01e0 and n_shouts / n < 0.05e0 and n_upper / c < 0.15e0 and n_repeat_words / n < 0.05e0
      then 1 else 0 end,
    case when n_stops / n > 0.03e0 and n_stops / n < 0.4e0 and word_chars / n > 3 and word_chars / n < 9 then 1 else 0 end
  ] as votes from s
), pattern as (
  select votes, count(*)::double as m from v group by votes
), em(round, votes, m, g) as (
  select 0, votes, m, case when list_sum(votes) < 0 then 0.1e0 else 0.9e0 end from pattern
  union all
  select round + 1, votes, any_value(m), 1 / (1 + exp(-(any_value(prior) + sum(odds)))) from (
    select round, votes, m, prior,
      ln((1 + sum(m * g) over (partition by rule, vote)) / s1) - ln((1 + sum(m * (1 - g)) over (partition by rule, vote)) / s0) as odds
    from (
      select e.*, unnest(range(10)) as rule, unnest(votes) as vote, ln(s1 / s0) as prior from (
        select *, 1 + sum(m * g) over () as s1, 1 + sum(m * (1 - g)) over () as s0 from em where round < 50
      ) e
    )
  ) group by round, votes
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and g >= 0.5 as kept
from v join (select votes, g from em where round = 50) using (votes)
"""

#: Five hex digits of the SHA-1 are four characters of its base 32.
_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
    f"(1 + (('0x' || substr(hex, {1 + 5 * k}, 5))::bigint >> {shift}) % 32)::int, 1)"
    for k in range(8)
    for shift in (15, 10, 5, 0)
)
OP6_SQL = f"""
with p as (
  select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as hex from pages
), q as (
  select page_id, html, hex, min(page_id) over (partition by html) as first_id, page_id is not distinct from min(page_id) over (partition by html) as own from p
)
select page_id, octet_length(encode(html)) as payload_bytes, {_BASE32} as payload_digest,
  case when own then 'response' else 'revisit' end as record_type,
  case when not own then first_id end as refers_to
from q
"""

_BENCH_WORDS = (
    f"regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
OP7_SQL = f"""
with i as (
  select item_id, w, least(10, len(w))::bigint as n from (select item_id, {_BENCH_WORDS} as w from benchmark) where len(w) > 0
), iw as (
  select distinct item_id, n, unnest([array_to_string(w[s : s + n - 1], ' ') for s in range(1, len(w) - n + 2)]) as win from i
), d as (
  select row_number() over () as row, doc_id, {_BENCH_WORDS} as w from documents
), dw as (
  select row, n, unnest([array_to_string(w[s : s + n - 1], ' ') for s in range(1, len(w) - n + 2)]) as win,
    unnest(range(1, len(w) - n + 2)) as s
  from d, (select distinct n from iw) where len(w) >= n
), h as (
  select distinct row, s, dw.n, item_id from dw join iw on dw.win = iw.win and dw.n = iw.n
), words as (
  select row, count(distinct p) as n_hit from (select row, unnest(range(s, s + n)) as p from h) group by row
), found as (
  select row, count(distinct item_id) as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as ids
  from h group by row
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, n_hit is not null as contaminated
from d left join words using (row) left join found using (row)
"""

_KEYWORDS = "|".join(
    "".join(f"[{x.upper()}{x}]" if x.isalpha() else x for x in word)
    for word in ("password", "passwd", "secret", "token", "api_?key")
)
_SECRETS = [
    ("assign", rf"(?:{_KEYWORDS})[\"'']?\x20*[:=]\x20*[\"'']?([A-Za-z0-9+/_.=-]+)", 1, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]{24,}", 0, 24), ("mixed", "[A-Za-z0-9_-]{20,}", 0, 20),
]
_MATCHES = " union all ".join(
    f"select row, {rank} as rank, '{kind}' as kind, regexp_extract_all(text, '{pattern}', 0) as w, "
    f"regexp_extract_all(text, '{pattern}', {group}) as v, string_split_regex(text, '{pattern}') as gap, "
    f"{least} as least from d"
    for rank, (kind, pattern, group, least) in enumerate(_SECRETS)
)
_ALL_STOCK = "(?i)^(?:example|sample|dummy|changeme|placeholder|your|x{4,}|0{4,}|123456?7?8?9?0?|abcdef|[_.-])+$"
OP9_SQL = f"""
with d as (
  select row_number() over () as row, doc_id, coalesce(text, '') as text, coalesce(source, '') as owner, coalesce(lang, '') as repository from documents
), m as ({_MATCHES}), u as (
  select row, rank, kind, least, unnest(range(1, len(w) + 1)) as k, unnest(w) as w, unnest(v) as v, unnest(gap[1 : len(w)]) as gap
  from m where len(w) > 0
), p as (
  select *, sum(length(gap) + length(w)) over (partition by row, kind order by k) as e from u
), q as (
  select *, e - length(w) as s, not regexp_matches(v, '{_ALL_STOCK}') and (kind <> 'mixed' or length(v) >= 16
    and regexp_matches(v, '[A-Za-z]') and regexp_matches(v, '[0-9]') and len(list_distinct(string_split(v, ''))) >= 8) as candidate
  from p where length(v) >= least and (kind <> 'mixed'
    or regexp_matches(v, '[A-Z]') and regexp_matches(v, '[a-z]') and regexp_matches(v, '[0-9]'))
), o as (
  select v, count(distinct owner) as owners, count(distinct {{o: owner, r: repository}}) as repos from q join d using (row) group by v
), f as (
  select q.*, kind || ':' || s::bigint || ':' || e::bigint as span, owners || '/' || repos as held from q join o using (v)
  where kind <> 'mixed' or candidate and owners <= 2 and repos <= 4
), g as (
  select row, count(*) filter (kind = 'assign') as a, count(*) filter (kind = 'access') as b,
    count(*) filter (kind = 'hex') as h, string_agg(span, ',' order by s, rank) filter (kind <> 'mixed') as base,
    string_agg(span, ',' order by s, rank) as spans, string_agg(held, ',' order by s, rank) as held_by
  from f group by row
)
select doc_id, coalesce(a, 0) as n_assign, coalesce(b, 0) as n_access, coalesce(h, 0) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans,
  coalesce(held_by, '') as held_by
from d left join g using (row)
"""

OP13_SQL = """
with recursive v as (
  select row_number() over () as row, vec_id, list_transform(embedding, lambda e: floor(1024 * e::double)::bigint) as x
  from embeddings where len(embedding) = 64
    and len(list_filter(embedding, lambda e: coalesce(isfinite(e::double), false))) = 64
), first as (
  select list(x order by h, x) as cs from (
    select sha256('3:' || vec_id) as h, x from v order by h nulls last, x limit 8
  )
), rounds(round, cs) as (
  select 0, cs from first
  union all
  select any_value(round) + 1, list(coalesce(moved, old) order by c) from (
    select o.round, o.c, o.old, m.moved from (
      select round, unnest(range(1, len(cs) + 1)) as c, unnest(cs) as old from rounds where round < 10
    ) o left join (
      select c, list((s - ((s % n) + n) % n) // n order by p) as moved from (
        select c, p, sum(xp)::hugeint as s, count(*) as n from (
          select list_position(ds, list_min(ds)) as c, unnest(range(1, 65)) as p, unnest(x) as xp from (
            select x, list_transform(cs, lambda k: list_sum(list_transform(list_zip(x, k), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint) as ds
            from v, rounds where round < 10
          )
        ) group by c, p
      ) group by c
    ) m using (c)
  ) group by round
), last as (
  select vec_id, cs, list_transform(cs, lambda k: list_sum(list_transform(list_zip(x, k), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint) as ds
  from v, rounds where round = 10
), placed as (
  select vec_id, list_position(ds, list_min(ds)) as c, list_min(ds) as distance, cs from last
)
select vec_id, (c - 1)::int as cluster, distance, (sum(distance) over (partition by c))::bigint as cluster_inertia,
  (sum(distance) over ())::bigint as inertia, sha256(array_to_string(cs[c], ',')) as centroid_sha256 from placed
"""

SQL = {
    "op2_minhash_join": OP2_SQL,
    "op3_suffix_dedup": OP3_SQL,
    "op4_weak_rules": OP4_SQL,
    "op6_content_archive": OP6_SQL,
    "op7_prefix_join": OP7_SQL,
    "op9_ownership_scan": OP9_SQL,
    "op13_bisector_clusters": OP13_SQL,
}
