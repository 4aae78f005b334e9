"""DuckDB statements computing the same rows as the registered queries."""

from __future__ import annotations

OP9 = r"""
with d as (
  select row_number() over () as rid, doc_id, source, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls
  from documents),
g as (
  select rid, i, ws[i] as a, ws[i + 1] as b, ws[i + 2] as c
  from (select rid, ws, unnest(generate_series(1, len(ws) - 2)) as i from d)),
r as (
  select rid, i from (select rid, i, count(*) over (partition by rid, a, b, c) as k from g)
  where k > 1),
p as (
  select rid, count(distinct j) as n
  from (select rid, unnest([i, i + 1, i + 2]) as j from r) group by rid),
m as (
  select d.doc_id, d.source, len(ws)::bigint as n_words,
         length(list_aggregate(ws, 'string_agg', ''))::bigint as word_chars,
         (length(t) - length(translate(t, '#*$%&|<>', '')))::bigint as n_symbols,
         (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
         len(ls)::bigint as n_lines, coalesce(p.n, 0)::bigint as n_repeat_words
  from d left join p using (rid)),
m2 as (select * replace (coalesce(word_chars, 0) as word_chars) from m),
j as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
         word_chars < 2 * n_words or word_chars > 15 * n_words or 100 * n_symbols > 10 * n_words
         or 100 * n_dup_lines > 30 * n_lines as soft_failed
  from m2),
h as (
  select source, count(*)::double as n,
         sum(case when base_failed or soft_failed then 1 else 0 end)::double as f
  from j group by source),
q as (select sum(n) as n, count(*) as h, sum(f) / sum(n) as p, sum(n * (f / n) * (f / n)) as sq from h),
e as (
  select p, p * (1 - p) as noise, sq / n - p * p as spread,
         (sq / n - p * p) - p * (1 - p) * h / n as excess from q),
k as (
  select p, case when excess <= 1e-9 then 1e6
                 else least(greatest((noise - spread) / excess, 1.0), 1e6) end as s from e),
v as (
  select source, (p * s + f) / (s + n) as mean, s + n as w from h, k),
z as (
  select source, source is not null and mean - 1.645 * sqrt(mean * (1 - mean) / (w + 1)) > 0.5
         as host_strict from v)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce(host_strict, false) as host_strict,
       not base_failed and not (soft_failed and coalesce(host_strict, false)) as kept
from j left join z using (source)
"""

_DOUBLE = ", ".join(f"'{x}'" for x in (
    "co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "ne.jp",
    "or.jp", "com.br", "com.cn", "com.mx", "com.tr", "co.in", "co.kr", "co.za", "com.ar", "com.tw"))


def _rate_and_strength(level: str) -> str:
    return f"""
  select coalesce(p, 0) as p,
         case when p is null or excess <= 1e-9 then 1e4
              else least(greatest((noise - spread) / excess, 2.0), 1e4) end as k
  from (select p, p * (1 - p) as noise, sq / n - p * p as spread,
               (sq / n - p * p) - p * (1 - p) * g / n as excess
        from (select sum(n) as n, count(*) as g, sum(bad)::double / sum(n) as p,
                     sum(n * (bad / n) * (bad / n)) as sq from {level} where n > 0))"""


OP3 = rf"""
with p as (
  select page_id,
         coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path,
         case when coalesce(html, '') <> '' then regexp_matches(html,
           '(?i)idiot|stupid|pathetic|disgusting|worthless|moron|cheap pills|[%]{{3}}|[#]{{3}}|[*]{{3}}')::int
         end as outcome
  from pages),
h as (
  select host, count(outcome) as n, coalesce(sum(outcome), 0) as bad,
         regexp_extract(host, '([^.]*\.[^.]*)$', 1) as two,
         regexp_extract(host, '([^.]*\.[^.]*\.[^.]*)$', 1) as three
  from p where host <> '' group by host),
hh as (
  select host, n, bad,
         case when two in ({_DOUBLE}) then two else regexp_extract(host, '([^.]*)$', 1) end as suffix,
         case when two in ({_DOUBLE}) then coalesce(nullif(three, ''), host)
              else coalesce(nullif(two, ''), host) end as domain
  from h),
d as (select domain, suffix, sum(n) as n, sum(bad) as bad from hh group by domain, suffix),
s as (select suffix, sum(n) as n, sum(bad) as bad from d group by suffix),
ks as ({_rate_and_strength("s")}),
kd as ({_rate_and_strength("d")}),
kh as ({_rate_and_strength("hh")}),
sr as (select suffix, (p * k + bad) / (k + n) as r from s, ks),
dr as (select domain, (sr.r * k + bad) / (k + n) as r from d join sr using (suffix), kd),
hr as (select host, (dr.r * k + bad) / (k + n) as m, k + n as w from hh join dr using (domain), kh),
b as (select host from hr where m - 1.645 * sqrt(m * (1 - m) / (w + 1)) > 0.5),
r as (
  select page_id, host, path,
         case when (host = 'example.net' or host like '%.example.net') and path like '/en/%'
              then 'example.net/en/'
              when (host = 'example.com' or host like '%.example.com') and path like '/de/%'
              then 'example.com/de/'
              when (host = 'org' or host like '%.org') and path like '/fr/%' then 'org/fr/'
              when (host = 'net' or host like '%.net') and path like '/%' then 'net/' end as rule
  from p)
select page_id, host, path, rule,
       case when rule in ('net/', 'example.com/de/') then 'block'
            when rule is not null then 'allow'
            when host in (select host from b) then 'block' else 'allow' end as verdict
from r
"""

# crc32 of the id's decimal digits, bit by bit: 256 stands for one shift.
OP11 = r"""
with recursive d as (
  select doc_id, source, lang, n_chars, text,
         doc_id is not null and xor(list_reduce(list_concat([4294967295::ubigint],
           list_reduce(list_transform(string_split(cast(doc_id as varchar), ''),
                                      lambda c: list_concat([ascii(c)::ubigint], list_transform(range(8), lambda i: 256::ubigint))),
                       lambda a, b: list_concat(a, b))),
           lambda a, x: case when x = 256 then xor(a >> 1, (a & 1) * 3988292384::ubigint) else xor(a, x) end),
           4294967295::ubigint) % 2 = 0 as even
  from documents),
f as (
  select *, coalesce(strlen(cast(doc_id as varchar)) || ':' || doc_id, '-')
         || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
         || coalesce(strlen(cast(n_chars as varchar)) || ':' || n_chars, '-') as head,
         replace(text, chr(10), '') as cut
  from d),
h as (
  select doc_id, dense_rank() over (order by source nulls first) - 1 as g,
         sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
         case when even then sha256(head || coalesce(strlen(cut) || ':' || cut, '-')) end as changed
  from f),
l as (
  select *, row_number() over () as rid,
         row_number() over (partition by g order by doc_id nulls first, leaf) - 1 as pos from h),
n as (
  select g, 0 as lvl, pos, leaf as d from l
  union all
  select g, lvl + 1, pos // 3, sha256(string_agg(d, '' order by pos))
  from (select *, count(*) over (partition by g) as k from n) where k > 1 group by g, lvl, pos // 3),
depth as (select g, max(lvl) as deep from n group by g),
s as (select n.g as pos, n.d, n.g from n join depth on n.g = depth.g and n.lvl = deep),
t as (
  select 0 as lvl, pos, d from s
  union all
  select lvl + 1, pos // 3, sha256(string_agg(d, '' order by pos))
  from (select *, count(*) over () as k from t) where k > 1 group by lvl, pos // 3),
top as (select max(lvl) as deep from t),
root as (select d from t, top where lvl = deep),
nodes as (select g as scope, lvl, pos, d from n union all select -1, lvl, pos, d from t),
steps as (
  select rid, i as step, l.g as scope, i as lvl, pos // cast(3 ** i as bigint) as p
  from l join depth using (g), unnest(range(deep)) as u(i)
  union all
  select rid, depth.deep + i, -1, i, l.g // cast(3 ** i as bigint)
  from l join depth using (g), top, unnest(range(top.deep)) as u(i)),
path as (
  select rid, step, coalesce(string_agg(d, '' order by pos) filter (pos < p), '') as a,
         coalesce(string_agg(d, '' order by pos) filter (pos > p), '') as b
  from steps left join nodes on nodes.scope = steps.scope and nodes.lvl = steps.lvl and pos // 3 = p // 3
  group by rid, step),
proof as (select rid, string_agg(a || b, '' order by step) as x, count(*) as n from path group by rid),
fold as (
  select rid, 0 as step, coalesce(changed, leaf) as d from l
  union all
  select fold.rid, fold.step + 1, sha256(a || d || b) from fold join path on fold.rid = path.rid and fold.step = path.step)
select l.doc_id, l.leaf, s.d as subroot, root.d as root, sha256(coalesce(x, '')) as proof_sha256,
       fold.d as folded_root, fold.d = root.d as verified
from l join s using (g) cross join root left join proof using (rid)
join fold on fold.rid = l.rid and fold.step = coalesce(proof.n, 0)
"""

OP13 = r"""
with d as (
  select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as u,
         sha256('1:' || coalesce(cast(doc_id as varchar), '')) as k
  from documents),
h as (
  select doc_id, t, u, len(u) as n, cast('0x' || k[1:8] as bigint) as h1, cast('0x' || k[9:16] as bigint) as h2,
         cast('0x' || k[17:24] as bigint) as h3, cast('0x' || k[25:32] as bigint) as h4
  from d),
c as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
         case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90
              then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form
  from h),
p as (
  select *, array_to_string(u[1:a], '') as x, array_to_string(u[a + 1:b], '') as y,
         array_to_string(u[b + 1:n], '') as z
  from c)
select doc_id, cast(n as bigint) as n, form,
       case when form <> 'plain' then length(x) end as prefix_chars,
       case when form <> 'plain' then length(y) end as middle_chars,
       sha256(case form when 'plain' then t when 'spm' then '<S>' || z || '<P>' || x || '<M>' || y
                        else '<P>' || x || '<S>' || z || '<M>' || y end) as output_sha256,
       sha256(t) as restored_sha256
from p
"""

STATEMENTS: dict[str, str] = {
    "op3_url_filters": OP3,
    "op9_quality_rules": OP9,
    "op11_merkle_manifest": OP11,
    "op13_fill_in_middle": OP13,
}
