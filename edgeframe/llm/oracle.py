"""DuckDB SQL of the queries that SQL can express."""

ORACLE: dict[str, str] = {}

ORACLE["op9_exact"] = r"""
with t as (
  select doc_id, length(coalesce(text, '')) size,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') body
  from documents
)
select doc_id,
       first_value(doc_id) over (partition by body order by size desc, doc_id nulls last) keep_id,
       count(*) over (partition by body) group_size,
       row_number() over (partition by body order by size desc, doc_id nulls last) = 1 kept,
       sha256(body) text_sha256
from t
"""

ORACLE["op1_topk"] = """
with v as (
  select vec_id, [cast(floor(256 * cast(x as double)) as bigint) for x in embedding] vec
  from embeddings
  where embedding is not null and vec_id is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), scored as (
  select q.vec_id query_id, c.vec_id,
         cast(list_sum([p[1] * p[2] for p in list_zip(q.vec, c.vec)]) as bigint) score
  from v q join v c on q.vec_id <> c.vec_id and len(q.vec) = len(c.vec)
  where q.vec_id % 50 = 0
), ranked as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) rank
  from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""

ORACLE["op3_urls"] = r"""
with cut as (
  select page_id, case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end rest
  from pages
), parts as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') path
  from cut
), rules(verdict, rule_host, rule_path) as (
  values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), fits as (
  select p.page_id, p.host, p.path, r.rule_host || r.rule_path rule, r.verdict,
         row_number() over (partition by p.page_id
                            order by length(rule_host) desc nulls last, length(rule_path) desc) nr
  from parts p left join rules r
    on (p.host = r.rule_host or ends_with(p.host, '.' || r.rule_host)) and starts_with(p.path, r.rule_path)
)
select page_id, host, path, rule, coalesce(verdict, 'allow') verdict from fits where nr = 1
"""

ORACLE["op4_minhash"] = r"""
with recursive words as (
  select doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') w
  from documents
), shingles as (
  select distinct doc_id, hash(list_slice(w, i, i + 4)) s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) i from words where len(w) > 0)
), sizes as (
  select doc_id, count(*) n from shingles group by doc_id
), links as (
  select a.doc_id a, b.doc_id b
  from shingles a join shingles b using (s)
  join sizes x on x.doc_id = a.doc_id join sizes y on y.doc_id = b.doc_id
  where a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id
  having 100 * count(*) >= 75 * (max(x.n) + max(y.n) - count(*))
), reach(doc_id, other) as (
  select doc_id, doc_id from documents
  union
  select r.doc_id, l.b from reach r join links l on l.a = r.other
), least as (
  select doc_id, min(other) component_id from reach group by doc_id
)
select d.doc_id, coalesce(z.n, 0) n_shingles, l.component_id, d.doc_id = l.component_id kept
from documents d join least l on l.doc_id = d.doc_id left join sizes z on z.doc_id = d.doc_id
"""

ORACLE["op5_warc"] = r"""
with p as (
  select page_id, url, coalesce(html, '') html, sha256(coalesce(html, '')) digest,
         regexp_replace(coalesce(url, ''), '^[^:/?#]*://', '') rest
  from pages
), f as (
  select *, case when strlen(html) >= 100 then min(page_id) over (partition by digest) end first,
         regexp_extract(rest, '^[^/?#]*') host
  from p
), k as (
  select *, case when page_id > first then first end refers_to,
         case when url is null then ''
              else array_to_string(list_reverse(string_split(lower(host), '.')), ',') || ')'
                   || substr(rest, length(host) + 1) end url_key
  from f
)
select page_id, cast(strlen(html) as bigint) payload_bytes, digest payload_digest,
       case when refers_to is null then 'response' else 'revisit' end record_type, refers_to,
       url_key, row_number() over (order by url_key, page_id) - 1 as position
from k
"""

ORACLE["op11_trie"] = """
with own as (
  select conv_id, list(struct_pack(k := m, x := coalesce(text, '')) order by turn nulls first, m) turns
  from (select *, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) m
        from conversations where conv_id is not null)
  group by conv_id
), crc as (
  select conv_id, turns, conv_id - conv_id % 100 base,
         xor(list_reduce(
               list_prepend(4294967295::bigint,
                            list_transform(string_split(conv_id::varchar, ''), lambda s : ascii(s)::bigint)),
               lambda c, b : list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
                                  lambda v, z : case when v % 2 = 1 then xor(v // 2, 3988292384) else v // 2 end)),
             4294967295) % 6 h
  from own
), paths as (
  select c.conv_id, list_concat(coalesce(list_slice(b.turns, 1, c.h), []), list_slice(c.turns, c.h + 1, len(c.turns))) path
  from crc c left join own b on b.conv_id = c.base
), steps as (
  select conv_id, len(path) size, d, array_to_string(list_transform(list_slice(path, 1, d), lambda t : t.k), '') k,
         case when d > 0 then length(path[d].x) else 0 end chars
  from (select *, unnest(range(0, len(path) + 1)) d from paths)
), nodes as (
  select k, d, min(conv_id) conv_id, count(*) n, max(chars) chars,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (size = d), '')) ends
  from steps group by k, d
), kids as (
  select substr(k, 1, 32 * (d - 1)) k, count(*) n from nodes where d > 0 group by 1
), below as (
  select substr(k, 1, 32 * a) k, sum(saved) saved, sum(leaf) leaves
  from (select u.k, (u.n - 1) * u.chars saved, case when c.n is null then 1 else 0 end leaf, unnest(range(0, u.d + 1)) a
        from nodes u left join kids c on c.k = u.k)
  group by 1
)
select v.conv_id, v.d as depth, p.conv_id parent_conv_id, v.n n_convs, coalesce(c.n, 0) n_children,
       cast(b.leaves as bigint) n_leaves, cast(b.saved as bigint) saved_tokens, v.ends ends_sha256
from nodes v join below b on b.k = v.k left join kids c on c.k = v.k
left join nodes p on v.d > 0 and p.k = substr(v.k, 1, 32 * (v.d - 1))
"""

ORACLE["op12_mixing"] = r"""
with d as (
  select row_number() over () nr, doc_id, source, md5('0:' || coalesce(doc_id::varchar, '')) h, md5(coalesce(text, '')) t,
         cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) size
  from documents
), s as (
  select source, cast(sum(size) as bigint) whole, row_number() over (order by source nulls last) - 1 as place,
         [3, 1, 2][(row_number() over (order by source nulls last) - 1) % 3 + 1] weight
  from d group by source
), w as (
  select *, sum(2 * whole) over upto caps, sum(weight) over upto weights,
         sum(whole) over () total, sum(weight) over () every
  from s window upto as (order by 2 * whole / weight, place)
), c as (
  select *, 2 * (caps * weight + 2 * whole * (every - weights)) < 3 * total * weight capped from w
), l as (
  select *, cast(3 * total - 2 * coalesce(sum(2 * whole) filter (capped) over (), 0) as bigint) level,
         cast(2 * coalesce(sum(weight) filter (not capped) over (), 0) as bigint) parts
  from c
), g as (
  select source, place, whole,
         case when total = 0 then 0.0::double when capped then (2 * whole)::double
              else cast(weight * level as double) / cast(parts as double) end target
  from l
), docs as (
  select d.nr, d.doc_id, d.size, g.place, g.whole, g.target,
         sum(d.size) over (partition by g.place order by h, t, nr rows unbounded preceding) - d.size as begin
  from d join g on d.source is not distinct from g.source
), pieces as (
  select nr, place, b, greatest(begin, b * 1024) - b * 1024 as first, least(begin + size, b * 1024 + 1024) - b * 1024 as last
  from (select *, unnest(range(cast(begin // 1024 as bigint), cast((begin + size - 1) // 1024 + 1 as bigint))) b
        from docs where size > 0)
), blocks as (
  select place, target, b, epoch, least(1024, whole - b * 1024) size
  from (select *, unnest(range(0, (whole + 1023) // 1024)) b from g), (values (0), (1)) e(epoch)
  where epoch = 0 or floor(target) > whole
), drawn as (
  select place, b, least(size, floor(target) - before) take
  from (select *, sum(size) over (partition by place order by epoch, md5('0:' || place || ':' || epoch || ':' || b)
                                  rows unbounded preceding) - size as before from blocks)
  where floor(target) > before
), taken as (
  select nr, sum(greatest(0, least(last, take) - first)) words from pieces join drawn using (place, b) group by nr
)
select doc_id, size, whole source_size, target, cast(coalesce(words, 0) as bigint) taken from docs left join taken using (nr)
"""
