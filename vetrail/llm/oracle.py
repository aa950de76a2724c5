"""SQL twins of the queries that SQL can express on whole tables: all pairs, then what is reachable."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

ORACLE: dict[str, str] = {}

ORACLE["op2_ngram_jaccard_join"] = f"""
with recursive w as (select doc_id,
  regexp_extract_all(translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'), '[^\\x20\\x09-\\x0D]+') as words from documents),
lists as (select doc_id, case when len(words) = 0 then cast([] as varchar[])
  when len(words) < 5 then [array_to_string(words, ' ')]
  else list_transform(range(1, len(words) - 3), lambda i: array_to_string(list_slice(words, i, i + 4), ' ')) end as s from w),
sets as (select distinct doc_id, unnest(s) as shingle from lists),
sizes as (select doc_id, count(*) as n from sets group by 1),
common as (select x.doc_id as a, y.doc_id as b, count(*) as both_ from sets x join sets y using (shingle)
  where x.doc_id <> y.doc_id group by 1, 2),
links as (select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * both_ >= 80 * (x.n + y.n - both_)),
reach as (select doc_id as a, doc_id as b from documents union select r.a, l.b from reach r join links l on l.a = r.b)
select d.doc_id, coalesce(n, 0) as n_shingles, component_id
from documents d left join sizes using (doc_id) join (select a as doc_id, min(b) as component_id from reach group by 1) using (doc_id)"""

ORACLE["op6_embedding_near_dedup"] = """
with recursive v as (
  select vec_id, label, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings
  where label is not null and embedding is not null),
sound as (select * from v where len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0
  and len(list_filter(e, lambda x: x <> 0)) > 0),
links as (select a.vec_id as a, b.vec_id as b from sound a join sound b on a.label = b.label and a.vec_id <> b.vec_id
  where len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.98),
reach as (select vec_id as a, vec_id as b from embeddings
  union select r.a, l.b from reach r join links l on l.a = r.b),
counts as (select a, count(*) as n from links group by 1)
select a as vec_id, coalesce(any_value(n), 0) as n_links, min(b) as component_id, a = min(b) as kept
from reach left join counts using (a) group by a"""

_RULES = "('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')"

ORACLE["op11_url_filters"] = f"""
with rests as (select page_id, row_number() over () as row,
  case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
raws as (select *, regexp_extract(rest, '^[^/?#]*') as raw from rests),
parted as (select page_id, row, translate(raw, '{ascii_uppercase}', '{ascii_lowercase}') as host,
  regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path from raws),
rules(h, p, v) as (values {_RULES}),
fits as (select row, arg_max(h || p, (length(h || p), length(h))) as rule, arg_max(v, (length(h || p), length(h))) as v
  from parted join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by row)
select page_id, host, path, rule, coalesce(v, 'allow') as verdict from parted left join fits using (row)"""

_SOUND = """embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"""
_WHOLE = "list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint))"
#: Whole-number quotients rounded down, also of negative sums.
_FLOORED = "cast((total - ((total % n) + n) % n) // n as bigint)"


def _codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    steps = [
        f"""kept as materialized (select vec_id, label, {_WHOLE} as e, row_number() over (order by vec_id, embedding) as r
  from embeddings where {_SOUND}),
members as materialized (select r, p, list_slice(e, p * len(e) // {parts} + 1, (p + 1) * len(e) // {parts}) as v
  from kept, range({parts}) as _(p)),
book0 as materialized (select p, r - 1 as c, v as b from members where r <= {entries})"""
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""apart{i} as (select r, p, c, v, cast(list_sum(list_transform(range(1, len(v) + 1), lambda j: (v[j] - b[j]) * (v[j] - b[j]))) as bigint) as d
  from members join book{i} using (p)),
near{i} as materialized (select r, p, arg_min(c, (d, c)) as c, min(d) as d, any_value(v) as v from apart{i} group by r, p)"""
        )
        if i < rounds:
            steps.append(
                f"""sums{i} as (select p, c, j, sum(v[j]) as total, count(*) as n from near{i}, lateral (select unnest(range(1, len(v) + 1)) as j) group by all),
means{i} as (select p, c, list({_FLOORED} order by j) as b from sums{i} group by p, c),
book{i + 1} as materialized (select p, c, coalesce(m.b, o.b) as b from book{i} o left join means{i} m using (p, c))"""
            )
    return f"""with {', '.join(steps)},
digest as (select sha256(string_agg(array_to_string(b, ','), ',' order by p, c)) as codebooks_sha256 from book{rounds}),
coded as (select vec_id, label, string_agg(printf('%02x', cast(c as int)), '' order by p) as code, cast(sum(d) as bigint) as error
  from kept join near{rounds} using (r) group by r, vec_id, label)
select vec_id, label, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
from coded, digest"""


def _clusters_sql(clusters: int = 40, rounds: int = 5, length: int = 64) -> str:
    steps = [
        f"""kept as materialized (select vec_id, {_WHOLE} as v, row_number() over (order by sha256('2:' || vec_id) nulls last, vec_id, embedding) as r
  from embeddings where len(embedding) = {length} and {_SOUND}),
book0 as materialized (select r - 1 as c, v as b from kept where r <= {clusters})"""
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""apart{i} as (select r, c, v, cast(list_sum(list_transform(range(1, {length + 1}), lambda j: (v[j] - b[j]) * (v[j] - b[j]))) as bigint) as d
  from kept, book{i}),
near{i} as materialized (select r, arg_min(c, (d, c)) as c, min(d) as d, any_value(v) as v from apart{i} group by r)"""
        )
        if i < rounds:
            steps.append(
                f"""sums{i} as (select c, j, sum(v[j]) as total, count(*) as n from near{i}, range(1, {length + 1}) as _(j) group by all),
means{i} as (select c, list({_FLOORED} order by j) as b from sums{i} group by c),
book{i + 1} as materialized (select c, coalesce(m.b, o.b) as b from book{i} o left join means{i} m using (c))"""
            )
    return f"""with {', '.join(steps)}
select vec_id, cast(c as int) as cluster, d as distance, cast(sum(d) over (partition by c) as bigint) as cluster_inertia,
  cast(sum(d) over () as bigint) as inertia, sha256(array_to_string(b, ',')) as centroid_sha256
from near{rounds} join kept using (r) join book{rounds} using (c)"""


ORACLE["op12_vector_codes"] = _codes_sql()
ORACLE["op13_centroid_clusters"] = _clusters_sql()
