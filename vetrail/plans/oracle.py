"""The same results in DuckDB SQL, one statement per registered query that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["scope_filter"] = """
select o_orderkey, area from (select o_orderkey, nullif(o_orderpriority, '3-MEDIUM') as area from orders)
where area is null or area not in ('1-URGENT', '5-LOW')"""

ORACLE["class_flags"] = """
select o_orderkey, status,
  cast(coalesce(status = 'F', false) as bigint) as is_oai,
  cast(coalesce(status = 'P', false) as bigint) as is_vai,
  cast(coalesce(status = 'O', false) as bigint) as is_nai
from (select o_orderkey, nullif(o_orderstatus, 'O') as status from orders)"""

_COERCED = """
select o_orderkey,
  cast(try_strptime(case o_orderpriority when '5-LOW' then '' when '2-HIGH' then '20200230'
    else strftime(o_orderdate, '%Y%m%d') end, '%Y%m%d') as date) as coerced,
  case when o_orderpriority <> '5-LOW' then cast(o_orderdate as date) end as strict,
  case when o_orderpriority <> '5-LOW' then cast(year(o_orderdate) as bigint) end as year,
  case when o_orderstatus <> 'F' then cast(o_custkey as bigint) end as number
from orders"""
ORACLE["date_coerce"] = _COERCED
ORACLE["complete_rows"] = f"""
select o_orderkey, coerced, number from ({_COERCED})
where coerced is not null and number is not null"""

ORACLE["text_exclusion"] = """
select o_orderkey, area from (select o_orderkey, nullif(o_orderpriority, '3-MEDIUM') as area from orders)
where area is null or area not ilike '%urgent%'"""

ORACLE["year_range"] = """
select o_orderkey, cast(o_orderdate as date) as o_date, cast(year(o_orderdate) as bigint) as year
from orders where year(o_orderdate) >= 1998"""

ORACLE["elapsed_days"] = """
select event_id,
  cast(floor((epoch_us(timestamp '2024-03-01') - epoch_us(ts)) / 86400000000.0) as bigint) as days
from events"""

_COUNTS = """(select l_orderkey, count(l_partkey) as n_citations, count(distinct l_partkey) as n_unique_cfr
  from lineitem group by l_orderkey)"""
ORACLE["detail_counts"] = f"""
select o_orderkey, coalesce(n_citations, 0) as n_citations, coalesce(n_unique_cfr, 0) as n_unique_cfr
from orders left join {_COUNTS} on l_orderkey = o_orderkey"""

ORACLE["semi_join_details"] = """
select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, l_partkey from lineitem
where l_orderkey in (select o_orderkey from orders where o_orderpriority <> '5-LOW')"""

# Events with their counts; rn is the position in the entity's history.
_EVENTS = f"""events_ as (
  select o_custkey as fei, o_orderkey as id, cast(o_orderdate as date) as dt,
    o_orderpriority as area, c_mktsegment as kind, n_name as country,
    cast(o_orderstatus = 'F' as bigint) as oai, cast(o_orderstatus = 'P' as bigint) as vai,
    cast(o_orderstatus = 'O' as bigint) as nai,
    coalesce(n_citations, 0) as cit, coalesce(n_unique_cfr, 0) as cfr
  from orders left join customer on c_custkey = o_custkey
    left join nation on n_nationkey = c_nationkey
    left join {_COUNTS} on l_orderkey = o_orderkey),
placed as (select *, row_number() over (partition by fei order by dt, id, area) as rn from events_)"""


def _history(strict: bool, more: str = "") -> str:
    """History by explicit joins: ``first`` is the number of rows that come before."""
    before = "min(rn) over (partition by fei, dt)" if strict else "rn"
    return f"""
{_EVENTS},
cut as (select *, {before} - 1 as before from placed),
past as (
  select c.fei, c.id, c.area, count(p.rn) as n, coalesce(sum(p.oai), 0) as oai,
    coalesce(sum(p.vai), 0) as vai, coalesce(sum(p.nai), 0) as nai, coalesce(sum(p.cit), 0) as cit,
    coalesce(max(p.cit), 0) as max_cit, coalesce(sum(p.cfr), 0) as cfr
  from cut c left join placed p on p.fei = c.fei and p.rn <= c.before
  group by c.fei, c.id, c.area),
hist as (
  select c.id as inspection_id, c.fei as fei_number, c.dt as inspection_date, c.kind as product_type,
    c.country, c.area as project_area, c.oai as target_oai,
    cast(n as bigint) as n_prior_inspections, cast(h.oai as bigint) as n_prior_oai,
    cast(h.vai as bigint) as n_prior_vai, cast(h.nai as bigint) as n_prior_nai,
    round(h.oai / greatest(n, 1), 6) as pct_oai, round(h.vai / greatest(n, 1), 6) as pct_vai,
    cast(case when n = 0 then -1 else date_diff('day', a.dt, c.dt) end as bigint)
      as days_since_last_inspection,
    coalesce(a.oai, 0) as last_classification_oai, coalesce(a.vai, 0) as last_classification_vai,
    cast(coalesce(a.oai > b.oai, false) as bigint) as trend_worsening,
    case when n >= 2 then round((a.oai + b.oai) / 2, 6) else 0.0::double end as recent_oai_rate,
    cast(h.cit as bigint) as total_prior_citations,
    round(h.cit / greatest(n, 1), 6) as avg_citations_per_inspection,
    cast(max_cit as bigint) as max_citations_single_inspection,
    cast(h.cfr as bigint) as total_unique_cfr_violated
  from cut c join past h on h.fei = c.fei and h.id = c.id and h.area = c.area
    left join placed a on a.fei = c.fei and a.rn = c.before
    left join placed b on b.fei = c.fei and b.rn = c.before - 1)"""


_HISTORY_COLUMNS = """inspection_id, fei_number, n_prior_inspections, n_prior_oai, n_prior_vai,
  n_prior_nai, pct_oai, pct_vai, days_since_last_inspection, last_classification_oai,
  last_classification_vai, trend_worsening, recent_oai_rate, total_prior_citations,
  avg_citations_per_inspection, max_citations_single_inspection, total_unique_cfr_violated"""
ORACLE["history_positional"] = f"with {_history(False)} select {_HISTORY_COLUMNS} from hist"
ORACLE["history_strict"] = f"with {_history(True)} select {_HISTORY_COLUMNS} from hist"

_ITEMS = """items as (
  select o_custkey as fei, cast(l_shipdate as date) as dt, l_returnflag as flag,
    l_linestatus as line, o_orderstatus as status
  from lineitem join orders on o_orderkey = l_orderkey)"""
_LETTERS = """select o.o_orderkey, o.o_custkey, cast(o.o_orderdate as date) as o_date,
  count(i.dt) as n_warning_letters,
  cast(coalesce(date_diff('day', max(i.dt), cast(o.o_orderdate as date)), -1) as bigint)
    as days_since_last_wl
from orders o left join items i on i.fei = o.o_custkey and i.flag = 'R'
  and i.dt < cast(o.o_orderdate as date)
group by o.o_orderkey, o.o_custkey, o.o_orderdate"""
_RECALLS = """select o.o_orderkey, o.o_custkey, cast(o.o_orderdate as date) as o_date,
  count(i.dt) as n_recalls, count(case when i.line = 'F' then 1 end) as n_class_I_recalls,
  count(case when i.line = 'O' then 1 end) as n_class_II_recalls
from orders o left join items i on i.fei = o.o_custkey and i.flag = 'A'
  and i.dt < cast(o.o_orderdate as date)
group by o.o_orderkey, o.o_custkey, o.o_orderdate"""
_FORMS = """select o.o_orderkey, o.o_custkey, cast(o.o_orderdate as date) as o_date,
  count(i.dt) as n_published_483s
from orders o left join items i on i.fei = o.o_custkey and i.flag = 'N' and i.status = 'O'
  and i.dt < cast(o.o_orderdate as date)
group by o.o_orderkey, o.o_custkey, o.o_orderdate"""
ORACLE["prior_letters"] = f"with {_ITEMS} {_LETTERS}"
ORACLE["prior_recalls"] = f"with {_ITEMS} {_RECALLS}"
ORACLE["prior_483s"] = f"with {_ITEMS} {_FORMS}"

FEATURES = f"""{_history(False)}, {_ITEMS}, letters as ({_LETTERS}), recalls as ({_RECALLS}),
forms as ({_FORMS}),
features as (
  select h.*, n_warning_letters, cast(n_warning_letters > 0 as bigint) as has_warning_letter,
    days_since_last_wl, n_recalls, cast(n_recalls > 0 as bigint) as has_recall, n_class_I_recalls,
    n_class_II_recalls, n_published_483s, cast(n_published_483s > 0 as bigint) as has_published_483
  from hist h join letters l on l.o_orderkey = h.inspection_id
    join recalls r on r.o_orderkey = h.inspection_id join forms f on f.o_orderkey = h.inspection_id)"""
ORACLE["feature_table"] = f"with {FEATURES} select * from features"

ORACLE["value_counts"] = "select o_orderstatus, count(*) as n from orders group by 1"
ORACLE["top_codes"] = """
select l_partkey, count(*) as n from lineitem where l_partkey is not null group by 1
order by n desc, l_partkey limit 15"""
ORACLE["share_of_total"] = """
select o_orderstatus, count(*) as n, round(count(*) / sum(count(*)) over (), 6) as share
from orders where o_orderstatus is not null group by 1"""
ORACLE["crosstab"] = """
select cast(year(o_orderdate) as bigint) as year,
  count(case when o_orderstatus = 'F' then 1 end) as "F",
  count(case when o_orderstatus = 'O' then 1 end) as "O",
  count(case when o_orderstatus = 'P' then 1 end) as "P", cast(0 as bigint) as other
from orders group by 1"""
ORACLE["crosstab_unlisted"] = """
select cast(year(o_orderdate) as bigint) as year,
  count(case when o_orderstatus = 'F' then 1 end) as "F",
  count(case when o_orderstatus = 'P' then 1 end) as "P",
  count(case when o_orderstatus not in ('F', 'P') then 1 end) as other,
  round(count(case when o_orderstatus = 'F' then 1 end) / count(o_orderstatus), 6) as rate
from orders group by 1"""
_WITH_CUSTOMER = """orders left join customer on c_custkey = o_custkey
  left join nation on n_nationkey = c_nationkey"""
ORACLE["crosstab_rate"] = f"""
select c_mktsegment, count(case when o_orderstatus = 'F' then 1 end) as "F",
  count(case when o_orderstatus = 'O' then 1 end) as "O",
  count(case when o_orderstatus = 'P' then 1 end) as "P", cast(0 as bigint) as other,
  round(count(case when o_orderstatus = 'F' then 1 end) / count(*), 6) as rate
from {_WITH_CUSTOMER} where c_mktsegment is not null and o_orderstatus is not null group by 1"""
_RATES = """select cast(year(o_orderdate) as bigint) as year, count(*) as n,
  avg(cast(o_orderstatus = 'F' as double)) as rate from orders group by 1"""
ORACLE["rate_by_group"] = f"select year, n, round(rate, 6) as rate from ({_RATES})"
ORACLE["mean_of_rates"] = f"select round(avg(rate), 6) as mean_rate from ({_RATES})"
ORACLE["detail_by_class"] = f"""
select o_orderstatus, round(avg(coalesce(n_citations, 0)), 6) as mean_details,
  round(avg(cast(coalesce(n_citations, 0) > 0 as double)), 6) as share_with_detail
from orders left join {_COUNTS} on l_orderkey = o_orderkey where o_orderstatus is not null group by 1"""

_OFFENDERS = f"""select o_custkey, count(*) as n_oai, max(cast(o_orderdate as date)) as last_oai,
  arg_min(n_name, o_orderkey) as country, arg_min(c_mktsegment, o_orderkey) as product_type,
  arg_min(o_orderpriority, o_orderkey) as first_area
from {_WITH_CUSTOMER} where o_orderstatus = 'F' and o_custkey is not null group by 1"""
ORACLE["repeat_offenders"] = _OFFENDERS
ORACLE["top_offenders"] = f"{_OFFENDERS} order by n_oai desc, o_custkey limit 15"
ORACLE["offenders_over"] = f"""
select count(*) as n_entities, count(case when n_oai >= 3 then 1 end) as n_repeat from ({_OFFENDERS})"""
ORACLE["count_of_counts"] = f"select n_oai, count(*) as n_entities from ({_OFFENDERS}) group by 1"
ORACLE["topk_groups_rate"] = f"""
select n_name, count(*) as n, round(avg(cast(o_orderstatus = 'F' as double)), 6) as rate
from {_WITH_CUSTOMER} where n_name is not null group by 1 order by n desc, n_name limit 15"""
ORACLE["distinct_codes"] = "select count(distinct l_partkey) as n_distinct from lineitem"
ORACLE["yearly_counts"] = """
select cast(year(o_orderdate) as bigint) as year, count(*) as n from orders group by 1"""

_TARGET = """count(*) as n_rows, cast(sum(cast(o_orderstatus = 'F' as int)) as bigint) as n_pos,
  round(avg(cast(o_orderstatus = 'F' as double)), 6) as rate from orders group by 1"""
ORACLE["split_profile"] = f"""
select case when year(o_orderdate) < 2000 then 'train' else 'test' end as part, {_TARGET}"""
ORACLE["rolling_split"] = f"""
select case when year(o_orderdate) < (select max(year(o_orderdate)) from orders) then 'train'
  else 'valid' end as part, {_TARGET}"""
ORACLE["class_ratio"] = """
select count(case when o_orderstatus <> 'F' then 1 end) as n_neg,
  count(case when o_orderstatus = 'F' then 1 end) as n_pos,
  round(count(case when o_orderstatus <> 'F' then 1 end) / count(case when o_orderstatus = 'F' then 1 end), 6)
    as ratio
from orders"""
ORACLE["label_encode"] = f"""
with rows_ as (select o_orderkey, nullif(n_name, 'NATION_7') as n_name, c_mktsegment from {_WITH_CUSTOMER}),
a as (select v, row_number() over (order by v) - 1 as code
  from (select distinct coalesce(n_name, 'nan') as v from rows_)),
b as (select v, row_number() over (order by v) - 1 as code
  from (select distinct coalesce(c_mktsegment, 'nan') as v from rows_))
select o_orderkey, n_name, c_mktsegment, a.code as n_name_encoded, b.code as c_mktsegment_encoded
from rows_ join a on a.v = coalesce(n_name, 'nan') join b on b.v = coalesce(c_mktsegment, 'nan')"""


def _steps(score: str) -> str:
    return f"""scored as (
  select cast(l_returnflag = 'R' as int) as y, {score} as threshold from lineitem),
grouped as (select threshold, sum(y) as pos, sum(1 - y) as neg from scored group by 1),
steps as (
  select threshold, pos, neg, sum(pos) over (order by threshold desc) as tp,
    sum(neg) over (order by threshold desc) as fp, sum(pos) over () as p, sum(neg) over () as n
  from grouped)"""


_FINE, _TIED = "l_extendedprice / 110000", "l_discount * 10"
_METRICS = """cast(sum(pos + neg) as bigint) as n_rows, cast(sum(pos) as bigint) as n_pos,
  round(sum(pos / p * (n - fp + neg / 2) / n), 6) as roc_auc,
  round(sum(pos / p * tp / (tp + fp)), 6) as pr_auc,
  round(coalesce(2 * sum(case when threshold >= 0.5 then pos end)
    / (sum(case when threshold >= 0.5 then pos + neg end) + sum(pos)), 0), 6) as f1"""
ORACLE["roc_auc"] = f"""
with {_steps(_FINE)} select n_rows, n_pos, roc_auc from (select {_METRICS} from steps)"""
ORACLE["avg_precision"] = f"with {_steps(_TIED)} select pr_auc, f1 from (select {_METRICS} from steps)"
ORACLE["model_comparison"] = f"""
with a as (with {_steps(_FINE)} select 'fine' as model, {_METRICS} from steps),
b as (with {_steps(_TIED)} select 'tied' as model, {_METRICS} from steps),
u as (select * from a union all select * from b)
select *, cast(model = (select model from u order by pr_auc desc, model desc limit 1) as bigint) as is_best
from u"""
ORACLE["roc_curve"] = f"""
with {_steps(_FINE)}
select round(threshold, 6) as threshold, round(fp / n, 6) as fpr, round(tp / p, 6) as tpr from steps
union all select null, 0.0, 0.0"""
ORACLE["pr_curve"] = f"""
with {_steps(_TIED)}
select round(threshold, 6) as threshold, round(tp / (tp + fp), 6) as precision, round(tp / p, 6) as recall
from steps union all select null, 1.0, 0.0"""
_TABLE = """select threshold, tp / (tp + fp) as precision, tp / p as recall,
  2 * (tp / (tp + fp)) * (tp / p) / (tp / (tp + fp) + tp / p + 1e-8) as f1 from steps"""
_ROUNDED = """round(threshold, 6) as threshold, round(precision, 6) as precision,
  round(recall, 6) as recall, round(f1, 6) as f1"""
ORACLE["threshold_table"] = f"with {_steps(_FINE)} select {_ROUNDED} from ({_TABLE})"
ORACLE["threshold_at_recall"] = f"""
with {_steps(_FINE)} select {_ROUNDED} from ({_TABLE} order by abs(recall - 0.8), threshold limit 1)"""
ORACLE["class_report"] = f"""
with c as (
  select count(case when y and g then 1 end) as tp, count(case when not y and g then 1 end) as fp,
    count(case when y and not g then 1 end) as fn, count(case when not y and not g then 1 end) as tn
  from (select l_returnflag = 'R' as y, {_FINE} >= 0.3 as g from lineitem)),
m as (select *, tn / (tn + fn) as p0, tn / (tn + fp) as r0, 2 * tn / (2 * tn + fn + fp) as f0,
  tp / (tp + fp) as p1, tp / (tp + fn) as r1, 2 * tp / (2 * tp + fp + fn) as f1, tn + fp as s0,
  tp + fn as s1, (tp + tn) / (tp + tn + fp + fn) as acc from c),
r as (select 'Non-OAI' as row, p0 as precision, r0 as recall, f0 as f1, s0 as support from m
  union all select 'OAI', p1, r1, f1, s1 from m
  union all select 'accuracy', acc, acc, acc, s0 + s1 from m
  union all select 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, s0 + s1 from m
  union all select 'weighted avg', (p0 * s0 + p1 * s1) / (s0 + s1), (r0 * s0 + r1 * s1) / (s0 + s1),
    (f0 * s0 + f1 * s1) / (s0 + s1), s0 + s1 from m)
select row, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, support from r"""


# Name normalisation; the blank-and-form steps in the order that leaves d/b/a uncut, and the other.
_RAW = """'  ' || array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')
  || ', ' || upper(p_type[1]) || lower(p_type[2:])
  || case p_size % 3 when 0 then ' Co., Inc.' when 1 then ' (GmbH) dba Other' else '/Ltd www.x.com' end"""


def _norm(c: str, strip_first: bool = False) -> str:
    def cut(x: str, pattern: str, to: str = "") -> str:
        return f"regexp_replace({x}, '{pattern}', '{to}', 'g')"

    web, tail = r"\bwww\.[a-z0-9.-]+\.(com|org|net|us)\b", r"\bd/?b/?a\b.*$"
    forms = r"\b(llc|inc|corp|corporation|ltd|limited|co|company|plc|gmbh|ag|sa)\b"
    x = f"lower(coalesce({c}, ''))"
    if strip_first:
        x = cut(cut(x, web), tail)
    x = cut(cut(x, r"[.,;:!?''\"()\[\]{}/\\]", " "), forms)
    if not strip_first:
        x = cut(cut(x, tail), web)
    return f"trim({cut(x, chr(92) + 's+', ' ')})"


ORACLE["normalize_names"] = f"""
select p_partkey, {_norm(_RAW)} as norm, {_norm(_RAW, True)} as norm_stripped from part"""

ORACLE["normalize_locations"] = """
select p_partkey,
  array_to_string(list_filter([
    case when p_brand <> 'Brand#7' then lower(p_brand) end,
    case when p_size > 40 then null else 'tx' end, lower(p_type)], lambda x: x is not null), '|') as location,
  cast(p_size < 20 and p_size <= 40 as bigint) as overlap
from part"""

# All grams of a name: for each word framed by blanks, slides of 2, 3 and 4 characters.
_GRAMS = """flatten(list_transform(list_filter(string_split_regex(name, '\\s+'), lambda w: w <> ''),
  lambda w: flatten(list_transform(list_filter([2, 3, 4], lambda n: n = 2 or n - 1 < length(w) + 2),
    lambda n: list_transform(range(1, greatest(length(w) + 3 - n, 1) + 1),
      lambda i: substring(' ' || w || ' ', i, n))))))"""
ORACLE["char_grams"] = f"""
select gram, count(*) as n, count(distinct name) as n_names
from (select name, unnest({_GRAMS}) as gram from (select {_norm('p_name')} as name from part))
group by 1"""

_FIRM = "concat_ws(' ', concat_ws(', ', p_name, p_type), 'Inc.')"
_FACILITY = "concat_ws(' ', p_name, p_brand)"


def _matching(sources: str) -> str:
    """Cosine of every source name with every target name that shares a gram."""
    return f"""src as ({sources}),
tgt as (select {_norm(_FACILITY)} as name, count(*) as w, min(p_partkey) as id,
  arg_min(p_brand, p_partkey) as city, arg_min(p_type, p_partkey) as country from part group by 1),
snames as (select name, sum(w) as w from src group by 1),
every as (select name, sum(w) as w from (select name, w from tgt union all select name, w from snames) group by 1),
terms as (select name, w, gram, count(*) as tf
  from (select name, w, unnest({_GRAMS}) as gram from every) group by 1, 2, 3),
vocabulary as (select gram, ln((1 + (select sum(w) from every)) / (1 + sum(w))) + 1 as idf
  from terms group by 1),
weighted as (select name, gram, tf * idf as x from terms join vocabulary using (gram)),
unit as (select name, gram, x / sqrt(sum(x * x) over (partition by name)) as x from weighted),
pairs as (select s.name as s_name, t.name as t_name, sum(s.x * t.x) as cosine
  from unit s join unit t using (gram)
  where s.name in (select name from snames) and t.name in (select name from tgt) group by 1, 2),
best as (select s_name, id, cosine, city, country from pairs join tgt on tgt.name = t_name
  qualify row_number() over (partition by s_name order by round(cosine, 9) desc, id) = 1)"""


_LETTER_MATCH = f"""{_matching(f"select {_FIRM} as raw, {_norm(_FIRM)} as name, count(*) as w from part group by 1, 2")},
matched as (select p_partkey, {_FIRM} as company_name, id as matched_fei, cosine as score
  from part left join best on s_name = {_norm(_FIRM)} and round(cosine, 9) >= 0.5)"""
ORACLE["tfidf_match"] = f"""
with {_LETTER_MATCH}
select p_partkey, company_name, matched_fei, round(coalesce(score, 0), 6) as match_score from matched"""
ORACLE["match_table"] = f"""
with {_LETTER_MATCH}
select 'letters' as source, company_name as name, min(matched_fei) as fei, round(max(score), 6) as score
from matched where matched_fei is not null group by company_name"""

_RECALL_MATCH = f"""{_matching(f'''select {_FIRM} as raw, {_norm(_FIRM)} as name, 1 as w,
  arg_min(p_brand, p_partkey) as s_city, arg_min(p_type, p_partkey) as s_country from part group by 1, 2''')},
accepted as (
  select raw, id, case when round(cosine, 9) >= 0.8 then cosine
    when round(cosine, 9) >= 0.5 and (s_city = city or s_country = country) then cosine + 0.15 end as score
  from src join best on s_name = name),
matched as (select p_partkey, {_FIRM} as recalling_firm, id as matched_fei, score
  from part left join accepted on raw = {_FIRM} and score is not null)"""
ORACLE["match_accept"] = f"""
with {_RECALL_MATCH}
select p_partkey, recalling_firm, matched_fei, round(coalesce(score, 0), 6) as match_score from matched"""
ORACLE["match_rate"] = f"""
with {_RECALL_MATCH}
select count(*) as n_names, count(fei) as n_matched, round(count(fei) / count(*), 6) as rate
from (select recalling_firm, min(matched_fei) as fei from matched group by 1)"""

ORACLE["lookup_join"] = """
select c_custkey, n_name as label, cast(n_nationkey as bigint) as matched_fei
from customer join nation on n_nationkey = c_nationkey where n_nationkey <> 3"""


def _plain(x: str) -> str:
    for entity, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "''"), ("amp", "&")):
        x = f"replace({x}, '&{entity};', '{char}')"
    return x


_TEXT = _plain(r"trim(regexp_replace(regexp_extract(a, '(?s)<a[^>]*>(.*?)</a>', 1), '(?s)\s*<[^>]+>\s*', '', 'g'))")
_HREF = _plain("regexp_extract(a, 'href=\"([^\"]*)\"', 1)")
ORACLE["html_links"] = f"""
with links as (
  select page_id, unnest(found) as a, cast(generate_subscripts(found, 1) - 1 as bigint) as pos
  from (select page_id, regexp_extract_all(html, '(?s)<a [^>]*>.*?</a>') as found from pages))
select page_id, pos, {_TEXT} as link_text,
  case when {_HREF} <> '' and not starts_with({_HREF}, 'http') then 'https://host.example' || {_HREF}
    else {_HREF} end as url
from links"""
ORACLE["html_cells"] = """
select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as posted_date,
  case when o_orderstatus = 'P' then '' else strftime(o_orderdate, '%Y-%m-%d') end as issue_date,
  'Firm' || o_orderkey || '& Co' as company_name,
  case when o_orderstatus = 'F' then 'https://other.example/' || o_orderkey
    else 'https://host.example/c/' || o_orderkey end as letter_url,
  o_orderpriority as issuing_office, '' as subject
from orders"""
ORACLE["html_markup"] = """
select o_orderkey, 'Firm ’' || o_orderkey || '’' || 'AT&T' || 'é<b>' as link_text,
  case o_orderstatus when 'F' then 'https://host.example/p?a=1&b=' || o_orderkey
    when 'O' then 'https://host.example/q/' || o_orderkey else 'http://x.example/' || o_orderkey end as url,
  '1 < 2' || o_orderkey || '&unknown; &lt;' || 'x' as cell
from orders"""
ORACLE["html_inspections"] = """
select c_custkey, c_name as firm_name, 'Springfield' as city, '' as state,
  cast(c_nationkey as varchar) as country, '00000' as zip_code,
  case when c_nationkey < 9 then '2021-02-03' else 'unknown' end as inspection_end_date,
  c_mktsegment as classification, '' as project_area, '' as posted_date, '' as fei_number
from customer"""


# Latest value per column: the last non-null one by date, then by position.
ORACLE["latest_nonnull"] = f"""
with {FEATURES},
r as (select *, case when target_oai = 0 then project_area end as c from features)
select fei_number, arg_max(inspection_id, n_prior_inspections) as inspection_id,
  max(inspection_date) as inspection_date,
  arg_max(c, n_prior_inspections) filter (where c is not null) as country,
  arg_max(n_recalls, n_prior_inspections) as n_recalls, arg_max(pct_oai, n_prior_inspections) as pct_oai
from r group by fei_number"""

_NEXT = f"""{FEATURES},
newest as (select * from features
  qualify row_number() over (partition by fei_number order by n_prior_inspections desc) = 1),
rolled as (
  select * replace (
    n_prior_inspections + 1 as n_prior_inspections, n_prior_oai + target_oai as n_prior_oai,
    n_prior_nai + 1 - target_oai as n_prior_nai,
    round((n_prior_oai + target_oai) / (n_prior_inspections + 1), 6) as pct_oai,
    round(n_prior_vai / (n_prior_inspections + 1), 6) as pct_vai,
    cast(date_diff('day', inspection_date, date '2002-01-01') as bigint) as days_since_last_inspection,
    target_oai as last_classification_oai, 0::bigint as last_classification_vai,
    cast(n_prior_inspections >= 1 and target_oai > last_classification_oai as bigint) as trend_worsening,
    case when n_prior_inspections >= 1 then (target_oai + last_classification_oai) / 2
      else target_oai::double end as recent_oai_rate)
  from newest)"""
ORACLE["next_event_features"] = f"with {_NEXT} select * from rolled"

# A row dated 2002-01-01 for every customer, after all of its orders.
ORACLE["next_event_exact"] = f"""
with {_EVENTS}, {_ITEMS},
newest as (select *, lag(oai) over (partition by fei order by rn) as oai2 from placed
  qualify row_number() over (partition by fei order by rn desc) = 1),
total as (select fei, count(*) as n, sum(oai) as oai, sum(vai) as vai, sum(nai) as nai, sum(cit) as cit,
  sum(cfr) as cfr, max(cit) as max_cit from events_ group by fei),
side as (select fei,
  count(case when flag = 'R' then 1 end) as letters, max(case when flag = 'R' then dt end) as letter,
  count(case when flag = 'A' then 1 end) as recalls,
  count(case when flag = 'A' and line = 'F' then 1 end) as c1,
  count(case when flag = 'A' and line = 'O' then 1 end) as c2,
  count(case when flag = 'N' and status = 'O' then 1 end) as forms
  from items where dt < date '2002-01-01' group by fei)
select n.fei as fei_number, date '2002-01-01' as inspection_date, n.kind as product_type, n.country,
  n.area as project_area, cast(t.n as bigint) as n_prior_inspections, cast(t.oai as bigint) as n_prior_oai,
  cast(t.vai as bigint) as n_prior_vai, cast(t.nai as bigint) as n_prior_nai,
  round(t.oai / t.n, 6) as pct_oai, round(t.vai / t.n, 6) as pct_vai,
  cast(date_diff('day', n.dt, date '2002-01-01') as bigint) as days_since_last_inspection,
  n.oai as last_classification_oai, n.vai as last_classification_vai,
  cast(coalesce(n.oai > n.oai2, false) as bigint) as trend_worsening,
  case when t.n >= 2 then (n.oai + n.oai2) / 2 else 0.0::double end as recent_oai_rate,
  cast(t.cit as bigint) as total_prior_citations, round(t.cit / t.n, 6) as avg_citations_per_inspection,
  cast(t.max_cit as bigint) as max_citations_single_inspection,
  cast(t.cfr as bigint) as total_unique_cfr_violated,
  coalesce(letters, 0) as n_warning_letters, cast(coalesce(letters, 0) > 0 as bigint) as has_warning_letter,
  cast(coalesce(date_diff('day', letter, date '2002-01-01'), -1) as bigint) as days_since_last_wl,
  coalesce(recalls, 0) as n_recalls, cast(coalesce(recalls, 0) > 0 as bigint) as has_recall,
  coalesce(c1, 0) as n_class_I_recalls, coalesce(c2, 0) as n_class_II_recalls,
  coalesce(forms, 0) as n_published_483s, cast(coalesce(forms, 0) > 0 as bigint) as has_published_483
from newest n join total t using (fei) left join side s using (fei)"""

_TIER_APP = """case when score >= 0.6 then 'CRITICAL' when score >= 0.3 then 'HIGH'
  when score >= 0.1 then 'MEDIUM' else 'LOW' end"""
_TIER_BATCH = """case when score <= 0 or score > 1 then null when score <= 0.1 then 'Low'
  when score <= 0.3 then 'Medium' when score <= 0.6 then 'High' else 'Critical' end"""
_RANK = "cast(list_position(['Low', 'Medium', 'High', 'Critical'], risk_tier) - 1 as bigint) as tier_rank"
_SCORES = "(select l_discount * 10 as score, count(*) as n from lineitem group by 1)"
ORACLE["risk_tier_app"] = f"""
select round(score, 6) as score, n, {_TIER_APP} as risk_tier from {_SCORES}"""
ORACLE["risk_tier_batch"] = f"""
select round(score, 6) as score, n, {_TIER_BATCH} as risk_tier,
  {_RANK.replace('risk_tier)', _TIER_BATCH + ')')} from {_SCORES}"""

# Unrounded rates, so that the score is rounded once.
_RULE = """(n_prior_oai / greatest(n_prior_inspections, 1) + recent_oai_rate) / 2"""
_BATCH = f"""{FEATURES},
newest as (select *, {_RULE} as score from features
  qualify row_number() over (partition by fei_number order by n_prior_inspections desc) = 1),
batch as (select fei_number, product_type, country, round(score, 6) as risk_score,
  {_TIER_BATCH} as risk_tier, inspection_date from newest)"""
ORACLE["batch_scores"] = f"with {_BATCH} select *, {_RANK} from batch"
ORACLE["alerts"] = f"with {_BATCH} select *, {_RANK} from batch where risk_tier in ('High', 'Critical')"
ORACLE["tier_counts"] = f"""
with {_BATCH} select risk_tier, count(*) as n from batch where risk_tier is not null group by 1"""
ORACLE["profile_cards"] = f"""
with {_NEXT}, s as (select *, {_RULE} as score from rolled)
select fei_number, product_type, country, project_area,
  strftime(inspection_date, '%Y-%m-%d') as last_inspection, n_prior_inspections as total_inspections,
  n_prior_oai as oai_inspections, n_prior_vai as vai_inspections, n_prior_nai as nai_inspections,
  n_warning_letters as warning_letters, n_recalls as recalls, n_published_483s as published_483s,
  days_since_last_inspection, printf('%.1f%%', round(score * 100, 1)) as risk_score, {_TIER_APP} as risk_tier from s"""
ORACLE["entity_history"] = """
select o_custkey as fei_number, cast(o_orderdate as date) as inspection_date,
  c_mktsegment as product_type, o_orderpriority as project_area,
  case o_orderstatus when 'F' then 'OAI' else 'NAI/VAI' end as classification
from orders left join customer on c_custkey = o_custkey"""
ORACLE["riskiest"] = f"""
with {FEATURES},
top as (select fei_number, inspection_id, inspection_date, {_RULE} as score, target_oai from features
  order by score desc, inspection_id limit 5)
select fei_number, inspection_id, inspection_date, round(score, 6) as risk_score, target_oai,
  row_number() over (order by score desc, inspection_id) as rank from top"""

ORACLE["quality_gates"] = """
with f as (
  select cast(o_orderdate as date) as dt, cast(o_orderstatus = 'F' as int) as y,
    row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) - 1 as prior from orders),
g as (select count(*) as n, avg(y) as rate, count(case when prior = 0 then 1 end) as firsts,
    count(case when year(dt) < 2000 then 1 end) as train, count(case when year(dt) >= 2000 then 1 end) as test,
    date_diff('day', max(case when year(dt) < 2000 then dt end), min(case when year(dt) >= 2000 then dt end)) as gap
  from f)
select 'rows' as gate, n::double as value, cast(n > 10000 as bigint) as passed from g
union all select 'missing_columns', 0, 1
union all select 'target_not_binary', 0, 1
union all select 'target_rate', round(rate, 6), cast(rate > 0.01 and rate < 0.2 as bigint) from g
union all select 'first_rows', firsts, cast(firsts > 0 as bigint) from g
union all select 'history_of_first_rows', 0, 1
union all select 'train_rows', train, cast(train > 0 as bigint) from g
union all select 'test_rows', test, cast(test > 0 as bigint) from g
union all select 'days_between_parts', gap, cast(gap > 0 as bigint) from g"""
ORACLE["score_gates"] = """
with g as (select count(case when l_discount * 11 > 1 or l_discount * 11 < 0 then 1 end) as n from lineitem)
select 'outside_unit_range' as gate, n::double as value, cast(n = 0 as bigint) as passed from g
union all select 'sum_not_one', 0, 1"""

_ORDER_SCORES = """s as (select o_orderkey, cast(o_orderdate as date) as dt, o_totalprice / 500000 as score,
  cast(o_orderstatus = 'F' as int) as y from orders)"""
ORACLE["score_drift"] = f"""
with {_ORDER_SCORES},
b as (select avg(score) as m, stddev_samp(score) as sd from s where year(dt) < 1998),
w as (select cast(date_trunc('week', dt) as date) as week, count(*) as n, avg(score) as mean_score
  from s where year(dt) >= 1998 group by 1)
select week, n, round(mean_score, 6) as mean_score, round(m, 6) as baseline_mean,
  round(abs(mean_score - m) / sd, 6) as deviations, cast(abs(mean_score - m) > 0.25 * sd as bigint) as alert
from w, b"""
_RANKS = ", ".join(f"avg(cast(score <= {i / 10} as int)) as f{i}" for i in range(1, 10)) + ", 1.0 as f10, 0.0 as f0"
_PSI = " + ".join(
    f"(greatest(0.0001, o.f{i} - o.f{i - 1}) - greatest(0.0001, b.f{i} - b.f{i - 1}))"
    f" * ln(greatest(0.0001, o.f{i} - o.f{i - 1}) / greatest(0.0001, b.f{i} - b.f{i - 1}))"
    for i in range(1, 11)
)
_KS = ", ".join(f"abs(o.f{i} - b.f{i})" for i in range(1, 11))
ORACLE["distribution_drift"] = f"""
with {_ORDER_SCORES},
b as (select {_RANKS} from s where year(dt) < 1998),
o as (select cast(date_trunc('month', dt) as date) as month, count(*) as n, {_RANKS} from s where year(dt) >= 1998 group by 1)
select month, n, round({_PSI}, 6) as psi, round(greatest({_KS}), 6) as ks, cast(({_PSI}) > 0.2 as bigint) as alert from o, b"""
ORACLE["sketched_years"] = " union all ".join(
    f"""select * from (select cast({a} as bigint) as first, cast({z} as bigint) as last, cast(sum(count(*)) over () as bigint) as n,
  count(*) over () as quantities, cast(l_quantity as bigint) as item, count(*) as count, cast(1 as bigint) as near
  from lineitem where year(l_shipdate) between {a} and {z} group by l_quantity order by count(*) desc, item limit 5)"""
    for a, z in ((1996, 1997), (1995, 2000))
)
ORACLE["predicted_vs_actual"] = f"""
with {_ORDER_SCORES}
select cast(date_trunc('month', dt) as date) as month, count(*) as n, round(avg(score), 6) as predicted,
  round(avg(y), 6) as actual, round(avg(score) - avg(y), 6) as gap
from s group by 1"""
ORACLE["training_window"] = f"""
with {_ORDER_SCORES}
select cast(year(dt) as bigint) as part, count(*) as n_rows, cast(sum(y) as bigint) as n_pos,
  round(avg(y), 6) as rate
from s where dt >= date '1997-07-01' and dt < date '2000-07-01' group by 1"""
ORACLE["letter_within_year"] = f"""
with {_ITEMS}
select o.o_orderkey, o.o_custkey, cast(o.o_orderdate as date) as o_date, count(i.dt) as n_warning_letters
from orders o left join items i on i.fei = o.o_custkey and i.flag = 'R'
  and i.dt > cast(o.o_orderdate as date) and i.dt <= cast(o.o_orderdate as date) + 365
group by o.o_orderkey, o.o_custkey, o.o_orderdate"""

_SECTIONS = {
    "sterility": "113, 42, 46", "process_validation": "100, 110", "quality_system": "22, 192",
    "records_documentation": "180, 186", "testing_lab": "160, 165",
}
_KINDS = [
    *[(k, f"l_partkey % 200 in ({v})") for k, v in _SECTIONS.items()],
    ("other", f"l_partkey % 200 not in ({', '.join(_SECTIONS.values())})"),
]
_BEFORE = "over (partition by fei order by dt, id, area rows between unbounded preceding and 1 preceding)"
ORACLE["severity_history"] = f"""
with {_EVENTS},
c as (select l_orderkey, {', '.join(f'count(case when {test} then 1 end) as {k}' for k, test in _KINDS)}
  from lineitem group by 1)
select id as inspection_id,
  {', '.join(f'cast(coalesce(sum({k}) {_BEFORE}, 0) as bigint) as prior_citations_{k}' for k, _ in _KINDS)}
from events_ left join c on l_orderkey = id"""
_SUBJECTS = {
    "cgmp": "F", "unapproved_drug": "O", "adulterated": "F", "misbranded": "O", "medical_device": "-",
    "compounding": "-", "fsvp": "-",
}
ORACLE["subject_history"] = f"""
with {_ITEMS}
select o.o_orderkey, {', '.join(
    f"count(case when i.line = '{v}' then 1 end) as wl_{k}" for k, v in _SUBJECTS.items())}
from orders o left join items i on i.fei = o.o_custkey and i.flag = 'R'
  and i.dt < cast(o.o_orderdate as date)
group by o.o_orderkey"""

_CUT = "o_orderdate < timestamp '2000-01-01'"
_LINEAR = [
    "n_prior_inspections", "n_prior_oai", "n_prior_vai", "n_prior_nai", "pct_oai", "pct_vai",
    "days_since_last_inspection", "last_classification_oai", "last_classification_vai", "trend_worsening",
    "recent_oai_rate", "total_prior_citations", "avg_citations_per_inspection",
    "max_citations_single_inspection", "total_unique_cfr_violated", "n_warning_letters", "has_warning_letter",
    "days_since_last_wl", "n_recalls", "has_recall", "n_class_I_recalls", "n_class_II_recalls",
    "n_published_483s", "has_published_483",
]
_NOT_TREES = ["has_warning_letter", "has_recall", "has_published_483", "pct_oai", "pct_vai", "last_classification_oai"]
_TREES = [c for c in _LINEAR if c not in _NOT_TREES]
_LISTS = " union all ".join(
    f"select '{m}' as model, cast({i} as bigint) as place, '{c}' as feature, count(\"{c}\") as n_known from features"
    for m, names in (("linear", _LINEAR), ("trees", _TREES))
    for i, c in enumerate(names)
)
ORACLE["feature_lists"] = f"with {FEATURES} {_LISTS}"

ORACLE["codes_of_older_rows"] = f"""
with rows_ as (select o_orderkey, o_orderdate, n_name, c_mktsegment,
  concat_ws(' ', c_mktsegment, case when o_orderkey % 7 = 0 then cast(year(o_orderdate) as varchar) end) as segment
  from {_WITH_CUSTOMER}),
a as (select v, row_number() over (order by v) - 1 as code
  from (select distinct coalesce(n_name, 'nan') as v from rows_ where {_CUT})),
b as (select v, row_number() over (order by v) - 1 as code
  from (select distinct coalesce(segment, 'nan') as v from rows_ where {_CUT}))
select o_orderkey, n_name, c_mktsegment, segment, coalesce(a.code, -1) as n_name_encoded,
  coalesce(b.code, -1) as segment_encoded
from rows_ left join a on a.v = coalesce(n_name, 'nan') left join b on b.v = coalesce(segment, 'nan')"""

ORACLE["class_weights"] = f"""
select n_neg, n_pos, round((n_neg + n_pos) / (2 * n_neg), 6) as w_neg, round((n_neg + n_pos) / (2 * n_pos), 6) as w_pos,
  round(n_neg / n_pos, 6) as ratio
from (select count(case when o_orderstatus <> 'F' then 1 end) as n_neg,
  count(case when o_orderstatus = 'F' then 1 end) as n_pos from orders where {_CUT})"""

ORACLE["time_folds"] = """
with days as (select cast(o_orderdate as date) as day, count(*) as n from orders group by 1),
run as (select day, sum(n) over (order by day) - n as before_, (select count(*) from orders) as total from days),
cuts as (select f.fold, min(day) as start, min(before_) as n_train, any_value(total) as total
  from run, (select unnest([1, 2, 3]) as fold) f where before_ * 4 >= f.fold * total group by 1)
select cast(fold as bigint) as fold, start, cast(n_train as bigint) as n_train,
  cast(coalesce(lead(n_train) over (order by fold), total) - n_train as bigint) as n_valid
from cuts"""

ORACLE["scaled_features"] = """
select count(*) as n, 0.0::double as l_quantity_mean, 0.0::double as l_discount_mean,
  1.0::double as l_quantity_sd, 1.0::double as l_discount_sd from lineitem"""

_FLAG = """(select cast(l_linestatus = 'F' as bigint) as flag,
  cast(l_returnflag = 'R' or l_quantity > 45 as int) as y from lineitem)"""
ORACLE["logistic_of_one_flag"] = f"""
select flag, count(*) as n, round(avg(y), 3) as score from {_FLAG} group by 1"""
ORACLE["trees_of_one_flag"] = f"""
with r as {_FLAG}, b as (select avg(y) as p from r)
select flag, count(*) as n,
  round(1 / (1 + exp(-(ln(any_value(p) / (1 - any_value(p))) - 0.1 * sum(p - y) / (sum(p * (1 - p)) + 1)))), 6) as score
from r, b group by 1"""


def _stumps(trees: int) -> str:
    """Second-order boosting with trees of one split, every value of both columns tried."""
    steps = [
        """rows0 as materialized (select cast(l_quantity as double) as l_quantity, cast(l_discount as double) as l_discount,
  cast(l_returnflag = 'R' or l_quantity > 45 as int) as y from lineitem),
margins0 as materialized (select *, (select ln(avg(y) / (1 - avg(y))) from rows0) as m from rows0)"""
    ]
    for t in range(trees):
        steps.append(
            f"""parts{t} as (select *, 1 / (1 + exp(-m)) - y as g, 1 / (1 + exp(-m)) * (1 - 1 / (1 + exp(-m))) as h from margins{t}),
sums{t} as (select 0 as k, l_quantity as v, sum(g) as g, sum(h) as h from parts{t} group by 2
  union all select 1, l_discount, sum(g), sum(h) from parts{t} group by 2),
below{t} as (select k, v, sum(g) over below as lg, sum(h) over below as lh, sum(g) over whole as ag, sum(h) over whole as ah from sums{t}
  window below as (partition by k order by v rows between unbounded preceding and 1 preceding), whole as (partition by k)),
gains{t} as (select *, lg * lg / (lh + 1) + (ag - lg) * (ag - lg) / (ah - lh + 1) - ag * ag / (ah + 1) as gain from below{t}
  where lh >= 1 and ah - lh >= 1),
best{t} as materialized (select *, -0.1 * lg / (lh + 1) as lv, -0.1 * (ag - lg) / (ah - lh + 1) as rv from gains{t} order by gain desc, k, v limit 1),
margins{t + 1} as materialized (select r.* exclude (m), m + case when (case when b.k = 0 then l_quantity else l_discount end) < b.v
  then lv else rv end as m from margins{t} r, best{t} b)"""
        )
    told = " union all ".join(f"select {t} as tree, * from best{t}" for t in range(trees))
    return f"""with {', '.join(steps)} select cast(tree as bigint) as tree, case k when 0 then 'l_quantity' else 'l_discount' end as feature,
  round(v, 2) as threshold, round(gain, 1) as gain, round(lv, 6) as left_value, round(rv, 6) as right_value from ({told})"""


ORACLE["boosted_splits"] = _stumps(2)
ORACLE["shapley_of_two_flags"] = """
with r as (select cast(l_linestatus = 'F' as bigint) as a, cast(l_quantity > 25 as bigint) as b,
  cast(l_returnflag = 'R' or l_quantity > 45 as int) as y from lineitem),
p as (select avg(y) as p from r),
cells as (select a, b, count(*) as n, sum(p * (1 - p)) as h, -0.1 * sum(p - y) / (sum(p * (1 - p)) + 1) as v from r, p group by 1, 2),
shares as (select *, sum(h) over (partition by b) as hb, sum(h) over () as hh from cells),
known as (select *, sum(v * hb / hh) over (partition by a) as of_a, sum(v * h / hb) over (partition by b) as of_b,
  sum(v * h / hh) over () as of_none from shares)
select a, b, n, round(ln(p / (1 - p)) + v, 6) as margin, round((of_a - of_none + v - of_b) / 2, 6) as a_value,
  round((of_b - of_none + v - of_a) / 2, 6) as b_value, round(ln(p / (1 - p)) + of_none, 6) as base
from known, p"""

_PRECISION = " union all ".join(
    f"""select {i} as sequence, '{v}' as version, sum(pos / p * tp / (tp + fp)) as pr_auc from (
  select pos, sum(pos) over up as tp, sum(neg) over up as fp, sum(pos) over () as p
  from (select {c} as s, sum(y)::double as pos, sum(1 - y)::double as neg from r group by 1)
  window up as (order by s desc rows between unbounded preceding and current row))"""
    for i, (v, c) in enumerate(
        {"v8": "l_quantity", "v9": "-l_quantity", "v10": "l_discount", "v11": "case l_linestatus when 'F' then l_tax else -l_tax end"}.items(), 1
    )
)
ORACLE["registry"] = f"""
with r as (select *, cast(l_returnflag = 'R' as int) as y from lineitem),
m as ({_PRECISION}),
seen as (select *, max(pr_auc) over (order by sequence rows between unbounded preceding and 1 preceding) as best from m)
select cast(sequence as bigint) as sequence, version, round(pr_auc, 6) as pr_auc, cast(best is null or pr_auc > best as bigint) as promoted,
  cast(pr_auc = (select max(pr_auc) from m) as bigint) as is_champion from seen"""
ORACLE["model_gates"] = f"""
with u as ({ORACLE["model_comparison"]}),
m as (select min(roc_auc) as roc, min(pr_auc) as pr from u)
select 'roc_auc' as gate, roc as value, cast(roc > 0.7 as bigint) as passed from m
union all select 'pr_auc', pr, cast(pr > 0.2 as bigint) from m union all select 'n_features', 12.0, 1"""
ORACLE["additivity"] = """
select o_orderkey as inspection_id, 0.0::double as off from orders, (select unnest([1, 2]))
where o_orderdate >= timestamp '2000-01-01' and o_custkey is not null"""

_WEIGHTS = {"n_prior_oai": 0.375, "n_prior_nai": -0.125, "n_recalls": 0.0625}
_PARTS = " union all ".join(
    f"select inspection_id, '{c}' as feature, {c}::double as value, {w} * ({c} - (select avg({c}) from features)) "
    "as contribution from features"
    for c, w in _WEIGHTS.items()
)
_RULED = f"""{FEATURES}, long as ({_PARTS}),
margins as (select inspection_id, sum(contribution) - 0.5 as margin from long group by 1),
ruled as (select f.inspection_id, fei_number, target_oai, margin, 1 / (1 + exp(-margin)) as risk_score
  from features f join margins using (inspection_id)),
strongest as (select *, row_number() over (partition by inspection_id order by round(abs(contribution), 9) desc, feature)
  as place from long),
texts as (select *, case when contribution > 0 then '↑' else '↓' end || ' ' || feature || ' = '
  || printf('%.0f', value) || ' (impact: ' || printf('%+.3f', round(round(contribution, 9) + sign(contribution) * 1e-10, 3)) || ')' as driver from strongest)"""
_DRIVER = "place, feature, value, round(contribution, 6) as contribution, driver"
ORACLE["rule_drivers"] = f"with {_RULED} select inspection_id, {_DRIVER} from texts where place <= 2"
ORACLE["rule_importance"] = f"""
with {_RULED} select feature, round(avg(abs(contribution)), 6) as importance from long group by 1"""
ORACLE["rule_direction"] = f"""
with {_RULED} select feature, round(corr(value, contribution), 6) as correlation,
  round(avg(contribution), 6) as mean_contribution, round(min(contribution), 6) as lowest,
  round(max(contribution), 6) as highest from long group by 1"""
_CORRELATIONS = ", ".join(
    f"""case when stddev_pop(contribution) = 0 or stddev_pop({c}) = 0 then 0
    else abs(covar_pop(contribution, {c}) / (stddev_pop(contribution) * stddev_pop({c}))) end as r_{c}"""
    for c in _WEIGHTS
)
_STRENGTHS = " union all ".join(
    f"select feature, '{c}' as partner, sum(n * r_{c}) / sum(n) as strength from bins where feature <> '{c}' group by 1"
    for c in _WEIGHTS
)
_HIGH = " ".join(f"when '{c}' then {c} > (select avg({c}) from features)" for c in _WEIGHTS)
ORACLE["rule_dependence"] = f"""
with {_RULED}, wide as (select feature, value, contribution, floor(value / 2) as bin, {', '.join(_WEIGHTS)}
  from long join features using (inspection_id) where feature in ('n_prior_oai', 'n_recalls')),
bins as (select feature, bin, count(*) as n, {_CORRELATIONS} from wide group by 1, 2),
strengths as ({_STRENGTHS}),
partners as (select feature, arg_min(partner, (-round(strength, 6), partner)) as partner from strengths group by 1)
select feature, bin * 2 as value, partner, cast(case partner {_HIGH} end as bigint) as partner_high, count(*) as n,
  round(avg(contribution), 6) as mean_contribution
from wide join partners using (feature) group by 1, 2, 3, 4"""
ORACLE["rule_waterfall"] = f"""
with {_RULED}, cases as (
  select 'true_positive' as "case", * from (select * from ruled where target_oai = 1 and risk_score > 0.5
    order by inspection_id limit 1)
  union all select 'false_negative', * from (select * from ruled where target_oai = 1 and risk_score < 0.2
    order by inspection_id limit 1))
select inspection_id, "case", round(risk_score, 6) as risk_score, round(margin, 6) as margin, {_DRIVER},
  -0.5::double as base
from cases join texts using (inspection_id)"""
ORACLE["rule_report"] = f"""
with {_RULED}, head as (select *, row_number() over (order by risk_score desc, inspection_id) as rank from ruled
  order by risk_score desc, inspection_id limit 5)
select inspection_id, rank, printf('%.1f%%', risk_score * 100) as score_text,
  case target_oai when 1 then 'OAI' else 'Non-OAI' end as actual, round(risk_score, 6) as risk_score, fei_number, {_DRIVER}
from head join texts using (inspection_id)"""

ORACLE["csv_inspections"] = """
select o_orderkey as id, o_custkey as fei, 'Firm "' || o_custkey || '", Inc.' as name, cast(null as varchar) as city,
  cast(o_orderdate as date) as day, o_orderstatus as outcome, cast(year(o_orderdate) as bigint) as year from orders"""
ORACLE["csv_citations"] = """
select nullif(l_returnflag, 'N') as code, 'a, b' as text, count(*) as n, cast(sum(l_orderkey) as bigint) as ids,
  cast(sum(l_suppkey) as bigint) as keys from lineitem group by 1"""
ORACLE["csv_forms"] = """
select o_orderkey as id, case o_orderstatus when 'F' then o_custkey else o_custkey + 9007199254740993 end as fei,
  cast(o_orderdate as date) as day
from orders where o_orderstatus in ('F', 'O') and o_orderpriority <> '5-LOW'"""
ORACLE["json_letters"] = """
select o_orderkey as id, cast(o_custkey as varchar) as company_name,
  case when o_orderpriority <> '5-LOW' then cast(o_orderdate as date) end as issue_date,
  cast(null as varchar) as letter_url from orders"""
ORACLE["json_recalls"] = """
select case l_returnflag when 'R' then 'drug' else 'device' end as source, cast(l_suppkey as varchar) as recalling_firm,
  case l_linestatus when 'F' then 'Class I' else '' end as classification, '' as status, count(*) as n,
  count(case when l_linenumber <> 1 then 1 end) as n_dated,
  max(case when l_linenumber <> 1 then cast(l_shipdate as date) end) as newest
from lineitem where l_returnflag in ('R', 'A') group by 1, 2, 3"""
ORACLE["document_recalls"] = """
select cast(l_suppkey as varchar) as recalling_firm, l_returnflag as classification, count(*) as n
from lineitem group by 1, 2"""
ORACLE["whole_recalls"] = ORACLE["document_recalls"]
ORACLE["array_letters"] = """
select o_orderkey as id, 'Firm } "{' || o_custkey as company_name, cast(o_orderdate as date) as issue_date,
  cast(null as varchar) as letter_url from orders"""
ORACLE["document_mapping"] = "select 'letters' as source, c_name as name, c_custkey as fei from customer"
ORACLE["stored_features"] = f"""
with {FEATURES} select project_area, count(*) as n, cast(sum(n_prior_oai) as bigint) as n_prior_oai,
  cast(sum(total_prior_citations) as bigint) as citations from features group by 1"""
ORACLE["stored_mapping"] = ORACLE["match_table"]
ORACLE["dated_partitions"] = """
select o_orderkey, o_orderstatus, case o_orderstatus when 'P' then date '2001-08-02' else date '2001-08-01' end as run_date
from orders where o_orderstatus in ('P', 'O')"""
