"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from geoloom.llm import secret_ledger


def _spans() -> str:
    parts = []
    for rank, rule in enumerate(secret_ledger.RULES):
        p = rule.pattern.replace("'", "''")
        parts.append(
            f"""select doc_id, {rank} as rank, '{rule.name}' as kind, unnest(range(1, len(m) + 1)) as i,
                m, j, g from (select doc_id, regexp_extract_all(t, '{p}', 0) as m,
                regexp_extract_all(t, '{p}', {rule.group}) as j, string_split_regex(t, '{p}') as g from d)"""
        )
    located = " union all ".join(
        f"""select doc_id, rank, kind, length(j[i]) as size,
            list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) as s,
            length(m[i]) as n, {rule.least} as least from ({part})"""
        for rule, part in zip(secret_ledger.RULES, parts)
    )
    return f"select doc_id, rank, kind, s::bigint as s, (s + n)::bigint as e from ({located}) where size >= least"


_BASE = ", ".join(f"'{r.name}'" for r in secret_ledger.BASE)
_COUNTS = ", ".join(f"count(*) filter (kind = '{r.name}') as n_{r.name}" for r in secret_ledger.BASE)
SECRET_SCANS = f"""
with d as (select doc_id, coalesce(text, '') as t from documents), spans as ({_spans()}),
per as (select doc_id, {_COUNTS},
    string_agg(kind || ':' || s || ':' || e, ',' order by s, rank) filter (kind in ({_BASE})) as base,
    string_agg(kind || ':' || s || ':' || e, ',' order by s, rank) as spans from spans group by doc_id)
select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
    sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join per using (doc_id)"""

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
DECONTAMINATION = f"""
with d as materialized (select doc_id, {_WORDS} as w from documents),
b as (select item_id, {_WORDS} as w from benchmark),
item_windows as (select distinct item_id, len(x) as n, array_to_string(x, ' ') as x from (
    select item_id, unnest(list_transform(range(0, greatest(len(w) - 10, 0) + 1), lambda i: w[i + 1:i + 10])) as x
    from b where len(w) > 0)),
doc_windows as (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as x from (
    select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i
    from d, (select distinct n from item_windows) where len(w) >= n)),
hits as (select distinct doc_id, item_id, i, n from doc_windows join item_windows using (n, x)),
places as (select doc_id, count(distinct p) as n_hit from (
    select doc_id, unnest(range(i, i + n)) as p from hits) group by doc_id),
items as (select doc_id, count(*) as n_items, string_agg(k, ',' order by k) as k from (
    select distinct doc_id, item_id::varchar as k from hits) group by doc_id)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(k, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join places using (doc_id) left join items using (doc_id)"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
NEAR_DUPLICATES = f"""
with recursive d as materialized (select doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') as w from documents),
s as materialized (select distinct doc_id, unnest(case when len(w) >= 3
    then list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as x from d),
n as materialized (select doc_id, count(*) as n from s group by doc_id),
o as (select a.doc_id as u, b.doc_id as v, count(*) as k from s a join s b on a.x = b.x and a.doc_id < b.doc_id group by all),
links as materialized (select u, v from o join n p on p.doc_id = u join n q on q.doc_id = v
    where 100 * k >= 85 * (p.n + q.n - k)),
ways as (select u, v from links union all select v, u from links),
reach as (select doc_id, doc_id as other from n union select reach.doc_id, ways.v from reach join ways on ways.u = reach.other),
least as (select doc_id, min(other) as c from reach group by doc_id)
select d.doc_id, coalesce(n.n, 0) as n_shingles, coalesce(least.c, d.doc_id) as component_id,
    coalesce(least.c, d.doc_id) = d.doc_id as kept
from d left join n using (doc_id) left join least using (doc_id)"""

TOP_K = """
with e as (select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v from embeddings
    where vec_id is not null and len(embedding) > 0
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, p.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * p.v[i]))::bigint as score
    from e q join e p on p.vec_id != q.vec_id and len(p.v) = len(q.v) where q.vec_id % 20 = 0)
select * from (select query_id, row_number() over (partition by query_id order by score desc, vec_id) as rank, vec_id, score from s)
where rank <= 20"""

PERSPECTIVES = r"""
with t as (select conv_id, turn, coalesce(role, '') as speaker, coalesce(text, '') as body from conversations),
p as (select distinct conv_id, speaker as participant from t where speaker != 'system'),
r as (select t.*, participant, case when speaker = participant then 'assistant' when speaker = 'system' then 'system' else 'user' end as role
    from t join p on t.conv_id is not distinct from p.conv_id),
x as (select *, '<|im_start|>' || role || case when role = 'user' then ' name=' || regexp_replace(speaker, '[^A-Za-z0-9_-]', '_', 'g') else '' end
    || chr(10) as head, regexp_replace(body, '<\|(im_start|im_end)\|>', '<| \1|>', 'g') || '<|im_end|>' as content from r),
o as (select *, head || content || chr(10) as segment,
    row_number() over w as seq, coalesce(sum(length(head || content) + 1) over (w rows between unbounded preceding and 1 preceding), 0) as s
    from x window w as (partition by conv_id, participant order by turn nulls first, speaker, body))
select conv_id, participant, seq, turn, role, segment as text, s as start, s + length(segment) as "end",
    case when role = 'assistant' then s + length(head) end as mask_start,
    case when role = 'assistant' then s + length(head) + length(content) end as mask_end from o"""


def _prefixed(key: str, cost: str, letter: str) -> str:
    """A repair with one more edit in front; repairs are their cost in ten digits and their audit, so strings compare."""
    return f"printf('%010d', {key}[:10]::bigint + {cost}) || '{letter}' || {key}[11:]"


def _edits(state: int, fits: str) -> str:
    due = 3 if state == 2 else 2
    keeps = " ".join(f"when f < 2 and cls = '{c}' then {_prefixed(f'k{n}', 'late', 'K')}" for c, n in zip(fits[::2], fits[1::2]))
    rename = f"case when f < 2 then {_prefixed(f'k{due}', '2 + late', 'R')} end"
    return f"least({_prefixed(f'k{state}', '3', 'D')}, case {keeps} end, {rename}) as b{state}"


_BASE_EDITS = ", ".join(_edits(q, fits) for q, fits in enumerate(["s1u2", "u2", "a3", "u2"]))
CONVERSATION_REPAIR = rf"""
with recursive tab as (select list(c order by i) as t from (select i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c from range(256) r(i))),
keyed as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k from conversations),
faulty as (select *, xor(list_reduce(list_concat([4294967295], list_transform(range(1, length(k) + 1), lambda i: unicode(k[i])::bigint)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 as fault from keyed, tab),
damaged as (select conv_id, turn, case when fault = 4 then 'user' else role end as role,
    case fault when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(range(case when fault = 3 then 2 else 1 end)) as copy from faulty where fault != 0),
placed as (select *, row_number() over (partition by conv_id order by turn nulls first, role, md5(text), copy) as n from damaged),
judged as (select *, left(role, 1) as cls, case when not regexp_matches(text, '[^ 	-]') then 'blank'
    when row_number() over (partition by conv_id, role, text order by n) > 1 then 'duplicate'
    when not regexp_matches(text, '[.!?][ 	-]*$') then 'truncated' end as fault,
    lag(left(role, 1)) over (partition by conv_id order by n) as cls_before from placed),
rows_of as (select *, case when fault in ('blank', 'duplicate') then 2 when fault = 'truncated' then 1 else 0 end as f from judged),
per as (select conv_id, count(*) as size, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
    count(*) filter (fault = 'truncated') as truncated,
    count(*) filter (cls_before is not null and cls_before || cls not in ('su', 'ua', 'au')) as illegal from rows_of group by conv_id),
back as (
    select conv_id, size as i, '0000000000' as k0, '0000000004II' as k1, '0000000002I' as k2, '0000000000' as k3 from per
    union all
    select conv_id, i, least(b0, {_prefixed("l2", "2", "I")}), least(b1, {_prefixed("l2", "2", "I")}), l2, l3 from (
        select conv_id, i, b0, b1, least(b2, {_prefixed("b3", "2", "I")}) as l2, least(b3, {_prefixed("b2", "2", "I")}) as l3 from (
            select conv_id, i - 1 as i, {_BASE_EDITS} from (
                select back.*, cls, f, case when f = 1 then 1 else 0 end as late
                from back join rows_of r on r.conv_id is not distinct from back.conv_id and r.n = back.i)))),
best as (select conv_id, k0[:10]::bigint as cost, k0[11:] as audit from back where i = 0),
letters as (select conv_id, p, audit[p] as x from (select conv_id, audit, unnest(range(1, length(audit) + 1)) as p from best)),
counted as (select *, count(*) filter (x != 'I') over w as r, count(*) filter (x != 'D') over w - 1 as e from letters
    window w as (partition by conv_id order by p rows unbounded preceding)),
spoken as (select c.*, role, text, max(case when e = 0 and x = 'K' and cls = 's' then 1 else 0 end) over (partition by c.conv_id) as sys
    from counted c left join rows_of o on o.conv_id is not distinct from c.conv_id and o.n = c.r and x != 'I' where x != 'D'),
texts as (select conv_id, string_agg(case when x = 'K' then role when (e - sys) % 2 = 0 then 'user' else 'assistant' end
    || ':' || coalesce(text, ''), chr(10) order by p) as whole from spoken group by conv_id)
select a.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
    coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(cost, 0) as cost, coalesce(audit, '') as audit,
    sha256(coalesce(whole, '')) as repaired_sha256
from (select distinct conv_id from conversations) a left join per on per.conv_id is not distinct from a.conv_id
    left join best on best.conv_id is not distinct from a.conv_id left join texts on texts.conv_id is not distinct from a.conv_id"""


def _rounds(rounds: int) -> str:
    steps = []
    for t in range(rounds + 1):
        steps.append(f"""a{t} as materialized (select r, any_value(vec_id) as vec_id, any_value(v) as v, min({{'d': d, 'j': j}}) as b from (
            select k.*, j, list_sum(list_transform(range(1, 65), lambda i: (v[i] - c[i]) * (v[i] - c[i])))::bigint as d
            from kept k, c{t}) group by r)""")
        if t < rounds:
            steps.append(f"""c{t + 1} as materialized (select o.j, coalesce(m.c, o.c) as c from c{t} o left join (
                select j, list((s - ((s % n + n) % n)) // n order by i) as c from (
                    select j, i, sum(x)::bigint as s, count(*) as n from (
                        select b.j as j, unnest(v) as x, unnest(range(64)) as i from a{t}) group by j, i) group by j) m using (j))""")
    return ", ".join(steps)


CENTROIDS = f"""
with kept as materialized (select row_number() over () as r, * from (
    select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v from embeddings
    where vec_id is not null and len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)),
c0 as materialized (select row_number() over (order by h, c) - 1 as j, c from (
    select sha256('3:' || vec_id) as h, v as c from kept order by h, c limit 8)),
{_rounds(10)}
select vec_id, b.j::int as cluster, b.d as distance, sum(b.d) over (partition by b.j)::bigint as cluster_inertia,
    sum(b.d) over ()::bigint as inertia, sha256(array_to_string(c, ',')) as centroid_sha256 from a10 join c10 on c10.j = b.j"""
