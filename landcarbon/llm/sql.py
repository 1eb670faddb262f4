"""The same results as SQL, for those operators that SQL can express."""

from __future__ import annotations

from landcarbon.llm import curriculum, decontaminate, quality_rules, secret_scan
from landcarbon.llm.common import WHITE

_ROLES = {"id": [], "secret": [], "endpoint": []}
for _rank, (_name, _role, _pattern, _gate) in enumerate(secret_scan.KINDS):
    _ROLES[_role].append(str(_rank))


def _kind(rank: int, pattern: str) -> str:
    return f"""select rid, {rank} as rank, unnest(regexp_extract_all(t, '{pattern}')) as m, unnest(string_split_regex(t, '{pattern}')[:-2]) as p,
        generate_subscripts(regexp_extract_all(t, '{pattern}'), 1) as i from d"""


def _near(role: str, x: str = "x") -> str:
    return f"""exists (select 1 from parts y where y.rid = {x}.rid and y.rank in ({', '.join(_ROLES[role])}) and (y.e <= {x}.s or y.s >= {x}.e)
        and greatest(y.s, {x}.s) - least(y.e, {x}.e) <= {secret_scan.SCOPE})"""


def secrets_sql() -> str:
    kinds = " union all ".join(_kind(r, k[2]) for r, k in enumerate(secret_scan.KINDS))
    names = ", ".join(f"'{n}'" for n in secret_scan.NAMES)
    joined = "coalesce(string_agg(name || ':' || s || ':' || e, ',' order by s, rank, e) {}, '')"
    return f"""
with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
found as (select rid, rank, m, i, length(p) as g, length(m) as n from ({kinds})),
placed as (select rid, rank, m, sum(g + n) over (partition by rid, rank order by i) as e, n from found),
parts as (select row_number() over () as id, rid, rank, cast(e - n as bigint) as s, cast(e as bigint) as e from placed
    where rank > 0 or length(regexp_extract(m, '{secret_scan.ASSIGN}', 1)) >= 12),
kept as (select *, [{names}][rank + 1] as name from parts x where rank < 3
    or (rank = 3 and {_near('secret')}) or (rank = 4 and ({_near('id')} or {_near('endpoint')}))
    or (rank = 5 and {_near('id')} and {_near('secret')}))
select any_value(doc_id) as doc_id, count(*) filter (rank = 0) as n_assign, count(*) filter (rank = 1) as n_access,
    count(*) filter (rank = 2) as n_hex, count(*) filter (rank > 2) as n_linked,
    sha256({joined.format('filter (rank < 3)')}) as base_sha256, {joined.format('filter (rank >= 0)')} as spans
from d left join kept using (rid) group by rid"""


def quality_sql() -> str:
    stop = ", ".join(f"'{s}'" for s in sorted(set(quality_rules.STOP_WORDS)))
    broken = " or ".join(quality_rules.rule_sql(m, lo, hi).replace("0D", "0").replace("D ", " ").replace("D,", ",") for _, m, lo, hi in quality_rules.RULES)
    return rf"""
with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
w as (select *, regexp_extract_all(t, '[^{WHITE}]+') as w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^{WHITE}]')) as l from d),
win as (select rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as k from w, unnest(range(1, len(w) - 1)) as r(i)),
twice as (select rid, i from (select *, count(*) over (partition by rid, k) as c from win) where c > 1),
rep as (select rid, count(distinct i + o) as n from twice, range(0, 3) as r(o) group by rid),
c as (select rid, doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) as n_symbols, len(regexp_extract_all(t, '[A-Z]')) as n_upper,
    len(list_filter(w, lambda x: lower(x) in ({stop}))) as n_stop, len(l) as n_lines, len(l) - len(list_distinct(l)) as n_dup_lines,
    len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)[{WHITE}]*$'))) as n_cut_lines,
    len(list_filter(l, lambda x: regexp_matches(x, '^[{WHITE}]*[-*•]'))) as n_bullets, coalesce(rep.n, 0) as n_repeat_words
    from w left join rep using (rid))
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols,
    cast(n_dup_lines as bigint) as n_dup_lines, cast(n_repeat_words as bigint) as n_repeat_words, ({quality_rules.BASE_FAILED}) as base_failed,
    not ({quality_rules.BASE_FAILED}) and not ({broken}) as kept
from c"""


def decontaminate_sql() -> str:
    n = decontaminate.WINDOW
    words = "string_split(trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g')), ' ')"
    return f"""
with items as (select coalesce(cast(item_id as varchar), 'null') as item, list_filter({words}, lambda x: x <> '') as w from benchmark),
docs as (select row_number() over () as rid, doc_id, list_filter({words}, lambda x: x <> '') as w from documents),
wins as (select distinct item, least(len(w), {n}) as n, array_to_string(w[i:i + least(len(w), {n}) - 1], ' ') as k
    from items, unnest(range(1, greatest(len(w) - {n}, 0) + 2)) as r(i) where len(w) > 0),
sizes as (select distinct n from wins),
places as (select rid, n, i, array_to_string(w[i:i + n - 1], ' ') as k from docs, sizes, unnest(range(1, len(w) - n + 2)) as r(i)),
hits as (select rid, item, i, n from places join wins using (n, k)),
hit_words as (select rid, count(distinct i + o) as n_hit from (select rid, i, unnest(range(0, n)) as o from (select distinct rid, i, n from hits)) group by rid),
hit_items as (select rid, count(*) as n_items, string_agg(item, ',' order by item) as ids from (select distinct rid, item from hits) group by rid)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs left join hit_words using (rid) left join hit_items using (rid)"""


def _due(schedule: tuple, share: str) -> str:
    """The inverse of a schedule's integral, segment by segment."""
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(schedule, schedule[1:])]
    out = []
    for k, area in enumerate(areas):
        (t0, w0), (t1, w1) = schedule[k], schedule[k + 1]
        over = f"({share} * {sum(areas)!r}::double - {float(sum(areas[:k]))!r}::double)"
        root = f"sqrt(greatest({w0 * w0!r}::double + {2 * (w1 - w0) / (t1 - t0)!r}::double * {over}, 0::double))"
        inside = f"case when {over} > 0 then {t0!r}::double + 2 * {over} / ({w0!r}::double + {root}) else {t0!r}::double end"
        out.append(f"when {over} <= {area!r}::double then least({inside}, {t1!r}::double)")
    return f"case {' '.join(out)} else 1::double end"


def curriculum_sql() -> str:
    weights = ", ".join(f"{float(w)!r}::double" for w in curriculum.WEIGHTS)
    last = len(curriculum.LONG)
    length = " ".join(f"when size > target * {x!r}::double then {k}" for k, x in enumerate(curriculum.LONG))
    carried, needs = [], []
    for k in range(last + 1):
        before = "0::double" if k == 0 else "coalesce(o.left_over, 0::double)"
        old = "" if k == 0 else f"left join left{k - 1} o on o.source is not distinct from c.source"
        needs.append(f"select source, length, need from need{k}")
        carried.append(f"""need{k} as (select c.source, c.length, c.part + {before} as need from part c {old} where c.length = {k}),
left{k} as (select c.source, case when n.need is null then {before} else n.need - coalesce((select sum(d.size) from own d
    where d.length = {k} and d.source is not distinct from c.source and d.before + d.size / 2 < n.need), 0) end as left_over
    from src c left join need{k} n on n.source is not distinct from c.source {old})""")
    time = " ".join(f"when turn % {len(curriculum.SCHEDULES)} = {k} then {_due(s, '(before / total)')}" for k, s in enumerate(curriculum.SCHEDULES))
    return f"""
with s as (select row_number() over () as rid, doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^{WHITE}]+')) as bigint) as size from documents),
src as (select source, cast(sum(size) as bigint) as source_size, (row_number() over (order by source nulls last) - 1) % {len(curriculum.WEIGHTS)} as turn from s group by source),
w as (select *, [{weights}][turn + 1] as w from src),
r as (select *, row_number() over q as i, ((select sum(source_size) from w) - coalesce(sum({curriculum.REPEATS} * source_size) over (q rows between unbounded preceding and 1 preceding), 0))
    / sum(w) over (q rows between current row and unbounded following) as share from w window q as (order by {curriculum.REPEATS} * source_size / w, source)),
lam as (select coalesce(min_by(share, i), 0) as share from r where share * w <= {curriculum.REPEATS} * source_size),
t as (select source, turn, source_size, least(share * w, cast({curriculum.REPEATS} * source_size as double)) as target from w, lam),
placed as (select rid, doc_id, s.source, size, source_size, target, cast(least(floor(target / source_size), {curriculum.REPEATS}) as bigint) as whole,
    case {length} else {last} end as length, md5(coalesce(cast(doc_id as varchar), '')) as hash from s join t on s.source is not distinct from t.source where size > 0),
own as materialized (select *, coalesce(sum(size) over (partition by source, length order by hash, doc_id, size, rid rows between unbounded preceding and 1 preceding), 0) as before from placed),
part as (select source, length, (any_value(target) - any_value(whole) * any_value(source_size)) * sum(size) / any_value(source_size) as part from placed group by source, length),
{', '.join(carried)},
need as ({' union all '.join(needs)}),
taken as (select rid, doc_id, own.source, size, whole + cast(before + size / 2 < need as bigint) as copies
    from own join need on own.source is not distinct from need.source and own.length = need.length),
copies as (select rid, doc_id, source, size, unnest(range(1, copies + 1)) as copy from taken),
staged as (select *, coalesce(sum(size) over (partition by source order by copy, md5(copy || ':' || coalesce(cast(doc_id as varchar), '')), doc_id, size, rid rows between unbounded preceding and 1 preceding), 0) as before,
    sum(size) over (partition by source) as total from copies),
timed as (select staged.*, case {time} end as time from staged join t on staged.source is not distinct from t.source),
ordered as (select rid, size, coalesce(sum(size) over (order by time, source nulls last, copy, doc_id, rid rows between unbounded preceding and 1 preceding), 0) as start from timed),
sums as (select rid, cast(sum(size) as bigint) as taken, cast(min(start) as bigint) as first_start from ordered group by rid)
select doc_id, size, source_size, round(target, 6) as target, coalesce(taken, 0) as taken, first_start
from s join t on s.source is not distinct from t.source left join sums using (rid)"""


SQL: dict[str, str] = {"op1_secret_scan": secrets_sql(), "op2_quality_rules": quality_sql(), "op5_decontaminate": decontaminate_sql(), "op12_curriculum": curriculum_sql()}
