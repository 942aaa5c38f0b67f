"""DuckDB SQL for the results of the near-duplicate, conversation and manifest queries."""

from __future__ import annotations


def crc32_sql(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text expression."""
    step = "list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))"
    chars = f"list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, i::int, 1))::bigint)"
    return f"xor(list_reduce(list_concat([4294967295::bigint], {chars}), lambda c, b: {step}), 4294967295)"


def near_duplicates_sql(k: int, percent: int, kept: bool) -> str:
    """Shingle sets, all pairs that share a shingle, and the closure of their links."""
    return rf"""
    with recursive docs as (
        select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w
        from documents),
    shingles as (
        select distinct doc_id, unnest(case when len(w) >= {k} then list_transform(range(1, len(w) - {k} + 2), lambda i: array_to_string(w[i:i + {k - 1}], ' '))
                                            when len(w) > 0 then [array_to_string(w, ' ')] else [] end) s from docs),
    sizes as (select doc_id, count(*) n from shingles group by doc_id),
    shared as (select a.doc_id a, b.doc_id b, count(*) c from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by all),
    links as (select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * c >= {percent} * (x.n + y.n - c)),
    reached(node, least) as (
        select doc_id, doc_id from docs
        union
        select l.b, r.least from reached r join links l on l.a = r.node where r.least < l.b),
    components as (select node, min(least) component_id from reached group by node)
    select d.doc_id, coalesce(n, 0) n_shingles, component_id{", d.doc_id = component_id as kept" if kept else ""}
    from docs d join components on node = d.doc_id left join sizes z on z.doc_id = d.doc_id"""


def conversations_sql() -> str:
    """Damage, faults, and the cheapest repair turn by turn with the states of the accepted sequences."""
    key = "coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')"
    blank, broken = r"regexp_matches(text, '[^\x20\x09-\x0D]')", r"regexp_matches(text, '[.!?][\x20\x09-\x0D]*$')"
    return rf"""
    with recursive hit as (select conv_id, turn, coalesce(role, ' ') "role", coalesce(text, ' ') text, {crc32_sql(key)} % 20 h from conversations),
    rows as (
        select conv_id, turn, case h when 4 then 'user' else "role" end "role",
               case h when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end text,
               unnest(case h when 3 then [0, 1] else [0] end) again
        from hit where h <> 0),
    placed as (
        select *, row_number() over (partition by conv_id order by turn nulls first, "role", md5(text), again) i,
               row_number() over (partition by conv_id, "role", text order by turn nulls first, again) nth, left("role", 1) ini from rows),
    faults as (
        select *, case when not {blank} then 'blank' when nth > 1 then 'duplicate' when not {broken} then 'truncated' else 'fine' end fault,
               lag(ini) over (partition by conv_id order by i) || ini pair from placed),
    counts as (
        select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) gaps, count(*) filter (fault = 'blank') blank,
               count(*) filter (fault = 'duplicate') duplicate, count(*) filter (fault = 'truncated') truncated,
               count(*) filter (pair not in ('su', 'ua', 'au')) illegal
        from faults group by conv_id),
    step(p, r, q) as (values (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
    ins(p, q, cost, audit, lines) as (
        select p, p, 0, '', []::varchar[] from (values (0), (1), (2), (3)) t(p)
        union all values (0, 2, 5, 'I', ['user:']), (1, 2, 5, 'I', ['user:']), (3, 2, 5, 'I', ['user:']), (2, 3, 5, 'I', ['assistant:']),
                         (0, 3, 10, 'II', ['user:', 'assistant:']), (1, 3, 10, 'II', ['user:', 'assistant:'])),
    moves as (
        select conv_id, i, p, p as q, 2 as cost, 'D' as audit, []::varchar[] lines from faults, (values (0), (1), (2), (3)) t(p)
        union all
        select conv_id, i, p, q, (ini <> r)::int + case fault when 'truncated' then 5 else 0 end, case when ini = r then 'K' else 'R' end,
               [case when ini = r then "role" when r = 'u' then 'user' else 'assistant' end || ':' || text]
        from faults, step where fault in ('fine', 'truncated') and (r <> 's' or ini = 's')),
    best(conv_id, i, b) as (
        select conv_id, 0::bigint, {{'q': 0, 'cost': 0, 'audit': '', 'lines': []::varchar[]}} from (select distinct conv_id from rows)
        union all
        select t.conv_id, m.i, min({{'q': m.q, 'cost': t.b.cost + e.cost + m.cost, 'audit': t.b.audit || e.audit || m.audit,
                                    'lines': list_concat(list_concat(t.b.lines, e.lines), m.lines)}})
        from best t join ins e on e.p = t.b.q join moves m on m.conv_id is not distinct from t.conv_id and m.i = t.i + 1 and m.p = e.q
        group by t.conv_id, m.i, m.q),
    ends as (
        select t.conv_id, min({{'cost': t.b.cost + e.cost, 'audit': t.b.audit || e.audit, 'lines': list_concat(t.b.lines, e.lines)}}) f
        from best t join (select conv_id, max(i) i from faults group by conv_id) z on z.conv_id is not distinct from t.conv_id and z.i = t.i
        join ins e on e.p = t.b.q and e.q in (0, 3) group by t.conv_id)
    select c.conv_id, coalesce(gaps, 0) gaps, coalesce(blank, 0) blank, coalesce(duplicate, 0) duplicate, coalesce(truncated, 0) truncated,
           coalesce(illegal, 0) illegal, coalesce(f.cost, 0)::bigint as "cost", coalesce(f.audit, '') audit, sha256(coalesce(array_to_string(f.lines, chr(10)), '')) repaired_sha256
    from (select distinct conv_id from conversations) c left join counts n on n.conv_id is not distinct from c.conv_id
    left join ends x on x.conv_id is not distinct from c.conv_id"""


def manifest_sql() -> str:
    """Levels by a recursive query over all nodes, siblings by place, and the fold of each leaf."""
    def leaf(n_chars: str) -> str:
        def one(v):
            return f"case when {v} is null then '-' else strlen({v}::varchar) || ':' || {v} end"
        return "sha256(concat(" + ", ".join(one(v) for v in ("doc_id", "source", "lang", n_chars, "text")) + "))"

    changed = f"case when {crc32_sql('doc_id::varchar')} % 7 = 0 then n_chars + 1 else n_chars end"
    return f"""
    with recursive placed as (
        select doc_id, lang, {leaf("n_chars")} leaf, {leaf("(" + changed + ")")} bad from documents),
    leaves as (
        select *, dense_rank() over (order by lang nulls first) - 1 g, row_number() over (partition by lang order by doc_id, leaf) - 1 pos,
               count(*) over (partition by lang) n from placed),
    tree(lvl, g, pos, n, h) as (
        select 0, g, pos, n, leaf from leaves
        union all
        select lvl + 1, g, pos // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' order by pos)) from tree where n > 1 group by lvl, g, pos // 2),
    subroots as (select g, h subroot, lvl, count(*) over () n from tree where n = 1),
    up(lvl, pos, n, h) as (
        select 0, g, n, subroot from subroots
        union all
        select lvl + 1, pos // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' order by pos)) from up where n > 1 group by lvl, pos // 2),
    root as (select h root, lvl top from up where n = 1),
    steps as (
        select l.g, l.pos, t.lvl, t.h sib, t.pos < l.pos >> t.lvl as before
        from leaves l join subroots s on s.g = l.g join tree t on t.g = l.g and t.lvl < s.lvl and t.pos = xor(l.pos >> t.lvl, 1)
        union all
        select l.g, l.pos, s.lvl + u.lvl, u.h, u.pos < l.g >> u.lvl
        from leaves l join subroots s on s.g = l.g cross join root r join up u on u.lvl < r.top and u.pos = xor(l.g >> u.lvl, 1)),
    proofs as (select g, pos, sha256(string_agg(sib, '' order by lvl)) proof_sha256 from steps group by g, pos),
    fold(g, pos, lvl, h) as (
        select g, pos, 0, bad from leaves
        union all
        select f.g, f.pos, f.lvl + 1, sha256(case when s.sib is null then f.h when s.before then s.sib || f.h else f.h || s.sib end)
        from fold f join subroots z on z.g = f.g cross join root r left join steps s on s.g = f.g and s.pos = f.pos and s.lvl = f.lvl
        where f.lvl < z.lvl + r.top)
    select doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) proof_sha256, f.h folded_root, f.h = root as verified
    from leaves l join subroots z on z.g = l.g cross join root r left join proofs p on p.g = l.g and p.pos = l.pos
    join fold f on f.g = l.g and f.pos = l.pos and f.lvl = z.lvl + r.top"""
