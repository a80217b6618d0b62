"""SQL twins: all windows and pairs against all, trees level by level, repairs row by row with whole audits."""

from __future__ import annotations

# A table of 256 remainders, by the rule of the checksum, and its steps over the bytes of an ASCII text.
_REMAINDERS = """select list_transform(range(256), lambda i:
    list_reduce(range(8), lambda c, _: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i)) as t"""


def _crc32(text: str) -> str:
    return f"""xor(list_reduce(list_transform(string_split({text}, ''), lambda x: ascii(x)::bigint),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::bigint), 4294967295::bigint)"""


def _entry(value: str) -> str:
    return f"coalesce(strlen({value}::varchar) || ':' || {value}::varchar, '-')"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(_entry(v) for v in ('doc_id', 'source', 'lang', n_chars, 'text'))})"


MANIFEST = f"""with recursive
    remainders as materialized ({_REMAINDERS}),
    leaf as materialized (
        select doc_id, coalesce(':' || lang, '-') as tree, {_leaf('n_chars')} as leaf,
               case when {_crc32('doc_id::varchar')} % 7 = 0 then {_leaf('(n_chars + 1)')} else {_leaf('n_chars')} end as seen
        from documents, remainders),
    placed as materialized (
        select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as i,
               count(*) over (partition by tree) as n from leaf),
    node as materialized (
        select tree, 0 as level, i, n, leaf as h from placed
        union all
        select tree, level + 1, i // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' order by i))
        from node where n > 1 group by tree, level, i // 2),
    subroot as materialized (
        select tree, h as subroot, row_number() over (order by tree) - 1 as i, count(*) over () as n from node where n = 1),
    top as materialized (
        select 0 as level, i, n, subroot as h from subroot
        union all
        select level + 1, i // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' order by i))
        from top where n > 1 group by level, i // 2),
    step as materialized (
        select p.tree, p.i, a.level, (p.i >> a.level) % 2 = 1 as from_left, b.h
        from placed p join node a on a.tree = p.tree and a.i = p.i >> a.level and a.n > 1
        left join node b on b.tree = a.tree and b.level = a.level and b.i = xor(a.i, 1)
        union all
        select p.tree, p.i, 1000 + a.level, (s.i >> a.level) % 2 = 1, b.h
        from placed p join subroot s using (tree) join top a on a.i = s.i >> a.level and a.n > 1
        left join top b on b.level = a.level and b.i = xor(a.i, 1)),
    path as materialized (
        select tree, i, string_agg(h, '' order by level) as siblings,
               list({{'from_left': from_left, 'h': coalesce(h, '')}} order by level) as steps from step group by tree, i),
    fold as (
        select p.tree, p.i, 1 as k, seen as h, coalesce(steps, []) as steps
        from placed p left join path on path.tree = p.tree and path.i = p.i
        union all
        select tree, i, k + 1, sha256(case when steps[k].from_left then steps[k].h || h else h || steps[k].h end), steps
        from fold where k <= len(steps))
    select doc_id, leaf, subroot, root, sha256(coalesce(siblings, '')) as proof_sha256, fold.h as folded_root,
           fold.h = root as verified
    from placed p join subroot using (tree) join (select h as root from top where n = 1) on true
    left join path on path.tree = p.tree and path.i = p.i
    join fold on fold.tree = p.tree and fold.i = p.i and k > len(fold.steps)"""

_FILLED = r"regexp_matches(text, '[^\x20\x09-\x0D]')"
_CLOSED = r"regexp_matches(text, '[.!?][\x20\x09-\x0D]*$')"

CONVERSATIONS = rf"""with recursive
    remainders as materialized ({_REMAINDERS}),
    summed as (
        select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
               {_crc32("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as fault
        from conversations, remainders),
    hurt as (
        select conv_id, turn, case when fault = 4 then 'user' else role end as role,
               case fault when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
               unnest(range(case fault when 3 then 2 else 1 end)) as copy
        from summed where fault <> 0),
    placed as (
        select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), copy) as r from hurt),
    told as (
        select *, left(role, 1) as initial, case when not {_FILLED} then 'blank'
            when row_number() over (partition by conv_id, role, text order by r) > 1 then 'duplicate'
            when not {_CLOSED} then 'truncated' else '' end as fault,
            lag(left(role, 1)) over (partition by conv_id order by r) as before
        from placed),
    state(s, t, writes) as (values (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')),
    gap as (
        select s as a, s as b, '' as letters, []::varchar[] as lines from state
        union all select s, t, 'I', [writes || ':'] from state
        union all select x.s, y.t, 'II', [x.writes || ':', y.writes || ':'] from state x join state y on y.s = x.t),
    walk as (
        select distinct conv_id, 0::bigint as r, {{'cost': 0, 'audit': '', 'lines': []::varchar[]}} as best, 0 as s
        from conversations
        union all
        select w.conv_id, w.r + 1, min({{
                'cost': (w.best.cost + 3 * length(letters)
                    + case e when 'D' then 4 when 'R' then 3 else 0 end
                    + case when fault = 'truncated' and e <> 'D' then 3 else 0 end)::int,
                'audit': w.best.audit || letters || e,
                'lines': w.best.lines || gap.lines || case e when 'D' then []::varchar[]
                    when 'R' then [writes || ':' || text] else [role || ':' || text] end}}),
            case when e = 'D' then gap.b when e = 'K' and initial = 's' then 1 else t end
        from walk w join told d on d.conv_id is not distinct from w.conv_id and d.r = w.r + 1
        join gap on gap.a = w.s join state on state.s = gap.b
        join (values ('K'), ('R'), ('D')) edit(e) on e = 'D' or (fault not in ('blank', 'duplicate') and (e = 'R'
            or initial = left(writes, 1) or (initial = 's' and gap.b = 0)))
        group by w.conv_id, w.r, 4),
    ended as (
        select w.conv_id, w.r, min({{'cost': (w.best.cost + 3 * length(letters))::int, 'audit': w.best.audit || letters,
                                     'lines': w.best.lines || gap.lines}}) as best
        from walk w join gap on gap.a = w.s and gap.b in (0, 3) group by w.conv_id, w.r),
    final as (select conv_id, arg_max(best, r) as best from ended group by conv_id),
    counted as (
        select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
               count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
               count(*) filter (fault = 'truncated') as truncated,
               count(*) filter (before is not null and before || initial not in ('su', 'ua', 'au')) as illegal
        from told group by conv_id)
    select f.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
           coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, best.cost::bigint as cost,
           best.audit as audit, sha256(array_to_string(best.lines, chr(10))) as repaired_sha256
    from final f left join counted c on c.conv_id is not distinct from f.conv_id"""


# --- words, windows, shingles, vectors: everything against everything ----------------------------

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_ALNUM = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _documents(words: str) -> str:
    """Rows (r, doc_id, w): each document with a number of its own and its words."""
    return f"select row_number() over () as r, doc_id, {words} as w from documents"


def _components(nodes: str, links: str) -> str:
    """CTEs reach and least (r, least): the smallest identifier that a walk over the links leads to."""
    return f"""reach as (
        select r, r as s from ({nodes}) union select reach.r, l.b from reach join ({links}) l on l.a = reach.s),
    least as (select reach.r, min(n.id) as least from reach join ({nodes}) n on n.r = reach.s group by reach.r)"""


SUBSTRINGS = f"""with docs as materialized ({_documents(_SPACED.format("coalesce(text, '')"))}),
    spot as materialized (select r, i, md5(array_to_string(w[i:i + 34], ' ')) as h
                          from (select r, w, unnest(range(1, len(w) - 33)) as i from docs where len(w) >= 35)),
    gone as materialized (select distinct r, unnest(range(i, i + 35)) as i
                          from spot where h in (select h from spot group by h having count(*) > 1)),
    word as materialized (select r, unnest(w) as x, unnest(range(1, len(w) + 1)) as i from docs),
    kept as (select r, count(*) as n, string_agg(x, ' ' order by i) as told from word anti join gone using (r, i) group by r)
    select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed,
           sha256(coalesce(told, '')) as kept_sha256
    from docs left join kept using (r)"""

JACCARD = f"""with recursive docs as materialized ({_documents(_SPACED.format(_LOWER.format("coalesce(text, '')")))}),
    shingle as materialized (
        select distinct r, md5(array_to_string(w[i:i + 4], ' ')) as h
        from (select r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from docs where len(w) > 0)),
    size as materialized (select r, count(*) as n from shingle group by r),
    -- Equal sets are one class; classes are compared pair by pair.
    class as materialized (select r, min(r) over (partition by told) as c
                           from (select r, md5(string_agg(h, '' order by h)) as told from shingle group by r)),
    first as materialized (select r, h, n from shingle join class using (r) join size using (r) where r = c),
    link as materialized (
        select a.r as a, b.r as b from first a join first b on a.h = b.h and a.r <> b.r
        and 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)
        group by a.r, b.r, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))),
    {_components("select c as r, min(doc_id) as id from class join docs using (r) group by c", "select a, b from link")}
    select doc_id, coalesce(n, 0)::bigint as n_shingles, coalesce(least, doc_id) as component_id
    from docs left join size using (r) left join class using (r) left join least on least.r = c"""

VECTORS = f"""with recursive given as materialized (
        select row_number() over () as r, vec_id, embedding::double[] as v from embeddings),
    sound as materialized (
        select r, vec_id, list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))) as v from given
        where v is not null and len(v) > 0 and len(list_filter(v, lambda x: x is null or not isfinite(x))) = 0
          and list_inner_product(v, v) > 0),
    link as materialized (select a.r as a, b.r as b from sound a join sound b on a.r <> b.r and len(a.v) = len(b.v)
                          and list_inner_product(a.v, b.v) >= 0.9),
    {_components("select r, vec_id as id from given", "select a, b from link")}
    select vec_id, coalesce(n, 0)::bigint as n_links, least as component_id, vec_id = least as kept
    from given join least using (r) left join (select a as r, count(*) as n from link group by a) using (r)"""

DECONTAMINATION = f"""with docs as materialized ({_documents(_ALNUM.format(_LOWER.format("coalesce(text, '')")))}),
    item as (select item_id, {_ALNUM.format(_LOWER.format("coalesce(text, '')"))} as w from benchmark),
    sought as materialized (
        select distinct item_id, least(len(w), 10) as n, array_to_string(w[i:i + 9], ' ') as x
        from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from item where len(w) > 0)),
    spot as (
        select r, n, i, array_to_string(w[i:i + n - 1], ' ') as x
        from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i
              from docs, (select distinct n from sought) where len(w) >= n)),
    hit as materialized (select r, i, n, item_id from spot join sought using (n, x)),
    word as (select r, count(*) as n from (select distinct r, unnest(range(i, i + n)) as i from hit) group by r),
    told as (select r, count(*) as n, string_agg(item_id, ',' order by item_id) as items
             from (select distinct r, item_id::varchar as item_id from hit) group by r)
    select doc_id, len(w)::bigint as n_words, coalesce(word.n, 0)::bigint as n_hit, coalesce(told.n, 0)::bigint as n_items,
           sha256(coalesce(items, '')) as items_sha256, coalesce(word.n, 0) > 0 as contaminated
    from docs left join word using (r) left join told using (r)"""
