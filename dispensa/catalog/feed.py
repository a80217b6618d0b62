"""Feed query. The SQL cuts the text between the first and the last bracket."""

from __future__ import annotations

from dispensa.catalog import Query
from dispensa.plans import feed
from dispensa.sources.standins import standin, standin_sql

# Name in the feed and column of the fact table, written out here, so that the job's own are held against them.
_TEXTS = (
    "EventKod EventKod, P_Z PlanliZiyaret, Line Line, Bolge Bolge, SNo SNo, UyeAd UyeAd, UniteAd UniteAd, Semt Semt, "
    "Brick Brick, Iht iht, Unvan Unvan, DrAdSoyad DrAdSoyad, Tarih Tarih, Ilac Ilac, Ikili ikiliZiyaret"
)
_NUMBERS = "DrSabit DrSabit, IlacCalismaSirasi Sira"
_FIELDS = ", ".join(
    f"try_cast(json_extract_string(e, '$.{pair.split()[0]}') as {kind}) as {pair.split()[1]}"
    for kind, pairs in (("varchar", _TEXTS), ("int", _NUMBERS))
    for pair in pairs.split(", ")
)

_STRIPPED = r"""regexp_replace(regexp_replace(body, '^(\s*<[^>]*>)+\s*', ''), '(</[^>]*>\s*)+$', '')"""

# The kinds of a JSON value.
_KIND = """case json_type(v) when 'NULL' then 0 when 'VARCHAR' then 1 when 'BOOLEAN' then 3 when 'ARRAY' then 4
    when 'OBJECT' then 5 else 2 end"""

QUERIES: dict[str, Query] = {
    "json_rejects": Query(
        lambda s, d: feed.json_rejects(standin(s, d, "payloads_raw")),
        f"""with payloads as ({standin_sql('payloads_raw')}), cut as (select *, {_STRIPPED} as j from payloads),
            told as (select payload_id, body, case when body is null then 'missing' when trim(j) = '' then 'empty'
                when not json_valid(j) then 'malformed' when json_type(j) not in ('ARRAY', 'OBJECT') then 'scalar' end as reason
                from cut)
            select * from told where reason is not null""",
    ),
    "json_shred": Query(
        lambda s, d: feed.shred_json(standin(s, d, "payloads"), skip_rejects=True),
        f"""with payloads as ({standin_sql('payloads')}),
            cut as (select substr(body, strpos(body, '['), length(body) - strpos(reverse(body), ']') - strpos(body, '[') + 2)
                    as j from payloads where strpos(body, '[') > 0)
            select {_FIELDS} from (select unnest(cast(cast(j as json) as json[])) as e from cut)""",
    ),
    "json_typed": Query(
        lambda s, d: feed.json_typed(standin(s, d, "payloads_typed")),
        f"""with payloads as ({standin_sql('payloads_typed')}),
            whole as (select payload_id, case when json_type(body) = 'OBJECT' then '[' || body || ']' else body end as j
                      from payloads where body is not null),
            part as (select payload_id, unnest(cast(cast(j as json) as json[])) as e,
                            generate_subscripts(cast(cast(j as json) as json[]), 1) - 1 as element from whole),
            field as (select payload_id, element, e, unnest(json_keys(e)) as key from part where json_type(e) = 'OBJECT'),
            found as (select *, json_extract(e, '$."' || key || '"') as v from field)
            select payload_id, element::int as element, key, json_extract_string(v, '$') as value, {_KIND} as kind from found""",
    ),
}
