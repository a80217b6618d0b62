"""Stand-ins for the mart's input tables, derived from the test tables.

Each text is portable SQL: Spark runs it over DataFrames, and the test oracle runs the same
text over its own tables. All of them read whole tables; where a branch of a job needs rows
to be missing, an attribute decides (a balance, a brand, a type), never an id.

Shops are suppliers; a pack is a (brand, type) pair, so that shop x pack is dense enough for
the panel to meet the universe. A shop with a negative balance had another code before 2001, so it
has no turnover in the year before. Shops with a balance from 5000 on are on the panel; some others
are not in the universe. Accounts belong to one of three chains, whose code is their universe code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dispensa.sources.tables import parquet_table

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Number of a pack: brand number and type number.
_PACK = (
    "(cast(substring(p_brand, 7) as int) * 10 + case p_type when 'ECONOMY' then 1 when 'LARGE' then 2 "
    "when 'MEDIUM' then 3 when 'PROMO' then 4 when 'SMALL' then 5 else 6 end)"
)

# Monthly facts of the four sources, with blank-padded keys.
_MONTH = """
        select case l_returnflag || l_linestatus when 'AO' then 'T' when 'AF' then 'R' when 'NO' then 'P'
                    when 'NF' then 'RP' when 'RO' then 'T' else 'P' end as source,
               substring(cast(year(l_shipdate) * 100 + month(l_shipdate) as string), 3, 4) as period,
               'TR01' as production, cast(l_shipdate as date) as sale_date,
               rpad(lpad(cast(l_suppkey as string), 7, '0'), 10, ' ') as whs,
               rpad(lpad(cast(l_partkey as string), 7, '0'), 9, ' ') as pfc,
               lpad(cast(l_orderkey as string), 7, '0') as u_code,
               cast(l_quantity as decimal(10,0)) as pr_unit, cast(l_linenumber % 3 as decimal(10,0)) as pr_bonus,
               cast(l_extendedprice as decimal(10,2)) as pr_price, cast(l_extendedprice as decimal(10,2)) as ndf_price,
               l_linenumber as setflag, cast(l_extendedprice as decimal(10,2)) as pub_price,
               cast(l_extendedprice as decimal(10,2)) as trd_price, cast(l_discount as decimal(7,2)) as iskonto,
               cast(l_shipdate as date) as invoice_date, cast(l_orderkey as string) as invoice_number,
               cast(l_tax as decimal(7,2)) as vat, cast(1 as int) as is_prescription,
               l_quantity as prj_unit, l_extendedprice as prj_value
        from {lineitem}"""

STANDINS: dict[str, str] = {
    "sellin": f"""
        select cast(year(o_orderdate) * 100 + month(o_orderdate) as string) as period,
               case when s_acctbal < 0 and year(o_orderdate) < 2001 then '9' || lpad(cast(l_suppkey as string), 6, '0')
                    else lpad(cast(l_suppkey as string), 7, '0') end as customer_code,
               lpad(cast({_PACK} as string), 7, '0') as pfc,
               cast(l_quantity as int) as total_unit
        from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey
             join {{part}} on p_partkey = l_partkey
             join {{supplier}} on s_suppkey = l_suppkey""",
    "sellout_tx": f"""
        select make_date(year(l_shipdate), cast((day(l_shipdate) - 1) % 12 + 1 as int), month(l_shipdate)) as sale_date,
               lpad(cast(l_suppkey as string), 7, '0') as shop_code,
               lpad(cast({_PACK} as string), 7, '0') as pfc,
               case when l_returnflag = 'R' then '03' else '01' end as record_type,
               cast(l_quantity as int) as pr_unit
        from {{lineitem}} join {{part}} on p_partkey = l_partkey""",
    "shops_raw": """
        select lpad(cast(s_suppkey as string), 7, '0') as imscode, s_nationkey as brick,
               case when s_acctbal between 1000 and 1500 then 0 else 1 end as on_universe,
               case when s_acctbal >= 5000 then 1 else 0 end as on_panel
        from {supplier}""",
    "brick_region": """
        select n_nationkey as brick1, n_regionkey as tcode from {nation} where n_name <> 'NATION_7'""",
    "region_name": """
        select r_regionkey as brickcode, r_name as bolge from {region}""",
    "packs_raw": f"""
        select lpad(cast({_PACK} as string), 8, '0') as bridge_code, p_brand as prod_desc, p_type as class_code,
               case when max(p_partkey) % 2 = 0 then 'PRESC' else 'OTC' end as pack_flag
        from {{part}} group by p_brand, p_type""",
    "pfg": f"""
        select cast({_PACK} as string) as pfc, 'PFG' || cast(max(p_partkey) % 10 as string) as pfg
        from {{part}} where p_brand <> 'Brand#25' group by p_brand, p_type""",
    "prod_flag": f"""
        select cast({_PACK} as string) as pfc,
               case p_brand when 'Brand#1' then 'pfc' when 'Brand#2' then 'Brand' when 'Brand#3' then 'atc1'
                            when 'Brand#4' then 'atc2' when 'Brand#5' then 'atc3' when 'Brand#6' then 'ATC4'
                            when 'Brand#7' then 'basket' when 'Brand#8' then 'rx' when 'Brand#9' then 'other'
                            when 'Brand#10' then 'PFC' when 'Brand#11' then 'brand' end as prod_flag
        from {{part}} where p_type <> 'PROMO' group by p_brand, p_type""",
    "ctrl": """
        select 'MthsAvg' as param, cast(count(distinct month(o_orderdate)) - 3 as string) as val from {orders}""",
    "oper": """
        select distinct cast(year(o_orderdate) * 100 + month(o_orderdate) as int) as pd_id
        from {orders} where year(o_orderdate) = (select max(year(o_orderdate)) from {orders})""",
    "month_src": _MONTH,
    # As delivered, before anything is checked: a bonus, discount or tax of nothing, some flags and numbers are missing.
    "month_raw": f"""
        select source, period, production, sale_date, whs, pfc, u_code, pr_unit, nullif(pr_bonus, 0) as pr_bonus, pr_price,
               ndf_price, case when source <> 'R' then setflag end as setflag, pub_price, trd_price,
               nullif(iskonto, 0) as iskonto, invoice_date, case when source <> 'RP' then invoice_number end as invoice_number,
               nullif(vat, 0) as vat, is_prescription, prj_unit, nullif(prj_value, 0) as prj_value
        from ({_MONTH})""",
    "price_list": """
        select substring(cast(y * 100 + m as string), 3, 4) as period, lpad(cast(p_partkey as string), 7, '0') as prd_cd,
               p_name as new_name, substring(p_brand, 7, 2) as prod_flag, p_type as who_atc,
               cast(cast(p_retailprice as decimal(10,2)) + m as decimal(10,2)) as pub_price,
               cast(cast(p_retailprice as decimal(10,2)) - cast(150.5 as decimal(10,2)) as decimal(9,2)) as isf
        from (select distinct l_partkey, year(l_shipdate) as y, month(l_shipdate) as m from {lineitem}) sold
             join {part} on p_partkey = l_partkey
        where p_size < 50""",
    "account": """
        select lpad(cast(s_suppkey as string), 7, '0') as account_code, s_name as account_name,
               lpad(cast(s_nationkey % 3 as string), 7, '0') as universe_code
        from {supplier} where s_acctbal > -500""",
    "atc_names": """
        select lpad(cast(p_partkey as string), 7, '0') as pfc, substring(p_type, 1, 1) as atc1,
               substring(p_type, 1, 3) as atc2, substring(p_type, 1, 4) as atc3, p_type as atc4,
               p_brand as nfc1, substring(p_brand, 1, 6) as nfc2, 'N' as nfc3
        from {part} where p_size > 1""",
    "report_period": """
        select distinct substring(cast(year(l_shipdate) * 100 + month(l_shipdate) as string), 3, 4) as period,
               case when month(l_shipdate) = 12 then 0 else 1 end as is_active
        from {lineitem}""",
    "log_cycle": """
        select distinct cast(day(ts) as int) as cycle_id, cast(ts as date) as cycle_date,
               case when day(ts) = 13 then 1 when day(ts) % 2 = 0 then 0 end as is_deleted
        from {events}""",
    "gate_account": """
        select distinct case event_type when 'click' then 1 when 'error' then 2 when 'purchase' then 3
                        when 'signup' then 4 else 5 end as account_id,
               case when event_type = 'signup' then 1 end as is_deleted
        from {events}""",
    "log_pp": """
        select cast(day(ts) as int) as cycle_id,
               case event_type when 'click' then 1 when 'error' then 2 when 'purchase' then 3
                    when 'signup' then 4 else 5 end as account_id,
               cast(case when hour(ts) = 23 and day(ts) > 27 then 1 when hour(ts) > 20 then 0 end as int) as is_deleted,
               cast(case when day(ts) = 20 and event_type = 'view' then 1 else day(ts) end as int) as day_no,
               cast(month(ts) as int) as month_no, cast(year(ts) as int) as year_no,
               cast(sum(floor(value)) as int) as unit, cast(sum(case when value > 50 then 1 end) as int) as bonus,
               cast(count(distinct props) as int) as rec_p, cast(count(distinct user_id) as int) as rec_c,
               cast(count(*) as int) as rec_s, cast('loaded' as string) as note
        from {events} group by day(ts), month(ts), year(ts), hour(ts), event_type""",
    # Some payloads hold nothing inside the envelope, some never came.
    "payloads": """
        select event_id as payload_id, case when event_type = 'view' and minute(ts) = 7 then cast(null as string)
               when event_type = 'purchase' and minute(ts) = 11 then '<Envelope><Body><Result> </Result></Body></Envelope>' else
               '<?xml version="1.0"?><Envelope><Body><Result>[{{"EventKod":"' || cast(event_id as string) ||
               '","P_Z":"' || event_type || '","Line":"L' || cast(day(ts) as string) || '","Bolge":"B' ||
               cast(hour(ts) as string) || '","DrSabit":' || cast(user_id as string) || ',"Tarih":"' ||
               cast(cast(ts as date) as string) || '","IlacCalismaSirasi":' || cast(minute(ts) as string) ||
               '}},{{"EventKod":"x' || cast(event_id as string) || '","Iht":"' || event_type ||
               '","Ikili":"E","Extra":1}}]</Result></Body></Envelope>' end as body
        from {events}""",
    # The same, but error events arrive cut off after the first visit, and sign-ups with a stray word or a bare number.
    "payloads_raw": """
        select event_id as payload_id, case when event_type = 'view' and minute(ts) = 7 then cast(null as string)
               when event_type = 'purchase' and minute(ts) = 11 then '<Envelope><Body><Result> </Result></Body></Envelope>'
               when event_type = 'signup' and minute(ts) = 13 then '<Envelope>' || cast(user_id as string) || '</Envelope>' else
               '<Envelope><Body><Result>[{{"EventKod":"' || cast(event_id as string) || '","P_Z":"' || event_type ||
               '","DrSabit":' || cast(user_id as string) || '}},{{"EventKod":"x' || cast(event_id as string) ||
               case event_type when 'error' then '' when 'signup' then '"}}] stray' else '"}}]' end ||
               '</Result></Body></Envelope>' end as body
        from {events}""",
    # Undeclared fields of all kinds; an error has one element that is no object, a sign-up is an object by itself.
    "payloads_typed": """
        select event_id as payload_id, case when event_type = 'view' and minute(ts) = 7 then cast(null as string) else
               case when event_type = 'signup' then '' when event_type = 'error' then '[17,' else '[' end ||
               '{{"EventKod":"' || cast(event_id as string) || '","DrSabit":' || cast(user_id as string) || ',"Onay":' ||
               case when event_type = 'view' then 'true' else 'null' end || ',"Tarih x":"' || cast(cast(ts as date) as string) ||
               '","Ilac":["' || event_type || '",' || cast(hour(ts) as string) || '],"Yer":' || props || '}}' ||
               case when event_type = 'signup' then '' else ']' end end as body
        from {events}""",
}


def standin(spark: SparkSession, folder: str, name: str) -> DataFrame:
    text = STANDINS[name]
    used = {t: parquet_table(spark, folder, t) for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def standin_sql(name: str) -> str:
    """The same text over tables of the same names."""
    return STANDINS[name].format(**{t: t for t in TABLES})
