"""Gate queries. The SQL looks each value up with a correlated subquery per request."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dispensa.catalog import Query
from dispensa.plans import gate as g
from dispensa.sources.changes import ChangeTable
from dispensa.sources.staging import Staging
from dispensa.sources.standins import standin, standin_sql

STATUS = {"control": "C", "executed": "E"}
AS_OF = "2024-02-01"

# Requests: every (cycle, account) of the log, and one unknown account per cycle.
_REQUESTS = "select distinct cycle_id, account_id from {log} union all select distinct cycle_id, 9 from {log}"
_PROCESSES = """select cycle_id * 10 + account_id as process_id, cycle_id, account_id,
    case when account_id = 2 then cast(sum(rec_s) as int) when account_id <> 3 then 0 end as total_errors,
    'rows rejected' as err_message, case when cycle_id > 9 then 'started' end as message, cast(7 as int) as approve_flag
    from {log} group by cycle_id, account_id
    union all select distinct cycle_id * 10 + 8, cycle_id, 8, 0, 'rows rejected', cast(null as string), cast(7 as int)
    from {log}"""


def _tables(spark: SparkSession, folder: str) -> dict:
    log = standin(spark, folder, "log_pp")
    return {
        "staging": Staging(spark),
        "requests": spark.sql(_REQUESTS, log=log),
        "cycles": standin(spark, folder, "log_cycle"),
        "accounts": standin(spark, folder, "gate_account"),
        "log": log,
    }


def _preconditions(spark: SparkSession, folder: str) -> DataFrame:
    facts = g.facts_of_requests(**_tables(spark, folder))
    return facts.select(*g.KEYS, F.coalesce(g.precondition(35, 35), F.lit("")).alias("message"))


def _dates(spark: SparkSession, folder: str) -> DataFrame:
    facts = g.facts_of_requests(**_tables(spark, folder)).where(g.precondition(35, 35).isNull())
    return facts.select(*g.KEYS, F.coalesce(g.date_note(), F.lit("")).alias("note"))


def _growth(spark: SparkSession, folder: str) -> DataFrame:
    facts = g.facts_of_requests(**_tables(spark, folder)).where(g.precondition(5, 20).isNull())
    return facts.select(*g.KEYS, F.coalesce(g.growth_note(5, 20), F.lit("")).alias("note"))


def _verdict(spark: SparkSession, folder: str) -> DataFrame:
    return g.gate_verdict(**_tables(spark, folder))


def _notes(spark: SparkSession, folder: str) -> DataFrame:
    t = _tables(spark, folder)
    return g.write_notes(t["log"], g.gate_verdict(**t))


_LOG = (
    "cycle_id int, account_id int, is_deleted int, day_no int, month_no int, year_no int, unit int, bonus int, rec_p int, "
    "rec_c int, rec_s int, note string"
)


def _changed_log(spark: SparkSession, folder: str) -> DataFrame:
    """The log with the gate's notes, then with bonuses cleared and notes withdrawn for busy requests, one compaction between."""
    t = _tables(spark, folder)
    table = ChangeTable(spark, Staging(spark).root + "/log", _LOG, g.KEYS)
    table.create(t["log"])
    table.update(g.note_changes(g.gate_verdict(**t)))
    table.compact()
    busy = t["log"].groupBy(*g.KEYS).agg(F.sum("rec_s").alias("n")).where("n % 2 = 0")
    table.update(busy.select(*g.KEYS, F.lit(None).cast("int").alias("bonus")))
    table.update(busy.where("n % 3 = 0").select(*g.KEYS, F.lit("withdrawn").alias("note")))
    return table.read()


def _routed(spark: SparkSession, folder: str) -> DataFrame:
    t = _tables(spark, folder)
    verdicts = Staging(spark).keep(g.gate_verdict(**t), "verdicts")
    return g.route(spark.sql(_PROCESSES, log=t["log"]), verdicts, g.write_notes(t["log"], verdicts))


# --- the oracle ------------------------------------------------------------------------------

# Measures and texts are written out here, so that the job's own are held against them.
_METRICS = (
    ("units", "unit+unitbonus", "unit+unitbonus"),
    ("rec_p", "RecP", "product record counts"),
    ("rec_c", "RecC", "customer record counts"),
    ("rec_s", "RecS", "sales record counts"),
)
_SUPPLY = "Pharmacy File is passed from Supply Service Control successfully.........\\n"
_PRODUCTION = "Pharmacy File is passed from Production Control successfully.........\\n"


def _oracle(final: str, units_range: int = 35, records_range: int = 35) -> str:
    def logged(expr: str, cycle: str) -> str:
        return (
            f"(select {expr} from log_pp l where l.cycle_id = {cycle} and l.account_id = r.account_id "
            "and coalesce(l.is_deleted, 0) = 0)"
        )

    sums = {
        "units": "coalesce(sum(unit), 0) + coalesce(sum(bonus), 0)",
        "rec_p": "sum(rec_p)", "rec_c": "sum(rec_c)", "rec_s": "sum(rec_s)",
    }
    columns = []
    for prefix, cycle in (("c", "r.cycle_id"), ("p", "r.prev_id")):
        columns += [f"{logged('count(*)', cycle)} as {prefix}_n"]
        columns += [f"{logged(f'min({p}_no)', cycle)} as {prefix}_{p}" for p in ("day", "month", "year")]
        columns += [f"{logged(e, cycle)} as {prefix}_{m}" for m, e in sums.items()]
    dates = " ".join(
        f"when {x}_{p} <> {p}({d}) then 'Expected comparing ' || {x}_{p} || ' {p} is not matched with the {w} ' || {i} || ' cycle'"
        for x, d, w, i in (("c", "cycle_date", "current", "cycle_id"), ("p", "prev_date", "previous", "prev_id"))
        for p in ("day", "month", "year")
    )
    growth = " ".join(
        f"""when p_{m} = 0 then 'Previous cycle log has not any value on {name}'
            when abs(100.0 * (c_{m} - p_{m}) / p_{m}) > {units_range if m == 'units' else records_range}
            then printf('%.3f', round(100.0 * (c_{m} - p_{m}) / p_{m}, 3)) || ' suspected growth on {label}'"""
        for m, name, label in _METRICS
    )
    ctes = {n: standin_sql(n) for n in ("log_pp", "log_cycle", "gate_account")}
    ctes["live_cycle"] = "select * from log_cycle where is_deleted = 0 or is_deleted is null"
    ctes["dated"] = f"""select r.*, (select count(*) from live_cycle c where c.cycle_id = r.cycle_id) as n_cycles,
        (select max(cycle_date) from live_cycle c where c.cycle_id = r.cycle_id) as cycle_date
        from ({_REQUESTS.format(log='log_pp')}) r"""
    ctes["compared"] = """select *, cast(cycle_date - case when isodow(cycle_date) in (6, 7, 1) then 7 else 1 end as date)
        as prev_date from dated"""
    ctes["r"] = """select c.*, coalesce((select max(l.cycle_id) from live_cycle l where l.cycle_date = c.prev_date), 0)
        as prev_id from compared c"""
    ctes["looked_up"] = f"select r.*, {', '.join(columns)} from r"
    ctes["judged"] = f"""select *, case when cycle_id < 1 or account_id < 1 then 'Have missing or wrong parameters value'
            when n_cycles <> 1 then 'Not have one cycle record'
            when account_id not in (select account_id from gate_account where coalesce(is_deleted, 0) = 0)
                then 'Not have account record'
            when c_n = 0 then 'Not have LogPP record with current CycleId and AccountId'
            when prev_id not in (select cycle_id from live_cycle) then 'Not have previous cycle'
            when p_n = 0 then 'Not have LogPP previous record with previous CycleId and AccountId' end as message,
        case {dates} end as date_note, case {growth} end as growth_note from looked_up"""
    ctes["verdicts"] = """select cycle_id, account_id, message,
        case when message is null then coalesce(date_note, growth_note) end as note,
        case when message is not null then -1 when coalesce(date_note, growth_note) is not null then 0 else 1 end
            as verdict from judged"""
    ctes["noted"] = """select l.* exclude (note), coalesce(v.note, l.note) as note from log_pp l
        left join verdicts v on v.cycle_id = l.cycle_id and v.account_id = l.account_id"""
    ctes["processes"] = _PROCESSES.format(log="log_pp")
    # The accounts 8 have no verdict, which counts as a failed check.
    ctes["routed"] = """select p.*, coalesce(v.verdict, -1) as verdict,
        case when v.verdict is null then 'Production Control gave no verdict' else v.message end as gate_message,
        (select max(note) from noted n where n.cycle_id = p.cycle_id and n.account_id = p.account_id and is_deleted = 0)
            as log_note
        from processes p left join verdicts v on v.cycle_id = p.cycle_id and v.account_id = p.account_id"""
    body = ",\n".join(f"{n} as materialized ({t})" for n, t in ctes.items())
    return f"with {body}\n{final}"


_FOUND = "coalesce(log_note, '') || '\\n' || coalesce(gate_message, '')"

_UPDATES_SQL = f"""select process_id, 'E' as status,
    case when total_errors is null then null
         when total_errors <> 0 then 'There are ' || total_errors || ' error transaction for Supply Service....\\n'
              || err_message || '\\n' || coalesce(message, '')
         when verdict = 0 then '{_SUPPLY}' || {_FOUND}
         when verdict = -1 then {_FOUND} else '{_SUPPLY}{_PRODUCTION}' end as message,
    case when total_errors is null or total_errors <> 0 then approve_flag when verdict = 1 then 1 else 0 end as approve_flag
    from routed"""

QUERIES: dict[str, Query] = {
    "comparable_cycle": Query(
        lambda s, d: g.comparable_cycle(standin(s, d, "log_cycle")),
        _oracle(
            """select cycle_id, count(*) as n_cycles, max(cycle_date) as cycle_date,
               max(cycle_date - case when dayname(cycle_date) in ('Saturday', 'Sunday', 'Monday') then 7 else 1 end)
                 as prev_date,
               coalesce((select max(b.cycle_id) from live_cycle b where b.cycle_date = max(a.cycle_date)
                 - case when dayname(max(a.cycle_date)) in ('Saturday', 'Sunday', 'Monday') then 7 else 1 end), 0)
                 as prev_cycle_id from live_cycle a group by cycle_id"""
        ),
    ),
    "gate_preconditions": Query(
        _preconditions, _oracle("select cycle_id, account_id, coalesce(message, '') as message from judged")
    ),
    "gate_dates": Query(
        _dates, _oracle("select cycle_id, account_id, coalesce(date_note, '') as note from judged where message is null")
    ),
    "gate_growth": Query(
        _growth,
        _oracle("select cycle_id, account_id, coalesce(growth_note, '') as note from judged where message is null", 5, 20),
    ),
    "gate_verdict": Query(_verdict, _oracle("select * from verdicts")),
    "gate_notes": Query(_notes, _oracle("select * from noted")),
    "log_with_changes": Query(
        _changed_log,
        _oracle(
            """select n.* exclude (note, bonus), case when b.n % 2 = 0 then null else bonus end as bonus,
                      case when b.n % 6 = 0 then 'withdrawn' else note end as note
               from noted n left join (select cycle_id, account_id, sum(rec_s) as n from log_pp group by all) b
                 on b.cycle_id = n.cycle_id and b.account_id = n.account_id"""
        ),
    ),
    "gate_routing": Query(lambda s, d: g.process_updates(_routed(s, d), STATUS), _oracle(_UPDATES_SQL)),
    "gate_routing_log": Query(
        lambda s, d: g.operation_log(_routed(s, d), STATUS, AS_OF),
        _oracle(
            f"""select cycle_id, account_id, process_id, date '{AS_OF}' as operation_date,
                case when verdict = 1 then 'E' else 'C' end as status, 9999 as operation_user_id
                from routed where total_errors = 0"""
        ),
    ),
}
