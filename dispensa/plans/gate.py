"""Data-quality gate: is a load plausible beside a comparable earlier one?

A request names a load cycle and an account. All requests go through one plan: the load log is
summed once to (cycle, account), and the summary is joined to itself on the comparable cycle.
The first failing check of a request decides, as an ordered ``when``.

Inputs: requests (cycle_id, account_id), cycles (cycle_id, cycle_date, is_deleted), accounts
(account_id, is_deleted), log (cycle_id, account_id, is_deleted, day_no, month_no, year_no, unit,
bonus, rec_p, rec_c, rec_s, note).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dispensa.functions.compat import live
from dispensa.sources.staging import Staging

KEYS = ("cycle_id", "account_id")

# Texts of the precondition failures, in the order of the checks.
BAD_PARAMETERS = "Have missing or wrong parameters value"
NOT_ONE_CYCLE = "Not have one cycle record"
NO_ACCOUNT = "Not have account record"
NO_LOG = "Not have LogPP record with current CycleId and AccountId"
NO_PREVIOUS_CYCLE = "Not have previous cycle"
NO_PREVIOUS_LOG = "Not have LogPP previous record with previous CycleId and AccountId"

# The growth checks in order: measure, name in the note, label of the growth note.
METRICS = (
    ("units", "unit+unitbonus", "unit+unitbonus"),
    ("rec_p", "RecP", "product record counts"),
    ("rec_c", "RecC", "customer record counts"),
    ("rec_s", "RecS", "sales record counts"),
)

# Messages of the routing; the line break is written as two characters.
SUPPLY_PASSED = "Pharmacy File is passed from Supply Service Control successfully.........\\n"
PRODUCTION_PASSED = "Pharmacy File is passed from Production Control successfully.........\\n"
NO_VERDICT = "Production Control gave no verdict"
OPERATOR = 9999


def comparable_cycle(cycles: DataFrame) -> DataFrame:
    """Per live cycle id: its count and date, the date to compare with, and the latest cycle there.

    Saturday, Sunday and Monday compare with the week before, other days with the day before.
    A date without a cycle gives cycle 0.
    """
    alive = cycles.where(live()).select("cycle_id", "cycle_date")
    one = alive.groupBy("cycle_id").agg(F.count("*").alias("n_cycles"), F.max("cycle_date").alias("cycle_date"))
    latest = alive.groupBy(F.col("cycle_date").alias("prev_date")).agg(F.max("cycle_id").alias("prev_cycle_id"))
    back = F.when(F.dayofweek("cycle_date").isin(1, 2, 7), 7).otherwise(1)
    dated = one.withColumn("prev_date", F.date_sub("cycle_date", back))
    return dated.join(latest, "prev_date", "left").withColumn(
        "prev_cycle_id", F.coalesce("prev_cycle_id", F.lit(0))
    )


def log_summary(log: DataFrame) -> DataFrame:
    """Live log rows summed per (cycle, account); the logged date is the least of its parts."""

    def total(*columns: str) -> Column:
        parts = [F.sum(F.coalesce(c, F.lit(0))) for c in columns]
        return sum(parts[1:], parts[0]).cast("decimal(18,0)")

    return (
        log.where(live())
        .groupBy(*KEYS)
        .agg(
            F.count("*").alias("n_log"),
            F.min("day_no").alias("day"),
            F.min("month_no").alias("month"),
            F.min("year_no").alias("year"),
            total("unit", "bonus").alias("units"),
            *[total(m).alias(m) for m in ("rec_p", "rec_c", "rec_s")],
        )
    )


def facts_of_requests(
    requests: DataFrame, cycles: DataFrame, accounts: DataFrame, log: DataFrame, staging: Staging | None = None
) -> DataFrame:
    """One row per request with all that the checks look at; ``p_`` marks the previous cycle.

    The log's summary and the cycles are each needed twice; with ``staging`` they are stored, so that
    the log is summed once.
    """
    summary = log_summary(log)
    if staging is not None:
        summary, cycles = staging.keep(summary, "log_summary"), staging.keep(cycles, "cycles")
    previous = summary.select(
        F.col("cycle_id").alias("prev_cycle_id"),
        "account_id",
        *[F.col(c).alias(f"p_{c}") for c in summary.columns if c not in KEYS],
    )
    known = accounts.where(live()).select("account_id").distinct().withColumn("has_account", F.lit(True))
    existing = (
        cycles.where(live()).select(F.col("cycle_id").alias("prev_cycle_id")).distinct()
        .withColumn("has_previous", F.lit(True))
    )
    return (
        requests.join(comparable_cycle(cycles), "cycle_id", "left")
        .join(known, "account_id", "left")
        .join(existing, "prev_cycle_id", "left")
        .join(summary, list(KEYS), "left")
        .join(previous, ["prev_cycle_id", "account_id"], "left")
    )


def precondition(units_range: int | None, records_range: int | None) -> Column:
    """The text of the first unmet precondition, or null."""
    below_one = [F.col(k) < 1 for k in KEYS] + [F.lit(r).cast("int") < 1 for r in (units_range, records_range)]
    wrong = below_one[0]
    for c in below_one[1:]:
        wrong = wrong | c
    return (
        F.when(wrong, BAD_PARAMETERS)
        .when(F.coalesce("n_cycles", F.lit(0)) != 1, NOT_ONE_CYCLE)
        .when(F.col("has_account").isNull(), NO_ACCOUNT)
        .when(F.col("n_log").isNull(), NO_LOG)
        .when(F.col("has_previous").isNull(), NO_PREVIOUS_CYCLE)
        .when(F.col("p_n_log").isNull(), NO_PREVIOUS_LOG)
    )


def date_note() -> Column:
    """The note of the first logged date part that differs from the cycle's date, or null."""
    whens: Column | None = None
    for prefix, date, word, cycle in (
        ("", "cycle_date", "current", "cycle_id"),
        ("p_", "prev_date", "previous", "prev_cycle_id"),
    ):
        for part, of in (("day", F.dayofmonth), ("month", F.month), ("year", F.year)):
            logged = F.col(f"{prefix}{part}")
            note = F.concat(
                F.lit("Expected comparing "), logged.cast("string"),
                F.lit(f" {part} is not matched with the {word} "), F.col(cycle).cast("string"), F.lit(" cycle"),
            )
            differs = logged != of(date)
            whens = F.when(differs, note) if whens is None else whens.when(differs, note)
    return whens


def growth_percent(metric: str) -> Column:
    """Change in percent against the previous cycle; null where that one is zero."""
    now, before = F.col(metric), F.col(f"p_{metric}")
    return F.when(before != 0, F.lit(100) * ((now - before) / before))


def growth_note(units_range: int | None, records_range: int | None) -> Column:
    """The note of the first metric without a previous value or with too much growth, or null."""
    whens: Column | None = None
    for metric, name, label in METRICS:
        allowed = F.lit(units_range if metric == "units" else records_range).cast("int")
        empty = F.col(f"p_{metric}") == 0
        percent = growth_percent(metric)
        text = F.concat(percent.cast("decimal(18,3)").cast("string"), F.lit(f" suspected growth on {label}"))
        missing = F.lit(f"Previous cycle log has not any value on {name}")
        whens = F.when(empty, missing) if whens is None else whens.when(empty, missing)
        whens = whens.when(F.abs(percent) > allowed, text)
    return whens


def gate_verdict(
    requests: DataFrame,
    cycles: DataFrame,
    accounts: DataFrame,
    log: DataFrame,
    units_range: int | None = 35,
    records_range: int | None = 35,
    staging: Staging | None = None,
) -> DataFrame:
    """Per request: verdict -1 with a message, 0 with a note, or 1."""
    facts = facts_of_requests(requests, cycles, accounts, log, staging)
    checked = facts.select(
        *KEYS,
        "prev_cycle_id",
        precondition(units_range, records_range).alias("message"),
        F.coalesce(date_note(), growth_note(units_range, records_range)).alias("_note"),
    )
    note = F.when(F.col("message").isNull(), F.col("_note"))
    verdict = F.when(F.col("message").isNotNull(), -1).when(note.isNotNull(), 0).otherwise(1)
    return checked.select(*KEYS, verdict.alias("verdict"), "message", note.alias("note"))


def note_changes(verdicts: DataFrame) -> DataFrame:
    """The notes of failed requests by key, to update a log that is kept as a base with changes."""
    return verdicts.where(F.col("note").isNotNull()).select(*KEYS, "note")


def write_notes(log: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The log with the note of each failed request on all its rows, deleted ones included."""
    notes = note_changes(verdicts).withColumnRenamed("note", "_note")
    return log.join(notes, list(KEYS), "left").withColumn("note", F.coalesce("_note", "note")).drop("_note")


def route(processes: DataFrame, verdicts: DataFrame, noted_log: DataFrame) -> DataFrame:
    """Each process with the outcome that decides its branch.

    Only an error count of exactly 0 reaches the gate. The note comes from log rows whose deletion
    flag is 0; a missing flag does not count here. A process whose (cycle, account) has no verdict
    counts as one of -1: message, flag and status all follow from the verdict made here.
    """
    notes = noted_log.where(F.col("is_deleted") == 0).groupBy(*KEYS).agg(F.max("note").alias("log_note"))
    gate = verdicts.select(*KEYS, "verdict", F.col("message").alias("gate_message"))
    return (
        processes.join(gate, list(KEYS), "left")
        .join(notes, list(KEYS), "left")
        .withColumn("gate_message", F.when(F.col("verdict").isNull(), NO_VERDICT).otherwise(F.col("gate_message")))
        .withColumn("verdict", F.coalesce("verdict", F.lit(-1)))
        .withColumn("passed_supply", F.coalesce(F.col("total_errors") == 0, F.lit(False)))
    )


def process_updates(routed: DataFrame, status: Mapping[str, str]) -> DataFrame:
    """New status, message and approve flag of each process; the error branch keeps the flag."""
    old = F.coalesce("message", F.lit(""))
    found = F.concat(F.coalesce("log_note", F.lit("")), F.lit("\\n"), F.coalesce("gate_message", F.lit("")))
    errors = F.concat(
        F.lit("There are "), F.col("total_errors").cast("string"),
        F.lit(" error transaction for Supply Service....\\n"), F.col("err_message"), F.lit("\\n"), old,
    )
    message = (
        F.when(~F.col("passed_supply"), errors)
        .when(F.col("verdict") == 0, F.concat(F.lit(SUPPLY_PASSED), found))
        .when(F.col("verdict") == -1, found)
        .otherwise(F.lit(SUPPLY_PASSED + PRODUCTION_PASSED))
    )
    approve = F.when(~F.col("passed_supply"), F.col("approve_flag")).when(F.col("verdict") == 1, 1).otherwise(0)
    return routed.select(
        "process_id",
        F.lit(status["executed"]).alias("status"),
        message.alias("message"),
        approve.alias("approve_flag"),
    )


def operation_log(routed: DataFrame, status: Mapping[str, str], as_of: str) -> DataFrame:
    """A log row per process that reached the gate."""
    return routed.where("passed_supply").select(
        *KEYS,
        "process_id",
        F.to_date(F.lit(as_of)).alias("operation_date"),
        F.when(F.col("verdict") == 1, F.lit(status["executed"])).otherwise(F.lit(status["control"])).alias("status"),
        F.lit(OPERATOR).alias("operation_user_id"),
    )
