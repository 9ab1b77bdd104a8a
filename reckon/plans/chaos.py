"""Fault injection: damage one side of a wave of inputs in a known way, and judge what a build finds."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reckon.operators.scale import materialize


@dataclass(frozen=True)
class Wave:
    """Inputs of one delivery. events: (position double, line string); movements: the list's columns;
    reported: the reported balances. Lines are kept byte for byte."""

    events: DataFrame
    movements: DataFrame
    reported: DataFrame


def sample(keys: DataFrame, key: str, rate: float, seed: int) -> DataFrame:
    """(key) of a share of the different keys, at least three, the same for the same seed.

    The order is a hash of key and seed, ties by the key; all of them if there are three or fewer.
    """
    ids = keys.where(F.col(key).isNotNull()).select(key).distinct()
    n = ids.count()
    return materialize(ids.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(max(3, round(rate * n))))


def event_id(line: str = "line"):
    """An event's id; an object's id inside the line doesn't count."""
    return F.get_json_object(line, "$.id")


def naming(events: DataFrame, ids: DataFrame, id: str) -> DataFrame:
    """Positions of the lines that name one of the ids anywhere.

    Every identifier in a line is looked up once, by a hash join, instead of trying each id on each line.
    """
    words = events.select("position", F.explode(F.array_distinct(F.expr(r"regexp_extract_all(line, '[a-z]+_[A-Za-z0-9]+', 0)"))).alias(id))
    return words.join(ids.select(id), id, "left_semi").select("position").distinct()


def baseline(wave: Wave, seed: int = 1) -> list[Wave]:
    """The inputs as they are."""
    return [wave]


def duplicate_delivery(wave: Wave, seed: int = 1) -> list[Wave]:
    """5% of the events come again, the same line up to 39 places later."""
    ids = sample(wave.events.select(event_id().alias("id")), "id", 0.05, seed)
    again = wave.events.withColumn("id", event_id()).join(ids, "id", "left_semi")
    later = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(39)) + 1.5
    return [replace(wave, events=wave.events.unionByName(again.select((F.col("position") + later).alias("position"), "line")))]


def out_of_order(wave: Wave, seed: int = 1) -> list[Wave]:
    """All events in reverse."""
    return [replace(wave, events=wave.events.withColumn("position", -F.col("position")))]


def dropped_event(wave: Wave, seed: int = 1) -> list[Wave]:
    """Every event that names one of 2% of the charges, or its intent, is lost; the list isn't."""
    charges = sample(wave.movements.where("reporting_category = 'charge'").withColumnRenamed("source_id", "id"), "id", 0.02, seed)
    own = wave.events.where(F.get_json_object("line", "$.data.object.object") == "charge").select(F.get_json_object("line", "$.data.object.id").alias("id"), F.get_json_object("line", "$.data.object.payment_intent").alias("intent"))
    intents = own.join(charges, "id", "left_semi").where("intent IS NOT NULL").select(F.col("intent").alias("id")).distinct()
    lost = naming(wave.events, charges.unionByName(intents), "id")
    return [replace(wave, events=wave.events.join(lost, "position", "left_anti"))]


def _sampled(wave: Wave, category: str, rate: float, seed: int) -> DataFrame:
    return sample(wave.movements.where(F.col("reporting_category") == category), "balance_transaction_id", rate, seed)


def rounding_drift(wave: Wave, seed: int = 1) -> list[Wave]:
    """The net of 2% of the charge movements is one unit too high."""
    ids = _sampled(wave, "charge", 0.02, seed).withColumn("hit", F.lit(True))
    moved = wave.movements.join(ids, "balance_transaction_id", "left").withColumn("net", F.when(F.col("hit"), F.col("net") + 1).otherwise(F.col("net")))
    return [replace(wave, movements=moved.select(*wave.movements.columns))]


def reversal_dropped(wave: Wave, seed: int = 1) -> list[Wave]:
    """2% of the dispute reversals are missing from the list; without any reversal the arm refuses."""
    ids = _sampled(wave, "dispute_reversal", 0.02, seed)
    if ids.isEmpty():
        raise ValueError("there is no dispute reversal to drop")
    return [replace(wave, movements=wave.movements.join(ids, "balance_transaction_id", "left_anti").select(*wave.movements.columns))]


def unreported_transaction(wave: Wave, seed: int = 1) -> list[Wave]:
    """2% of the charge movements appear a second time in the list under a new id and the same source."""
    ids = _sampled(wave, "charge", 0.02, seed)
    clones = wave.movements.join(ids, "balance_transaction_id", "left_semi").withColumn("balance_transaction_id", F.concat("balance_transaction_id", F.lit("Phantom")))
    return [replace(wave, movements=wave.movements.unionByName(clones.select(*wave.movements.columns)))]


def late_arrival(wave: Wave, seed: int = 1, early_reported: DataFrame | None = None) -> list[Wave]:
    """2% of the movements, and the events that name their sources, come in a second wave.

    early_reported: what the processor reported of the early movements alone.
    """
    ids = sample(wave.movements, "balance_transaction_id", 0.02, seed)
    held = wave.movements.join(ids, "balance_transaction_id", "left_semi")
    late = materialize(naming(wave.events, held.select(F.col("source_id").alias("id")).distinct(), "id"))
    first = Wave(wave.events.join(late, "position", "left_anti"), wave.movements.join(ids, "balance_transaction_id", "left_anti").select(*wave.movements.columns), wave.reported if early_reported is None else early_reported)
    return [first, replace(wave, events=wave.events.join(late, "position", "left_semi"))]


ARMS: dict[str, Callable[..., list[Wave]]] = {
    f.__name__: f for f in (baseline, duplicate_delivery, out_of_order, dropped_event, late_arrival, rounding_drift, reversal_dropped, unreported_transaction)
}

def injected(arm: str, before: Wave, waves: list[Wave]) -> dict[str, int]:
    """What an arm damaged, counted by comparing its waves with the undamaged one, apart from what any check finds."""
    key, last = "balance_transaction_id", waves[-1]
    if arm == "dropped_event":
        named = last.events.select(F.get_json_object("line", "$.data.object.id").alias("source_id")).distinct()
        return {"lost_events": before.events.count() - last.events.count(), "blinded_transactions": before.movements.join(named, "source_id", "left_anti").count()}
    if arm == "rounding_drift":
        was = before.movements.select(key, F.col("net").alias("was"))
        return {"drifted_transactions": last.movements.join(was, key).where("net <> was").count()}
    if arm == "reversal_dropped":
        return {"lost_reversals": before.movements.join(last.movements.select(key), key, "left_anti").count()}
    if arm == "unreported_transaction":
        return {"phantom_transactions": last.movements.join(before.movements.select(key), key, "left_anti").count()}
    if arm == "duplicate_delivery":
        return {"redelivered_events": last.events.count() - before.events.count()}
    if arm == "late_arrival":
        return {"late_transactions": before.movements.join(waves[0].movements.select(key), key, "left_anti").count(), "held_events": last.events.count()}
    return {}


#: What each arm must make fail, and on how many rows: a count of what was injected, or None for any. Fixed values.
MUST_FAIL: dict[str, dict[str, str | None]] = {
    "baseline": {},
    "duplicate_delivery": {},
    "out_of_order": {},
    "late_arrival": {},
    "dropped_event": {"stream_complete": "blinded_transactions"},
    "rounding_drift": {"entries_balance": "drifted_transactions"},
    "reversal_dropped": {"nothing_unexplained": None, "list_complete": "lost_reversals"},
    "unreported_transaction": {"nothing_unexplained": None},
}

#: How an arm's measurements must compare: a sign, then a number, another measurement of the arm, ``null``
#: for a table never published, or nothing for the same measurement of the baseline. Fixed values.
MUST_MEASURE: dict[str, dict[str, str]] = {
    "baseline": {"silver_events": "=bronze_events", "gold_trial_balance": "=0", "gold_reconciliation_breaks": "=0", "gold_coverage_gaps": "=0", "gold_closes": "=1", "gold_restatements": "=0"},
    "duplicate_delivery": {"bronze_deliveries": ">bronze_events", "silver_events": "=", "gold_postings": "=", "gold_available": "=", "gold_reconciliation_breaks": "=0"},
    "out_of_order": {"silver_events": "=", "silver_charges": "=", "charges_created_checksum": "=", "gold_available": "=", "gold_reconciliation_breaks": "=0"},
    "dropped_event": {"silver_events": "<", "silver_charges": "<", "gold_postings": "=", "gold_reconciliation_breaks": "=0", "gold_coverage_gaps": ">0"},
    "late_arrival": {
        "silver_events": "=", "charges_created_checksum": "=", "gold_postings": "=", "gold_available": "=", "gold_reconciliation_breaks": "=0", "gold_coverage_gaps": "=0", "gold_closes": "=2", "gold_restatements": ">0",
    },
    "rounding_drift": {"gold_postings": "=", "gold_close_rows": "=null", "gold_reconciliation_breaks": "=null"},
    "reversal_dropped": {"silver_events": "=", "gold_postings": "<", "gold_reconciliation_breaks": ">0", "gold_coverage_gaps": ">0"},
    "unreported_transaction": {"silver_events": "=", "gold_postings": ">", "gold_trial_balance": "=0", "gold_coverage_gaps": "=0", "gold_reconciliation_breaks": ">0"},
}


def expected(arm: str, counts: dict[str, int]) -> dict[str, int | None]:
    """The checks that must fail, with the number of rows that the injection says."""
    return {check: None if count is None else counts[count] for check, count in MUST_FAIL[arm].items()}


def verdict(failed: dict[str, int], must_fail: dict[str, int | None], measured: dict[str, int | None], must_measure: dict[str, str], base: dict[str, int | None] | None = None) -> list[str]:
    """What speaks against an arm; an empty list is a pass.

    Strict both ways: a declared check that passes and an undeclared one that fails both count, and so
    does one that fails on another number of rows. A measurement that is missing equals only another
    that is.
    """
    against = [f"{c} should have failed" for c in must_fail if c not in failed]
    against += [f"{c} failed on {n} rows, not declared" for c, n in failed.items() if c not in must_fail]
    against += [f"{c} failed on {failed[c]} rows, declared {n}" for c, n in must_fail.items() if n is not None and c in failed and failed[c] != n]
    for name, rule in must_measure.items():
        sign, to = rule[0], rule[1:]
        want = None if to == "null" else (base or {}).get(name) if not to else int(to) if to.isdigit() else measured.get(to)
        got = measured.get(name)
        if got is None or want is None:
            ok = sign == "=" and got is want
        else:
            ok = got == want if sign == "=" else got < want if sign == "<" else got > want
        if not ok:
            against.append(f"{name} is {got}, declared {rule}, which is {sign} {want}")
    return against
