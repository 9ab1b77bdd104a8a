"""The latest state of each entity, recomputed from all events; correct at any lateness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reckon.schemas import EMBEDDED, OBJECT


def latest(events: DataFrame, entity_type: str, columns: list[str]) -> DataFrame:
    """(entity_id, columns, event_id, last_event_at, events): the last event of each entity of a type.

    Ordered by ``created``, ties by event id, greatest last. One aggregate gives the state and the
    number of events; a bare rank filter would need a second pass for the count.
    """
    rows = events.where((F.col("entity_type") == entity_type) & F.col("entity_id").isNotNull())
    last = rows.groupBy("entity_id").agg(F.max(F.struct("created", "event_id", *[F.col(c).alias(f"k_{c}") for c in columns])).alias("l"), F.count(F.lit(1)).alias("events"))
    return last.select("entity_id", *[F.col(f"l.k_{c}").alias(c) for c in columns], F.col("l.event_id").alias("event_id"), F.col("l.created").alias("last_event_at"), "events")


def charges(events: DataFrame) -> DataFrame:
    c = latest(events, "charge", ["payment_intent_id", "entity_created", "amount", "currency", "status", "balance_transaction_id", "amount_refunded", "refunded", "event_type"])
    return c.select(
        F.col("entity_id").alias("charge_id"), "payment_intent_id", F.col("entity_created").alias("created"), "amount", "currency", "status", "balance_transaction_id",
        F.coalesce("amount_refunded", F.lit(0)).alias("amount_refunded"), F.coalesce("refunded", F.lit(False)).alias("refunded"), F.col("event_type").alias("last_event_type"), "last_event_at", "events",
    )


def refunds(events: DataFrame) -> DataFrame:
    c = latest(events, "refund", ["charge_id", "payment_intent_id", "entity_created", "amount", "currency", "status", "balance_transaction_id", "reason"])
    return c.select(F.col("entity_id").alias("refund_id"), "charge_id", "payment_intent_id", F.col("entity_created").alias("created"), "amount", "currency", "status", "balance_transaction_id", "reason", "last_event_at", "events")


def disputes(events: DataFrame) -> DataFrame:
    c = latest(events, "dispute", ["charge_id", "payment_intent_id", "entity_created", "amount", "currency", "status", "reason"])
    return c.select(F.col("entity_id").alias("dispute_id"), "charge_id", "payment_intent_id", F.col("entity_created").alias("created"), "amount", "currency", "status", "reason", "last_event_at", "events")


def expanded_movements(events: DataFrame, payloads: DataFrame) -> DataFrame:
    """Movements embedded in the latest event of each dispute; earlier events' copies don't count.

    payloads: (event_id, payload), one row an event. Only dispute events are looked up. Elements of the
    list that aren't objects (bare ids, NULLs) carry no movement and are passed over.
    """
    last = latest(events, "dispute", []).select("event_id")
    held = payloads.join(last, "event_id").select("event_id", F.explode(F.from_json("payload", OBJECT).getField("data").getField("object").getField("balance_transactions")).alias("t"))
    read = held.where(F.col("t").startswith("{")).select("event_id", F.from_json("t", EMBEDDED).alias("m")).select("event_id", "m.*")
    return read.select(
        F.col("id").alias("balance_transaction_id"), F.col("source").alias("source_id"), F.col("event_id").alias("source_event_id"), "type", "reporting_category", "amount", "fee", "net", "currency",
        F.col("created").cast("timestamp").alias("created"), F.col("available_on").cast("timestamp").alias("available_on"), "status",
    )
