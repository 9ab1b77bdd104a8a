"""From raw deliveries to one typed row per event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reckon.schemas import ENVELOPE, OBJECT

COORDINATE = ["kafka_partition", "kafka_offset"]


def envelope(raw: DataFrame, *, key: str = "key", value: str = "value", carry: tuple[str, ...] = (), ingested_at: Column | None = None) -> DataFrame:
    """Landing projection: the payload kept byte for byte, its envelope in columns beside it.

    A payload that isn't JSON keeps its row with a NULL envelope; nothing is dropped here.
    """
    e = F.from_json(F.col(value).cast("string"), ENVELOPE)
    rows = raw.withColumn("_e", e)
    return rows.select(
        F.col("_e.id").alias("event_id"), F.col("_e.type").alias("event_type"), F.col("_e.created").cast("timestamp").alias("created"),
        F.col("_e.livemode").alias("livemode"), F.col("_e.api_version").alias("api_version"), F.col("_e.request.id").alias("request_id"),
        F.col("_e.request.idempotency_key").alias("idempotency_key"), F.col(value).cast("string").alias("payload"),
        F.col(key).cast("string").alias("kafka_key"), *carry, (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingested_at"),
    )


def quarantined(bronze: DataFrame) -> DataFrame:
    """Deliveries without an envelope: kept apart, never merged under a NULL key."""
    return bronze.where(F.col("event_id").isNull())


def partition_key(payload: str) -> Column:
    """What keeps an entity's events together: the charge, else the intent, else the object, else the event.

    Empty strings and anything but strings are passed over; a broken payload gives ``unknown``.
    """
    picks = [F.get_json_object(payload, f"$.data.object.{x}") for x in ("charge", "payment_intent", "id")] + [F.get_json_object(payload, "$.id")]
    plain = [F.when((p != "") & ~p.startswith("{") & ~p.startswith("["), p) for p in picks]
    return F.coalesce(*plain, F.lit("unknown"))


def reference(c: Column) -> Column:
    """The id of a reference that is an id or, expanded, an object with one."""
    return F.when(c.startswith("{"), F.get_json_object(c, "$.id")).otherwise(c)


def typed(bronze: DataFrame) -> DataFrame:
    """The object's fields of every delivery in columns, still one row a delivery.

    ``created`` is the event's time, ``entity_created`` the object's. The entity's type is the
    object's own, else the first part of the event's type; its charge is the one it refers to, or
    itself. Fields that are absent, or of another type than expected, are NULL.
    """
    rows = bronze.withColumn("_o", F.from_json("payload", OBJECT).getField("data").getField("object"))
    o = lambda name: F.col(f"_o.{name}")
    seconds = o("created").cast("timestamp")
    return rows.select(
        "event_id", "event_type", "created", seconds.alias("entity_created"),
        F.coalesce(o("object"), F.split("event_type", r"\.").getItem(0)).alias("entity_type"), o("id").alias("entity_id"),
        F.coalesce(reference(o("charge")), F.when(o("object") == "charge", o("id"))).alias("charge_id"),
        reference(o("payment_intent")).alias("payment_intent_id"), o("amount").alias("amount"), o("currency").alias("currency"), o("status").alias("status"),
        reference(o("balance_transaction")).alias("balance_transaction_id"), o("amount_refunded").alias("amount_refunded"), o("refunded").alias("refunded"),
        o("reason").alias("reason"), "livemode", "api_version", "request_id", "idempotency_key", "payload", *COORDINATE, "kafka_timestamp",
    )


def collapse(deliveries: DataFrame) -> DataFrame:
    """One row per event: content of the delivery with the least coordinate, with delivery counts.

    An aggregate with map-side partials instead of a window, so a redelivered event never sorts its
    copies in one task. Of deliveries with one coordinate the least content stands. NULL ids are
    quarantined elsewhere and left out.
    """
    content = [c for c in deliveries.columns if c not in ("event_id", *COORDINATE, "kafka_timestamp")]
    pack = F.struct(*COORDINATE, *content)
    one = deliveries.where(F.col("event_id").isNotNull()).groupBy("event_id").agg(
        F.min(pack).alias("_c"), F.count(F.lit(1)).cast("int").alias("deliveries"), F.min("kafka_timestamp").alias("first_seen_at"), F.max("kafka_timestamp").alias("last_seen_at")
    )
    return one.select("event_id", *[F.col(f"_c.{c}").alias(c) for c in content], "deliveries", "first_seen_at", "last_seen_at")


def merge_events(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Upsert a collapsed batch: counts add, first and last sight widen, the stored content stays.

    Both sides hold one row an event. The merge is a keyed aggregate over both instead of a join.
    """
    content = [c for c in stored.columns if c not in ("event_id", "deliveries", "first_seen_at", "last_seen_at")]
    rows = stored.select("*", F.lit(0).alias("_new")).unionByName(batch.select("*", F.lit(1).alias("_new")))
    one = rows.groupBy("event_id").agg(
        F.min(F.struct("_new", *content)).alias("_c"), F.sum("deliveries").cast("int").alias("deliveries"), F.min("first_seen_at").alias("first_seen_at"), F.max("last_seen_at").alias("last_seen_at")
    )
    return one.select("event_id", *[F.col(f"_c.{c}").alias(c) for c in content], "deliveries", "first_seen_at", "last_seen_at").select(*stored.columns)
