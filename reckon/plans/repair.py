"""Queries p1 to p5: the general data-repair operators over the domain tables, whole."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reckon.operators import changes, compare, dedup, lateness, nested
from reckon.operators.scale import MOST_BYTES, materialize, scratch_folder
from reckon.sources import landing
from reckon.sources.tables import table
from reckon.streaming import feeds

#: Lateness bound of problem 2.
CUT_OFF_HOURS = 240

ENTITY_FEED = changes.Feed(key=["entity_id"], order=["created", "event_id"], deletes="event_type IN ('customer.deleted', 'payment_method.detached')")


def _feed(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The changes, and the log of what committed: the delivered events, which are the same commits unreduced."""
    log = table(spark, sf, "bronze_events").where(F.col("event_id").isNotNull()).select("event_id", "created")
    return table(spark, sf, "silver_events"), log


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    """The change that stands of every entity that exists at the committed watermark."""
    feed, log = _feed(spark, sf)
    return changes.replay(feed, ENTITY_FEED, log=log).select("entity_id", "event_id")


def p1_state(spark: SparkSession, sf: str) -> DataFrame:
    """The rebuilt state itself: type, amount, currency and status of every entity that exists."""
    feed, log = _feed(spark, sf)
    return changes.replay(feed, ENTITY_FEED, keep=["entity_type", "amount", "currency", "status"], log=log).drop("created")


def p1_watermark(spark: SparkSession, sf: str) -> DataFrame:
    """How far the feed is committed: the transactions, those whole, the watermark and its instant, and the changes held."""
    feed, log = _feed(spark, sf)
    numbers = changes.instants(feed, ENTITY_FEED, log)
    reached = materialize(changes.frontier(numbers))
    counts = numbers.agg(F.count(F.lit(1)).alias("transactions"), F.count_if("_whole").alias("whole"), F.coalesce(F.sum("_declared"), F.lit(0)).alias("declared"), F.coalesce(F.sum("_arrived"), F.lit(0)).alias("arrived"))
    return counts.select("*", reached.select("watermark").scalar().alias("watermark"), reached.select("frontier").scalar().alias("frontier"))


def _buffer(spark: SparkSession, sf: str) -> DataFrame:
    arrivals = lateness.first_arrivals(table(spark, sf, "bronze_events"), id="event_id", event_time="created", arrival="ingested_at")
    closed = lateness.closings(table(spark, sf, "daily_close_log"), period="close_date", closed_at="closed_at", among=table(spark, sf, "daily_close"))
    return lateness.buffered(arrivals, closed, CUT_OFF_HOURS)


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """Events that corrected a day after its closing, within the cut-off, as the buffer releases them."""
    return lateness.released(_buffer(spark, sf)).where("status = 'corrected'").select(F.col("id").alias("event_id"), F.date_format("period", "yyyy-MM-dd").alias("close_date"))


def p2_days(spark: SparkSession, sf: str) -> DataFrame:
    """Provisional and final values of every closed day."""
    return lateness.ordered_values(_buffer(spark, sf)).withColumnRenamed("period", "close_date")


#: How long the stream waits for deliveries that come out of order, and the slots and lanes its buffer is kept in.
STREAM = {"delay": "1 hour", "slot_seconds": 3_600, "lanes": 2}


def p2_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same values from the deliveries drained as a stream through the kept buffer."""
    closed = lateness.closings(table(spark, sf, "daily_close_log"), period="close_date", closed_at="closed_at", among=table(spark, sf, "daily_close"))
    root = f"{scratch_folder(spark)}/{uuid.uuid4().hex}"
    stream = landing.table_stream(spark, f"{sf}/bronze_events.parquet", table(spark, sf, "bronze_events").schema)
    slots = feeds.kslack(stream, closed, id="event_id", event_time="created", arrival="ingested_at", bound_hours=CUT_OFF_HOURS, **STREAM)
    feeds.log_batches(slots, f"{root}/log", f"{root}/offsets").awaitTermination()
    return feeds.slack_values(spark, f"{root}/log").withColumnRenamed("period", "close_date")


#: What a movement's own fields are read as.
MOVEMENT = "id string, source string, type string, reporting_category string, amount long, fee long, net long, currency string, created long, available_on long, status string"
FEE_LINE = "amount long, currency string, description string, type string"


def _nodes(spark: SparkSession, sf: str, require: tuple[str, ...] = ("balance_transaction",)) -> DataFrame:
    events = table(spark, sf, "bronze_events").where(F.col("event_id").isNotNull())
    return nested.label(events, key=["event_id"], text="payload", at=("data", "object"), object_types=["balance_transaction"], element_fields=["fee_details"], require=require)


def _movements_with_fees(spark: SparkSession, sf: str) -> DataFrame:
    nodes = _nodes(spark, sf).withColumn("movement", F.get_json_object("attributes", "$.id"))
    return nested.contained(nodes, parent="object_type = 'balance_transaction'", child="field = 'fee_details' AND position IS NOT NULL", key=["event_id"], levels=2, carry=["movement"])


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """Every movement in the events, with the position of each of its fee lines."""
    linked = _movements_with_fees(spark, sf)
    return linked.select("event_id", F.col("movement").alias("balance_transaction_id"), F.coalesce("child_position", F.lit(-1)).cast("long").alias("fee_no")).distinct()


def p3_movements(spark: SparkSession, sf: str) -> DataFrame:
    """Flat table of movements with their labels: one row per node and different payload."""
    nodes = _nodes(spark, sf).where("object_type = 'balance_transaction'")
    own = F.from_json("attributes", MOVEMENT)
    return nodes.withColumn("m", own).select("event_id", "document", "pre", "post", "depth", "parent_pre", "field", "position", F.col("m.id").alias("balance_transaction_id"), "m.source", "m.type", "m.reporting_category", "m.amount", "m.fee", "m.net", "m.currency", "m.status").distinct()


def p3_fee_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Flat table of fee lines, each linked to its movement's node."""
    linked = _movements_with_fees(spark, sf).where("child_pre IS NOT NULL")
    return linked.withColumn("f", F.from_json("child_attributes", FEE_LINE)).select("event_id", "document", F.col("parent_pre").alias("movement_pre"), F.col("movement").alias("balance_transaction_id"), F.col("child_pre").alias("pre"), F.col("child_position").alias("fee_no"), "f.amount", "f.currency", "f.description", "f.type")


def p3_events(spark: SparkSession, sf: str) -> DataFrame:
    """Flat table of events: the envelope of every different payload, with its document digest."""
    events = table(spark, sf, "bronze_events").where(F.col("event_id").isNotNull())
    return events.select("event_id", F.md5("payload").alias("document"), "event_type", "created", "livemode", "api_version").distinct()


def currency_name(column: str):
    return F.lower(F.trim(F.col(column)))


def ledger_balances(postings: DataFrame) -> DataFrame:
    """(as_of_date, currency, pending, available): running balances on a dense grid of days.

    Each posting counts once by its id; of postings that share an id the least row counts. The grid
    holds every currency and every day from the first to the last posting; with no postings it is empty.
    """
    named = postings.select("posting_id", "account", "amount", currency_name("currency").alias("currency"), "posted_on")
    # Two accounts are all that the balances need; the grid below reads three columns of all rows.
    wanted = named.where(F.col("account").isin("asset:balance_pending", "asset:balance_available"))
    once = wanted.groupBy("posting_id").agg(F.min(F.struct("currency", "posted_on", "account", "amount")).alias("p")).select("p.*")
    of = lambda account: F.sum(F.when(F.col("account") == account, F.col("amount")).otherwise(0))
    moved = once.groupBy("currency", "posted_on").agg(of("asset:balance_pending").alias("pending"), of("asset:balance_available").alias("available"))
    # One row of one list: as long as there are currencies, whatever the number of postings.
    bounds = named.groupBy("currency").agg(F.min("posted_on").alias("a"), F.max("posted_on").alias("b"))
    spine = bounds.agg(F.min("a").alias("a"), F.max("b").alias("b"), F.collect_set("currency").alias("c"))
    days = spine.where("a IS NOT NULL").select(F.explode("c").alias("currency"), "a", "b").select("currency", F.explode(F.sequence("a", "b")).alias("as_of_date"))
    dense = days.join(moved.withColumnRenamed("posted_on", "as_of_date"), ["currency", "as_of_date"], "left")
    return dense.select(
        "as_of_date", "currency",
        *[F.expr(f"coalesce(sum({c}) OVER (PARTITION BY currency ORDER BY as_of_date ROWS UNBOUNDED PRECEDING), 0)").alias(c) for c in ("pending", "available")],
    )


def _balance_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    reported = table(spark, sf, "reported_balance").select("as_of_date", currency_name("currency").alias("currency"), "pending", "available")
    return ledger_balances(table(spark, sf, "ledger_postings")), reported


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """Days that one side lacks, and fields that differ, between ledger and reported balances."""
    ledger, reported = _balance_sides(spark, sf)
    out = compare.findings(ledger, reported, keys=["as_of_date", "currency"], fields=["pending", "available"], missing_left="missing_in_ledger", missing_right="missing_in_reported")
    return out.select(F.date_format("as_of_date", "yyyy-MM-dd").alias("as_of_date"), "currency", "finding")


def p4_values(spark: SparkSession, sf: str) -> DataFrame:
    """The cells that don't cancel, with both values."""
    ledger, reported = _balance_sides(spark, sf)
    out = compare.values_apart(ledger, reported, keys=["as_of_date", "currency"], fields=["pending", "available"])
    return out.select(F.date_format("as_of_date", "yyyy-MM-dd").alias("as_of_date"), "currency", "field", F.col("left_value").alias("ledger_value"), F.col("right_value").alias("reported_value"))


DELIVERY_ORDER = ["kafka_timestamp", "kafka_partition", "kafka_offset"]


def _repeated(spark: SparkSession, sf: str, most_bytes: int) -> DataFrame:
    messages = table(spark, sf, "bronze_events").select("event_id", *DELIVERY_ORDER)
    kept = dedup.one_of_each(messages, id="event_id", order=DELIVERY_ORDER, copies="copies", most_bytes=most_bytes)
    return kept.where("copies > 1").select("event_id", F.col("kafka_partition").cast("long").alias("kafka_partition"), "kafka_offset")


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """The delivery to keep of every event that was delivered more than once."""
    return _repeated(spark, sf, MOST_BYTES)


def p5_shuffled(spark: SparkSession, sf: str) -> DataFrame:
    """The same without any broadcast of repeated ids, as it runs where these are too large for one."""
    return _repeated(spark, sf, 0)


def p5_messages(spark: SparkSession, sf: str) -> DataFrame:
    """All messages with one delivery of each, without the payload; those without an id all stay."""
    messages = table(spark, sf, "bronze_events").select("event_id", "event_type", *DELIVERY_ORDER, "ingested_at")
    return dedup.one_of_each(messages, id="event_id", order=DELIVERY_ORDER, copies="copies")


QUERIES = {f.__name__: f for f in (p1_found, p1_state, p1_watermark, p2_found, p2_days, p2_stream, p3_found, p3_movements, p3_fee_lines, p3_events, p4_found, p4_values, p5_found, p5_shuffled, p5_messages)}
