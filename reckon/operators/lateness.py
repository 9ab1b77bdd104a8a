"""Late and out-of-order events: K-slack reordering into order-sensitive aggregates per period.

Every event waits in a buffer until the lateness bound K of its period has passed; then the buffer
releases the period's events sorted by event time to the final aggregate. Until then the buffer's
content gives provisional values. In a batch run the buffer is the table itself: each event's status
follows from its first arrival, its period's closing and K; on a stream it is kept state
(``streaming.feeds.kslack``), which releases to the same aggregate.

    on_time    arrived by the closing: in the provisional and the final value
    corrected  arrived after it, within K: only in the final value
    too_late   arrived after K: left out of both
    not_closed the period is not closed (yet)

The order-sensitive aggregate never sorts a period in one task. Events of one instant merge first
(map-side), instants sort within short slots, and slots merge in order: rows of the last step are
bounded by the slots of a period, whatever the share of one period in the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reckon.operators.scale import broadcast_if


def first_arrivals(events: DataFrame, *, id: str, event_time: str, arrival: str) -> DataFrame:
    """(id, event_time, arrival): per id its earliest delivery. NULL ids, times or arrivals don't count.

    Where deliveries of one id disagree on the event time, the earliest arrival's stands, of equal
    arrivals the least.
    """
    first = F.min(F.struct(F.col(arrival).alias("a"), F.col(event_time).alias("t")))
    known = events.where(F.col(id).isNotNull() & F.col(event_time).isNotNull() & F.col(arrival).isNotNull())
    return known.groupBy(F.col(id).alias("id")).agg(first.alias("f")).select("id", F.col("f.t").alias("event_time"), F.col("f.a").alias("arrival"))


def closings(log: DataFrame, *, period: str, closed_at: str, among: DataFrame | None = None) -> DataFrame:
    """(period, closed_at): the earliest closing of each period, if given only of periods in ``among``."""
    first = log.where(F.col(period).isNotNull() & F.col(closed_at).isNotNull()).groupBy(F.col(period).alias("period")).agg(F.min(closed_at).alias("closed_at"))
    if among is None:
        return first
    return first.join(among.select(F.col(period).alias("period")).distinct(), "period", "left_semi")


def buffered(arrivals: DataFrame, closed: DataFrame, bound_hours: int) -> DataFrame:
    """(id, event_time, arrival, period, closed_at, release_at, status) of every event.

    ``arrivals`` as from ``first_arrivals``, ``closed`` as from ``closings`` with days as periods.
    An arrival exactly at the closing is on time, one exactly at the bound is corrected.
    """
    slack = F.expr(f"INTERVAL {int(bound_hours)} HOURS")
    days = broadcast_if(closed)
    rows = arrivals.withColumn("period", F.to_date("event_time")).join(days, "period", "left")
    return rows.select(
        "id", "event_time", "arrival", "period", "closed_at", (F.col("closed_at") + slack).alias("release_at"),
        F.when(F.col("closed_at").isNull(), "not_closed").when(F.col("arrival") <= F.col("closed_at"), "on_time").when(F.col("arrival") <= F.col("closed_at") + slack, "corrected").otherwise("too_late").alias("status"),
    )


def released(buffer: DataFrame) -> DataFrame:
    """What the buffer lets go, in order of release: by release, event time and id.

    Each period's events leave it sorted once the bound has passed; those that came too late, and
    those of periods that aren't closed, never do. Rows are range-partitioned by all three columns, so
    that no period and no instant, however many events it has, is one task.
    """
    out = buffer.where(F.col("status").isin("on_time", "corrected"))
    return out.repartitionByRange("release_at", "event_time", "id").sortWithinPartitions("release_at", "event_time", "id")


def instants(rows: DataFrame) -> DataFrame:
    """(period, version, t, n, lo, hi): events merged by instant, in microseconds; they are counted and their least and greatest id kept."""
    at = F.unix_micros(F.col("event_time").cast("timestamp"))
    return rows.groupBy("period", "version", at.alias("t")).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi"))


def values_of(merged: DataFrame, slot_seconds: int = 60) -> DataFrame:
    """(period, version, events, first_id, last_id, longest_gap_s) from instants: slots sort alone, then merge in order."""
    slotted = merged.withColumn("slot", F.floor(F.col("t") / F.lit(slot_seconds * 1_000_000)))
    within = Window.partitionBy("period", "version", "slot").orderBy("t")
    steps = slotted.withColumn("step", F.col("t") - F.lag("t").over(within))
    slots = steps.groupBy("period", "version", "slot").agg(
        F.sum("n").alias("n"), F.min("t").alias("t0"), F.max("t").alias("t1"), F.max("step").alias("gap"),
        F.min(F.struct("t", "lo")).getField("lo").alias("first_id"), F.max(F.struct("t", "hi")).getField("hi").alias("last_id"),
    )
    along = Window.partitionBy("period", "version").orderBy("slot")
    joined = slots.withColumn("gap", F.greatest("gap", F.col("t0") - F.lag("t1").over(along)))
    return joined.groupBy("period", "version").agg(
        F.sum("n").alias("events"), F.min(F.struct("slot", "first_id")).getField("first_id").alias("first_id"),
        F.max(F.struct("slot", "last_id")).getField("last_id").alias("last_id"),
        F.expr("coalesce(max(gap), 0) div 1000000").alias("longest_gap_s"),
    )


def side_by_side(values: DataFrame, too_late: DataFrame) -> DataFrame:
    """One row a period from one a version, with the number of events left out (period, too_late)."""
    pick = lambda v, c: F.max(F.when(F.col("version") == v, F.col(c)))
    wide = [pick(v, c).alias(f"{v}_{c}") for v in ("provisional", "final") for c in ("events", "first_id", "last_id", "longest_gap_s")]
    columns = ["period", "version", "events", "first_id", "last_id", "longest_gap_s"]
    left_out = too_late.select("period", F.lit("too_late").alias("version"), F.col("too_late").alias("events"), *[F.lit(None).cast(t).alias(c) for c, t in (("first_id", "string"), ("last_id", "string"), ("longest_gap_s", "long"))])
    every = values.select(*columns).unionByName(left_out)
    return every.groupBy("period").agg(*wide, F.coalesce(pick("too_late", "events"), F.lit(0)).alias("too_late"))


def ordered_values(buffer: DataFrame, slot_seconds: int = 60) -> DataFrame:
    """Per closed period the provisional and the final value of order-sensitive aggregates.

    Columns: period, then for ``provisional_`` and ``final_``: events, first_id, last_id (by event
    time, then id byte by byte) and longest_gap_s, the longest time in whole seconds between
    neighbours; and too_late, the events left out. Final values come from what the buffer releases,
    provisional ones from its content at the closing. NULL where a value has no events; a single
    event has a gap of 0. Periods without any event have no row.
    """
    final = released(buffer).withColumn("version", F.lit("final"))
    provisional = buffer.where("status = 'on_time'").withColumn("version", F.lit("provisional"))
    merged = instants(final).unionByName(instants(provisional))
    too_late = buffer.where("status = 'too_late'").groupBy("period").agg(F.count(F.lit(1)).alias("too_late"))
    return side_by_side(values_of(merged, slot_seconds), too_late)
