"""Structured Streaming forms of the operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import replace

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from reckon.operators import changes, events, lateness
from reckon.operators.scale import broadcast_if, materialize, scratch
from reckon.sources.store import Store


def log_batches(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append each micro-batch to its own partition of a delivery log.

    A batch that is replayed after a failure overwrites its partition, so each delivery is logged
    once. No watermark: a delivery counts however late it comes.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def collapsed_log(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The event table as a function of the delivery log: exact at any lateness and under replays."""
    log = (spark.read.schema(schema + ", batch_id int") if schema else spark.read).parquet(path).drop("batch_id")
    return events.collapse(log)


#: Parts by hash of the key that a kept state is stored in; a micro-batch rewrites those it touches.
BUCKETS = 64


def replayed_state(stream: DataFrame, store: Store, name: str, feed: changes.Feed, keep: list[str], checkpoint: str, first: int = 1, buckets: int = BUCKETS) -> StreamingQuery:
    """Keep the current state of a change feed in a stored dataset, tombstones included.

    A change shows once the contiguous committed watermark reaches it; until then it waits in the
    dataset ``name``_held. first: number of the first transaction of a numbered feed. Replayed and
    out-of-order batches do no harm: the state and its watermark change in one switch, and applying a
    change again gives the same state. Only buckets with committed keys of the batch are rewritten.
    """
    waiting = f"{name}_held"
    columns = list(dict.fromkeys([*feed.key, *feed.order, *feed.transaction, *[c for c in (feed.declared, feed.sequence) if c], *keep]))
    bucket = F.pmod(F.xxhash64(*feed.key), F.lit(buckets)).cast("int")

    def merge(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        with scratch(spark):
            rows = batch.select(*columns, F.coalesce(F.expr(feed.deletes), F.lit(False)).alias("deleted"))
            rows = materialize(rows.unionByName(store.read(waiting)) if store.exists(waiting) else rows)
            told = replace(feed, deletes="deleted")
            done = store.note(name).get("watermark")
            mark = changes.watermark(rows, told, first if done is None else done + 1)
            shown = changes.visible(told, mark)
            fresh = materialize(changes.last_changes(rows.where(shown), told, keep).withColumn("_bucket", bucket))
            touched = [r[0] for r in fresh.select("_bucket").distinct().collect()]
            old = store.read(name, touched) if store.exists(name) else None
            state = fresh if old is None else changes.advance(old, fresh, told, keep).withColumn("_bucket", bucket)
            number = mark.first()["watermark"] if mark is not None and feed.sequence else None
            store.replace_parts(name, state, "_bucket", touched, note={"watermark": number})
            store.replace(waiting, rows.where(~shown))

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


#: What the kept buffer tells of one lane of a slot: its instants in order, for a version, or how many events came too late.
SLOT = "period date, slot long, lane int, version string, released boolean, t array<long>, n array<long>, lo array<string>, hi array<string>, too_late long"
_STATE = "ids array<string>, times array<long>, arrivals array<long>, released boolean, too_late long"


def sorted_instants(events: Iterable[tuple[int, str]]) -> tuple[list[int], list[int], list[str], list[str]]:
    """Events as (microseconds, id), sorted and merged by instant: times, counts, least and greatest ids."""
    t, n, lo, hi = [], [], [], []
    for at, id in sorted(events):
        if t and t[-1] == at:
            n[-1] += 1
            hi[-1] = id
        else:
            t.append(at)
            n.append(1)
            lo.append(id)
            hi.append(id)
    return t, n, lo, hi


def kslack(stream: DataFrame, closed: DataFrame, *, id: str, event_time: str, arrival: str, bound_hours: int, delay: str, slot_seconds: int = 60, lanes: int = 1) -> DataFrame:
    """K-slack over a stream of deliveries: rows of ``SLOT``, a snapshot with every change and one at the release.

    closed: (period, closed_at), as from ``lateness.closings``. The clock is the arrival time, which
    may be out of order by ``delay``. An event waits in the buffer of its slot until its period's
    closing plus the bound has passed by that clock. Meanwhile each change publishes the slot's
    instants as they were at the closing (provisional) and as they are now (final, not released);
    the release publishes them for good, and events that come afterwards, or arrived after the
    bound, only count as too late. Of repeated deliveries the earliest arrival counts. A slot's
    buffer is spread over ``lanes`` by a hash of the id, so that a burst is several states; slots and
    lanes merge in ``slack_values``. The ids of a released slot stay, to tell repeats from late events.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    rows = stream.where(F.col(id).isNotNull() & F.col(event_time).isNotNull() & F.col(arrival).isNotNull())
    rows = rows.select(F.col(id).alias("id"), micros(event_time).alias("t"), micros(arrival).alias("a"), F.col(arrival).cast("timestamp").alias("at"), F.to_date(event_time).alias("period"))
    until = broadcast_if(closed.select("period", F.unix_micros(F.col("closed_at").cast("timestamp")).alias("until")))
    slotted = rows.withWatermark("at", delay).join(until, "period").withColumn("slot", F.floor(F.col("t") / F.lit(slot_seconds * 1_000_000))).withColumn("lane", F.pmod(F.xxhash64("id"), F.lit(lanes)).cast("int"))
    bound = bound_hours * 3_600_000_000

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        period, slot, lane, until = key[0], int(key[1]), int(key[2]), int(key[3])
        ids, times, arrivals, gone, missed = state.get if state.exists else ([], [], [], False, 0)
        held = {i: (a, t) for i, t, a in zip(ids, times, arrivals)}
        passed = state.hasTimedOut or state.getCurrentWatermarkMs() * 1000 >= until + bound
        if not state.hasTimedOut:
            for p in parts:
                for i, t, a in zip(p["id"].tolist(), p["t"].tolist(), p["a"].tolist()):
                    if gone:
                        missed += i not in held
                        held.setdefault(i, (a, t))
                    else:
                        held[i] = min(held.get(i, (a, t)), (a, t))

        def snapshot(version: str, last: int, done: bool) -> tuple:
            return (period, slot, lane, version, done, *sorted_instants((t, i) for i, (a, t) in held.items() if a <= last), None)

        out = []
        if not gone:
            out = [snapshot("provisional", until, passed), snapshot("final", until + bound, passed)]
            missed = sum(a > until + bound for a, _ in held.values())
        out.append((period, slot, lane, "too_late", passed, [], [], [], [], missed))
        state.update((list(held), [t for _, t in held.values()], [a for a, _ in held.values()], gone or passed, int(missed)))
        if not passed:
            state.setTimeoutTimestamp((until + bound) // 1000)
        yield pd.DataFrame(out, columns=["period", "slot", "lane", "version", "released", "t", "n", "lo", "hi", "too_late"])

    return slotted.groupBy("period", "slot", "lane", "until").applyInPandasWithState(step, SLOT, _STATE, "append", GroupStateTimeout.EventTimeTimeout)


def slack_values(spark: SparkSession, path: str, slot_seconds: int = 60) -> DataFrame:
    """``lateness.side_by_side`` of every period in a log of ``kslack`` rows: of each slot's lanes the latest, merged in order."""
    log = spark.read.schema(SLOT + ", batch_id int").parquet(path)
    last = log.groupBy("period", "slot", "lane", "version").agg(F.max_by(F.struct("t", "n", "lo", "hi", "too_late"), F.struct("batch_id", "released")).alias("x")).select("period", "version", "x.*")
    each = last.where("version <> 'too_late'").select("period", "version", F.inline(F.arrays_zip("t", "n", "lo", "hi")))
    merged = each.groupBy("period", "version", "t").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    too_late = last.where("version = 'too_late' AND too_late > 0").groupBy("period").agg(F.sum("too_late").alias("too_late"))
    return lateness.side_by_side(lateness.values_of(merged, slot_seconds), too_late)
