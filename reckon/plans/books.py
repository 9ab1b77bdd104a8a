"""Queries of the engine's own operators over the domain tables, whole, each with SQL beside it."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reckon.functions import money, privacy
from reckon.operators import checks, close, entities, events, ledger, recon, upsert
from reckon.operators.scale import broadcast_if, materialize, scratch_folder
from reckon.plans import build, report
from reckon.schemas import LIST_COLUMNS
from reckon.sources import landing
from reckon.sources.tables import table
from reckon.streaming import feeds

T = table


def _bronze(spark: SparkSession, sf: str) -> DataFrame:
    return T(spark, sf, "bronze_events")


def _list(spark: SparkSession, sf: str) -> DataFrame:
    return T(spark, sf, "balance_transaction_list")


def _posted(spark: SparkSession, sf: str) -> DataFrame:
    return T(spark, sf, "ledger_postings")


def _silver(spark: SparkSession, sf: str) -> DataFrame:
    return T(spark, sf, "silver_events")


def trial_balance(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.trial_balance(_posted(spark, sf))


def ledger_postings(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.postings(_list(spark, sf))


def money_flow(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.flow(_posted(spark, sf))


def daily_close(spark: SparkSession, sf: str) -> DataFrame:
    return close.daily_close(_posted(spark, sf))


def day_grid(spark: SparkSession, sf: str) -> DataFrame:
    return close.day_grid(_posted(spark, sf))


def close_log_latest_two(spark: SparkSession, sf: str) -> DataFrame:
    return close.last_two_closes(T(spark, sf, "daily_close_log"))


def restatements(spark: SparkSession, sf: str) -> DataFrame:
    """What each closing run restated of the run before."""
    return close.restatements(T(spark, sf, "daily_close_log"), _list(spark, sf), all_runs=True)


def restatement_causes(spark: SparkSession, sf: str) -> DataFrame:
    """The late movements on the days that runs restated, a row each."""
    log, listed = T(spark, sf, "daily_close_log"), _list(spark, sf)
    return close.restatement_causes(close.restatements(log, listed, all_runs=True), log, listed, all_runs=True)


def _lost(df: DataFrame, column: str) -> DataFrame:
    """A damaged table: about a sixteenth of what the column names is lost, as the digest of the name decides."""
    return df.where(F.col(column).isNull() | ~F.md5(column).startswith("0"))


def _both(as_they_are: DataFrame, damaged: DataFrame) -> DataFrame:
    """A finding over the tables as they are and over damaged ones, which it must show."""
    return as_they_are.withColumn("tables", F.lit("as they are")).unionByName(damaged.withColumn("tables", F.lit("damaged")))


def _weighed(spark: SparkSession, sf: str) -> DataFrame:
    return recon.reconciliation(T(spark, sf, "daily_close"), T(spark, sf, "reported_balance"), _list(spark, sf), _posted(spark, sf))


def reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    return _weighed(spark, sf)


def reconciliation_items(spark: SparkSession, sf: str) -> DataFrame:
    return recon.items(_weighed(spark, sf), _list(spark, sf), _posted(spark, sf))


def unposted_net(spark: SparkSession, sf: str) -> DataFrame:
    return _both(recon.unposted_net(_list(spark, sf), _posted(spark, sf)), recon.unposted_net(_list(spark, sf), _lost(_posted(spark, sf), "balance_transaction_id")))


def reconciliation_after_loss(spark: SparkSession, sf: str) -> DataFrame:
    """The reconciliation where postings of some movements are lost: their net explains the gap they leave."""
    posted = _lost(_posted(spark, sf), "balance_transaction_id")
    return recon.reconciliation(T(spark, sf, "daily_close"), T(spark, sf, "reported_balance"), _list(spark, sf), posted)


def typed_deliveries(spark: SparkSession, sf: str) -> DataFrame:
    return events.typed(_bronze(spark, sf)).drop("payload")


def dedup_collapse(spark: SparkSession, sf: str) -> DataFrame:
    cols = ["event_id", "event_type", "created", "livemode", *events.COORDINATE, "kafka_timestamp"]
    return events.collapse(_bronze(spark, sf).select(*cols))


def dedup_upsert_two_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches by day of arrival, the second merged into the first."""
    rows = _bronze(spark, sf).select("event_id", "event_type", "created", *events.COORDINATE, "kafka_timestamp", F.dayofmonth("ingested_at").alias("d"))
    first, second = (events.collapse(rows.where(c).drop("d")) for c in ("d <= 15", "d > 15"))
    return events.merge_events(first, second)


def partition_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Deliveries by the key that their payload gives."""
    keyed = _bronze(spark, sf).where(F.col("event_id").isNotNull()).select(events.partition_key("payload").alias("key"))
    return keyed.groupBy("key").agg(F.count(F.lit(1)).alias("deliveries"))


def quarantined(spark: SparkSession, sf: str) -> DataFrame:
    return events.quarantined(_bronze(spark, sf)).select("kafka_partition", "kafka_offset", "kafka_timestamp", "payload")


def redacted_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Payloads as they may be shown, with keys blanked; a live one would stop the query. Of what must not be published nothing is left."""
    rows = _bronze(spark, sf).where(F.col("event_id").isNotNull())
    return rows.select("event_id", privacy.redacted("payload", ["idempotency_key", "email", "name"]).alias("payload")).select("*", F.size(privacy.leaks("payload")).alias("leaks"))


def charges(spark: SparkSession, sf: str) -> DataFrame:
    return entities.charges(_silver(spark, sf))


def refunds(spark: SparkSession, sf: str) -> DataFrame:
    return entities.refunds(_silver(spark, sf))


def disputes(spark: SparkSession, sf: str) -> DataFrame:
    return entities.disputes(_silver(spark, sf))


def _expanded(spark: SparkSession, sf: str) -> DataFrame:
    # Of the payloads only those of each dispute's last event are looked at, whatever their type.
    last = broadcast_if(entities.latest(_silver(spark, sf), "dispute", []).select("event_id"))
    about = _bronze(spark, sf).select("event_id", "payload", *events.COORDINATE, "kafka_timestamp").join(last, "event_id", "left_semi")
    payloads = events.collapse(about).select("event_id", "payload")
    return entities.expanded_movements(_silver(spark, sf), payloads)


def expanded_movements(spark: SparkSession, sf: str) -> DataFrame:
    """Embedded movements of the latest dispute events."""
    return _expanded(spark, sf).withColumns({c: F.unix_timestamp(c) for c in ("created", "available_on")})


def coverage_gaps(spark: SparkSession, sf: str) -> DataFrame:
    expanded = materialize(_expanded(spark, sf))
    listed, silver = _list(spark, sf), _silver(spark, sf)
    return _both(recon.coverage_gaps(listed, silver, expanded), recon.coverage_gaps(_lost(listed, "balance_transaction_id"), _lost(silver, "entity_id"), expanded))


def cross_check_agreement(spark: SparkSession, sf: str) -> DataFrame:
    return recon.cross_check(_expanded(spark, sf), _list(spark, sf))


def disputes_after_their_charge(spark: SparkSession, sf: str) -> DataFrame:
    d, c = disputes(spark, sf).alias("d"), charges(spark, sf).alias("c")
    late = d.join(c, "charge_id").where("d.created > c.created")
    return late.select("dispute_id", "charge_id", F.col("d.created").alias("disputed_at"), F.col("c.created").alias("charged_at"))


def event_type_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _bronze(spark, sf).groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "event_type")


def distinct_events(spark: SparkSession, sf: str) -> DataFrame:
    return _bronze(spark, sf).agg(F.count(F.lit(1)).alias("deliveries"), F.count_distinct("event_id").alias("events"))


def category_totals(spark: SparkSession, sf: str) -> DataFrame:
    return _list(spark, sf).groupBy("reporting_category").agg(F.count(F.lit(1)).alias("movements"), F.sum("net").alias("net")).orderBy("reporting_category")


def date_checksum(spark: SparkSession, sf: str) -> DataFrame:
    """Sum of the charges' dates in seconds: a re-dated row changes it."""
    return charges(spark, sf).agg(F.sum(F.unix_timestamp("created")).alias("checksum"))


def latest_reported(spark: SparkSession, sf: str) -> DataFrame:
    """The reported balances of the last day."""
    r = T(spark, sf, "reported_balance")
    last = r.agg(F.max("as_of_date").alias("m"))
    return r.where(F.col("as_of_date") == last.scalar()).select("as_of_date", "currency", "pending", "available").orderBy("currency")


def movement_list_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Movements loaded in the first half of a month, refreshed by a list that settles them all again."""
    once = _list(spark, sf).groupBy("balance_transaction_id").agg(F.min(F.struct(*[c for c in LIST_COLUMNS if c != "balance_transaction_id"])).alias("m")).select("balance_transaction_id", "m.*")
    stored = once.where(F.dayofmonth("loaded_at") <= 15)
    incoming = once.withColumns({"status": F.lit("settled"), "description": F.lit(None).cast("string"), "loaded_at": F.lit("2027-01-01 00:00:00").cast("timestamp_ntz")})
    return upsert.refresh_list(stored, incoming).select("balance_transaction_id", "status", "description", "net", "loaded_at")


def reported_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Reported balances with the rows of even days replaced by a later report that is one unit higher."""
    r = T(spark, sf, "reported_balance").select("as_of_date", "currency", "pending", "available")
    later = r.where(F.dayofmonth("as_of_date") % 2 == 0).withColumn("pending", F.col("pending") + 1)
    return upsert.replace_rows(r, later, ["as_of_date", "currency"])


def half_up_settlement(spark: SparkSession, sf: str) -> DataFrame:
    """Every movement's net at 86 hundredths, and the midnight a week after it was made."""
    m = _list(spark, sf)
    return m.select("balance_transaction_id", money.settled(F.col("net"), 86).alias("settled"), F.to_date(money.midnight_after(F.col("created"), 7)).alias("due_on"))


def entries_balance_check(spark: SparkSession, sf: str) -> DataFrame:
    return checks.entries_balance(_posted(spark, sf))


def every_movement_posted_check(spark: SparkSession, sf: str) -> DataFrame:
    listed, posted = _list(spark, sf), _posted(spark, sf)
    return _both(checks.every_movement_posted(listed, posted), checks.every_movement_posted(listed, _lost(posted, "balance_transaction_id")))


def available_explained_check(spark: SparkSession, sf: str) -> DataFrame:
    closed = T(spark, sf, "daily_close")
    return _both(checks.available_explained(closed), checks.available_explained(closed.withColumn("balance_available", -F.abs("balance_available") - 1)))


def unexplained_difference_check(spark: SparkSession, sf: str) -> DataFrame:
    return checks.nothing_unexplained(_weighed(spark, sf))


def same_days_check(spark: SparkSession, sf: str) -> DataFrame:
    return checks.same_days_closed(_weighed(spark, sf))


def close_uniqueness_check(spark: SparkSession, sf: str) -> DataFrame:
    closed = T(spark, sf, "daily_close")
    twice = closed.unionByName(closed.where(F.dayofmonth("close_date") % 2 == 0))
    return _both(*[checks.unique(c, ["close_date", "currency"]) for c in (closed, twice)])


def one_source_check(spark: SparkSession, sf: str) -> DataFrame:
    return checks.one_source_leg(_posted(spark, sf))


def flow_conservation_check(spark: SparkSession, sf: str) -> DataFrame:
    return checks.flow_conserves(money_flow(spark, sf), trial_balance(spark, sf))


def restatement_explained_check(spark: SparkSession, sf: str) -> DataFrame:
    """Restated days without a cause, also where no movement says when it was loaded."""
    log, listed = T(spark, sf, "daily_close_log"), _list(spark, sf)
    undated = listed.withColumn("loaded_at", F.lit(None).cast(listed.schema["loaded_at"].dataType))
    return _both(*[checks.restatement_explained(close.restatements(log, m, all_runs=True)) for m in (listed, undated)])


def list_complete_check(spark: SparkSession, sf: str) -> DataFrame:
    return checks.gaps_of(coverage_gaps(spark, sf), recon.UNLISTED)


def stream_complete_check(spark: SparkSession, sf: str) -> DataFrame:
    return checks.gaps_of(coverage_gaps(spark, sf), recon.UNANNOUNCED)


def column_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Every column check of the build over the domain tables and what is made of them: (dataset, check, column_name, violations)."""
    log, listed, posted = T(spark, sf, "daily_close_log"), _list(spark, sf), _posted(spark, sf)
    silver, expanded = _silver(spark, sf), materialize(_expanded(spark, sf))
    weighed = materialize(_weighed(spark, sf))
    frames = {
        "list": listed, "reported": T(spark, sf, "reported_balance"), "expanded": expanded, "postings": posted, "balances": ledger.trial_balance(posted), "daily_close": T(spark, sf, "daily_close"),
        "reconciliation": weighed, "money_flow": ledger.flow(posted), "close_log": log, "restatements": close.restatements(log, listed, all_runs=True),
        "coverage_gaps": recon.coverage_gaps(listed, silver, expanded), "reconciliation_items": recon.items(weighed, listed, posted),
    }
    found = [build.column_check(name)(df).withColumn("dataset", F.lit(name)) for name, df in frames.items()]
    return functools.reduce(DataFrame.unionByName, found)


def measurement_report(spark: SparkSession, sf: str) -> DataFrame:
    """All measurements over the domain tables."""
    expanded, weighed = materialize(_expanded(spark, sf)), materialize(_weighed(spark, sf))
    silver, listed, log = _silver(spark, sf), _list(spark, sf), T(spark, sf, "daily_close_log")
    frames = {
        "bronze": _bronze(spark, sf), "events": silver, "charges": entities.charges(silver), "refunds": entities.refunds(silver), "disputes": entities.disputes(silver),
        "expanded": expanded, "list": listed, "reported": T(spark, sf, "reported_balance"), "postings": _posted(spark, sf), "daily_close": T(spark, sf, "daily_close"),
        "reconciliation": weighed, "reconciliation_items": recon.items(weighed, listed, _posted(spark, sf)), "coverage_gaps": recon.coverage_gaps(listed, silver, expanded),
        "restatements": close.restatements(log, listed), "close_log": log,
    }
    return report.measurements(frames)


def streaming_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """The deliveries streamed into a replay-safe log, and the event table as a function of that log."""
    cols = ["event_id", "event_type", "created", "livemode", *events.COORDINATE, "kafka_timestamp"]
    root = f"{scratch_folder(spark)}/{uuid.uuid4().hex}"
    stream = landing.table_stream(spark, f"{sf}/bronze_events.parquet", _bronze(spark, sf).schema).select(*cols)
    feeds.log_batches(stream, f"{root}/log", f"{root}/offsets").awaitTermination()
    return feeds.collapsed_log(spark, f"{root}/log")


QUERIES = {
    f.__name__: f
    for f in (
        trial_balance, ledger_postings, money_flow, daily_close, day_grid, close_log_latest_two, restatements, restatement_causes, reconciliation, reconciliation_after_loss, reconciliation_items, unposted_net,
        typed_deliveries, dedup_collapse, dedup_upsert_two_batches, partition_keys, quarantined, redacted_payloads, charges, refunds, disputes, expanded_movements, coverage_gaps,
        cross_check_agreement, disputes_after_their_charge, event_type_counts, distinct_events, category_totals, date_checksum, latest_reported,
        movement_list_refresh, reported_upsert, half_up_settlement, entries_balance_check, every_movement_posted_check, available_explained_check,
        unexplained_difference_check, same_days_check, close_uniqueness_check, one_source_check, flow_conservation_check, restatement_explained_check,
        list_complete_check, stream_complete_check, column_checks, measurement_report, streaming_dedup,
    )
}
