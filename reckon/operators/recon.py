"""Weighing the ledger against the reported balances, with zero tolerance, and what explains a gap."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reckon.operators.scale import broadcast_if
from reckon.schemas import ANNOUNCED

# The two kinds of coverage gaps.
UNANNOUNCED = "source_missing_from_the_stream"
UNLISTED = "transaction_missing_from_the_list"


def unposted_net(movements: DataFrame, posted: DataFrame) -> DataFrame:
    """(close_date, currency, net) of movements without any posting, by their day of creation."""
    missing = movements.join(posted.select("balance_transaction_id").distinct(), "balance_transaction_id", "left_anti")
    return missing.groupBy(F.to_date("created").alias("close_date"), "currency").agg(F.sum("net").alias("net"))


def reconciliation(closed: DataFrame, reported: DataFrame, movements: DataFrame, posted: DataFrame) -> DataFrame:
    """Every day that either side knows, both balances, their difference and what it leaves unexplained.

    A side without the day counts as 0 and says so in its flag. ``unexplained_difference`` adds the
    net of movements never posted up to the day; ``unexplained_movement`` is its change since the
    currency's row before.
    """
    on = ["close_date", "currency"]
    ledger = closed.select(*on, F.col("balance_pending").alias("lp"), F.col("balance_available").alias("la"), F.lit(True).alias("hl"))
    theirs = reported.select(F.col("as_of_date").alias("close_date"), "currency", F.col("pending").alias("rp"), F.col("available").alias("ra"), F.lit(True).alias("hr"))
    days = ledger.join(theirs, on, "full_outer").join(unposted_net(movements, posted), on, "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    w = Window.partitionBy("currency").orderBy("close_date")
    rows = days.select(
        *on, zero("lp").alias("ledger_pending"), zero("la").alias("ledger_available"), (zero("lp") + zero("la")).alias("ledger_total"),
        zero("rp").alias("reported_pending"), zero("ra").alias("reported_available"), (zero("rp") + zero("ra")).alias("reported_total"),
        F.col("hl").isNotNull().alias("ledger_closed_the_day"), F.col("hr").isNotNull().alias("processor_reported_the_day"),
        F.sum(zero("net")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("unposted_net"),
    )
    diff = rows.select(
        "*", (F.col("ledger_pending") - F.col("reported_pending")).alias("pending_difference"), (F.col("ledger_available") - F.col("reported_available")).alias("available_difference"),
        (F.col("ledger_total") - F.col("reported_total")).alias("total_difference"), (F.col("ledger_total") - F.col("reported_total") + F.col("unposted_net")).alias("unexplained_difference"),
    )
    return diff.select("*", (F.col("unexplained_difference") - F.lag("unexplained_difference", 1, 0).over(w)).alias("unexplained_movement"))


def items(weighed: DataFrame, movements: DataFrame, posted: DataFrame) -> DataFrame:
    """The movements that touched a day whose unexplained difference changed, with their postings.

    A movement touches the days it is created and available on; exploding these (one row if they
    are the same day) makes the join an equi-join on day and currency.
    """
    moved = broadcast_if(weighed.where("unexplained_movement <> 0").select("close_date", "currency", "unexplained_difference", "unexplained_movement"))
    days = F.array_distinct(F.array_compact(F.array(F.to_date("created"), F.to_date("available_on"))))
    touched = movements.select("balance_transaction_id", "source_id", "reporting_category", "net", "currency", F.to_date("created").alias("born"), F.explode(days).alias("close_date")).join(moved, ["close_date", "currency"])
    counted = posted.groupBy("balance_transaction_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("entry_id").alias("e"))
    rows = touched.join(counted, "balance_transaction_id", "left")
    entries = F.coalesce("e", F.lit(0))
    return rows.select(
        "close_date", "currency", "unexplained_difference", "unexplained_movement", "balance_transaction_id", "source_id", "reporting_category", "net",
        F.when(F.col("born") == F.col("close_date"), "created").otherwise("matured").alias("touched_the_day_by"), F.coalesce("n", F.lit(0)).alias("postings"), entries.alias("entries"),
        (entries != 2).alias("posting_count_is_wrong"), (F.col("net") == F.col("unexplained_movement")).alias("net_matches_the_movement"),
    )


def coverage_gaps(movements: DataFrame, events: DataFrame, expanded: DataFrame) -> DataFrame:
    """Movements whose source the stream never named, and embedded movements the list doesn't have."""
    listed = movements.where(F.col("reporting_category").isin(ANNOUNCED))
    named = events.where(F.col("entity_type").isin("charge", "refund", "dispute") & F.col("entity_id").isNotNull()).select(F.col("entity_id").alias("source_id")).distinct()
    cols = lambda df, finding: df.select(F.lit(finding).alias("finding"), "balance_transaction_id", "source_id", "reporting_category", "net", "currency", F.to_date("created").alias("noticed_on"))
    unannounced = cols(listed.join(named, "source_id", "left_anti"), UNANNOUNCED)
    unlisted = cols(expanded.join(listed.select("balance_transaction_id").distinct(), "balance_transaction_id", "left_anti"), UNLISTED)
    return unannounced.unionByName(unlisted)


def cross_check(expanded: DataFrame, movements: DataFrame) -> DataFrame:
    """One row: embedded movements, those the list has, and those that agree in amount, fee and net."""
    m = movements.groupBy("balance_transaction_id").agg(F.max(F.struct("amount", "fee", "net")).alias("m"))
    rows = expanded.join(m, "balance_transaction_id", "left")
    same = (F.col("m.amount") == F.col("amount")) & (F.col("m.fee") == F.col("fee")) & (F.col("m.net") == F.col("net"))
    return rows.agg(F.count(F.lit(1)).alias("embedded"), F.count("m").alias("listed"), F.coalesce(F.sum(same.cast("long")), F.lit(0)).alias("agreeing"))
