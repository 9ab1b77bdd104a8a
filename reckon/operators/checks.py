"""Invariants. Each gives the rows that violate it; an empty result passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def entries_balance(posted: DataFrame) -> DataFrame:
    """Entries whose postings don't sum to zero in a currency."""
    return posted.groupBy("entry_id", "currency").agg(F.sum("amount").alias("off_by"), F.count(F.lit(1)).alias("postings")).where("off_by <> 0")


def every_movement_posted(movements: DataFrame, posted: DataFrame) -> DataFrame:
    """Movements without any posting."""
    return movements.select("balance_transaction_id", "reporting_category", "net").join(posted.select("balance_transaction_id").distinct(), "balance_transaction_id", "left_anti")


def available_explained(closed: DataFrame) -> DataFrame:
    """Days on which the available balance is negative though nothing was refunded or disputed so far."""
    return closed.where("balance_available < 0 AND disputes_to_date = 0 AND refunds_to_date = 0").select("close_date", "currency", "balance_available", "disputes_to_date", "refunds_to_date")


def nothing_unexplained(weighed: DataFrame) -> DataFrame:
    """Days with an unexplained difference of any size."""
    return weighed.where("unexplained_difference <> 0").select("close_date", "currency", "ledger_total", "reported_total", "unposted_net", "unexplained_difference")


def same_days_closed(weighed: DataFrame) -> DataFrame:
    """Days that only one side knows."""
    return weighed.where("NOT ledger_closed_the_day OR NOT processor_reported_the_day").select("close_date", "currency", "ledger_closed_the_day", "processor_reported_the_day")


def unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; NULL keys count as values."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).where("occurrences > 1")


def one_source_leg(posted: DataFrame) -> DataFrame:
    """Entries with more than one leg that takes money."""
    return posted.where("amount < 0").groupBy("entry_id", "currency").agg(F.count(F.lit(1)).alias("source_legs")).where("source_legs > 1")


def flow_conserves(flow: DataFrame, balances: DataFrame) -> DataFrame:
    """Accounts whose flow in less flow out isn't their balance."""
    legs = flow.select(F.col("target").alias("account"), "currency", "amount").unionByName(flow.select(F.col("source").alias("account"), "currency", (-F.col("amount")).alias("amount")))
    net = legs.groupBy("account", "currency").agg(F.sum("amount").alias("net_flow"))
    both = net.join(balances.select("account", "currency", "balance"), ["account", "currency"], "full_outer")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return both.select("account", "currency", zero("net_flow"), zero("balance")).where("net_flow <> balance")


def restatement_explained(restated: DataFrame) -> DataFrame:
    """Restated days that late movements don't fully explain."""
    return restated.where("NOT fully_explained_by_what_arrived_late").select("close_date", "currency", "pending_movement", "late_pending_effect", "available_movement", "late_available_effect")


def gaps_of(gaps: DataFrame, finding: str) -> DataFrame:
    """Coverage gaps of one kind."""
    return gaps.where(F.col("finding") == finding).drop("finding")


def columns(df: DataFrame, *, not_null: Sequence[str] = (), unique_columns: Sequence[str] = (), accepted: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """(check, column_name, violations) of every column check that fails, in one pass over the table.

    not_null: rows with NULL. accepted: rows whose value is neither NULL nor in the list. unique:
    values that occur more than once, NULL apart; each unique column costs an aggregate of its own.
    """
    counts = [("not_null", c, F.sum(F.col(c).isNull().cast("long"))) for c in not_null]
    counts += [("accepted_values", c, F.sum((~F.col(c).isin(list(v))).cast("long"))) for c, v in (accepted or {}).items()]
    parts = []
    if counts:
        one = df.agg(*[F.coalesce(x, F.lit(0)).alias(f"v{i}") for i, (_, _, x) in enumerate(counts)])
        parts.append(one.select(F.inline(F.array(*[F.struct(F.lit(k).alias("check"), F.lit(c).alias("column_name"), F.col(f"v{i}").alias("violations")) for i, (k, c, _) in enumerate(counts)]))))
    for c in unique_columns:
        repeated = unique(df.where(F.col(c).isNotNull()), [c])
        parts.append(repeated.agg(F.count(F.lit(1)).alias("violations")).select(F.lit("unique").alias("check"), F.lit(c).alias("column_name"), "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where("violations > 0")
