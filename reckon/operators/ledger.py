"""Double-entry postings from movements, the trial balance and the flow of money between accounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reckon.schemas import AVAILABLE, COUNTERPARTS, FEES, PENDING, SALES, UNCLASSIFIED


def postings(movements: DataFrame) -> DataFrame:
    """Two entries per movement, each summing to zero: recognition when created, availability when available.

    One pass: each movement becomes an array of legs. A movement without a category gets no
    counterpart leg, so that the balance check of its entry fails instead of the money going
    somewhere by default; an unknown category goes to the unclassified account, which no check accepts.
    """
    is_charge, other = F.col("reporting_category") == "charge", F.col("reporting_category") != "charge"
    counterpart = F.coalesce(*[F.when(F.col("reporting_category") == c, F.lit(a)) for c, a in COUNTERPARTS.items()], F.lit(UNCLASSIFIED))

    def leg(entry: str, account: Column, amount: Column, at: str, when: Column | None = None) -> Column:
        made = F.struct(F.lit(entry).alias("entry_type"), account.alias("account"), amount.alias("amount"), F.col(at).alias("posted_at"))
        return made if when is None else F.when(when, made)

    net = F.col("net")
    legs = F.array_compact(
        F.array(
            leg("recognition", F.lit(PENDING), net, "created"),
            leg("recognition", F.lit(FEES), F.col("fee"), "created", is_charge),
            leg("recognition", F.lit(SALES), -F.col("amount"), "created", is_charge),
            leg("recognition", counterpart, -net, "created", other),
            leg("availability", F.lit(PENDING), -net, "available_on"),
            leg("availability", F.lit(AVAILABLE), net, "available_on"),
        )
    )
    rows = movements.select("balance_transaction_id", "source_id", "reporting_category", "currency", F.inline(legs))
    entry_id = F.concat("balance_transaction_id", F.lit(":"), "entry_type")
    return rows.select(
        F.concat_ws("|", entry_id, "account").alias("posting_id"), entry_id.alias("entry_id"), "entry_type", "balance_transaction_id", "source_id", "reporting_category",
        "account", "amount", "currency", "posted_at", F.to_date("posted_at").alias("posted_on"),
    )


def trial_balance(posted: DataFrame) -> DataFrame:
    return posted.groupBy("account", "currency").agg(
        F.sum("amount").alias("balance"), F.count(F.lit(1)).alias("postings"), F.min("posted_on").alias("first_posting_on"), F.max("posted_on").alias("last_posting_on")
    )


def flow(posted: DataFrame) -> DataFrame:
    """Net flow of money between accounts: (source, target, currency, amount > 0).

    In an entry each leg that takes money pays every leg that receives it, once per taking leg.
    Legs first add up per entry and account, so an entry pairs at most as many rows as the chart
    has accounts, however often it was appended; flows both ways net out.
    """
    legs = posted.where("amount <> 0").groupBy("entry_id", "currency", "account").agg(F.sum((F.col("amount") < 0).cast("long")).alias("takes"), F.sum(F.greatest("amount", F.lit(0))).alias("gets"))
    entry = legs.groupBy("entry_id", "currency").agg(F.collect_list(F.when(F.col("takes") > 0, F.struct("account", "takes"))).alias("s"), F.collect_list(F.when(F.col("gets") > 0, F.struct("account", "gets"))).alias("u"))
    pairs = entry.select("currency", F.explode("s").alias("s"), "u").select("currency", "s", F.explode("u").alias("u"))
    paid = F.col("s.takes") * F.col("u.gets")
    low, high = F.least("s.account", "u.account"), F.greatest("s.account", "u.account")
    signed = F.when(F.col("s.account") < F.col("u.account"), paid).otherwise(-paid)
    netted = pairs.groupBy(low.alias("low"), high.alias("high"), "currency").agg(F.sum(signed).alias("x")).where("x <> 0")
    up = F.col("x") >= 0
    return netted.select(F.when(up, F.col("low")).otherwise(F.col("high")).alias("source"), F.when(up, F.col("high")).otherwise(F.col("low")).alias("target"), "currency", F.abs("x").alias("amount"))
