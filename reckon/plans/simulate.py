"""A simulated run: movements, the events that announce them, and what a processor would report.

Every draw is a hash of seed, row and purpose, so a run is made in parallel and comes out the same on
any cluster. All data is invented and says so. Fees and shares are parameters of the simulation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reckon.functions.money import half_up, settled
from reckon.schemas import FEE_DETAILS

DAY = 86_400


@dataclass(frozen=True)
class Run:
    """What fully determines a run. Shares in percent, fees in minor units, start in epoch seconds."""

    seed: int
    charges: int
    days: int
    start: int = 1_780_272_000
    refunded: int = 8
    disputed: int = 4
    lost: int = 60
    fee_bp: int = 150
    fee_fixed: int = 25
    dispute_fee: int = 2_460


def draw(run: Run, purpose: str, below: int) -> Column:
    """An integer from 0 on, below a bound, for the row's ``id``."""
    return F.pmod(F.xxhash64(F.lit(run.seed), "id", F.lit(purpose)), F.lit(below))


def _facts(spark: SparkSession, run: Run) -> DataFrame:
    """One row a charge with all that happens to it."""
    d = lambda p, n: draw(run, p, n)
    tier = d("tier", 100)
    amount = F.when(tier < 55, 199 + d("amount", 4_801)).when(tier < 90, 5_000 + d("amount", 20_000)).otherwise(25_000 + d("amount", 375_000))
    kind = d("currency", 100)
    currency = F.when(kind < 60, "eur").when(kind < 85, "usd").otherwise("gbp")
    rate = F.when(kind < 60, 100).when(kind < 85, 86).otherwise(117)
    fate = d("fate", 100)
    rows = spark.range(run.charges).select("id", amount.alias("amount"), currency.alias("currency"), rate.alias("rate"), fate.alias("fate"), (F.lit(run.start) + d("time", run.days * DAY)).alias("at"), (d("lost", 100) < run.lost).alias("lost"))
    rows = rows.withColumn("eur", settled(F.col("amount"), F.col("rate")))
    return rows.select(
        "*", (F.col("fate") < run.refunded).alias("is_refunded"), ((F.col("fate") >= run.refunded) & (F.col("fate") < run.refunded + run.disputed)).alias("is_disputed"),
        (F.col("at") + DAY * (1 + d("refund", 5))).alias("refund_at"), (F.col("at") + DAY * (5 + d("dispute", 21))).alias("dispute_at"),
        (F.col("at") + DAY * (5 + d("dispute", 21)) + DAY * (3 + d("closed", 8))).alias("closed_at"),
    )


def _id(prefix: str) -> Column:
    return F.concat(F.lit(prefix), F.col("id"))


def _movements_of(run: Run) -> Column:
    """The movements that a charge causes, as an array; payloads carry seconds, not timestamps."""

    def m(id: str, source: str, kind: str, category: str, amount: Column, fee: Column, at: str) -> Column:
        return F.struct(
            _id(id).alias("id"), _id(source).alias("source"), F.lit(kind).alias("type"), F.lit(category).alias("reporting_category"), amount.alias("amount"), fee.alias("fee"), (amount - fee).alias("net"),
            F.lit("eur").alias("currency"), F.col(at).alias("created"), F.expr(f"({at} div {DAY} + 7) * {DAY}").alias("available_on"), F.lit("available").alias("status"),
        )

    none, eur = F.lit(0).cast("long"), F.col("eur")
    fee = half_up(eur * run.fee_bp, 10_000) + run.fee_fixed
    return F.array_compact(
        F.array(
            m("txn_c", "ch_s", "charge", "charge", eur, fee, "at"),
            F.when(F.col("is_refunded"), m("txn_r", "re_s", "refund", "refund", -eur, none, "refund_at")),
            F.when(F.col("is_disputed"), m("txn_d", "du_s", "adjustment", "dispute", -eur, F.lit(run.dispute_fee).cast("long"), "dispute_at")),
            F.when(F.col("is_disputed") & ~F.col("lost"), m("txn_v", "du_s", "adjustment", "dispute_reversal", eur, none, "closed_at")),
        )
    )


def movements(spark: SparkSession, run: Run) -> DataFrame:
    """The processor's list, in the columns of the movement list."""
    rows = _facts(spark, run).select(F.explode(_movements_of(run)).alias("m"))
    at = lambda c: F.col(f"m.{c}").cast("timestamp")
    return rows.select(
        F.col("m.id").alias("balance_transaction_id"), F.col("m.source").alias("source_id"), "m.type", "m.reporting_category", "m.amount", "m.fee", "m.net", "m.currency",
        at("created").alias("created"), at("available_on").alias("available_on"), "m.status", F.lit("simulated").alias("description"), F.lit(None).cast(FEE_DETAILS).alias("fee_details"),
        F.to_json("m").alias("payload"), at("created").alias("loaded_at"),
    )


def event_lines(spark: SparkSession, run: Run) -> DataFrame:
    """(position, line): four events of each charge, refund and dispute, in order of time."""
    every = _movements_of(run)
    of = lambda category: F.filter(every, lambda m: m["reporting_category"].isin(category))

    def event(no: str, kind: str, at: Column, obj: Column) -> Column:
        body = F.struct(_id(f"evt_{no}").alias("id"), F.lit("event").alias("object"), F.lit(kind).alias("type"), at.alias("created"), F.lit(False).alias("livemode"), F.lit("simulated").alias("api_version"), F.struct(_id(f"req_{no}").alias("id")).alias("request"), F.struct(obj.alias("object")).alias("data"))
        return F.struct(at.alias("at"), F.concat(F.lit(no), "id").alias("no"), F.to_json(body).alias("line"))

    common = [F.col("amount").alias("amount"), F.col("currency").alias("currency")]
    intent = lambda s: F.struct(_id("pi_s").alias("id"), F.lit("payment_intent").alias("object"), *common, F.lit(s).alias("status"), F.col("at").alias("created"))
    charge = lambda txn: F.struct(_id("ch_s").alias("id"), F.lit("charge").alias("object"), *common, F.lit("succeeded").alias("status"), _id("pi_s").alias("payment_intent"), txn.alias("balance_transaction"), F.col("at").alias("created"))
    refund = F.struct(_id("re_s").alias("id"), F.lit("refund").alias("object"), *common, F.lit("succeeded").alias("status"), _id("ch_s").alias("charge"), _id("txn_r").alias("balance_transaction"), F.col("refund_at").alias("created"))
    dispute = lambda s, moved: F.struct(_id("du_s").alias("id"), F.lit("dispute").alias("object"), *common, F.lit(s).alias("status") if isinstance(s, str) else s.alias("status"), _id("ch_s").alias("charge"), F.col("dispute_at").alias("created"), moved.alias("balance_transactions"))
    at, ra, da, ca = (F.col(c) for c in ("at", "refund_at", "dispute_at", "closed_at"))
    lines = [
        event("a", "payment_intent.created", at, intent("requires_payment_method")), event("b", "charge.succeeded", at, charge(F.lit(None).cast("string"))),
        event("c", "charge.updated", at + 1, charge(_id("txn_c"))), event("d", "payment_intent.succeeded", at + 1, intent("succeeded")),
    ]
    refunds = [event("e", "refund.created", ra, refund), event("f", "charge.refunded", ra, charge(_id("txn_c"))), event("g", "refund.updated", ra + 1, refund), event("h", "charge.refund.updated", ra + 1, refund)]
    disputes = [
        event("i", "charge.dispute.created", da, dispute("needs_response", of([]))), event("j", "charge.dispute.funds_withdrawn", da + 1, dispute("needs_response", of(["dispute"]))),
        event("k", "charge.dispute.updated", da + 2, dispute("under_review", of(["dispute"]))),
        event("l", "charge.dispute.closed", ca, dispute(F.when(F.col("lost"), "lost").otherwise("won"), of(["dispute", "dispute_reversal"]))),
    ]
    every_event = F.array_compact(F.array(*lines, *[F.when(F.col("is_refunded"), e) for e in refunds], *[F.when(F.col("is_disputed"), e) for e in disputes]))
    rows = _facts(spark, run).select(F.explode(every_event).alias("e")).select("e.*")
    # A position orders events by time and names them: a digest as fraction keeps equal times apart.
    place = F.col("at") + F.pmod(F.xxhash64("no"), F.lit(4_000_037)) / 4_000_037.0
    return rows.select(place.alias("position"), "line")


def reported(moved: DataFrame) -> DataFrame:
    """What the processor would report of movements at the end of each day, by code apart from the ledger's.

    Pending holds what is created but not yet available, available the rest. Days run without gaps
    from the first creation to the last availability.
    """
    spark = moved.sparkSession
    moved.createOrReplaceTempView("reckon_reported_movements")
    return spark.sql("""
        WITH steps AS (
          SELECT currency, step.day, sum(step.p) AS p, sum(step.a) AS a FROM (
            SELECT currency, explode(array(struct(to_date(created) AS day, net AS p, 0L AS a), struct(to_date(available_on) AS day, -net AS p, net AS a))) AS step FROM reckon_reported_movements)
          GROUP BY currency, step.day
        ), days AS (SELECT currency, explode(sequence(min(day), max(day))) AS day FROM steps GROUP BY currency)
        SELECT d.day AS as_of_date, d.currency, sum(coalesce(s.p, 0L)) OVER w AS pending, sum(coalesce(s.a, 0L)) OVER w AS available
        FROM days d LEFT JOIN steps s ON s.currency = d.currency AND s.day = d.day
        WINDOW w AS (PARTITION BY d.currency ORDER BY d.day ROWS UNBOUNDED PRECEDING)""")


def balance_lines(run: Run, balances: DataFrame) -> DataFrame:
    """(position, line): a ``balance.available`` event for each reported row, at the midnight its day begins."""
    at = F.unix_timestamp(F.col("as_of_date").cast("timestamp"))
    of = lambda c: F.array(F.struct(F.col(c).alias("amount"), F.col("currency").alias("currency"), F.struct(F.col(c).alias("card")).alias("source_types")))
    no = F.concat(F.lit("bal_"), F.date_format("as_of_date", "yyyyMMdd"), F.col("currency"))
    obj = F.struct(F.lit("balance").alias("object"), of("available").alias("available"), of("pending").alias("pending"), F.lit(False).alias("livemode"))
    body = F.struct(F.concat(F.lit("evt_"), no).alias("id"), F.lit("event").alias("object"), F.lit("balance.available").alias("type"), at.alias("created"), F.lit(False).alias("livemode"), F.lit("simulated").alias("api_version"), F.struct(F.concat(F.lit("req_"), no).alias("id")).alias("request"), F.struct(obj.alias("object")).alias("data"))
    return balances.select((at + F.pmod(F.xxhash64(F.lit(run.seed), no), F.lit(4_000_037)) / 4_000_037.0).alias("position"), F.to_json(body).alias("line"))


def stream_lines(spark: SparkSession, run: Run, balances: DataFrame) -> DataFrame:
    """(position, line): the whole stream of a run, four events a charge, refund and dispute and one a reported row."""
    return event_lines(spark, run).unionByName(balance_lines(run, balances))
