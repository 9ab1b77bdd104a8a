"""Daily closes on a dense calendar, their log, and the days that later runs restated."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reckon.operators.scale import broadcast_if, materialize
from reckon.schemas import AVAILABLE, BANK, DISPUTES, FEES, PENDING, REFUNDS, SALES

#: Figures of a day and the account and sign each adds up.
FIGURES = {
    "gross_sales": (SALES, -1), "refunds": (REFUNDS, 1), "processing_fees": (FEES, 1), "disputes": (DISPUTES, 1),
    "pending_movement": (PENDING, 1), "available_movement": (AVAILABLE, 1), "bank_movement": (BANK, 1),
}
#: Running sums and what each runs over.
RUNNING = {"balance_pending": "pending_movement", "balance_available": "available_movement", "balance_bank": "bank_movement", "disputes_to_date": "disputes", "refunds_to_date": "refunds"}
LOGGED = ["close_date", "currency", "balance_pending", "balance_available", "gross_sales", "refunds", "processing_fees", "disputes"]


def day_grid(posted: DataFrame) -> DataFrame:
    """Every currency on every day from the first to the last posting; empty without postings.

    Built from one aggregated row with the list of currencies, not from a cross join.
    """
    per = posted.groupBy("currency").agg(F.min("posted_on").alias("a"), F.max("posted_on").alias("b"))
    spine = per.agg(F.min("a").alias("a"), F.max("b").alias("b"), F.collect_set("currency").alias("c")).where("a IS NOT NULL")
    return spine.select(F.explode("c").alias("currency"), "a", "b").select(F.explode(F.sequence("a", "b")).alias("close_date"), "currency")


def _signed_sum(account: str, sign: int) -> Column:
    return F.sum(F.when(F.col("account") == account, F.col("amount") * sign).otherwise(0))


def daily_close(posted: DataFrame) -> DataFrame:
    """The figures and running balances of each day and currency. All running sums share one window."""
    sums = posted.groupBy(F.col("posted_on").alias("close_date"), "currency").agg(*[_signed_sum(a, s).alias(n) for n, (a, s) in FIGURES.items()])
    daily = day_grid(posted).join(sums, ["close_date", "currency"], "left").select("close_date", "currency", *[F.coalesce(n, F.lit(0)).alias(n) for n in FIGURES])
    so_far = Window.partitionBy("currency").orderBy("close_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.select("*", *[F.sum(over).over(so_far).alias(name) for name, over in RUNNING.items()])


def log_rows(closed: DataFrame, run_id: str, closed_at: datetime) -> DataFrame:
    """What a closing run appends to the log: all closed days under its id and time."""
    return closed.select(F.lit(run_id).alias("run_id"), F.lit(closed_at).alias("closed_at"), *LOGGED)


def logged(closed: DataFrame, before: DataFrame, run: DataFrame) -> DataFrame:
    """The closing log with this run's rows added: ``run`` is one row (run_id, closed_at)."""
    stamp = [run.select(c).scalar().alias(c) for c in ("run_id", "closed_at")]
    return before.select("run_id", "closed_at", *LOGGED).unionByName(closed.select(*stamp, *LOGGED))


def last_two_closes(log: DataFrame) -> DataFrame:
    """(closed_at, recency) of the two last runs: a top-2 of the distinct times, no global window."""
    two = log.select("closed_at").distinct().orderBy(F.desc("closed_at")).limit(2)
    last = two.agg(F.max("closed_at").alias("m"))
    return two.select("closed_at", F.when(F.col("closed_at") == last.scalar(), 1).otherwise(2).alias("recency"))


def adjacent_closes(log: DataFrame) -> DataFrame:
    """(closed_then, restated_at): every two closing runs that follow one another; as many as there are runs."""
    runs = log.select("closed_at").distinct()
    return runs.select(F.lag("closed_at").over(Window.orderBy("closed_at")).alias("closed_then"), F.col("closed_at").alias("restated_at")).where("closed_then IS NOT NULL")


def late_movements(movements: DataFrame, pairs: DataFrame, until_now: bool) -> DataFrame:
    """(balance_transaction_id, net, currency, s, m, closed_then): movements loaded after the earlier run of a pair.

    s, m: the days they are created and available on. until_now: only those loaded by the later run;
    as pairs follow one another, each movement is late for one of them. Else all loaded since, which
    is meant for a single pair.
    """
    late = movements.where(F.col("loaded_at").isNotNull()).select("balance_transaction_id", "net", "currency", F.to_date("created").alias("s"), F.to_date("available_on").alias("m"), "loaded_at")
    # The runs in order, as one array of as many times as there are runs.
    then = pairs.agg(F.array_sort(F.collect_list("closed_then")).alias("a"), F.max("restated_at").alias("z"))
    last_before = F.try_element_at(F.filter("_runs", lambda t: t < F.col("loaded_at")), F.lit(-1))
    out = late.withColumn("_runs", then.select("a").scalar()).withColumn("closed_then", last_before).where("closed_then IS NOT NULL").drop("_runs")
    return (out.where(F.col("loaded_at") <= then.select("z").scalar()) if until_now else out).drop("loaded_at")


def restatements(log: DataFrame, movements: DataFrame, *, all_runs: bool = False, with_causes: bool = False) -> DataFrame:
    """Days whose balances differ between two closing runs, and the late movements that explain it.

    Compares the last two runs; with ``all_runs`` every run with the one before, and then a movement
    counts for the run it was loaded by. Days that only one of the runs closed are not restated. A
    movement loaded after the earlier run adds its net to pending from its creation until it is
    available, and to available from then on: steps on its days, added up along each currency's days.
    with_causes: adds ``caused_by``, the ids of the movements that start or mature on the day, as an
    array, which a day with very many of them makes very long; ``restatement_causes`` gives them as rows.
    """
    pairs = adjacent_closes(log)
    if not all_runs:
        pairs = pairs.orderBy(F.desc("restated_at")).limit(1)
    pairs = F.broadcast(materialize(pairs))
    on = ["close_date", "currency"]
    now = log.join(pairs, F.col("closed_at") == F.col("restated_at")).select(*on, "closed_then", "restated_at", F.col("balance_pending").alias("pending_now"), F.col("balance_available").alias("available_now"))
    then = log.join(pairs.select("closed_then").distinct(), F.col("closed_at") == F.col("closed_then")).select(*on, "closed_then", F.col("balance_pending").alias("pending_then"), F.col("balance_available").alias("available_then"))
    moved = materialize(now.join(then, [*on, "closed_then"]).where("pending_now <> pending_then OR available_now <> available_then").distinct())
    late = late_movements(movements, pairs, all_runs)
    net, none = F.col("net"), F.lit(0).cast("long")
    step = lambda day, p, a: F.struct(day.alias("day"), p.alias("p"), a.alias("a"))
    known = F.col("s").isNotNull() & F.col("m").isNotNull()
    steps = F.array_compact(F.array(F.when(known, step(F.col("s"), net, none)), F.when(known, step(F.greatest("s", "m"), -net, none)), F.when(F.col("m").isNotNull(), step(F.col("m"), none, net))))
    touched = F.array_compact(F.array_distinct(F.array("s", "m")))
    per_day = late.select("closed_then", "currency", F.inline(steps)).groupBy("closed_then", "currency", "day").agg(F.sum("p").alias("p"), F.sum("a").alias("a"))
    counts = late.select("closed_then", "currency", F.explode(touched).alias("close_date"), "balance_transaction_id").groupBy("closed_then", "currency", "close_date")
    causes = counts.agg(F.count(F.lit(1)).alias("n"), *([F.sort_array(F.collect_list("balance_transaction_id")).alias("ids")] if with_causes else []))
    asked = moved.select("closed_then", "currency", F.col("close_date").alias("day"), F.lit(None).cast("long").alias("p"), F.lit(None).cast("long").alias("a"), F.lit(True).alias("asked"))
    so_far = Window.partitionBy("closed_then", "currency").orderBy("day").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    added = per_day.withColumn("asked", F.lit(False)).unionByName(asked).select("closed_then", "currency", F.col("day").alias("close_date"), "asked", F.sum("p").over(so_far).alias("ep"), F.sum("a").over(so_far).alias("ea"))
    out = moved.join(added.where("asked").drop("asked").distinct(), ["closed_then", *on], "left").join(causes, ["closed_then", *on], "left")
    zero = lambda c: F.coalesce(c, none)
    p, a = F.col("pending_now") - F.col("pending_then"), F.col("available_now") - F.col("available_then")
    return out.select(
        *on, "closed_then", "restated_at", "pending_then", "pending_now", p.alias("pending_movement"), "available_then", "available_now", a.alias("available_movement"),
        zero("n").alias("late_transactions"), zero("ep").alias("late_pending_effect"), zero("ea").alias("late_available_effect"),
        ((zero("ep") == p) & (zero("ea") == a)).alias("fully_explained_by_what_arrived_late"),
        *([F.coalesce("ids", F.array().cast("array<string>")).alias("caused_by")] if with_causes else []),
    )


def restatement_causes(restated: DataFrame, log: DataFrame, movements: DataFrame, *, all_runs: bool = False) -> DataFrame:
    """(close_date, currency, restated_at, balance_transaction_id, net, touched_the_day_by): a row for each late movement that starts or matures on a restated day."""
    pairs = adjacent_closes(log)
    if not all_runs:
        pairs = pairs.orderBy(F.desc("restated_at")).limit(1)
    days = broadcast_if(restated.select("close_date", "currency", "closed_then", "restated_at"))
    late = late_movements(movements, pairs, all_runs).withColumn("close_date", F.explode(F.array_compact(F.array_distinct(F.array("s", "m")))))
    linked = late.join(days, ["close_date", "currency", "closed_then"])
    return linked.select("close_date", "currency", "restated_at", "balance_transaction_id", "net", F.when(F.col("s") == F.col("close_date"), "created").otherwise("matured").alias("touched_the_day_by"))
