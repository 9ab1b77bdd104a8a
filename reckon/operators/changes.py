"""Applying a feed of inserts, updates and deletes: commit-ordered transactional replay.

A feed is a table of changes, each carrying a whole state. Changes commit in transactions, and only
whole transactions become visible, in commit order, up to the *committed watermark*:

1. repeated deliveries of a change collapse (same key, same position in the commit order);
2. a transaction is complete once as many different changes of it arrived as it declares, in a
   column of its changes or in a log of commits kept apart from the feed;
3. transactions are numbered, by the feed or by the order of their commit instants, and the watermark
   stops before the first number that is missing or incomplete: everything behind is held, not applied;
4. keys don't conflict with one another, so each key's changes reduce in parallel to the last one
   at or below the watermark. The reduction is an aggregate with map-side partials: a key with a
   third of all changes costs one row per task in the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reckon.operators.scale import materialize


@dataclass(frozen=True)
class Feed:
    """How to read a change feed.

    key: columns that name the entity. order: columns that order changes, greatest last; the last
    of them tells changes of one instant apart. deletes: a boolean SQL expression. transaction:
    columns that name the transaction, by default the first order column (a commit instant).
    declared: column with the number of changes the transaction has. sequence: column that numbers
    transactions without gaps. closed: whether the feed has ended, so that its last commit instant
    counts as complete where nothing is declared.
    """

    key: Sequence[str]
    order: Sequence[str]
    deletes: str
    transaction: Sequence[str] = ()
    declared: str | None = None
    sequence: str | None = None
    closed: bool = True

    @property
    def by(self) -> list[str]:
        return list(self.transaction) or list(self.order[:1])


def transactions(changes: DataFrame, feed: Feed, log: DataFrame | None = None) -> DataFrame:
    """(transaction columns, sequence, _at, _declared, _arrived) of every transaction in the feed or its log.

    _at: its first instant. log: a table of committed changes, with the transaction columns and the
    order columns, that says what each transaction holds: its different changes there are the
    declared size. Both tables go through one aggregate, so a commit that never reached the feed is
    seen as well. Repeated deliveries count once. A size that nobody declares is NULL.
    """
    by, at, own = feed.by, feed.order[0], [feed.sequence] if feed.sequence else []
    told_by = list(feed.order[-1:]) if log is not None else [c for c in dict.fromkeys([*feed.key, *feed.order]) if c not in (*by, *own)]

    def named(df: DataFrame, size: Column, logged: bool) -> DataFrame:
        return df.select(*by, *own, F.col(at).alias("_at"), F.struct(F.lit(0).alias("_"), *told_by).alias("_id"), F.lit(logged).alias("_log"), size.cast("long").alias("_size"))

    rows = named(changes, F.col(feed.declared) if feed.declared else F.lit(None), False)
    if log is not None:
        rows = rows.unionByName(named(log, F.lit(None), True))
    once = rows.groupBy(*by, *own, "_id").agg(F.min("_at").alias("_at"), F.max((~F.col("_log")).cast("long")).alias("_here"), F.max(F.col("_log").cast("long")).alias("_logged"), F.max("_size").alias("_size"))
    logged = F.nullif(F.sum("_logged"), F.lit(0))
    return once.groupBy(*by, *own).agg(F.min("_at").alias("_at"), F.greatest(F.max("_size"), logged).alias("_declared"), F.sum("_here").alias("_arrived"))


#: Whether all of a transaction's changes arrived; without a declared size it counts as complete.
COMPLETE = "coalesce(_arrived >= _declared, _arrived > 0)"


def complete_transactions(changes: DataFrame, feed: Feed, log: DataFrame | None = None) -> DataFrame:
    """The rows of ``transactions`` all of whose declared changes arrived."""
    return transactions(changes, feed, log).where(COMPLETE)


def numbered(rows: DataFrame, column: str, name: str) -> DataFrame:
    """Rows that differ in ``column``, each with its place in their order as ``name``, from 1; NULL comes first.

    Rows are range-partitioned and written; each partition's count gives the next ones their offset,
    and rows are numbered within their partition. There is no window over all rows.
    """
    parts = materialize(rows.repartitionByRange(F.col(column).asc_nulls_first()).withColumn("_part", F.spark_partition_id()))
    # One row a partition: as few as spark.sql.shuffle.partitions.
    counts = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("_part", F.expr("sum(n) OVER (ORDER BY _part) - n").alias("_before"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(F.col(column).asc_nulls_first()))
    return parts.withColumn("_n", within).join(F.broadcast(before), "_part").select(*rows.columns, (F.col("_n") + F.col("_before")).alias(name))


def contiguous_watermark(there: DataFrame, sequence: str, first: int | None = None, seen: DataFrame | None = None) -> DataFrame:
    """One row, ``watermark``: the last number of the unbroken run that starts at ``first``.

    Each number says that it is there and that its successor is awaited; the least number awaited
    but not there ends the run. Two rows a number and one aggregate: no global sort or window.
    Without ``first`` the run starts at the least number, or at that of ``seen``, where incomplete
    transactions count too. No numbers: NULL.
    """
    n = F.col(sequence).cast("long")
    marks = there.where(F.col(sequence).isNotNull()).select(
        F.explode(F.array(F.struct(n.alias("v"), F.lit(1).alias("have")), F.struct((n + 1).alias("v"), F.lit(0).alias("have")))).alias("x")
    ).select("x.*")
    if first is not None:
        marks = marks.where(F.col("v") >= first)
        start = there.sparkSession.range(1).select(F.lit(first).cast("long").alias("v"), F.lit(0).alias("have"))
        marks = marks.unionByName(start)
    elif seen is not None:
        start = seen.agg(F.min(F.col(sequence).cast("long")).alias("v")).where("v IS NOT NULL")
        marks = marks.unionByName(start.select("v", F.lit(0).alias("have")))
    missing = marks.groupBy("v").agg(F.max("have").alias("have")).where("have = 0")
    return missing.agg((F.min("v") - 1).alias("watermark"))


def instants(changes: DataFrame, feed: Feed, log: DataFrame | None = None) -> DataFrame:
    """(_at, _number, _declared, _arrived, _whole) of every commit instant of a feed without numbers, written.

    An instant is whole if every transaction that begins there is. In an open feed whose sizes nobody
    declares the last instant isn't, because more of it may come.
    """
    of = transactions(changes, feed, log)
    at = of.groupBy("_at").agg(F.sum("_declared").alias("_declared"), F.sum("_arrived").alias("_arrived"), F.min(F.expr(COMPLETE)).alias("_whole"))
    rows = numbered(at, "_at", "_number")
    if not feed.closed:
        last = at.agg(F.max("_at").alias("last"))
        rows = rows.withColumn("_whole", F.col("_whole") & (F.col("_declared").isNotNull() | F.coalesce(F.col("_at") < last.scalar(), F.lit(True))))
    return materialize(rows)


def frontier(numbers: DataFrame) -> DataFrame:
    """One row, (watermark, frontier): the last number of the unbroken run of whole instants, and its instant."""
    mark = contiguous_watermark(numbers.where("_whole"), "_number", seen=numbers)
    reached = numbers.where(F.col("_number") <= mark.scalar())
    return reached.agg(F.coalesce(F.max("_number"), F.lit(0)).alias("watermark"), F.max("_at").alias("frontier"))


def watermark(changes: DataFrame, feed: Feed, first: int | None = None, log: DataFrame | None = None) -> DataFrame | None:
    """One written row, (watermark, frontier): the contiguous watermark, and its instant where instants are numbered.

    None for a closed feed that declares no sizes, has no numbers and no log: it can lack nothing.
    """
    if feed.sequence:
        seen = transactions(changes, feed, log)
        mark = contiguous_watermark(seen.where(COMPLETE), feed.sequence, first, seen)
        return materialize(mark.withColumn("frontier", F.lit(None).cast("string")))
    if feed.closed and not feed.declared and log is None:
        return None
    return materialize(frontier(instants(changes, feed, log)))


def visible(feed: Feed, mark: DataFrame | None) -> Column:
    """Whether a change is at or below a watermark; never NULL."""
    if mark is None:
        return F.lit(True)
    number, until = mark.select("watermark").scalar(), mark.select("frontier").scalar()
    if feed.sequence:
        return F.coalesce(F.col(feed.sequence) <= number, F.lit(False))
    at = F.col(feed.order[0])
    return F.when(at.isNull(), number > 0).otherwise(F.coalesce(at <= until, F.lit(False)))


def committed(changes: DataFrame, feed: Feed, first: int | None = None, log: DataFrame | None = None) -> DataFrame:
    """The changes that are committed: at or below the contiguous watermark of whole transactions.

    With a sequence column the watermark is the end of the unbroken run of complete numbers from
    ``first`` on, and a NULL number is never committed. Otherwise the commit instants are numbered,
    and the first instant at which a transaction is incomplete stops it: neither that transaction
    nor any later one shows. NULL instants come before all others. A feed that declares no sizes and
    has no log can lack nothing, so all of it is committed, but for the last instant if it is open.
    """
    return changes.where(visible(feed, watermark(changes, feed, first, log)))


def held(changes: DataFrame, feed: Feed, first: int | None = None, log: DataFrame | None = None) -> DataFrame:
    """The changes that wait behind a gap or an incomplete transaction."""
    return changes.where(~visible(feed, watermark(changes, feed, first, log)))


def last_changes(changes: DataFrame, feed: Feed, keep: Sequence[str]) -> DataFrame:
    """Per key its last change: key, order and ``keep`` columns, and ``deleted``. Tombstones stay."""
    extra = [c for c in keep if c not in feed.key and c not in feed.order]
    rows = changes.where(F.lit(True) if not feed.key else F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in feed.key)))
    last = F.max(
        F.struct(
            *[F.col(c).alias(f"o{i}") for i, c in enumerate(feed.order)],
            F.coalesce(F.expr(feed.deletes), F.lit(False)).alias("d"),
            *[F.col(c).alias(f"k{i}") for i, c in enumerate(extra)],
        )
    )
    out = rows.groupBy(*feed.key).agg(last.alias("_last"))
    return out.select(
        *feed.key,
        *[F.col(f"_last.o{i}").alias(c) for i, c in enumerate(feed.order)],
        *[F.col(f"_last.k{i}").alias(c) for i, c in enumerate(extra)],
        F.col("_last.d").alias("deleted"),
    )


def replay(changes: DataFrame, feed: Feed, keep: Sequence[str] = (), first: int | None = None, log: DataFrame | None = None) -> DataFrame:
    """The current state at the committed watermark: per key that exists, its key and order columns and ``keep``.

    Entities whose last committed change is a delete are gone; a change whose insert never came
    still counts, because it carries the whole state. NULL keys are no entity. NULL order values
    sort before all others; of changes equal in key and order the greatest ``keep`` values stand, so
    the result doesn't depend on arrival. An empty feed gives an empty state. Only the named columns
    are read, so extra columns of any name do no harm; ``keep`` columns must be orderable.
    """
    state = last_changes(committed(changes, feed, first, log), feed, keep)
    return state.where(~F.col("deleted")).drop("deleted")


def advance(state: DataFrame, batch: DataFrame, feed: Feed, keep: Sequence[str] = ()) -> DataFrame:
    """A new state with tombstones from the last one and a further batch of committed changes.

    ``state`` is what ``last_changes`` or ``advance`` returned. Applying a batch twice, or batches
    out of order, gives the same state.
    """
    extra = [c for c in keep if c not in feed.key and c not in feed.order]
    cols = [*feed.key, *feed.order, *extra]
    old = state.select(*cols, F.col("deleted"))
    new = batch.select(*cols, F.coalesce(F.expr(feed.deletes), F.lit(False)).alias("deleted"))
    return last_changes(old.unionByName(new), Feed(feed.key, feed.order, "deleted"), extra)
