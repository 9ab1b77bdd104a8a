"""Messages delivered more than once: keep one copy of each identifier.

Identifiers split by their aggregated frequency. Counting moves only identifiers, pre-aggregated;
the identifiers that repeat are written once as a table. Singletons then pass without being ranked
or grouped, and only repeated groups are ranked, by an aggregate with map-side partials, so that an
identifier with a third of all rows becomes one row per task before anything moves.

Where the repeated identifiers are small, their table is broadcast and only their groups move. Where
they aren't, messages meet them in one shuffle that both halves read; messages without an identifier
and those of hot identifiers never enter it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reckon.operators.scale import MOST_BYTES, materialize, measured

#: An identifier is hot with more than 1 / HOT_IDS of all repeated messages, so there are fewer than that.
HOT_IDS = 20_000


def repeated_ids(messages: DataFrame, id: str) -> DataFrame:
    """(id, copies) of every identifier with more than one message."""
    counts = messages.where(F.col(id).isNotNull()).groupBy(F.col(id).alias("id")).agg(F.count(F.lit(1)).alias("copies"))
    return counts.where("copies > 1")


def _orderable(df: DataFrame, c: str) -> Column:
    return F.to_json(f"row.{c}") if "map<" in dict(df.dtypes)[c] else F.col(f"row.{c}")


def one_of_each(messages: DataFrame, *, id: str, order: Sequence[str], stored: DataFrame | None = None, copies: str | None = None, most_bytes: int = MOST_BYTES) -> DataFrame:
    """One message per identifier: the least in ``order``; messages without an identifier all stay.

    stored: messages kept before, of the same columns; the result covers both. copies: name of a
    column to add with the number of messages seen under the identifier (1 without one). most_bytes:
    size up to which the table of repeated identifiers is broadcast.
    NULLs in ``order`` sort first. Of messages equal in ``order`` the one with the least other columns,
    in the table's order, stays; fully equal ones are one. Input columns may have any name; an empty
    table gives an empty one.
    """
    rows = messages if stored is None else stored.unionByName(messages)
    cols = rows.columns
    numbered = rows.toDF(*[f"c{i}" for i in range(len(cols))])
    own = f"c{cols.index(id)}"
    # The rank is read from the row after it moved, so that both halves of the split move the same columns.
    packed = numbered.select(F.col(own).alias("id"), F.struct(*numbered.columns).alias("row"))
    known = packed.where(F.col("id").isNotNull())
    rank = F.struct(*[_orderable(numbered, f"c{cols.index(c)}") for c in order], *[_orderable(numbered, c) for c in numbered.columns])

    def ranked(part: DataFrame, seen: Column) -> DataFrame:
        """Rows of repeated identifiers to one each."""
        return part.groupBy("id").agg(F.min_by("row", rank).alias("row"), seen.cast("long").alias("copies"))

    one = F.lit(1).cast("long").alias("copies")
    parts = [packed.where(F.col("id").isNull()).select("row", one)]
    many, small = measured(repeated_ids(rows, id), most_bytes)
    if small:
        many = F.broadcast(many)
        parts += [known.join(many.select("id"), "id", "left_anti").select("row", one), ranked(known.join(many, "id"), F.max("copies")).select("row", "copies")]
    else:
        total = many.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n"))
        # Hashes of fewer than HOT_IDS identifiers: at most 160 KB, however long these are. An identifier that
        # shares its hash with a hot one goes the same way, which counts and ranks exactly.
        hot = F.broadcast(materialize(many.where(F.col("copies") * HOT_IDS > total.scalar()).select(F.xxhash64("id").alias("hash")).distinct()))
        hashed = known.withColumn("hash", F.xxhash64("id"))
        cold = hashed.join(hot, "hash", "left_anti").drop("hash").repartition("id")
        parts += [
            ranked(hashed.join(hot, "hash", "left_semi"), F.count(F.lit(1))).select("row", "copies"),
            cold.join(many.select("id"), "id", "left_anti").select("row", one),
            ranked(cold.join(many, "id"), F.max("copies")).select("row", "copies"),
        ]
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    out = [F.col(f"row.c{i}").alias(c) for i, c in enumerate(cols)]
    return both.select(*out, *([F.col("copies").alias(copies)] if copies else []))
