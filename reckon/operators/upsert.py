"""Keyed upserts without a row-level catalog: pure rewrites of a table and a batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reckon.schemas import BALANCE_LINE, LIST_COLUMNS, MOVEMENT_LINE


def refresh_list(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Upsert movements: a new row wins in every column, also where it is NULL, but keeps ``loaded_at``.

    A movement repeated within ``incoming`` stays repeated; the uniqueness check is what must stop it.
    """
    key = "balance_transaction_id"
    old = stored.select(F.col(key).alias("_key"), F.struct(*[c for c in LIST_COLUMNS if c != key]).alias("_old"))
    new = incoming.select(F.col(key).alias("_key"), F.struct(*[c for c in LIST_COLUMNS if c != key]).alias("_new"))
    both = old.join(new, "_key", "full_outer")
    pick = lambda c: F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c)
    cols = [F.col("_key").alias(key)] + [pick(c) for c in LIST_COLUMNS if c not in (key, "loaded_at")] + [F.coalesce("_old.loaded_at", "_new.loaded_at").alias("loaded_at")]
    return both.select(*cols)


def replace_rows(stored: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert whole rows by key: stored rows whose key comes again go, all incoming rows stay."""
    return stored.join(incoming.select(*keys).distinct(), list(keys), "left_anti").select(*stored.columns).unionByName(incoming.select(*stored.columns))


def read_list(spark: SparkSession, path: str, loaded_at) -> DataFrame:
    """The movement list from JSON lines; each line is kept as payload."""
    raw = spark.read.text(path).withColumnRenamed("value", "payload").withColumn("t", F.from_json("payload", MOVEMENT_LINE))
    return raw.select(
        F.col("t.id").alias("balance_transaction_id"), F.col("t.source").alias("source_id"), "t.type", "t.reporting_category", "t.amount", "t.fee", "t.net", "t.currency",
        F.col("t.created").cast("timestamp").alias("created"), F.col("t.available_on").cast("timestamp").alias("available_on"), "t.status", "t.description", "t.fee_details", "payload", loaded_at.alias("loaded_at"),
    )


def read_reported(spark: SparkSession, path: str) -> DataFrame:
    """Reported balances from JSON lines; each line is kept as payload."""
    raw = spark.read.text(path).withColumnRenamed("value", "payload").withColumn("t", F.from_json("payload", BALANCE_LINE))
    return raw.select(F.to_date("t.date").alias("as_of_date"), "t.currency", "t.pending", "t.available", "payload")
