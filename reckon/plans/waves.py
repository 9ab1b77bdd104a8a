"""Waves and runs as files: the stream's lines as they came, the lists as JSON lines, manifests with digests."""

from __future__ import annotations

import hashlib
import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reckon.operators import upsert
from reckon.operators.changes import numbered
from reckon.operators.scale import materialize
from reckon.plans import chaos, simulate

#: Lines that are digested together; the digests of a file's blocks are digested in order.
BLOCK = 10_000
ARTIFACTS = ("events", "balance_transactions", "daily_balance")


def _file(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def write_json(spark: SparkSession, path: str, value: Any) -> None:
    """A small document as one file."""
    at, fs = _file(spark, path)
    out = fs.create(at, True)
    try:
        out.write(bytearray((json.dumps(value, indent=2, sort_keys=True) + "\n").encode()))
    finally:
        out.close()


def read_json(spark: SparkSession, path: str) -> Any:
    at, fs = _file(spark, path)
    if not fs.exists(at):
        raise FileNotFoundError(path)
    stream = fs.open(at)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def ordered_lines(rows: DataFrame, column: str) -> DataFrame:
    """(no, line) of (``column``, line): lines with their places in order. Equal places are an error of the caller."""
    return numbered(rows.select(column, "line"), column, "no").select("no", "line")


def sha256(lines: DataFrame) -> str:
    """Digest of (no, line) that depends on the lines and their order alone, not on how they lie in files.

    Blocks of ``BLOCK`` lines are digested where they lie; only their digests come to the driver.
    """
    block = lines.groupBy(F.floor((F.col("no") - 1) / F.lit(BLOCK)).alias("block")).agg(F.array_sort(F.collect_list(F.struct("no", "line"))).alias("x"))
    digests = block.select("block", F.sha2(F.concat_ws("\n", "x.line"), 256).alias("d")).orderBy("block")
    out = hashlib.sha256()
    for row in digests.toLocalIterator():
        out.update(row["d"].encode())
    return out.hexdigest()


def _json_lines(rows: DataFrame, columns: dict[str, F.Column] | None = None) -> DataFrame:
    """(place, line): rows as JSON with sorted names, placed by that text and, where texts repeat, by their count."""
    shown = columns or {c: F.col(c) for c in rows.columns}
    line = F.to_json(F.struct(*[shown[c].alias(c) for c in sorted(shown)]), {"ignoreNullFields": "false"})
    counted = rows.select(line.alias("line")).groupBy("line").agg(F.count(F.lit(1)).alias("n"))
    each = counted.select("line", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("i"))
    return each.select(F.struct("line", "i").alias("place"), "line")


def _seconds(column: str) -> F.Column:
    return F.unix_timestamp(F.col(column).cast("timestamp"))


def artifacts(wave: chaos.Wave) -> dict[str, DataFrame]:
    """(no, line) of each of a wave's files. The stream's lines are those that came; the lists are written anew."""
    movement = {"id": F.col("balance_transaction_id"), "source": F.col("source_id"), "created": _seconds("created"), "available_on": _seconds("available_on")}
    movement |= {c: F.col(c) for c in ("type", "reporting_category", "amount", "fee", "net", "currency", "status", "description", "fee_details")}
    balance = {"date": F.date_format("as_of_date", "yyyy-MM-dd"), **{c: F.col(c) for c in ("currency", "pending", "available")}}
    return {
        "events": ordered_lines(wave.events, "position"),
        "balance_transactions": ordered_lines(_json_lines(wave.movements, movement), "place"),
        "daily_balance": ordered_lines(_json_lines(wave.reported, balance), "place"),
    }


def write_wave(wave: chaos.Wave, path: str) -> dict[str, dict[str, Any]]:
    """Write a wave's files, each a folder of lines in order; gives ``counts`` and ``sha256`` of each."""
    counts, digests = {}, {}
    for name, lines in artifacts(wave).items():
        kept = materialize(lines)
        kept.orderBy("no").select("line").write.text(f"{path}/{name}")
        counts[name], digests[name] = kept.count(), sha256(kept)
    return {"counts": counts, "sha256": digests}


def read_wave(spark: SparkSession, path: str) -> chaos.Wave:
    """A wave from its files; the stream stays text, line for line in the order written."""
    for name in ARTIFACTS:
        at, fs = _file(spark, f"{path}/{name}")
        if not fs.exists(at):
            raise FileNotFoundError(f"{path}/{name}: a wave is written by write_wave first")
    # Files are read in the order of their names, and rows in the order of their files.
    raw = spark.read.text(f"{path}/events").select(F.col("value").alias("line"), F.col("_metadata.file_name").alias("f"), F.monotonically_increasing_id().alias("i"))
    placed = numbered(raw.select(F.struct("f", "i").alias("at"), "line"), "at", "no")
    never = F.lit(None).cast("timestamp")
    return chaos.Wave(placed.select(F.col("no").cast("double").alias("position"), "line"), upsert.read_list(spark, f"{path}/balance_transactions", never), upsert.read_reported(spark, f"{path}/daily_balance"))


def write_run(spark: SparkSession, run: simulate.Run, path: str) -> dict[str, Any]:
    """Simulate a run and write its files and ``run.json``."""
    moved = materialize(simulate.movements(spark, run))
    balances = materialize(simulate.reported(moved))
    told = write_wave(chaos.Wave(simulate.stream_lines(spark, run, balances), moved, balances), path)
    manifest = {"simulated": True, "transactions": run.charges, "seed": run.seed, "days": run.days, "start": run.start, **told}
    write_json(spark, f"{path}/run.json", manifest)
    return manifest


def source_run(spark: SparkSession, path: str) -> dict[str, Any]:
    """What names a run: size, seed, calendar and the digest of its stream, as its manifest says."""
    run = read_json(spark, f"{path}/run.json")
    return {"transactions": run["transactions"], "seed": run["seed"], "days": run["days"], "events": run["sha256"]["events"]}


def write_scenario(spark: SparkSession, arm: str, source: str, path: str, seed: int) -> dict[str, Any]:
    """Damage a written run by one arm; write its waves and ``scenario.json``, which says what must come of it."""
    before = read_wave(spark, source)
    waves = chaos.ARMS[arm](before, seed)
    counts = chaos.injected(arm, before, waves)
    manifest = {
        "simulated": True, "scenario": arm, "seed": seed, "source_run": source_run(spark, source), "injected": counts,
        "waves": [write_wave(w, f"{path}/wave{i}") for i, w in enumerate(waves, start=1)],
        "expect": {"failures": chaos.expected(arm, counts), "metrics": chaos.MUST_MEASURE[arm]},
    }
    write_json(spark, f"{path}/scenario.json", manifest)
    return manifest
