"""Runs waves of inputs through landing, typing, entities and a gated build, and judges each fault arm."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reckon.operators import entities, events, upsert
from reckon.operators.scale import materialize, scratch
from reckon.plans import chaos, simulate
from reckon.plans.build import Result, build, run_sources
from reckon.plans.report import Frames, measure

PARTITIONS = 12


def landed(lines: DataFrame, wave: int, at: datetime) -> DataFrame:
    """Bronze rows of event lines, in the order of their positions within each partition."""
    keyed = lines.select(F.col("line").alias("value"), events.partition_key("line").alias("key"), "position")
    placed = keyed.select("value", "key", F.pmod(F.xxhash64("key"), F.lit(PARTITIONS)).cast("int").alias("kafka_partition"), (F.col("position") * 1_000_000).cast("long").alias("kafka_offset"), F.lit(at).alias("kafka_timestamp"))
    return events.envelope(placed, carry=("kafka_partition", "kafka_offset", "kafka_timestamp"), ingested_at=F.lit(at))


def run_waves(spark: SparkSession, waves: list[chaos.Wave], run_id: str, began: datetime) -> tuple[Result, Frames]:
    """Deliver each wave and build after it; gives the last build and all its tables.

    Nothing is shared between calls: every table of a run belongs to the run.
    """
    bronze = listed = log = None
    result, frames = Result(run_id), {}
    for i, wave in enumerate(waves):
        at = began + timedelta(days=i)
        new = landed(wave.events, i, at)
        bronze = materialize(new if bronze is None else bronze.unionByName(new))
        incoming = wave.movements.withColumn("loaded_at", F.lit(at))
        listed = materialize(incoming if listed is None else upsert.refresh_list(listed, incoming))
        silver = materialize(events.collapse(events.typed(bronze)))
        payloads = silver.select("event_id", "payload")
        made: Frames = {"list": listed, "reported": wave.reported, "events": silver, "expanded": materialize(entities.expanded_movements(silver, payloads))}
        name = f"{run_id}-{i}"
        result = build({**made, **run_sources(spark, name, at + timedelta(hours=1), log)}, name, keep=lambda _, df: materialize(df))
        log = result.frames.get("close_log", log)
        frames = {**result.frames, "bronze": bronze, "charges": entities.charges(silver), "refunds": entities.refunds(silver), "disputes": entities.disputes(silver)}
        if log is not None:
            frames["close_log"] = log
    return result, frames


@dataclass
class Verdict:
    """An arm's outcome: what speaks against it, what was injected, its measurements, and the run it damaged."""

    against: list[str]
    injected: dict[str, int]
    measured: dict[str, int | None]
    source_run: dict[str, Any]

    def document(self, arm: str) -> dict[str, Any]:
        """The arm as the export takes it."""
        return {"arm": arm, "as_described": not self.against, "against": self.against, "injected": self.injected, "measured": self.measured, "source_run": self.source_run}


def judge_waves(spark: SparkSession, wave: chaos.Wave, source_run: dict[str, Any], arms: list[str] | None = None, began: datetime = datetime(2026, 9, 1), seed: int = 1) -> dict[str, Verdict]:
    """The verdict on each arm, baseline first; an arm without a result is an error, not a failure.

    Each arm runs apart: its tables live in a scratch folder of its own, which goes once it is judged.
    """
    out: dict[str, Verdict] = {}
    base: dict[str, int | None] | None = None
    for arm in ["baseline", *[a for a in (arms or chaos.ARMS) if a != "baseline"]]:
        with scratch(spark):
            waves = chaos.ARMS[arm](wave, seed)
            if arm == "late_arrival":
                waves[0] = chaos.Wave(waves[0].events, waves[0].movements, materialize(simulate.reported(waves[0].movements)))
            counts = chaos.injected(arm, wave, waves)
            result, frames = run_waves(spark, waves, arm, began)
            got = measure(frames)
            base = base or got
            out[arm] = Verdict(chaos.verdict(result.failed, chaos.expected(arm, counts), got, chaos.MUST_MEASURE[arm], base), counts, got, source_run)
    return out


def judge(spark: SparkSession, run: simulate.Run, arms: list[str] | None = None, began: datetime = datetime(2026, 9, 1)) -> dict[str, Verdict]:
    """``judge_waves`` over a simulated run."""
    moved = materialize(simulate.movements(spark, run))
    balances = materialize(simulate.reported(moved))
    wave = chaos.Wave(materialize(simulate.stream_lines(spark, run, balances)), moved, balances)
    return judge_waves(spark, wave, {"charges": run.charges, "seed": run.seed, "days": run.days}, arms, began, run.seed)
