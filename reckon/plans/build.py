"""Gated builds: datasets in order of their inputs; a failed check stops what depends on its table."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from reckon.operators import checks, close, ledger, recon
from reckon.schemas import ACCOUNTS, CLOSE_LOG

Frames = dict[str, DataFrame]


@dataclass(frozen=True)
class Check:
    """Rows that violate something, computed from datasets by name."""

    name: str
    inputs: Sequence[str]
    find: Callable[..., DataFrame]


@dataclass(frozen=True)
class Dataset:
    name: str
    inputs: Sequence[str]
    make: Callable[..., DataFrame]


@dataclass
class Result:
    """What one build did. A build that never ran has no result, which isn't the same as a failed one."""

    run_id: str
    frames: Frames = field(default_factory=dict)
    failed: dict[str, int] = field(default_factory=dict)
    skipped: list[str] = field(default_factory=list)
    passed: list[str] = field(default_factory=list)


#: Order matters only where inputs make it so. Sources: list, reported, events, expanded; log_before, run.
DATASETS = [
    Dataset("postings", ["list"], ledger.postings),
    Dataset("balances", ["postings"], ledger.trial_balance),
    Dataset("coverage_gaps", ["list", "events", "expanded"], recon.coverage_gaps),
    Dataset("daily_close", ["postings"], close.daily_close),
    Dataset("money_flow", ["postings"], ledger.flow),
    Dataset("close_log", ["daily_close", "log_before", "run"], close.logged),
    Dataset("restatements", ["close_log", "list"], close.restatements),
    # Items stand beside the published reconciliation, so that a difference found in it still gets itemised.
    Dataset("weighed", ["daily_close", "reported", "list", "postings"], recon.reconciliation),
    Dataset("reconciliation", ["weighed"], lambda w: w),
    Dataset("reconciliation_items", ["weighed", "list", "postings"], recon.items),
]

#: What every column must hold, by dataset: (not NULL, unique, accepted values).
COLUMNS: dict[str, tuple[list[str], list[str], dict[str, list[str]]]] = {
    "list": (["balance_transaction_id", "net", "currency"], ["balance_transaction_id"], {}),
    "reported": (["as_of_date", "available", "pending"], [], {}),
    "expanded": (["balance_transaction_id"], ["balance_transaction_id"], {}),
    "postings": (["posting_id", "entry_id", "entry_type", "account", "amount", "currency", "balance_transaction_id"], ["posting_id"], {"entry_type": ["recognition", "availability"], "account": ACCOUNTS}),
    "balances": (["account", "balance"], [], {}),
    "daily_close": (["close_date", "currency", "balance_pending", "balance_available"], [], {}),
    "reconciliation": (["close_date", "currency", "unexplained_difference"], [], {}),
    "money_flow": (["source", "target", "amount", "currency"], [], {}),
    "close_log": (["run_id", "closed_at", "close_date"], [], {}),
    "restatements": (["close_date", "fully_explained_by_what_arrived_late"], [], {}),
    "coverage_gaps": (["finding", "balance_transaction_id", "net"], [], {"finding": [recon.UNANNOUNCED, recon.UNLISTED]}),
    "reconciliation_items": (["balance_transaction_id"], [], {}),
}


def column_check(name: str) -> Callable[[DataFrame], DataFrame]:
    not_null, unique, accepted = COLUMNS[name]
    return lambda df: checks.columns(df, not_null=not_null, unique_columns=unique, accepted=accepted)


CHECKS = [
    *[Check(f"{name}_columns", [name], column_check(name)) for name in COLUMNS],
    Check("entries_balance", ["postings"], checks.entries_balance),
    Check("one_source_leg", ["postings"], checks.one_source_leg),
    Check("every_movement_posted", ["list", "postings"], checks.every_movement_posted),
    Check("list_complete", ["coverage_gaps"], lambda g: checks.gaps_of(g, recon.UNLISTED)),
    Check("stream_complete", ["coverage_gaps"], lambda g: checks.gaps_of(g, recon.UNANNOUNCED)),
    Check("one_row_a_day", ["daily_close"], lambda d: checks.unique(d, ["close_date", "currency"])),
    Check("available_explained", ["daily_close"], checks.available_explained),
    Check("flow_conserves", ["money_flow", "balances"], checks.flow_conserves),
    Check("restatement_explained", ["restatements"], checks.restatement_explained),
    Check("same_days_closed", ["reconciliation"], checks.same_days_closed),
    Check("nothing_unexplained", ["reconciliation"], checks.nothing_unexplained),
]


def depends(name: str, on: str, datasets: Sequence[Dataset]) -> bool:
    """Whether a dataset stands, directly or not, on another."""
    made = {d.name: d for d in datasets}
    return name in made and any(i == on or depends(i, on, datasets) for i in made[name].inputs)


def run_sources(spark: SparkSession, run_id: str, closed_at: datetime, log: DataFrame | None) -> Frames:
    """The sources that name a build: its id and time, and the closing log as it was."""
    run = spark.createDataFrame([(run_id, closed_at)], "run_id string, closed_at timestamp")
    empty = spark.createDataFrame([], CLOSE_LOG)
    return {"run": run, "log_before": empty if log is None else log}


def build(sources: Frames, run_id: str, *, datasets: Sequence[Dataset] = DATASETS, check: Sequence[Check] = CHECKS, keep: Callable[[str, DataFrame], DataFrame] | None = None) -> Result:
    """Make each dataset, then run the checks whose inputs are all there.

    A failed check records its number of rows and stops the datasets that stand on all that it
    looked at, unless they were made before: what a check judged stays for inspection. ``keep`` writes
    a dataset and gives it back as read; without it nothing is written.
    """
    out = Result(run_id, dict(sources))
    pending, done = list(check), set()

    def run_ready() -> None:
        for c in pending:
            if c.name not in done and all(i in out.frames for i in c.inputs):
                done.add(c.name)
                rows = c.find(*[out.frames[i] for i in c.inputs]).count()
                if rows:
                    out.failed[c.name] = rows
                else:
                    out.passed.append(c.name)

    def blocked(d: Dataset) -> bool:
        if any(i not in out.frames for i in d.inputs):
            return True
        stopping = [c for c in check if c.name in out.failed and c.name in done]
        return any(all(i in d.inputs or depends(d.name, i, datasets) for i in c.inputs) for c in stopping)

    run_ready()
    for d in datasets:
        if blocked(d):
            out.skipped.append(d.name)
            continue
        made = d.make(*[out.frames[i] for i in d.inputs])
        out.frames[d.name] = keep(d.name, made) if keep else made
        run_ready()
    return out
