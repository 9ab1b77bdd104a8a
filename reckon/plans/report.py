"""Measurements of a build in named numbers, and its export as checked documents."""

from __future__ import annotations

import datetime
import json
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reckon.schemas import AVAILABLE

#: Rows that an exported table may hold at most: they are bounded by the calendar and the chart of accounts.
MOST_ROWS = 5_000

Frames = dict[str, DataFrame]

#: Name, table, aggregate as SQL.
MEASURES: list[tuple[str, str, str]] = [
    ("bronze_deliveries", "bronze", "count(*)"),
    ("bronze_events", "bronze", "count(DISTINCT event_id)"),
    ("silver_events", "events", "count(*)"),
    ("silver_deliveries", "events", "coalesce(sum(deliveries), 0)"),
    ("silver_charges", "charges", "count(*)"),
    ("silver_refunds", "refunds", "count(*)"),
    ("silver_disputes", "disputes", "count(*)"),
    ("silver_expanded_transactions", "expanded", "count(*)"),
    ("list_transactions", "list", "count(*)"),
    ("reported_days", "reported", "count(*)"),
    ("charges_created_checksum", "charges", "coalesce(sum(unix_timestamp(created)), 0)"),
    ("gold_postings", "postings", "count(*)"),
    ("gold_entries", "postings", "count(DISTINCT entry_id)"),
    ("gold_trial_balance", "postings", "coalesce(sum(amount), 0)"),
    ("gold_available", "postings", f"coalesce(sum(CASE WHEN account = '{AVAILABLE}' THEN amount END), 0)"),
    ("gold_close_rows", "daily_close", "count(*)"),
    ("gold_reconciliation_breaks", "reconciliation", "count_if(unexplained_difference <> 0)"),
    ("gold_reconciliation_items", "reconciliation_items", "count(*)"),
    ("gold_coverage_gaps", "coverage_gaps", "count(*)"),
    ("gold_restatements", "restatements", "count(*)"),
    ("gold_closes", "close_log", "count(DISTINCT closed_at)"),
]


def measurements(frames: Frames) -> DataFrame:
    """(measure, value) of every measurement, NULL where its table doesn't exist; one pass over each table."""
    parts, absent = [], []
    for table in dict.fromkeys(t for _, t, _ in MEASURES):
        own = [(name, a) for name, t, a in MEASURES if t == table]
        if table not in frames:
            absent += [name for name, _ in own]
            continue
        one = frames[table].agg(*[F.expr(a).cast("long").alias(name) for name, a in own])
        parts.append(one.select(F.inline(F.array(*[F.struct(F.lit(name).alias("measure"), F.col(name).alias("value")) for name, _ in own]))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if absent:
        out = out.unionByName(out.sparkSession.createDataFrame([(name, None) for name in absent], "measure string, value long"))
    return out


def measure(frames: Frames) -> dict[str, int | None]:
    """The measurements by name."""
    return {r["measure"]: r["value"] for r in measurements(frames).collect()}


#: Exported tables: document, part of it, table, fields, order. Fixed values.
EXPORTS: list[tuple[str, str, str, list[str], list[str]]] = [
    ("accounts", "rows", "balances", ["account", "currency", "balance", "postings"], ["currency", "account"]),
    ("flow", "rows", "money_flow", ["source", "target", "currency", "amount"], ["-amount", "source", "target"]),
    ("daily_close", "rows", "daily_close", ["close_date", "currency", "balance_pending", "balance_available", "gross_sales", "refunds", "processing_fees", "disputes"], ["close_date", "currency"]),
    ("reconciliation", "rows", "reconciliation", ["close_date", "currency", "ledger_total", "reported_total", "total_difference", "unexplained_difference", "ledger_closed_the_day", "processor_reported_the_day"], ["close_date", "currency"]),
    ("findings", "coverage_gaps", "coverage_gaps", ["finding", "balance_transaction_id", "source_id", "reporting_category", "net", "currency", "noticed_on"], ["finding", "balance_transaction_id"]),
    ("findings", "restatements", "restatements", ["close_date", "currency", "pending_then", "pending_now", "available_then", "available_now", "late_transactions", "fully_explained_by_what_arrived_late"], ["close_date", "currency"]),
]
#: Measurements that an exported arm shows. Fixed values.
SHOWN = ["bronze_deliveries", "bronze_events", "silver_events", "silver_charges", "gold_postings", "gold_trial_balance", "gold_reconciliation_breaks", "gold_coverage_gaps", "gold_restatements"]
VERSION = 1


class Refused(ValueError):
    """An export that would break a promise; nothing is written."""


def rows_of(df: DataFrame, fields: list[str], order: list[str]) -> list[dict[str, Any]]:
    """The named fields of a small table, sorted; a missing field or a table over the cap is refused."""
    missing = [f for f in fields if f not in df.columns]
    if missing:
        raise Refused(f"missing fields {missing}")
    by = [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in order]
    rows = df.select(*fields).orderBy(*by).limit(MOST_ROWS + 1).collect()
    if len(rows) > MOST_ROWS:
        raise Refused(f"more than {MOST_ROWS} rows")
    plain = lambda v: v.isoformat() if isinstance(v, (datetime.date, datetime.datetime)) else v
    return [{f: plain(r[f]) for f in fields} for r in rows]


def refuse_floats(value: Any, at: str = "") -> None:
    """Money is integral: a floating number anywhere is refused."""
    if isinstance(value, float):
        raise Refused(f"a floating number at {at}")
    if isinstance(value, dict):
        for k, v in value.items():
            refuse_floats(v, f"{at}.{k}")
    elif isinstance(value, list):
        for i, v in enumerate(value):
            refuse_floats(v, f"{at}[{i}]")


def refuse_dates(value: Any, at: str = "") -> None:
    """Whatever is named a date or a day is one in ISO form, without a time."""
    if isinstance(value, dict):
        for k, v in value.items():
            if k.endswith(("_date", "_on")):
                try:
                    plain = isinstance(v, str) and len(v) == 10 and datetime.date.fromisoformat(v)
                except ValueError:
                    plain = None
                if not plain:
                    raise Refused(f"{k} at {at} isn't a date")
            refuse_dates(v, f"{at}.{k}")
    elif isinstance(value, list):
        for i, v in enumerate(value):
            refuse_dates(v, f"{at}[{i}]")


def refuse_arms(documents: list[dict[str, Any]], arms: list[str] | None) -> None:
    """Arms are all of the suite's or none, each as described, and all of one run."""
    if documents and {d["arm"] for d in documents} != set(arms or [d["arm"] for d in documents]):
        raise Refused("the suite isn't complete")
    for d in documents:
        if not d["as_described"]:
            raise Refused(f"{d['arm']} didn't do what it says: {d['against'][:3]}")
        if not d.get("source_run"):
            raise Refused(f"{d['arm']} doesn't say which run it damaged")
        if d["source_run"] != documents[0]["source_run"]:
            raise Refused(f"{d['arm']} damaged another run than {documents[0]['arm']}")


def export(frames: Frames, run: dict[str, Any], suite: list[dict[str, Any]] | None = None, arms: list[str] | None = None) -> dict[str, str]:
    """Documents by name as JSON text, with a manifest; refused as a whole if a promise is broken.

    suite: arms as documents, see ``suite.Verdict``; arms: the names that a complete suite has.
    Promises: no floating numbers; days in ISO form; the trial balance of each currency is zero; flow
    is positive and equals balances; no day is unexplained; the suite is complete, as described and of
    one run, if there is one. Every document says whether its data is simulated, and none holds the
    time of the export.
    """
    docs: dict[str, dict[str, Any]] = {}
    for name, part, table, fields, order in EXPORTS:
        if table in frames:
            docs.setdefault(name, {})[part] = rows_of(frames[table], fields, order)
    accounts = docs.get("accounts", {}).get("rows", [])
    totals: dict[str, int] = {}
    for r in accounts:
        totals[r["currency"]] = totals.get(r["currency"], 0) + r["balance"]
    if any(totals.values()):
        raise Refused(f"the trial balance is {totals}")
    if "accounts" in docs:
        docs["accounts"]["total"] = sum(totals.values())
    if "flow" in docs and "accounts" in docs:
        net: dict[tuple[str, str], int] = {}
        for r in docs["flow"]["rows"]:
            if r["amount"] <= 0:
                raise Refused(f"a flow of {r['amount']} from {r['source']}")
            net[r["target"], r["currency"]] = net.get((r["target"], r["currency"]), 0) + r["amount"]
            net[r["source"], r["currency"]] = net.get((r["source"], r["currency"]), 0) - r["amount"]
        held = {(r["account"], r["currency"]): r["balance"] for r in accounts}
        off = [k for k in net.keys() | held.keys() if net.get(k, 0) != held.get(k, 0)]
        if off:
            raise Refused(f"flow and balance differ for {sorted(off)[:3]}")
    if "reconciliation" in docs:
        days = docs["reconciliation"]["rows"]
        off = [r for r in days if r["unexplained_difference"]]
        if off:
            raise Refused(f"{len(off)} days have an unexplained difference")
        docs["reconciliation"] |= {"days_reconciled": len(days), "days_with_an_unexplained_difference": 0}
    told = list(suite or [])
    refuse_arms(told, arms)
    whole = told[0]["source_run"] if told else None
    if suite is not None:
        docs["chaos"] = {"arms": [{**{k: v for k, v in d.items() if k != "measured"}, "counts": {m: d["measured"].get(m) for m in SHOWN}} for d in told], "run": whole}
    simulated = bool(run.get("simulated", False))
    out = {name: {"version": VERSION, "simulated": simulated, **doc} for name, doc in docs.items()}
    counts = {name: sum(len(v) for v in doc.values() if isinstance(v, list)) for name, doc in docs.items()}
    out["manifest"] = {"version": VERSION, "simulated": simulated, "run": run, "chaos_run": whole, "files": counts}
    refuse_floats(out)
    refuse_dates(out)
    return {name: json.dumps(doc, sort_keys=True, ensure_ascii=False) for name, doc in out.items()}
