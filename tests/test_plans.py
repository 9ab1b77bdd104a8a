"""Plans of the hot paths: what they scan, join and shuffle."""

import re

from oracle import SF

import __spark_entry__ as entry
from reckon.operators import ledger
from reckon.sources.tables import table


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def count(text: str, what: str) -> int:
    return len(re.findall(rf"\b{what}\b", text))


def test_postings_scan_once_without_a_shuffle(spark):
    p = plan(ledger.postings(table(spark, SF, "balance_transaction_list")))
    assert count(p, "FileScan") == 1 and count(p, "Exchange") == 0


def test_daily_close_shares_one_window(spark):
    p = plan(entry.queries()["daily_close"](spark, SF))
    assert count(p, "Window") == 1 and count(p, "CartesianProduct") == 0 and count(p, "BroadcastNestedLoopJoin") == 0


def test_items_and_flow_have_no_nested_loop(spark):
    for q in ("reconciliation_items", "money_flow", "restatements", "p3_found", "p4_found", "coverage_gaps"):
        p = plan(entry.queries()[q](spark, SF))
        assert count(p, "CartesianProduct") == 0 and count(p, "BroadcastNestedLoopJoin") == 0, q


def test_scans_read_only_what_they_need(spark):
    for q in ("p1_found", "p2_found", "p5_found"):
        p = plan(entry.queries()[q](spark, SF))
        assert "payload" not in p, q
    # The only shuffle of the labelled nodes is by document; the filter runs before the walk.
    p = plan(entry.queries()["p3_found"](spark, SF))
    assert count(p, "FileScan") == 1 and count(p, "MapInArrow") == 1


def test_replay_pre_aggregates_before_its_shuffle(spark):
    p = plan(entry.queries()["p1_found"](spark, SF))
    assert p.count("partial_max") >= 1
