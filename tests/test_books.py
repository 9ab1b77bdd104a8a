"""Ledger, close, reconciliation and checks on small hand-made inputs."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from reckon.functions import money, privacy
from reckon.operators import checks, close, entities, events, ledger, recon, upsert

LIST = "balance_transaction_id string, source_id string, type string, reporting_category string, amount bigint, fee bigint, net bigint, currency string, created timestamp_ntz, available_on timestamp_ntz, status string, description string, fee_details array<struct<amount: bigint, currency: string, description: string, type: string>>, payload string, loaded_at timestamp_ntz"
D = lambda d, h=0, m=0, s=0: dt.datetime(2026, 1, d, h, m, s)


def movement(id, category, amount, fee, created=D(1), available=D(8), currency="eur", loaded=D(1), source=None):
    return (id, source or f"src_{id}", category, category, amount, fee, amount - fee, currency, created, available, "available", None, None, "{}", loaded)


def listed(spark, *rows):
    return spark.createDataFrame(list(rows), LIST)


def test_postings_close_forms_and_balances(spark):
    m = listed(spark, movement("a", "charge", 100, 4), movement("b", "refund", -50, 0), movement("c", "payout", -20, 0), movement("d", "dispute", -30, 15), movement("z", "charge", 10, 0))
    p = ledger.postings(m)
    assert p.count() == 5 * 2 + 4 * 3 and p.select("entry_id").distinct().count() == 10
    assert checks.entries_balance(p).count() == 0
    t = {r.account: r.balance for r in ledger.trial_balance(p).collect()}
    assert sum(t.values()) == 0 and t["asset:balance_pending"] == 0 and t["revenue:gross_sales"] == -110 and t["asset:bank"] == 20


def test_missing_and_unknown_category(spark):
    p = ledger.postings(listed(spark, movement("n", None, 10, 0), movement("u", "novel", 7, 0)))
    assert [r.entry_id for r in checks.entries_balance(p).collect()] == ["n:recognition"]
    bad = checks.columns(p, accepted={"account": ["asset:balance_pending", "asset:balance_available"]}).collect()
    assert [(r.check, r.column_name, r.violations) for r in bad] == [("accepted_values", "account", 1)]


def test_fee_above_amount_has_two_sources(spark):
    p = ledger.postings(listed(spark, movement("t", "charge", 10, 25)))
    assert [(r.entry_id, r.source_legs) for r in checks.one_source_leg(p).collect()] == [("t:recognition", 2)]


def test_midnight_and_month_end(spark):
    p = ledger.postings(listed(spark, movement("a", "charge", 9, 1, created=D(31, 23, 59, 59), available=dt.datetime(2026, 2, 7)), movement("b", "charge", 9, 1, created=dt.datetime(2026, 2, 1), available=dt.datetime(2026, 2, 8))))
    days = {r.close_date: r for r in close.daily_close(p).collect()}
    assert len(days) == 9 and days[dt.date(2026, 1, 31)].gross_sales == 9 and days[dt.date(2026, 2, 1)].balance_pending == 16
    assert days[dt.date(2026, 2, 8)].balance_available == 16


def test_empty_inputs(spark):
    m = listed(spark)
    p = ledger.postings(m)
    d = close.daily_close(p)
    rep = spark.createDataFrame([], "as_of_date date, currency string, pending bigint, available bigint")
    w = recon.reconciliation(d, rep, m, p)
    for df in (p, d, close.day_grid(p), ledger.flow(p), w, recon.items(w, m, p)):
        assert df.count() == 0


def test_two_currencies_on_other_days(spark):
    p = ledger.postings(listed(spark, movement("a", "charge", 5, 0, available=D(2)), movement("b", "charge", 7, 0, created=D(3), available=D(4), currency="usd")))
    assert close.day_grid(p).count() == 8
    rep = spark.createDataFrame([(dt.date(2026, 1, 5), "eur", 0, 5), (dt.date(2026, 1, 1), "eur", 5, 0)], "as_of_date date, currency string, pending bigint, available bigint")
    w = recon.reconciliation(close.daily_close(p), rep, listed(spark), p)
    assert w.count() == 9 and w.where("NOT ledger_closed_the_day").count() == 1 and w.where("NOT processor_reported_the_day").count() == 7


def test_flow_nets_both_ways_and_conserves(spark):
    p = ledger.postings(listed(spark, movement("a", "charge", 100, 4), movement("r", "refund", -30, 0), movement("v", "dispute_reversal", 20, 0), movement("d", "dispute", -50, 0)))
    f = ledger.flow(p)
    assert checks.flow_conserves(f, ledger.trial_balance(p)).count() == 0
    assert f.where("amount <= 0").count() == 0
    twice = p.unionByName(p)
    assert checks.flow_conserves(ledger.flow(twice), ledger.trial_balance(twice)).count() > 0


def test_restatements(spark):
    early = [movement("a", "charge", 100, 0, created=D(1), available=D(3), loaded=D(1))]
    late = movement("b", "charge", 40, 0, created=D(2), available=D(3), loaded=D(5))
    first = close.log_rows(close.daily_close(ledger.postings(listed(spark, *early))), "r1", D(4))
    m = listed(spark, *early, late)
    second = close.log_rows(close.daily_close(ledger.postings(m)), "r2", D(6))
    log = first.unionByName(second)
    got = {r.close_date.day: r for r in close.restatements(log, m, with_causes=True).collect()}
    assert set(got) == {2, 3} and got[2].pending_movement == 40 and got[3].available_movement == 40
    assert all(r.fully_explained_by_what_arrived_late and r.caused_by == ["b"] and r.late_transactions == 1 for r in got.values())
    assert close.restatements(first, m).count() == 0
    links = close.restatement_causes(close.restatements(log, m), log, m).collect()
    assert sorted((r.close_date.day, r.balance_transaction_id, r.touched_the_day_by) for r in links) == [(2, "b", "created"), (3, "b", "matured")]
    unexplained = close.restatements(log, listed(spark, *early), with_causes=True)
    assert checks.restatement_explained(unexplained).count() == 2 and [r.caused_by for r in unexplained.collect()] == [[], []]


def test_every_run_restates_by_what_it_loaded(spark):
    days = [movement(f"m{i}", "charge", 10 * (i + 1), 0, created=D(1 + i % 3), available=D(2 + i % 4), loaded=D(1 + i)) for i in range(6)]
    days += [movement("n", "charge", 7, 0, created=D(4), available=D(2), loaded=D(3))]
    log = None
    for run, at in enumerate((D(2, 12), D(4, 12), D(4, 13), D(9))):
        known = [m for m in days if m[14] <= at]
        rows = close.log_rows(close.daily_close(ledger.postings(listed(spark, *known))), f"r{run}", at)
        log = rows if log is None else log.unionByName(rows)
    got = close.restatements(log, listed(spark, *days), all_runs=True).collect()
    assert {r.restated_at for r in got} == {D(4, 12), D(9)} and all(r.late_transactions >= 0 for r in got)
    # A movement that is available before it is created never was pending by attribution, but is by the ledger.
    assert all(r.fully_explained_by_what_arrived_late for r in got if r.restated_at == D(9))
    last = {(r.close_date, r.late_pending_effect, r.late_available_effect) for r in got if r.restated_at == D(9)}
    assert last == {(r.close_date, r.late_pending_effect, r.late_available_effect) for r in close.restatements(log, listed(spark, *days)).collect()} | last


def test_refresh_list_keeps_loading_time_and_takes_nulls(spark):
    old, new = movement("a", "charge", 5, 0, loaded=D(1)), list(movement("a", "refund", 6, 0, loaded=D(9)))
    new[10] = None
    out = upsert.refresh_list(listed(spark, old, movement("k", "charge", 1, 0)), listed(spark, tuple(new), movement("n", "charge", 2, 0, loaded=D(9)))).collect()
    got = {r.balance_transaction_id: r for r in out}
    assert set(got) == {"a", "k", "n"} and got["a"].loaded_at == D(1) and got["a"].status is None and got["a"].amount == 6 and got["n"].loaded_at == D(9)


BRONZE = "event_id string, event_type string, created timestamp, livemode boolean, api_version string, request_id string, idempotency_key string, payload string, kafka_partition int, kafka_offset bigint, kafka_timestamp timestamp"


def test_typing_and_collapse(spark):
    body = lambda o, x="": f'{{"id":"e","data":{{"object":{o}}}{x}}}'
    rows = [
        ("e1", "charge.refund.updated", body('{"id":"re_1","object":"refund","charge":"ch_1","amount":1.5,"created":86400}'), 1, 5),
        ("e1", "charge.refund.updated", body('{"id":"re_1","object":"refund","charge":"ch_1","amount":"7"}'), 1, 4),
        ("e2", "charge.updated", body('{"id":"ch_2","object":"charge","amount":10,"balance_transaction":{"id":"txn_9","object":"balance_transaction"}}'), 0, 1),
        ("e3", "balance.available", body('{"available":[]}'), 0, 2),
        (None, None, "{broken", 0, 3),
    ]
    df = spark.createDataFrame([(i, t, D(1), False, "v", None, None, p, a, b, D(2)) for i, t, p, a, b in rows], BRONZE)
    typed = {(r.event_id, r.kafka_offset): r for r in events.typed(df).collect()}
    assert typed["e1", 5].amount is None and typed["e1", 4].amount is None and typed["e1", 5].entity_type == "refund" and typed["e1", 5].charge_id == "ch_1"
    assert typed["e1", 5].entity_created == dt.datetime(1970, 1, 2)
    assert typed["e2", 1].balance_transaction_id == "txn_9" and typed["e2", 1].charge_id == "ch_2"
    assert typed["e3", 2].entity_type == "balance" and typed["e3", 2].entity_id is None
    one = {r.event_id: r for r in events.collapse(events.typed(df)).collect()}
    assert set(one) == {"e1", "e2", "e3"} and one["e1"].deliveries == 2 and '"7"' in one["e1"].payload
    assert events.quarantined(df).count() == 1
    late = events.collapse(events.typed(df.where("event_id = 'e1'")))
    merged = {r.event_id: r for r in events.merge_events(events.collapse(events.typed(df)), late).collect()}
    assert merged["e1"].deliveries == 4 and merged["e1"].payload == one["e1"].payload and merged["e2"].deliveries == 1


def test_partition_keys(spark):
    bodies = ['{"id":"e","data":{"object":{"charge":"ch_1","id":"x"}}}', '{"id":"e","data":{"object":{"charge":"","payment_intent":"pi_1"}}}', '{"id":"e","data":{"object":{"charge":{"id":"ch"},"id":"x"}}}', '{"id":"e"}', "{", ""]
    got = [r[0] for r in spark.createDataFrame([(b,) for b in bodies], "payload string").select(events.partition_key("payload")).collect()]
    assert got == ["ch_1", "pi_1", "x", "e", "unknown", "unknown"]


def test_latest_breaks_ties_by_id(spark):
    df = spark.createDataFrame([("e1", "b", D(1), "charge", 1), ("e2", "b", D(1), "charge", 2), ("e0", "b", D(1), "charge", 3), ("e9", None, D(2), "charge", 4), ("e9", "r", D(2), "refund", 4)], "event_id string, entity_id string, created timestamp, entity_type string, amount int")
    r = entities.latest(df, "charge", ["amount"]).collect()
    assert [(x.entity_id, x.event_id, x.amount, x.events) for x in r] == [("b", "e2", 2, 3)]


def test_half_up(spark):
    values = [(n, d, money.half_up(F.lit(n).cast("long"), d)) for n in (0, 1, 149, 150, 151, -149, -150, -151, 2**61) for d in (1, 100, 300)]
    row = spark.range(1).select(*[v.alias(str(i)) for i, (_, _, v) in enumerate(values)]).first()
    assert list(row) == [(1 if n >= 0 else -1) * ((2 * abs(n) + d) // (2 * d)) for n, d, _ in values]
    assert spark.range(1).select(money.settled(F.lit(100), 86), money.half_up(F.lit(None).cast("long"), 3)).first()[:] == (86, None)


def test_privacy(spark):
    df = spark.createDataFrame([('{"a":{"livemode": true},"email":"x\\"y","name":null}',), ('{"livemode":false}',), (None,)], "p string")
    assert [r[0] for r in df.select(privacy.is_live("p")).collect()] == [True, False, False]
    assert df.select(privacy.blanked("p", ["email", "name"])).first()[0] == '{"a":{"livemode": true},"email":"","name":null}'
    body = '{"account":"acct_1Ab","email":"x@y.z","receipt_url":"https://pay.example.com/receipts/a/b?t=1","amount":5}'
    one = spark.createDataFrame([(body,), (None,)], "p string")
    want = f'{{"account":"{privacy.ACCOUNT}","email":"","receipt_url":"{privacy.RECEIPT}","amount":5}}'
    assert [r[0] for r in one.select(privacy.redacted("p", ["email"])).collect()] == [want, None]
    for guard in (privacy.redacted("p", ["email"]), privacy.test_mode("p")):
        with pytest.raises(Exception, match="live mode"):
            df.select(guard).collect()
    assert privacy.masked("key sk_test_123abc and whsec_x-1 stay") == "key sk_*** and whsec_*** stay"
    import hashlib
    import hmac

    sign = lambda s, t: f"t={t},v1={hmac.new(s, f'{t}.'.encode() + b'body', hashlib.sha256).hexdigest()}"
    assert privacy.signed(b"body", sign(b"old", 1000), ["new", "old"], 1200)
    assert not privacy.signed(b"body", sign(b"old", 1000), ["old"], 1301)
    assert not privacy.signed(b"bodY", sign(b"old", 1000), ["old"], 1000) and not privacy.signed(b"body", "v1=1", ["old"], 1)
    assert not privacy.signed(b"body", sign(b"x", 1000), ["old"], 1000)


def test_leaks_are_named_and_the_repository_has_none(spark):
    key = "sk_" + "live_abc"
    texts = [(f"a {key}",), ("whsec" + "_" + "x" * 20,), ("acct" + "_12345678ab and me" + "@example.org",), ("acct_00000000000000",), (None,), ("https://pay.example.com/receipts" + "/abcd/efgh12345",)]
    got = [r[0] for r in spark.createDataFrame(texts, "t string").select(privacy.leaks("t")).collect()]
    assert got == [["live_key"], ["signing_secret"], ["account", "email"], [], [], ["receipt"]]
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.{py,md}").text([f"{root}/reckon", f"{root}/tests", f"{root}/README.md"])
    found = files.select("value", F.explode(privacy.leaks("value")).alias("leak")).collect()
    assert files.count() > 1000 and [r for r in found if r.leak != "email"] == []


def test_no_floating_types(spark):
    m = listed(spark, movement("a", "charge", 5, 0))
    p = ledger.postings(m)
    d = close.daily_close(p)
    for df in (p, d, ledger.trial_balance(p), ledger.flow(p)):
        assert not [t for _, t in df.dtypes if t.startswith(("double", "float", "decimal"))]


@pytest.mark.parametrize("unique,want", [(["k"], [("not_null", "v", 1), ("unique", "k", 1)])])
def test_column_checks(spark, unique, want):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 2), (None, 2)], "k string, v int")
    assert sorted((r.check, r.column_name, r.violations) for r in checks.columns(df, not_null=["v"], unique_columns=unique).collect()) == want
