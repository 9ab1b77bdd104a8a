"""The gated build, the simulated run, every fault arm, the verdict and the export."""

import json

import pytest
from pyspark.sql import functions as F

from reckon.plans import chaos, report, simulate, suite, waves
from reckon.plans.build import CHECKS, COLUMNS, DATASETS, build

RUN = simulate.Run(seed=5, charges=400, days=10)


@pytest.fixture(scope="module", autouse=True)
def small_plans(spark):
    """Hundreds of tiny jobs: compiling their code would take longer than running them."""
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.unset("spark.sql.codegen.wholeStage")
    spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.fixture(scope="module")
def wave(spark):
    moved = simulate.movements(spark, RUN).cache()
    return chaos.Wave(simulate.event_lines(spark, RUN).cache(), moved, simulate.reported(moved).cache())


def test_run_is_determined_by_its_seed(spark, wave):
    again = simulate.movements(spark, RUN)
    assert again.exceptAll(wave.movements.select(*again.columns)).count() == 0
    other = simulate.movements(spark, simulate.Run(seed=6, charges=400, days=10))
    assert other.exceptAll(again).count() > 0


def test_identities_of_a_run(wave):
    n = {r.reporting_category: r["count"] for r in wave.movements.groupBy("reporting_category").count().collect()}
    assert n["charge"] == 400 and wave.events.count() == 4 * (n["charge"] + n["refund"] + n["dispute"])
    assert wave.events.select("position").distinct().count() == wave.events.count()
    lines = simulate.stream_lines(wave.movements.sparkSession, RUN, wave.reported)
    assert lines.count() == 4 * (n["charge"] + n["refund"] + n["dispute"]) + wave.reported.count()
    last = wave.reported.orderBy(F.desc("as_of_date")).first()
    assert last.pending == 0 and last.available == wave.movements.agg(F.sum("net")).first()[0]


def test_arms_damage_one_side_only(wave):
    same = lambda a, b: a.select(*b.columns).exceptAll(b).count() == 0 == b.exceptAll(a.select(*b.columns)).count()
    for arm in ("duplicate_delivery", "out_of_order", "dropped_event"):
        (w,) = chaos.ARMS[arm](wave)
        assert same(w.movements, wave.movements)
        assert w.events.select("line").distinct().exceptAll(wave.events.select("line").distinct()).count() == 0
    for arm in ("rounding_drift", "reversal_dropped", "unreported_transaction"):
        (w,) = chaos.ARMS[arm](wave)
        assert same(w.events, wave.events) and not same(w.movements, wave.movements)
    first, second = chaos.late_arrival(wave)
    assert first.events.count() + second.events.count() == wave.events.count() and first.movements.count() < second.movements.count()


def test_identifier_lookup_equals_a_scan(spark, wave):
    ids = spark.createDataFrame([("ch_s7",), ("pi_s12",), ("du_s1",)], "id string")
    got = {r[0] for r in chaos.naming(wave.events, ids, "id").collect()}
    import re

    want = {r.position for r in wave.events.collect() if {"ch_s7", "pi_s12", "du_s1"} & set(re.findall("[a-z]+_[A-Za-z0-9]+", r.line))}
    assert got == want and got


@pytest.mark.parametrize("arms", [["duplicate_delivery", "out_of_order", "dropped_event", "rounding_drift"], ["reversal_dropped", "unreported_transaction", "late_arrival"]])
def test_each_arm_is_caught_by_its_check_alone(spark, arms):
    got = suite.judge(spark, RUN, arms)
    assert {a: v.against for a, v in got.items()} == dict.fromkeys(["baseline", *arms], [])
    for arm, v in got.items():
        assert all(v.injected[c] > 0 for c in chaos.MUST_FAIL[arm].values() if c) and v.document(arm)["as_described"]


def test_verdict_is_strict_both_ways():
    assert chaos.verdict({}, {"c": None}, {}, {}) == ["c should have failed"]
    assert chaos.verdict({"c": 2}, {}, {}, {}) == ["c failed on 2 rows, not declared"]
    assert chaos.verdict({"c": 2}, {"c": 3}, {}, {}) == ["c failed on 2 rows, declared 3"]
    assert chaos.verdict({"c": 3}, {"c": 3}, {"m": None}, {"m": "=null"}) == []
    assert chaos.verdict({}, {}, {"m": None}, {"m": "=0"}) and chaos.verdict({}, {}, {"m": 0}, {"m": "=null"})
    assert not chaos.verdict({}, {}, {"m": None}, {"m": "="}, {"m": None}) and chaos.verdict({}, {}, {"m": None}, {"m": "="}, {"m": 1})
    assert not chaos.verdict({}, {}, {"m": 2, "n": 1}, {"m": ">n"}) and chaos.verdict({}, {}, {"m": 2, "n": 2}, {"m": ">n"})
    assert chaos.expected("rounding_drift", {"drifted_transactions": 7}) == {"entries_balance": 7}


def test_a_failed_check_stops_what_stands_on_it(spark, wave):
    (bad,) = chaos.rounding_drift(wave)
    empty = spark.createDataFrame([], "balance_transaction_id string, source_id string, reporting_category string, net bigint, currency string, created timestamp")
    silver = spark.createDataFrame([], "entity_type string, entity_id string, deliveries int")
    r = build({"list": bad.movements, "reported": bad.reported, "events": silver, "expanded": empty}, "x")
    assert "entries_balance" in r.failed and {"postings", "coverage_gaps"} <= set(r.frames)
    assert {"daily_close", "balances", "money_flow", "close_log", "restatements", "weighed", "reconciliation", "reconciliation_items"} == set(r.skipped)
    assert sum(len(n) + len(u) + len(a) for n, u, a in COLUMNS.values()) == 42
    assert len({c.name for c in CHECKS}) == len(CHECKS) and len({d.name for d in DATASETS}) == len(DATASETS)
    assert report.measure(r.frames)["gold_close_rows"] is None and report.measure(r.frames)["gold_postings"] > 0


def frames(spark, balance=0, unexplained=0, day="2026-01-01", amount=5):
    a = spark.createDataFrame([("x", "eur", amount + balance, 1), ("y", "eur", -amount, 1)], "account string, currency string, balance bigint, postings bigint")
    f = spark.createDataFrame([("y", "x", "eur", amount)], "source string, target string, currency string, amount bigint")
    w = spark.createDataFrame([(day, "eur", 1, 1, 0, unexplained, True, True)], "close_date string, currency string, ledger_total bigint, reported_total bigint, total_difference bigint, unexplained_difference bigint, ledger_closed_the_day boolean, processor_reported_the_day boolean")
    return {"balances": a, "money_flow": f, "reconciliation": w.withColumn("close_date", F.expr("try_cast(close_date AS date)")) if day[0] == "2" else w}


def arm(name, against=(), run=1):
    return suite.Verdict(list(against), {"n": 1}, {"gold_postings": 5, "list_transactions": 9}, {"seed": run} if run else {}).document(name)


def test_export_and_its_refusals(spark):
    good = report.export(frames(spark), {"simulated": True, "seed": 1}, [arm("baseline")], ["baseline"])
    assert set(good) == {"accounts", "flow", "reconciliation", "chaos", "manifest"} and '"simulated": true' in good["flow"]
    assert good == report.export(frames(spark), {"simulated": True, "seed": 1}, [arm("baseline")])
    assert json.loads(good["chaos"])["arms"][0]["counts"]["gold_postings"] == 5 and json.loads(good["manifest"])["chaos_run"] == {"seed": 1}
    assert json.loads(good["reconciliation"])["rows"][0]["ledger_closed_the_day"] is True and json.loads(good["accounts"])["total"] == 0
    for bad in (frames(spark, balance=1), frames(spark, unexplained=1), frames(spark, day="x")):
        with pytest.raises(report.Refused):
            report.export(bad, {})
    with pytest.raises(report.Refused):
        report.export(frames(spark), {"rate": 0.5})
    for arms, names in (([arm("baseline")], ["baseline", "other"]), ([arm("baseline", ["x"])], None), ([arm("a"), arm("b", run=2)], None), ([arm("a", run=0)], None)):
        with pytest.raises(report.Refused):
            report.export(frames(spark), {}, arms, names)
    with pytest.raises(report.Refused):
        report.export({"balances": spark.range(1)}, {})
    with pytest.raises(report.Refused):
        report.export({"balances": spark.range(report.MOST_ROWS + 1).selectExpr("'a' AS account", "'e' AS currency", "0L AS balance", "1L AS postings")}, {})
    late = {"balances": frames(spark)["balances"], "money_flow": frames(spark, amount=6)["money_flow"]}
    with pytest.raises(report.Refused):
        report.export(late, {})


def test_waves_as_files(spark, tmp_path):
    run = simulate.Run(seed=3, charges=60, days=5)
    told = waves.write_run(spark, run, str(tmp_path / "run"))
    assert told == waves.read_json(spark, str(tmp_path / "run" / "run.json")) == waves.write_run(spark, run, str(tmp_path / "again"))
    n = {c: told["counts"][c] for c in waves.ARTIFACTS}
    moved = simulate.movements(spark, run)
    kinds = moved.select("source_id").distinct().count()
    assert n["balance_transactions"] == moved.count() and n["events"] == 4 * kinds + n["daily_balance"]
    back = waves.read_wave(spark, str(tmp_path / "run"))
    want = [r.line for r in simulate.stream_lines(spark, run, simulate.reported(moved)).orderBy("position").collect()]
    assert [r.line for r in back.events.orderBy("position").collect()] == want
    assert back.movements.drop("payload", "loaded_at").exceptAll(moved.drop("payload", "loaded_at")).count() == 0
    assert waves.write_wave(back, str(tmp_path / "copy")) == {"counts": told["counts"], "sha256": told["sha256"]}
    damaged = waves.write_scenario(spark, "rounding_drift", str(tmp_path / "run"), str(tmp_path / "arm"), 1)
    assert damaged["waves"][0]["sha256"]["events"] == told["sha256"]["events"] == damaged["source_run"]["events"]
    assert damaged["expect"]["failures"] == {"entries_balance": damaged["injected"]["drifted_transactions"]}
    with pytest.raises(FileNotFoundError):
        waves.read_wave(spark, str(tmp_path / "nothing"))


def test_digest_depends_on_order_and_lines_alone(spark, monkeypatch):
    monkeypatch.setattr(waves, "BLOCK", 3)
    rows = spark.createDataFrame([(i, f"line {i}") for i in range(1, 11)], "no long, line string")
    assert waves.sha256(rows) == waves.sha256(rows.repartition(4))
    assert waves.sha256(rows) != waves.sha256(rows.replace("line 3", "line 33"))
    assert waves.sha256(rows) != waves.sha256(rows.withColumn("no", 11 - F.col("no")))
