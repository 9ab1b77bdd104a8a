"""Stored tables by period, deliveries for a broker, and scratch folders."""

import os

import pytest
from pyspark.sql import functions as F

from reckon.operators.scale import broadcast_if, materialize, measured, scratch
from reckon.schemas import TABLES
from reckon.sources import landing, tables


def test_stored_tables_by_day_and_month(spark, tmp_path):
    tables.create_tables(spark, "reckon_test", str(tmp_path))
    tables.create_tables(spark, "reckon_test", str(tmp_path))
    assert {r.tableName for r in spark.sql("SHOW TABLES IN reckon_test").collect()} == set(TABLES)
    rows = spark.sql("SELECT DATE'2026-01-31' AS as_of_date, 'eur' AS currency, 1L AS pending, 2 AS available, '{}' AS payload UNION ALL SELECT DATE'2026-02-01', NULL, NULL, NULL, NULL")
    tables.insert(rows, "reckon_test", "reported_balance")
    assert sorted(d for d in os.listdir(tmp_path / "reported_balance") if "=" in d) == ["as_of_date_month=2026-01-01", "as_of_date_month=2026-02-01"]
    back = tables.stored(spark, "reckon_test", "reported_balance")
    assert sorted(r.as_of_date.day for r in back.collect()) == [1, 31] and "as_of_date_month" not in back.columns
    log = spark.sql("SELECT 'r' AS run_id, TIMESTAMP'2026-03-05 01:00:00' AS closed_at, DATE'2026-03-04' AS close_date, 'eur' AS currency, 1L AS balance_pending, 1L AS balance_available, 0L AS gross_sales, 0L AS refunds, 0L AS processing_fees, 0L AS disputes")
    tables.insert(log, "reckon_test", "daily_close_log")
    plan = spark.table("reckon_test.daily_close_log").where("closed_at_month = DATE'2026-03-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(closed_at_month" in plan
    tables.drop_tables(spark, "reckon_test")
    assert not spark.catalog.databaseExists("reckon_test")


def test_deliveries_for_a_broker(spark):
    payloads = spark.createDataFrame([('{"id":"e1","type":"t","data":{"object":{"id":"o","charge":"c"}}}',), ('{"id":"e2"}',), ('{"type":"x"}',)], "payload string")
    rows = {bytes(r.key).decode(): r for r in landing.broker_rows(payloads).collect()}
    assert set(rows) == {"c", "e2", "unknown"}
    assert [(h.key, bytes(h.value)) for h in sorted(rows["c"].headers)] == [("event_id", b"e1"), ("event_type", b"t")]
    assert [bytes(h.value) for h in sorted(rows["unknown"].headers)] == [b"", b"x"]
    sent = landing.publish_to_broker(payloads.unionByName(payloads.limit(1)), "nowhere:9092", "topic", dry_run=True)
    assert {r.key: r.deliveries for r in sent.collect()} == {"c": 2, "e2": 1, "unknown": 1}
    with pytest.raises(Exception, match="not a JSON object"):
        landing.publish_to_broker(spark.createDataFrame([("{broken",)], "payload string"), "nowhere:9092", "topic", dry_run=True).collect()


def test_directories_and_lines(spark, tmp_path):
    (tmp_path / "b.json").write_text('{"id": 2,\n "x": 1}\n')
    (tmp_path / "a.json").write_text('{"id": 1}')
    (tmp_path / "note.md").write_text("no")
    assert [r.payload for r in landing.lines(spark, str(tmp_path)).collect()] == ['{"id": 1}', '{"id": 2,\n "x": 1}']


def test_months_on_a_stream(spark, tmp_path):
    spark.sql("SELECT TIMESTAMP'2026-05-17 00:00:00' AS t, 1 AS x").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("t timestamp, x int").parquet(str(tmp_path / "in"))
    landing.append(stream, str(tmp_path / "out"), str(tmp_path / "c"), by="t", unit="month").awaitTermination()
    assert (tmp_path / "out" / "t_month=2026-05-01").is_dir()


def test_broadcasts_are_measured_in_bytes(spark):
    wide = spark.range(100).select(F.repeat(F.lit("x"), 1000).alias("s"), F.array(F.lit("y")).alias("a"))
    assert measured(wide, 200_000)[1] and not measured(wide, 50_000)[1]
    assert measured(wide.limit(0), 10_000)[1]
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan(broadcast_if(wide)) and "broadcast" not in plan(broadcast_if(wide, 1))


def test_scratch_goes_with_its_block(spark):
    with scratch(spark) as folder:
        assert materialize(spark.range(5)).count() == 5
        path = folder.removeprefix("file:")
        assert os.listdir(path)
    assert not os.path.exists(path)
