"""Streams drained from files: landing, exact dedup under replay, kept state, K-slack."""

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from reckon.operators import changes, events, lateness
from reckon.sources import landing
from reckon.sources.store import Store
from reckon.streaming import feeds

LINES = [f'{{"id":"evt_{i % 7}","type":"charge.updated","created":{1000 + i},"data":{{"object":{{"id":"ch_{i % 3}","object":"charge","charge":"ch_{i % 3}"}}}}}}' for i in range(20)]


def test_publish_land_and_collapse(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text("\n".join(LINES[:10]) + "\n\n  \n")
    (tmp_path / "more.jsonl").write_text("\n".join(LINES[10:]))
    for f in ("in.jsonl", "more.jsonl"):
        landing.publish(landing.lines(spark, str(tmp_path / f)), str(tmp_path / "topic"))
    schema = "key string, value string, partition int, offset bigint, timestamp timestamp"
    stream = landing.table_stream(spark, str(tmp_path / "topic"), schema, files_per_batch=1)
    bronze = events.envelope(stream.withColumnsRenamed({"partition": "kafka_partition", "offset": "kafka_offset", "timestamp": "kafka_timestamp"}), carry=("kafka_partition", "kafka_offset", "kafka_timestamp"))
    landing.append(bronze, str(tmp_path / "bronze"), str(tmp_path / "c1")).awaitTermination()
    landed = spark.read.parquet(str(tmp_path / "bronze"))
    assert landed.count() == 20 and sorted(r[0] for r in landed.select("payload").collect()) == sorted(LINES)
    typed = events.typed(spark.readStream.schema(landed.schema).parquet(str(tmp_path / "bronze")))
    for checkpoint in ("c2", "c3"):  # a second run replays every batch under its number
        feeds.log_batches(typed, str(tmp_path / "log"), str(tmp_path / checkpoint)).awaitTermination()
    one = feeds.collapsed_log(spark, str(tmp_path / "log"))
    assert one.count() == 7 and one.agg(F.sum("deliveries")).first()[0] == 20


def test_malformed_payload_stops_publishing(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text('{"id":"a"}\n{broken')
    try:
        landing.publish(landing.lines(spark, str(tmp_path / "in.jsonl")), str(tmp_path / "topic"))
    except Exception as e:
        assert "not a JSON object" in str(e)
    else:
        raise AssertionError("it should have stopped")


def test_state_of_a_feed(spark, tmp_path):
    feed = changes.Feed(key=["k"], order=["t", "id"], deletes="op = 'd'")
    rows = [("a", 3, "3", "d"), ("b", 1, "1", "i"), ("a", 1, "1", "i"), ("b", 2, "2", "u"), ("c", 1, "1", "i")]
    for i, r in enumerate(rows):
        spark.createDataFrame([r], "k string, t int, id string, op string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, t int, id string, op string").option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    store = Store(spark, str(tmp_path / "store"))
    feeds.replayed_state(stream, store, "state", feed, [], str(tmp_path / "c")).awaitTermination()
    assert sorted((r.k, r.t) for r in store.read("state").where("NOT deleted").collect()) == [("b", 2), ("c", 1)]
    again = store.read("state")
    for _ in range(2):
        store.append("state", again, token="t1")
    assert store.read("state").count() == 6
    store.drop("state")
    assert not store.exists("state")


def drained(spark, folder, batches, schema):
    """A stream that gives each batch of rows in a micro-batch of its own."""
    folder.mkdir()
    for i, b in enumerate(batches):
        spark.createDataFrame(b, schema).coalesce(1).write.parquet(str(folder / f"b{i}"))
        (made,) = [f for f in (folder / f"b{i}").iterdir() if f.suffix == ".parquet"]
        (folder / "all").mkdir(exist_ok=True)
        made.rename(folder / "all" / f"b{i}.parquet")
        os.utime(folder / "all" / f"b{i}.parquet", (1_000_000 + i, 1_000_000 + i))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder / "all"))


def test_kept_state_waits_for_its_watermark(spark, tmp_path):
    schema = "k string, n long, id string, op string, size int"
    feed = changes.Feed(key=["k"], order=["n", "id"], deletes="op = 'd'", transaction=["n"], declared="size", sequence="n")
    batches = [[("a", 2, "2", "i", 1), ("b", 1, "1", "i", 2)], [("c", 1, "9", "i", 2)], [("d", 4, "4", "i", 1), ("a", 2, "2", "i", 1)], [("a", 3, "3", "d", 1)]]
    wants = [[], ["a", "b", "c"], ["a", "b", "c"], ["b", "c", "d"]]
    for i, want in enumerate(wants):
        store = Store(spark, str(tmp_path / f"store{i}"))
        feeds.replayed_state(drained(spark, tmp_path / f"in{i}", batches[: i + 1], schema), store, "s", feed, [], str(tmp_path / f"c{i}"), buckets=4).awaitTermination()
        assert sorted(r.k for r in store.read("s").where("NOT deleted").collect()) == want
    assert store.note("s") == {"watermark": 4} and store.read("s_held").count() == 0
    feeds.replayed_state(drained(spark, tmp_path / "again", batches, schema), store, "s", feed, [], str(tmp_path / "c_again"), buckets=4).awaitTermination()
    assert sorted(r.k for r in store.read("s").where("NOT deleted").collect()) == wants[-1]


def test_store_survives_a_writer_that_died(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    for n in (1, 2, 3, 4):
        store.replace("x", spark.range(n))
    folder = tmp_path / "x"
    assert len(list((folder / "_manifests").glob("*.json"))) == 2 and len(list(folder.glob("v-*"))) == 2
    (folder / "_manifests" / "000000000005.json").write_text('{"parts": {"v')
    assert store.read("x").count() == 4
    store.replace("x", spark.range(9))
    assert store.read("x").count() == 9


def test_kslack_equals_the_batch_form(spark, tmp_path):
    rng = random.Random(4)
    t0 = dt.datetime(2026, 1, 1)
    rows = []
    for i in range(300):
        t = t0 + dt.timedelta(seconds=rng.choice([rng.randint(0, 3 * 86_400), 5_000]))
        for _ in range(rng.choice([1, 1, 2])):
            rows.append((f"e{i}", t, t + dt.timedelta(hours=rng.choice([0, 5, 20, 30, 40, 60, 90]))))
    rows.sort(key=lambda r: r[2])
    rows.append((None, t0, t0))
    schema = "id string, t timestamp_ntz, a timestamp_ntz"
    closed = lateness.closings(spark.createDataFrame([(dt.date(2026, 1, d), dt.datetime(2026, 1, d + 1, 2)) for d in (1, 2)], "d date, at timestamp_ntz"), period="d", closed_at="at")
    want = lateness.ordered_values(lateness.buffered(lateness.first_arrivals(spark.createDataFrame(rows, schema), id="id", event_time="t", arrival="a"), closed, 24)).collect()
    out = [tuple(r) for r in want]
    assert len(out) == 2 and all(r.too_late > 0 and r.provisional_events < r.final_events for r in want)
    for name, batches in (("one", [rows]), ("many", [rows[i : i + 80] for i in range(0, len(rows), 80)])):
        stream = drained(spark, tmp_path / name, batches, schema)
        slots = feeds.kslack(stream, closed, id="id", event_time="t", arrival="a", bound_hours=24, delay="2 hours", slot_seconds=7200, lanes=2)
        feeds.log_batches(slots, str(tmp_path / f"log-{name}"), str(tmp_path / f"c-{name}")).awaitTermination()
        assert sorted(map(tuple, feeds.slack_values(spark, str(tmp_path / f"log-{name}")).collect())) == sorted(out)
        assert spark.read.parquet(str(tmp_path / f"log-{name}")).where("released AND version = 'final'").count() > 0
