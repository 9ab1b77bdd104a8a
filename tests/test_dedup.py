"""One copy of each message against a dictionary, on each path."""

import random

import pytest

from reckon.operators import dedup

SCHEMA = "id string, t int, n int, body string, copies long, row string, rank int"


def rows_of(seed, n):
    rng = random.Random(seed)
    return [(rng.choice([None, "HOT", "HOT", f"m{rng.randint(0, n)}"]), rng.choice([None, 1, 2]), rng.choice([1, 2]), rng.choice([None, "", "b", "c" * 5000]), 0, "r", 1) for _ in range(n)]


def check(spark, rows, stored=None, most_bytes=dedup.MOST_BYTES):
    new = spark.createDataFrame(rows, SCHEMA).repartition(3)
    old = None if stored is None else spark.createDataFrame(stored, SCHEMA)
    out = [tuple(r) for r in dedup.one_of_each(new, id="id", order=["t", "n"], stored=old, most_bytes=most_bytes).collect()]
    every = rows + (stored or [])
    assert len([r for r in out if r[0] is None]) == len([r for r in every if r[0] is None])
    named = [r for r in out if r[0] is not None]
    assert sorted(r[0] for r in named) == sorted({r[0] for r in every if r[0] is not None})
    for r in named:
        own = [(x[1] is not None, x[1] or 0, x[2]) for x in every if x[0] == r[0]]
        assert r in every and (r[1] is not None, r[1] or 0, r[2]) == min(own)
    return sorted(map(str, out))


@pytest.mark.parametrize("path", ["broadcast", "shuffle with hot ids", "shuffle"])
def test_against_a_dictionary(spark, monkeypatch, path):
    most = dedup.MOST_BYTES if path == "broadcast" else 0
    monkeypatch.setattr(dedup, "HOT_IDS", 3 if path == "shuffle with hot ids" else 0)
    rows = rows_of(1, 200)
    a = check(spark, rows, most_bytes=most)
    random.Random(2).shuffle(rows)
    assert check(spark, rows, most_bytes=most) == a == check(spark, rows)
    check(spark, rows_of(3, 50), stored=rows, most_bytes=most)


def test_shuffled_halves_share_one_exchange(spark, monkeypatch):
    monkeypatch.setattr(dedup, "HOT_IDS", 3)
    df = spark.createDataFrame(rows_of(4, 200), SCHEMA)
    out = dedup.one_of_each(df, id="id", order=["t", "n"], most_bytes=0)
    out.collect()
    assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()


def test_maps_and_ties_across_all_columns(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', 1, map('k', 2), 'z'), ('a', 1, map('k', 2), 'y'), ('a', 1, map('k', 3), 'x') AS t(id, t, m, b)")
    for most in (0, dedup.MOST_BYTES):
        assert [(r.m, r.b) for r in dedup.one_of_each(df, id="id", order=["t"], most_bytes=most).collect()] == [({"k": 2}, "y")]


def test_empty_and_fully_equal(spark):
    assert check(spark, []) == []
    one = ("a", 1, 1, "x", 0, "r", 1)
    assert len(check(spark, [one] * 5)) == 1


def test_copies_are_counted(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 1)], "id string, t int")
    out = dedup.one_of_each(df, id="id", order=["t"], copies="n").collect()
    assert sorted((r.id or "", r.t, r.n) for r in out) == [("", 1, 1), ("", 1, 1), ("a", 1, 2), ("b", 1, 1)]
