"""Replay of change feeds against a plain loop, and the cases that its docstring defines."""

import random

from pyspark.sql import functions as F

from reckon.operators import changes

FEED = changes.Feed(key=["k"], order=["t", "id"], deletes="op = 'd'")
SCHEMA = "k string, t int, id string, op string, v int"


def brute(rows):
    state = {}
    for k, t, i, op, v in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] == "d", r[4] is not None, r[4] or 0)):
        if k is None:
            continue
        state[k] = (op, t, i, v)
    return sorted(((k, t, i, v) for k, (op, t, i, v) in state.items() if op != "d"), key=str)


def got(df):
    return sorted(((r.k, r.t, r.id, r.v) for r in df.select("k", "t", "id", "v").collect()), key=str)


def test_any_order_and_repeats_give_one_state(spark):
    rng = random.Random(3)
    base = [(rng.choice(["a", "b", "c", "HOT", "HOT", None]), rng.choice([None, 1, 2, 3, 4]), f"e{i}", rng.choice("iud"), rng.choice([None, 1, 2])) for i in range(300)]
    rows = base + rng.sample(base, 100)
    for _ in range(2):
        rng.shuffle(rows)
        assert got(changes.replay(spark.createDataFrame(rows, SCHEMA).repartition(5), FEED, keep=["v"])) == brute(base)


def test_delete_without_insert_and_reinsert(spark):
    rows = [("a", 1, "1", "d", 0), ("b", 1, "1", "d", 0), ("b", 2, "2", "i", 5), ("c", 3, "1", "u", 7), ("c", 3, "2", "d", 7)]
    assert got(changes.replay(spark.createDataFrame(rows, SCHEMA), FEED, keep=["v"])) == [("b", 2, "2", 5)]


def test_empty_feed_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA + ", _last int, deleted int, o0 int, d int")
    assert changes.replay(empty, FEED, keep=["v"]).count() == 0
    one = spark.createDataFrame([("a", 1, "x", "i", 1, 9, 9, 9, 9)], SCHEMA + ", _last int, deleted int, o0 int, d int")
    assert got(changes.replay(one, FEED, keep=["v"])) == [("a", 1, "x", 1)]


def test_open_feed_holds_its_last_instant(spark):
    rows = [("a", 1, "x", "i", 1), ("a", 2, "y", "u", 2), ("b", 2, "z", "i", 3)]
    open_ = changes.Feed(key=["k"], order=["t", "id"], deletes="op = 'd'", closed=False)
    assert got(changes.replay(spark.createDataFrame(rows, SCHEMA), open_, keep=["v"])) == [("a", 1, "x", 1)]


NUMBERED = changes.Feed(key=["k"], order=["n", "id"], deletes="op = 'd'", transaction=["x"], declared="size", sequence="n")
N_SCHEMA = "k string, n long, id string, op string, x string, size int"


def test_gap_holds_everything_behind_it(spark):
    rows = [("a", 1, "1", "i", "t1", 1), ("a", 2, "2", "u", "t2", 1), ("b", 4, "3", "i", "t4", 1), ("a", 5, "4", "d", "t5", 1)]
    df = spark.createDataFrame(rows, N_SCHEMA)
    assert [(r.k, r.n) for r in changes.replay(df, NUMBERED).collect()] == [("a", 2)]
    assert sorted(r.n for r in changes.held(df, NUMBERED).collect()) == [4, 5]
    whole = df.unionByName(spark.createDataFrame([("c", 3, "9", "i", "t3", 1)], N_SCHEMA))
    assert sorted((r.k, r.n) for r in changes.replay(whole, NUMBERED).collect()) == [("b", 4), ("c", 3)]
    assert changes.held(whole, NUMBERED).count() == 0


def test_incomplete_transaction_holds_until_its_last_change(spark):
    rows = [("a", 1, "1", "i", "t1", 2), ("a", 1, "1", "i", "t1", 2), ("b", 2, "3", "i", "t2", 1)]
    df = spark.createDataFrame(rows, N_SCHEMA)
    assert changes.replay(df, NUMBERED).count() == 0
    rest = df.unionByName(spark.createDataFrame([("c", 1, "2", "i", "t1", 2)], N_SCHEMA))
    assert sorted(r.k for r in changes.replay(rest, NUMBERED).collect()) == ["a", "b", "c"]


def test_watermark_against_a_loop(spark):
    rng = random.Random(5)
    for _ in range(4):
        numbers = rng.sample(range(1, 12), 8)
        want = 0
        while want + 1 in numbers:
            want += 1
        df = spark.createDataFrame([(n,) for n in numbers * 2], "n long")
        assert changes.contiguous_watermark(df, "n", first=1).first()[0] == want
    assert changes.contiguous_watermark(spark.createDataFrame([], "n long"), "n").first()[0] is None
    assert changes.contiguous_watermark(spark.createDataFrame([], "n long"), "n", first=1).first()[0] == 0


def test_batches_in_any_order_reach_the_same_state(spark):
    rng = random.Random(7)
    rows = [(rng.choice("abc"), rng.randint(1, 9), f"e{i}", rng.choice("iud"), i) for i in range(60)]
    parts = [rows[:20], rows[20:40], rows[40:]]
    for order in ([0, 1, 2], [2, 0, 1, 0]):
        state = changes.last_changes(spark.createDataFrame(parts[order[0]], SCHEMA), FEED, ["v"])
        for i in order[1:]:
            state = changes.advance(state, spark.createDataFrame(parts[i], SCHEMA), FEED, ["v"])
        assert got(state.where(~F.col("deleted"))) == brute(rows)


def test_incomplete_instant_hides_all_later_ones(spark):
    sized = changes.Feed(key=["k"], order=["t", "id"], deletes="op = 'd'", declared="size")
    schema = SCHEMA + ", size int"
    rows = [("a", 1, "x", "i", 1, 1), ("b", 2, "y", "i", 2, 2), ("c", 3, "z", "i", 3, 1)]
    df = spark.createDataFrame(rows, schema)
    assert [r.k for r in changes.replay(df, sized).collect()] == ["a"]
    assert sorted(r.k for r in changes.held(df, sized).collect()) == ["b", "c"]
    whole = df.unionByName(spark.createDataFrame([("d", 2, "w", "i", 4, 2), ("d", 2, "w", "i", 4, 2)], schema))
    assert sorted(r.k for r in changes.replay(whole, sized).collect()) == ["a", "b", "c", "d"]
    named = changes.Feed(key=["k"], order=["t", "id"], deletes="op = 'd'", transaction=["x"], declared="size")
    of = spark.createDataFrame([(*r, f"t{r[1]}") for r in rows], schema + ", x string")
    assert [r.k for r in changes.replay(of, named).collect()] == ["a"]


def test_log_of_commits_tells_what_is_missing(spark):
    rows = [("a", 1, "x", "i", 1), ("a", 1, "x", "i", 1), ("b", 2, "y", "i", 2), ("c", 4, "z", "i", 3), (None, None, "n", "i", 0)]
    feed = spark.createDataFrame(rows, SCHEMA)
    log = lambda *ids: spark.createDataFrame(list(ids), "id string, t int")
    whole = log(("x", 1), ("y", 2), ("z", 4), ("z", 4), ("n", None))
    names = lambda lg: sorted(r.k for r in changes.replay(feed, FEED, log=lg).collect())
    assert names(whole) == ["a", "b", "c"]
    assert names(whole.unionByName(log(("q", 3)))) == ["a", "b"]
    assert names(whole.unionByName(log(("q", 2)))) == ["a"]
    assert names(whole.unionByName(log(("q", None)))) == []
    assert names(log()) == ["a", "b", "c"]
    gone = changes.held(feed, FEED, log=whole.unionByName(log(("q", 3))))
    assert [r.k for r in gone.collect()] == ["c"]
    assert changes.held(feed, FEED, log=whole).count() == 0
    assert changes.replay(spark.createDataFrame([], SCHEMA), FEED, log=log(("q", 1))).count() == 0


def test_places_against_a_sort(spark):
    rng = random.Random(9)
    values = rng.sample(range(1000), 300) + [None]
    got = {r.v: r.n for r in changes.numbered(spark.createDataFrame([(v,) for v in values], "v int"), "v", "n").collect()}
    assert got == {v: i + 1 for i, v in enumerate(sorted(values, key=lambda v: (v is not None, v)))}
