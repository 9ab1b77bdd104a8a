"""K-slack statuses and order-sensitive values against a plain loop."""

import datetime as dt
import random

from reckon.operators import lateness

T0 = dt.datetime(2026, 1, 1)


def frames(spark, events, closed):
    e = spark.createDataFrame(events, "id string, t timestamp_ntz, a timestamp_ntz, status int, period int")
    c = spark.createDataFrame(closed, "d date, at timestamp_ntz")
    arrivals = lateness.first_arrivals(e, id="id", event_time="t", arrival="a")
    return lateness.buffered(arrivals, lateness.closings(c, period="d", closed_at="at"), 24)


def test_against_a_loop(spark):
    rng = random.Random(1)
    events = []
    for i in range(400):
        t = T0 + dt.timedelta(seconds=rng.choice([rng.randint(0, 3 * 86400), 40_000]))
        for _ in range(rng.choice([1, 1, 2])):
            events.append((f"e{i}", t, t + dt.timedelta(hours=rng.choice([0, 5, 30, 60, 90])), 0, 0))
    closed = [(dt.date(2026, 1, d), dt.datetime(2026, 1, d + 1, 2)) for d in (1, 2)] + [(dt.date(2026, 1, 1), dt.datetime(2026, 1, 9))]
    got = {r.period: r for r in lateness.ordered_values(frames(spark, events, closed)).collect()}
    first = {}
    for i, t, a, *_ in events:
        first[i] = (t, min(a, first.get(i, (t, a))[1]))
    for d in (1, 2):
        close = dt.datetime(2026, 1, d + 1, 2)
        own = sorted((t, i, a) for i, (t, a) in first.items() if t.date() == dt.date(2026, 1, d))
        for version, until in (("provisional", close), ("final", close + dt.timedelta(hours=24))):
            seen = [(t, i) for t, i, a in own if a <= until]
            gap = max([int((b[0] - a[0]).total_seconds()) for a, b in zip(seen, seen[1:])], default=0)
            r = got[dt.date(2026, 1, d)].asDict()
            assert [r[f"{version}_{c}"] for c in ("events", "first_id", "last_id", "longest_gap_s")] == [len(seen), seen[0][1], seen[-1][1], gap]
        assert r["too_late"] == sum(a > close + dt.timedelta(hours=24) for _, _, a in own)
    assert len(got) == 2


def test_bounds_nulls_and_empty(spark):
    close = dt.datetime(2026, 1, 2, 2)
    at = lambda h: close + dt.timedelta(hours=h)
    events = [("on", T0, at(0), 1, 1), ("in", T0, at(24), 1, 1), ("out", T0, at(24) + dt.timedelta(microseconds=1), 1, 1), (None, T0, at(1), 1, 1), ("x", None, at(1), 1, 1), ("y", T0, None, 1, 1), ("z", dt.datetime(2027, 1, 1), at(1), 1, 1)]
    got = {r.id: r.status for r in frames(spark, events, [(dt.date(2026, 1, 1), close)]).collect()}
    assert got == {"on": "on_time", "in": "corrected", "out": "too_late", "z": "not_closed"}
    assert lateness.ordered_values(frames(spark, [], [])).count() == 0
    assert lateness.ordered_values(frames(spark, events, [])).count() == 0
