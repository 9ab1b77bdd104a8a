"""Packing keeps every token once, never overfills, splits only what is too large, and fills well."""

import random
from collections import defaultdict

import pytest

from reckon.llm import packing


def run(spark, items, kinds, **more):
    i = spark.createDataFrame([(a, b, "x", 1) for a, b in items], "doc string, size long, kind string, open int")
    k = spark.createDataFrame(kinds, "name string, cap int")
    return packing.pack(i, k, id="doc", size="size", kind="name", capacity="cap", **more).collect()


def check(rows, items, kinds):
    content, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        content[r.container_kind, r.container_id].append(r)
        pieces[r.container_kind, r.doc].append(r)
    caps = dict(kinds)
    for (kind, _), own in content.items():
        assert 0 < sum(r.size for r in own) <= caps[kind]
    for kind, cap in kinds:
        for doc in {d for d, _ in items if d is not None}:
            want = sorted(n for d, n in items if d == doc and n)
            own = pieces.get((kind, doc), [])
            assert sum(r.size for r in own) == sum(want)
            assert len(own) == sum(-(-n // cap) for n in want)
            assert all(r.start == r.piece * cap for r in own)
    return content


@pytest.mark.parametrize("per_lane", [100_000, 40])
def test_every_item_lies_whole_in_one_place(spark, per_lane):
    rng = random.Random(1)
    items = [(f"d{i}", rng.choice([None, 0, 1, 5, 60, 99, 100, 101, 250, rng.randint(1, 90)])) for i in range(400)]
    items += items[:30]
    kinds = [("small", 100), ("large", 1000)]
    rows = run(spark, items, kinds, per_lane=per_lane)
    content = check(rows, items, kinds)
    total = sum(n or 0 for _, n in items)
    for kind, cap in kinds:
        used = sum(k == kind for k, _ in content)
        assert used <= 1.12 * -(-total // cap) + 1


def test_same_result_whatever_the_partitions(spark):
    rng = random.Random(2)
    items = [(f"d{i}", rng.randint(1, 70)) for i in range(300)]
    first = run(spark, items, [("a", 100)], per_lane=50)
    rng.shuffle(items)
    assert sorted(first) == sorted(run(spark, items, [("a", 100)], per_lane=50))


def test_best_fit_and_emitting_the_fullest():
    w = packing.Windows(10, 2, "w")
    for size in (6, 7):
        assert w.place((size,), size) == []
    assert w.place((3,), 3) == [("w-1", [(7,), (3,)])]
    assert w.place((5,), 5) == [] and len(w.free) == 2
    assert w.place((8,), 8) == [("w-0", [(6,)])]
    assert sorted(w.rest()) == [("w-2", [(5,)]), ("w-3", [(8,)])]


def test_a_single_lane_is_packed_online_first(spark):
    rng = random.Random(3)
    items = [(f"d{i}", rng.randint(1, 70)) for i in range(300)]
    rows = run(spark, items, [("a", 100)], windows=4)
    content = check(rows, items, [("a", 100)])
    rounds = [c.split("-")[1] for _, c in content]
    # At most the open windows are left over; sorted, their items fill about as many containers.
    assert rounds.count("0") > rounds.count("1") > 0 and rounds.count("1") <= 5


def test_tiny_items_never_fill_a_lane(spark, monkeypatch):
    seen = []
    real = packing.group_lanes

    def counted(rows, group, per_lane):
        lanes, n = real(rows, group, per_lane)
        seen.append((max(lanes.values(), default=0), n))
        return lanes, n

    monkeypatch.setattr(packing, "group_lanes", counted)
    items = [(f"d{i}", 1) for i in range(60_000)]
    rows = run(spark, items, [("huge", 1_000_000)], per_lane=5_000)
    assert len({r.container_id for r in rows}) == 1 and len(rows) == 60_000 and len({r.doc for r in rows}) == 60_000
    # Twelve lanes of one open window each: after the first round only its bundles go on.
    assert seen[0] == (12, 60_000) and seen[1][1] <= 12 * 2 and seen[-1][0] == 1


def test_bundles_are_few_and_large_enough():
    rng = random.Random(8)
    for capacity in (1, 10, 640, 131_072):
        sizes = []
        while len(sizes) < 5000 and sum(sizes) < capacity:
            sizes.append(min(rng.choice([1, 1, 2, max(1, capacity // 50)]), capacity - sum(sizes)))
        got = defaultdict(int)
        for no, item in packing.bundles(list(range(len(sizes))), sizes, capacity):
            got[no] += sizes[item]
        assert sum(got.values()) == sum(sizes) and len(got) <= packing.BUNDLE + 1
        assert sum(v < max(1, capacity // packing.BUNDLE) for v in got.values()) <= 1


def test_empty_tables(spark):
    assert run(spark, [], [("a", 10)]) == []
    assert run(spark, [("d", 3)], []) == []
    assert run(spark, [("d", None), ("e", 0)], [("a", 10), ("b", None)]) == []


def test_fill_report(spark):
    items = spark.createDataFrame([("a", 60), ("b", 50), ("c", 40)], "doc string, size long")
    kinds = spark.createDataFrame([("k", 100)], "name string, cap int")
    packed = packing.pack(items, kinds, id="doc", size="size", kind="name", capacity="cap")
    assert [tuple(r) for r in packing.fill(packed, kinds, kind="name", capacity="cap").collect()] == [("k", 100, 2, 150, 2, 7500)]
