"""Differences of two copies against dictionaries."""

import random

import pytest

from reckon.operators import compare

SCHEMA = "k string, d int, x long, y string, field_no int, value string"


def run(spark, left, right, **more):
    a, b = (spark.createDataFrame([(*r, 0, "v") for r in rows], SCHEMA) for rows in (left, right))
    return sorted(((r.k, r.d, r.finding) for r in compare.findings(a, b, keys=["k", "d"], fields=["x", "y"], **more).collect()), key=str)


def brute(left, right):
    out = set()
    for key in {r[:2] for r in left + right}:
        l, r = [x for x in left if x[:2] == key], [x for x in right if x[:2] == key]
        if not l:
            out.add((*key, "missing_in_left"))
        elif not r:
            out.add((*key, "missing_in_right"))
        else:
            out |= {(*key, f) for i, f in ((2, "x"), (3, "y")) if {v[i] for v in l} != {v[i] for v in r}}
    return sorted(out, key=str)


def test_against_dictionaries(spark):
    rng = random.Random(9)
    side = lambda: [(rng.choice(["a", "b", None]), rng.choice([1, 2, None, 3]), rng.choice([None, 1, 2]), rng.choice([None, "", "p"])) for _ in range(15)]
    for _ in range(3):
        left = side()
        right = rng.sample(left, 9) + side()[:4]
        assert run(spark, left, right) == brute(left, right)


def test_null_differs_from_values_only_and_empty_sides(spark):
    assert run(spark, [("a", 1, None, "")], [("a", 1, None, None)]) == [("a", 1, "y")]
    assert run(spark, [], [("a", 1, 1, "")]) == [("a", 1, "missing_in_left")]
    assert run(spark, [], []) == []


def test_counting_rows(spark):
    one = ("a", 1, 5, "p")
    assert run(spark, [one, one], [one]) == []
    assert run(spark, [one, one], [one], count_rows=True) == [("a", 1, "rows")]


def test_values_compare_in_the_wider_type(spark):
    a = spark.createDataFrame([(1, 1), (2, 2), (3, 0)], "k int, x long")
    b = spark.createDataFrame([(1, 1.5), (2, 2.0), (3, -0.0)], "k long, x double")
    for left, right in ((a, b), (b, a)):
        assert [(r.k, r.finding) for r in compare.findings(left, right, keys=["k"], fields=["x"]).collect()] == [(1, "x")]
    assert [tuple(r) for r in compare.values_apart(a, b, keys=["k"], fields=["x"]).collect()] == [(1, "x", "1.0", "1.5")]
    c = spark.createDataFrame([(1, "1")], "k int, x string")
    with pytest.raises(TypeError):
        compare.findings(a, c, keys=["k"], fields=["x"])
    with pytest.raises(TypeError):
        compare.findings(a, spark.sql("SELECT 1 AS k, DATE'2026-01-01' AS x"), keys=["k"], fields=["x"])
