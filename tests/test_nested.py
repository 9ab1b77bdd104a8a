"""Interval labels and links against recursion over the same JSON."""

import json
import random

from reckon.operators import nested

SCHEMA = "id string, body string, pre int, document string"


def tree(rng, depth):
    kind = rng.random()
    if depth == 0 or kind < 0.3:
        return rng.choice([None, 1, "x", True])
    if kind < 0.5:
        return [tree(rng, depth - 1) for _ in range(rng.randint(0, 3))]
    out = {k: tree(rng, depth - 1) for k in rng.sample(["a", "b", "lines", "c"], rng.randint(0, 3))}
    if rng.random() < 0.5:
        out["object"] = rng.choice(["m", "other", 5])
    if rng.random() < 0.4:
        out["lines"] = [rng.choice([{"n": i}, None, i]) for i in range(rng.randint(0, 3))]
    return out


def movements(value, found):
    if isinstance(value, dict):
        if value.get("object") == "m":
            lines = value.get("lines")
            found += [(i,) for i in range(len(lines))] if isinstance(lines, list) and lines else [(-1,)]
        for v in value.values():
            movements(v, found)
    elif isinstance(value, list):
        for v in value:
            movements(v, found)
    return found


def linked(df):
    nodes = nested.label(df, key=["id"], text="body", at=["data"], object_types=["m"], element_fields=["lines"])
    return nested.contained(nodes, parent="object_type = 'm'", child="field = 'lines' AND position IS NOT NULL", key=["id"], levels=2, carry=["depth"])


def test_links_against_recursion(spark):
    rng = random.Random(2)
    docs = [(f"d{i}", json.dumps({"data": tree(rng, 6)}), 1, "x") for i in range(150)]
    rows = linked(spark.createDataFrame(docs, SCHEMA).repartition(4)).collect()
    got = sorted((r.id, -1 if r.child_position is None else r.child_position) for r in rows)
    assert got == sorted((i, n) for i, b, *_ in docs for (n,) in movements(json.loads(b)["data"], []))


def test_labels_contain_exactly_the_descendants():
    value = tree(random.Random(4), 7)
    nodes = list(nested.walk(value))
    parent = {n[0]: n[3] for n in nodes}
    for a in nodes:
        for b in nodes:
            up, above = parent[b[0]], False
            while up is not None:
                above, up = above or up == a[0], parent[up]
            assert above == (a[0] < b[0] and a[1] > b[1])
    assert sorted(n[0] for n in nodes) == sorted(n[1] for n in nodes) == list(range(len(nodes)))


def test_broken_missing_empty_long_and_escaped(spark):
    long = json.dumps({"data": {"object": "m", "text": "y" * 3_000_000, "lines": [1]}})
    deep = '{"data":' + "[" * 100_000 + '{"object": "m"}' + "]" * 100_000 + "}"
    escaped = '{"data": {"object": "\\u006d", "l\\u0069nes": [7, 8]}}'
    docs = [("null", None), ("empty", ""), ("cut", '{"data": {"object": "m"'), ("none", '{"other": 1}'), ("scalar", '{"data": 3}'), ("long", long), ("deep", deep), ("esc", escaped), ("null key", '{"data": {"object": "m"}}')]
    df = spark.createDataFrame([(None if i == "null key" else i, b, 1, "x") for i, b in docs], SCHEMA)
    got = sorted((str(r.id), r.child_position) for r in linked(df).collect() for _ in [0])
    assert got == [("None", None), ("deep", None), ("esc", 0), ("esc", 1), ("long", 0)]
    assert linked(spark.createDataFrame([], SCHEMA)).count() == 0


def test_nested_movements_link_to_the_nearest(spark):
    body = json.dumps({"data": {"object": "m", "inner": {"object": "m", "lines": ["i"]}, "lines": ["o1", "o2"]}})
    rows = linked(spark.createDataFrame([("a", body, 1, "x"), ("a", body, 1, "x")], SCHEMA)).collect()
    assert sorted((r.depth, r.child_attributes) for r in rows) == [(0, '"o1"'), (0, '"o2"'), (1, '"i"')]


def test_cut_emoji_constants_and_endless_numbers(spark):
    docs = [
        ("emoji", '{"data": {"object": "m", "id": "a\\ud83d", "lines": [1]}}'), ("name", '{"data": {"object": "m", "\\ud83d": 1}}'), ("nan", '{"data": {"object": "m", "x": NaN}}'),
        ("inf", '{"data": {"object": "m", "x": 1e999, "y": [-Infinity]}}'), ("large", '{"data": {"object": "m", "x": 1e999, "y": ' + "9" * 6000 + "}}"),
    ]
    df = spark.createDataFrame([(i, b, 1, "x") for i, b in docs], SCHEMA)
    nodes = nested.label(df, key=["id"], text="body", at=["data"], object_types=["m"]).collect()
    assert sorted(r.id for r in nodes) == ["emoji", "large", "name"]
    assert "a\ufffd" in next(r.attributes for r in nodes if r.id == "emoji")
    assert json.loads(next(r.attributes for r in nodes if r.id == "large"))["x"] == "1e999"


def test_deep_reader_equals_the_quick_one():
    rng = random.Random(6)
    for _ in range(300):
        value = tree(rng, 5)
        text = json.dumps(value, indent=rng.choice([None, 1]))
        assert nested.read_deep(text) == value
        broken = text[: rng.randrange(len(text))] if rng.random() < 0.5 else text + rng.choice([",", "]", " 1"])
        for read in (nested.read_deep, nested.read):
            try:
                got = read(broken)
            except ValueError:
                got = "broken"
            try:
                want = json.loads(broken)
            except ValueError:
                want = "broken"
            assert got == want
    for odd in ("", " ", "[1,]", '{"a":1,}', "{1:2}", "01", "-", "1.", "nul", '"a', "[1 2]", '{"a" 1}', "\ufeff1"):
        for read in (nested.read_deep, nested.read):
            try:
                assert read(odd) is None and False
            except ValueError:
                pass
