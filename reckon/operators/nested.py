"""Deeply nested JSON to related flat tables: interval labels by depth-first traversal.

Every node of a document (object, array, scalar) gets a pre-order and a post-order number from one
depth-first walk. Node a contains node b exactly if ``a.pre < b.pre and a.post > b.post``, so flat
tables cut from the nodes keep their links without paths or nested keys, at any depth.

The walk is the one step that Spark's expressions can't do, as the depth is open; it runs as an
Arrow-batched map beside the scan. Documents that can't hold a wanted node are dropped before it by
a test on the text, which is necessary for a match: it looks for the type's name, or for an escape
that could hide it. Neither the walk nor the reading of deep texts recurses, so no depth is too deep.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable, Iterator, Sequence
from json.decoder import scanstring

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: document: digest of the text. object_type: the node's own "object". field: the name it stands
#: under, for an element that of its array. position: index in that array, else NULL. attributes: for
#: an object its scalar fields as JSON, for a scalar its value.
NODE = "document string, pre long, post long, depth int, parent_pre long, kind string, object_type string, field string, position long, attributes string"

_ARROW = pa.schema([("document", pa.string()), ("pre", pa.int64()), ("post", pa.int64()), ("depth", pa.int32()), ("parent_pre", pa.int64()), ("kind", pa.string()), ("object_type", pa.string()), ("field", pa.string()), ("position", pa.int64()), ("attributes", pa.string())])


def walk(root: object) -> Iterator[tuple]:
    """(pre, post, depth, parent_pre, value, field, position) of every node, in post-order.

    The root has pre 0, depth 0 and no parent. No recursion, so any depth is walked.
    """
    pre, post = 1, 0
    if not isinstance(root, (dict, list)):
        yield 0, 0, 0, None, root, None, None
        return

    def children(value: object, field: str | None) -> Iterator[tuple]:
        return iter([(v, k, None) for k, v in value.items()]) if isinstance(value, dict) else iter([(v, field, i) for i, v in enumerate(value)])

    # A frame: the node's label, depth, parent's label, value, field, position, and its children to come.
    stack: list[tuple] = [(0, 0, None, root, None, None, children(root, None))]
    while stack:
        own, depth, above, value, field, position, ahead = stack[-1]
        for child, name, at in ahead:
            if isinstance(child, (dict, list)):
                stack.append((pre, depth + 1, own, child, name, at, children(child, name)))
                pre += 1
                break
            yield pre, post, depth + 1, own, child, name, at
            pre, post = pre + 1, post + 1
        else:
            stack.pop()
            yield own, post, depth, above, value, field, position
            post += 1


def storable(text: str) -> str:
    """The text with halves of broken surrogate pairs replaced, as UTF-8 has no form for them."""
    try:
        text.encode()
        return text
    except UnicodeEncodeError:
        return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def own_type(value: object) -> str | None:
    """An object's own ``object``, if that is a string."""
    kind = value.get("object") if isinstance(value, dict) else None
    return kind if isinstance(kind, str) else None


def row_of(node: tuple) -> tuple:
    """A node in the columns of ``NODE`` after the document."""
    pre, post, depth, parent, value, field, position = node
    if isinstance(value, dict):
        kind, attributes = "object", json.dumps({k: v for k, v in value.items() if not isinstance(v, (dict, list))}, ensure_ascii=False)
    elif isinstance(value, list):
        kind, attributes = "array", None
    else:
        kind, attributes = "scalar", json.dumps(value, ensure_ascii=False)
    clean = lambda t: t if t is None else storable(t)
    return pre, post, depth, parent, kind, clean(own_type(value)), clean(field), position, clean(attributes)


def _refuse(constant: str) -> None:
    raise ValueError(f"{constant} is not JSON")


def _real(text: str) -> float | str:
    """A number beyond a double's range stays text, as JSON has no form for infinity."""
    x = float(text)
    return text if math.isinf(x) else x


def _whole(text: str) -> int | float | str:
    return int(text) if len(text) < 4000 else _real(text)


_LOADS: Callable[[str], object] = json.JSONDecoder(parse_constant=_refuse, parse_float=_real).decode
_SPACE = re.compile(r"[ \t\n\r]*")
_NUMBER = re.compile(r"(-?(?:0|[1-9]\d*))(\.\d+)?([eE][-+]?\d+)?", re.ASCII)
_WORDS = {"true": True, "false": False, "null": None}


def read_deep(text: str) -> object:
    """The value of a JSON text of any depth, read with a stack of open containers; ValueError if broken."""
    i = _SPACE.match(text, 0).end()
    stack: list[tuple[object, str | None]] = []  # open containers, each with the name it stands under
    name: str | None = None
    while True:
        # A value begins at i.
        ch = text[i : i + 1]
        value: object
        opened = False
        if ch == '"':
            value, i = scanstring(text, i + 1, True)
        elif ch in ("{", "["):
            value, i, opened = ({} if ch == "{" else []), _SPACE.match(text, i + 1).end(), True
        else:
            word = next((w for w in _WORDS if text.startswith(w, i)), None)
            number = None if word else _NUMBER.match(text, i)
            if word:
                value, i = _WORDS[word], i + len(word)
            elif number:
                value, i = (_real if number[2] or number[3] else _whole)(number[0]), number.end()
            else:
                raise ValueError(f"no value at {i}")
        if opened and text[i : i + 1] != ("}" if ch == "{" else "]"):
            stack.append((value, name))
            if ch == "{":
                name, i = _name(text, i)
            continue
        if opened:
            i += 1
        # A value is whole: put it into its container, and close what ends after it.
        while True:
            i = _SPACE.match(text, i).end()
            if not stack:
                if i != len(text):
                    raise ValueError(f"more after the value at {i}")
                return value
            into, outer = stack[-1]
            if isinstance(into, dict):
                into[name] = value
            else:
                into.append(value)
            ch = text[i : i + 1]
            if ch == ",":
                i = _SPACE.match(text, i + 1).end()
                if isinstance(into, dict):
                    name, i = _name(text, i)
                break
            if ch != ("}" if isinstance(into, dict) else "]"):
                raise ValueError(f"no comma or end at {i}")
            value, name, i = into, outer, i + 1
            stack.pop()


def _name(text: str, i: int) -> tuple[str, int]:
    """A member's name that begins at ``i``, and where its value begins."""
    if text[i : i + 1] != '"':
        raise ValueError(f"no name at {i}")
    name, i = scanstring(text, i + 1, True)
    i = _SPACE.match(text, i).end()
    if text[i : i + 1] != ":":
        raise ValueError(f"no colon at {i}")
    return name, _SPACE.match(text, i + 1).end()


def read(text: str) -> object:
    """The value of a JSON text; ValueError if broken. The quick reader first, the deep one where it gives up."""
    try:
        return _LOADS(text)
    except RecursionError:
        return read_deep(text)
    except json.JSONDecodeError:
        raise
    except ValueError as e:
        # Either a constant that isn't JSON, which the deep reader refuses too, or an integer of very many digits.
        if "not JSON" in str(e):
            raise
        return read_deep(text)


def parse(text: str | None, at: Sequence[str] = ()) -> tuple[bool, object]:
    """(whether there is a value under ``at``, that value). Broken JSON counts as none."""
    try:
        value = read(text) if text is not None else None
    except ValueError:
        return False, None
    for name in at:
        if not isinstance(value, dict) or name not in value:
            return False, None
        value = value[name]
    return text is not None, value


def may_hold(column: str, object_types: Sequence[str], fields: Sequence[str]):
    """Whether the text can hold a node of such an own type or under such a name."""
    c = F.col(column)
    test = c.contains("\\u")
    for t in object_types:
        test = test | c.rlike(rf'"object"\s*:\s*"{re.escape(t)}"')
    for f in fields:
        test = test | c.contains(json.dumps(f, ensure_ascii=False))
    return test


def label(documents: DataFrame, *, key: Sequence[str], text: str, at: Sequence[str] = (), object_types: Sequence[str] = (), element_fields: Sequence[str] = (), require: Sequence[str] = ()) -> DataFrame:
    """Node rows of the JSON value under ``at`` in each document: the key columns and ``NODE``.

    object_types, element_fields: only nodes with such an own ``object``, or that are elements of an
    array under such a name; labels still count every node. Neither given: every node.
    require: own types of which a document must be able to hold at least one to be looked at.
    ``document`` tells apart different texts under one key; equal texts under one key give equal
    rows. NULL, empty and broken texts, and those without ``at``, give no rows; NaN and infinity are
    broken. A half of a surrogate pair reads as the replacement character, a number beyond a double's
    range as text. Of equal names in one object the last counts.
    """
    key = list(key)
    rows = documents.select(*key, F.col(text).alias("_text")).where(F.col("_text").isNotNull())
    if require:
        rows = rows.where(may_hold("_text", require, ()))
    elif object_types or element_fields:
        rows = rows.where(may_hold("_text", object_types, element_fields))
    rows = rows.withColumn("_document", F.md5("_text"))
    types, fields, path = frozenset(object_types), frozenset(element_fields), tuple(at)
    every = not types and not fields

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            take, columns = [], [[] for _ in range(9)]
            documents_, texts = batch.column("_document"), batch.column("_text")
            for i, raw in enumerate(texts):
                found, value = parse(raw.as_py(), path)
                if not found:
                    continue
                for node in walk(value):
                    if every or own_type(node[4]) in types or (node[6] is not None and node[5] in fields):
                        take.append(i)
                        for column, x in zip(columns, row_of(node)):
                            column.append(x)
                if len(take) > 50_000:
                    yield emit(batch, documents_, take, columns)
                    take, columns = [], [[] for _ in range(9)]
            if take:
                yield emit(batch, documents_, take, columns)

    def emit(batch: pa.RecordBatch, documents_: pa.Array, take: list[int], columns: list[list]) -> pa.RecordBatch:
        index = pa.array(take, pa.int64())
        arrays = [batch.column(k).take(index) for k in key] + [documents_.take(index)] + [pa.array(c, f.type) for c, f in zip(columns, list(_ARROW)[1:])]
        return pa.RecordBatch.from_arrays(arrays, names=[*key, *_ARROW.names])

    fields_ddl = ", ".join(f"`{k}` {t}" for k, t in rows.select(*key).dtypes)
    return rows.mapInArrow(run, f"{fields_ddl}, {NODE}")


def contained(nodes: DataFrame, *, parent: str, child: str, key: Sequence[str], levels: int, carry: Sequence[str]) -> DataFrame:
    """Link each child node to the parent node that contains it ``levels`` levels above; keep childless parents.

    parent, child: SQL conditions on node rows; a node may be both. Nodes of one depth never overlap,
    so the only candidate is the last parent of that depth that opened before the child: one window
    over the document's labels instead of a join of all pairs, then the containment test. Returns key,
    ``document``, ``parent_pre``, the parent's ``carry`` columns, ``child_pre``, and the child's
    ``child_position`` and ``child_attributes``, which are NULL for a parent without children.
    Children that no parent contains are left out. Equal rows of a repeated document collapse.
    """
    ids = [*key, "document"]
    roles = F.array_compact(F.array(F.when(F.expr(parent), F.lit(True)), F.when(F.expr(child), F.lit(False))))
    each = nodes.withColumn("_is_parent", F.explode(roles))
    own = lambda column: F.when(~F.col("_is_parent"), F.col(column))
    rows = each.select(
        *ids, "_is_parent", "pre", "post", F.when(F.col("_is_parent"), F.col("depth")).otherwise(F.col("depth") - levels).alias("_level"),
        F.when(F.col("_is_parent"), F.struct(*carry)).alias("_carry"), own("position").alias("_position"), own("attributes").alias("_attributes"),
    )
    along = Window.partitionBy(*ids, "_level").orderBy("pre", F.desc("_is_parent"))
    opened = F.last(F.when(F.col("_is_parent"), F.struct("pre", "post", "_carry")), ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = rows.withColumn("_in", opened)
    inside = placed.where(F.col("_is_parent") | ((F.col("_in.pre") < F.col("pre")) & (F.col("_in.post") > F.col("post"))))
    held = F.max((~F.col("_is_parent")).cast("int")).over(Window.partitionBy(*ids, "_level", F.col("_in.pre")))
    linked = inside.withColumn("_held", held).where(~F.col("_is_parent") | (F.col("_held") == 0))
    return linked.select(
        *ids, F.col("_in.pre").alias("parent_pre"), *[F.col("_in._carry").getField(x).alias(x) for x in carry],
        own("pre").alias("child_pre"), F.col("_position").alias("child_position"), F.col("_attributes").alias("child_attributes"),
    ).distinct()
