"""Differences between two copies of a data set: cancel signed cells.

Both sides unpivot to key-field-value rows, plus one row that says the key is there. The union of
both, counted with signs, is grouped by cell: what occurs on both sides cancels. Keys with cells
left over are the findings. Nothing is joined; each side is read once, counts pre-aggregate before
they move, and a key or value held by a third of all rows is one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, NullType, StringType


def common_types(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> dict[str, DataType]:
    """For each column the type that takes the values of both sides; TypeError where there is none.

    Numbers widen to the wider type, dates to timestamps. Text and anything else have no common type.
    """
    out = {}
    for c in columns:
        a, b = left.schema[c].dataType, right.schema[c].dataType
        if a != b and not isinstance(a, NullType) and not isinstance(b, NullType):
            if isinstance(a, StringType) or isinstance(b, StringType):
                raise TypeError(f"{c} is {a.simpleString()} on the left and {b.simpleString()} on the right")
        try:
            out[c] = left.select(c).limit(0).union(right.select(c).limit(0)).schema[c].dataType
        except AnalysisException as e:
            raise TypeError(f"{c} is {a.simpleString()} on the left and {b.simpleString()} on the right") from e
    return out


def _text(column: str, kind: DataType) -> Column:
    """A value as text that is equal exactly where values are: a negative zero is a zero."""
    c = F.col(column).cast(kind)
    return (c + F.lit(0.0).cast(kind) if isinstance(kind, (DoubleType, FloatType)) else c).cast("string")


def _cells(df: DataFrame, keys: Sequence[str], fields: Sequence[str], types: dict[str, DataType], left: bool) -> DataFrame:
    cell = lambda no, value: F.struct(F.lit(no).alias("field_no"), value.alias("value"))
    # The row mark is field -1; a field's cell holds NULL as NULL, which groups with NULL alone.
    cells = [cell(-1, F.lit(None).cast("string"))] + [cell(i, _text(f, types[f])) for i, f in enumerate(fields)]
    rows = df.select(*[F.col(k).cast(types[k]).alias(f"key{i}") for i, k in enumerate(keys)], F.explode(F.array(*cells)).alias("c"))
    return rows.select(*[f"key{i}" for i in range(len(keys))], "c.field_no", "c.value", F.lit(int(left)).alias("l"), F.lit(int(not left)).alias("r"))


def findings(left: DataFrame, right: DataFrame, *, keys: Sequence[str], fields: Sequence[str], missing_left: str = "missing_in_left", missing_right: str = "missing_in_right", count_rows: bool = False) -> DataFrame:
    """(keys, finding): a key that only one side has, or, where both have it, each field that differs.

    A side that repeats a row says the same as one that has it once, unless ``count_rows``: then a
    key whose number of rows differs gives the finding ``rows``. If a side repeats a key with
    different values, the field differs. NULL equals NULL and differs from every value; NULL keys
    match each other. Values compare in the wider of both sides' types, a field without a common type is
    a TypeError. Empty sides are allowed.
    """
    types = common_types(left, right, [*keys, *fields])
    ks = [f"key{i}" for i in range(len(keys))]
    cells = _cells(left, keys, fields, types, True).unionByName(_cells(right, keys, fields, types, False))
    counted = cells.groupBy(*ks, "field_no", "value").agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    is_row = F.col("field_no") == -1
    off = (F.col("l") > 0) != (F.col("r") > 0)
    per_key = counted.groupBy(*ks).agg(
        F.max(F.when(is_row, F.col("l"))).alias("l"), F.max(F.when(is_row, F.col("r"))).alias("r"),
        *[F.max(F.when((F.col("field_no") == i) & off, 1)).alias(f"off{i}") for i in range(len(fields))],
    )
    differ = [F.when(F.col(f"off{i}") == 1, F.lit(f)) for i, f in enumerate(fields)]
    if count_rows:
        differ.append(F.when(F.col("l") != F.col("r"), F.lit("rows")))
    found = F.when(F.col("l") == 0, F.array(F.lit(missing_left))).when(F.col("r") == 0, F.array(F.lit(missing_right))).otherwise(F.array_compact(F.array(*differ)))
    return per_key.select(*[F.col(k).alias(name) for k, name in zip(ks, keys)], F.explode(found).alias("finding"))


def values_apart(left: DataFrame, right: DataFrame, *, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """(keys, field, left_value, right_value) of every cell that doesn't cancel, values as text.

    Of several values of one side for a cell the greatest is shown. A missing row shows as NULLs on
    its side in every field that the other side fills.
    """
    types = common_types(left, right, [*keys, *fields])
    ks = [f"key{i}" for i in range(len(keys))]
    cells = _cells(left, keys, fields, types, True).unionByName(_cells(right, keys, fields, types, False)).where("field_no >= 0")
    counted = cells.groupBy(*ks, "field_no", "value").agg(F.sum("l").alias("l"), F.sum("r").alias("r")).where("(l > 0) != (r > 0)")
    both = counted.groupBy(*ks, "field_no").agg(F.max(F.when(F.col("l") > 0, F.col("value"))).alias("left_value"), F.max(F.when(F.col("r") > 0, F.col("value"))).alias("right_value"))
    name = F.element_at(F.array(*[F.lit(f) for f in fields]), F.col("field_no") + 1)
    return both.select(*[F.col(k).alias(n) for k, n in zip(ks, keys)], name.alias("field"), "left_value", "right_value")
