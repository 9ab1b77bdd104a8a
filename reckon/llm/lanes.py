"""Rounds of a sequential reduction that runs in parallel lanes and merges what each lane leaves over.

Rows of a group spread over the group's lanes by a hash, so one source or document with a third of
all rows is spread too. A lane is processed in a fixed order of hashes; its result therefore depends
only on its rows, not on task retries or shuffle order. Each round is written to the shared folder;
what a round leaves open goes into fewer lanes, until one lane of each group finishes it. A lane
holds about ``per_lane`` rows in every round, the last one too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reckon.operators.scale import materialize

#: What a lane gives: takes the round's number, the lane, the group's value and its rows in order (as
#: tuples of the columns), and whether it is the group's last lane; yields output rows.
Step = Callable[[int, int, object, Iterator[tuple], bool], Iterator[tuple]]
#: Groups up to which their numbers of lanes are read into the driver; they come from parameter tables.
MOST_GROUPS = 10_000


def lanes_for(rows: int, per_lane: int) -> int:
    return max(1, -(-rows // per_lane))


def group_lanes(rows: DataFrame, group: str, per_lane: int) -> tuple[dict[object, int], int]:
    """(lanes of each group, all rows)."""
    counts = rows.groupBy(group).agg(F.count(F.lit(1)).alias("n")).limit(MOST_GROUPS + 1).collect()
    if len(counts) > MOST_GROUPS:
        raise ValueError(f"more than {MOST_GROUPS} groups")
    return {r[group]: lanes_for(r["n"], per_lane) for r in counts}, sum(r["n"] for r in counts)


def one_round(rows: DataFrame, *, group: str, hashed: list[str], first: list[str], lanes: dict[object, int], tasks: int, round_no: int, step: Step, schema: str, least_rounds: int, seed: int) -> DataFrame:
    """Apply ``step`` to each (lane, group) of ``rows``."""
    columns = rows.columns
    spark = rows.sparkSession
    of = spark.createDataFrame([(k, n) for k, n in lanes.items()], f"_of {dict(rows.dtypes)[group]}, _lanes int")
    spread = rows.withColumn("_h", F.xxhash64(F.lit(seed), *hashed)).join(F.broadcast(of), F.col(group).eqNullSafe(F.col("_of"))).withColumn("_lane", F.pmod("_h", F.col("_lanes")).cast("int")).drop("_of", "_lanes")
    placed = spread.repartition(tasks, group, "_lane").sortWithinPartitions("_lane", group, *[F.desc(c) for c in first], "_h", *hashed)
    last_of = {k: n == 1 and round_no + 1 >= least_rounds for k, n in lanes.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[str] = []
        buffer: list[tuple] = []

        def flat() -> Iterator[tuple]:
            for batch in batches:
                lane = batch.column("_lane").to_pylist()
                yield from zip(lane, zip(*[batch.column(c).to_pylist() for c in columns]))

        def pack() -> pa.RecordBatch:
            cols = list(zip(*buffer))
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow)], names=[f.name for f in arrow])
            buffer.clear()
            return out

        at = columns.index(group)
        stream = flat()
        ahead = next(stream, None)
        while ahead is not None:
            lane, key = ahead[0], ahead[1][at]

            def own() -> Iterator[tuple]:
                nonlocal ahead
                while ahead is not None and (ahead[0], ahead[1][at]) == (lane, key):
                    row = ahead[1]
                    ahead = next(stream, None)
                    yield row

            for out in step(round_no, lane, key, own(), last_of[key]):
                buffer.append(out)
                if len(buffer) >= 20_000:
                    yield pack()
        if buffer:
            yield pack()

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = list(to_arrow_schema(StructType.fromDDL(schema)))
    return placed.mapInArrow(run, schema)


def reduce_in_rounds(rows: DataFrame, *, group: str, hashed: list[str], per_lane: int, step: Step, schema: str, columns: list[str], first: tuple[str, ...] = (), seed: int = 17) -> DataFrame:
    """All rows that rounds of ``step`` settle; ``schema`` must have a boolean column ``open``.

    ``columns``: what an open row takes into the next round. ``first``: columns whose greatest values a
    lane takes first, before the order of hashes. A lane must leave far fewer rows open than it takes.
    """
    round_no, settled, current = 0, None, rows
    while True:
        lanes, count = group_lanes(current, group, per_lane)
        done = materialize(one_round(current, group=group, hashed=hashed, first=list(first), lanes=lanes, tasks=lanes_for(count, per_lane), round_no=round_no, step=step, schema=schema, least_rounds=1, seed=seed + round_no))
        part = done.where("NOT open").drop("open")
        settled = part if settled is None else settled.unionByName(part)
        if max(lanes.values(), default=1) == 1:
            return settled
        current = done.where("open").select(*columns)
        round_no += 1
