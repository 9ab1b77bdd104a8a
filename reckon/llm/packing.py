"""Filling containers of fixed capacity: bounded-space online best fit, then a merge of leftovers.

What a lane leaves open goes on in *bundles*: an item of at least a 64th of the capacity alone, smaller
ones together until they reach that. A window is at most 65 bundles and a lane leaves a bounded number
of windows, so each round has a small part of the rows of the one before, however small the items.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reckon.llm.lanes import group_lanes, lanes_for, one_round
from reckon.operators.scale import broadcast_if, materialize

#: Windows a lane keeps open at a time.
OPEN_WINDOWS = 32
#: Rows of one lane, in every round; so many at most are sorted in memory.
PER_LANE = 100_000
#: Part of the capacity that a bundle of small items reaches.
BUNDLE = 64
#: Kinds of containers up to which they are read into the driver (a parameter table).
MOST_KINDS = 10_000


def pieces(items: DataFrame, kinds: DataFrame, *, id: str, size: str, kind: str, capacity: str) -> DataFrame:
    """(kind, capacity, id, piece, start, size): each item once for every kind of container.

    An item over the capacity splits into full pieces and a rest; no other item splits. Items of
    NULL or no size, and kinds of NULL or no capacity, hold nothing and give no piece.
    """
    ks = kinds.where(F.col(capacity) > 0).select(F.col(kind).alias("kind"), F.col(capacity).cast("long").alias("capacity")).distinct().limit(MOST_KINDS + 1).collect()
    if len(ks) > MOST_KINDS:
        raise ValueError(f"more than {MOST_KINDS} kinds of containers")
    all_kinds = F.array(*[F.struct(F.lit(k["kind"]).cast("string").alias("kind"), F.lit(k["capacity"]).cast("long").alias("capacity")) for k in sorted(ks, key=repr)])
    if not ks:
        all_kinds = F.array().cast("array<struct<kind: string, capacity: long>>")
    of = items.where(F.col(size) > 0).select(F.col(id).alias("id"), F.col(size).cast("long").alias("whole"))
    each = of.select("id", "whole", F.explode(all_kinds).alias("k")).select("id", "whole", "k.kind", "k.capacity")
    cut = each.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(whole - 1) div capacity"))))
    start = F.col("piece") * F.col("capacity")
    return cut.select("kind", "capacity", "id", "piece", start.alias("start"), F.least(F.col("capacity"), F.col("whole") - start).alias("size"))


class Windows:
    """Open containers of one capacity, found by best fit through a list sorted by free space."""

    def __init__(self, capacity: int, most: int | None, name: str):
        self.capacity, self.most, self.name = capacity, most, name
        self.free: list[tuple[int, int]] = []
        self.content: dict[int, list[tuple]] = {}
        self.made = 0

    def place(self, item: tuple, size: int) -> list[tuple[str, list[tuple]]]:
        """Put an item into the fullest window that takes it; gives the window closed to make room, if any."""
        at = bisect.bisect_left(self.free, (size, -1))
        closed = []
        if at < len(self.free):
            left, no = self.free.pop(at)
        else:
            if self.most and len(self.free) >= self.most:
                closed.append(self.close(self.free.pop(0)[1]))
            left, no = self.capacity, self.made
            self.made += 1
            self.content[no] = []
        self.content[no].append(item)
        if left == size:
            closed.append(self.close(no))
        else:
            bisect.insort(self.free, (left - size, no))
        return closed

    def close(self, no: int) -> tuple[str, list[tuple]]:
        return f"{self.name}-{no}", self.content.pop(no)

    def rest(self) -> Iterator[tuple[str, list[tuple]]]:
        for _, no in self.free:
            yield self.close(no)


def bundles(content: list[tuple], sizes: list[int], capacity: int) -> Iterator[tuple[int, tuple]]:
    """(number of its bundle, item) of each item of a window that stays open."""
    least, no, size = max(1, capacity // BUNDLE), 0, 0
    for item, own in sorted(zip(content, sizes), key=lambda x: -x[1]):
        yield no, item
        size += own
        if size >= least:
            no, size = no + 1, 0


def pack(items: DataFrame, kinds: DataFrame, *, id: str, size: str, kind: str, capacity: str, windows: int = OPEN_WINDOWS, per_lane: int = PER_LANE) -> DataFrame:
    """(container_kind, container_id, id, piece, start, size): where each piece of each item lies.

    In each lane a bounded number of windows is open. An item goes to the open window that it fills
    best; if none takes it and no more may open, the fullest is emitted. Windows still open at the
    end of a lane are leftovers: their bundles go round again in fewer lanes, and the last lane of a
    kind packs them by best fit with the largest first. The first round is online at every size, also
    in a single lane; only leftovers of an earlier round are sorted. Full pieces are containers already.
    Repeated rows are separate items; empty tables give no containers.
    """
    all_pieces = pieces(items, kinds, id=id, size=size, kind=kind, capacity=capacity)
    full = all_pieces.where("size = capacity")

    def packer(carried: int, at_size: int):
        """The step of a round whose rows are (kind, capacity, ...): yields their first ``carried`` columns, place and open."""

        def step(round_no: int, lane: int, key: object, rows: Iterator[tuple], last: bool) -> Iterator[tuple]:
            if last:
                rows = iter(sorted(rows, key=lambda r: -r[at_size]))
            w: Windows | None = None
            for row in rows:
                w = w or Windows(row[1], None if last else windows, f"{key}-{round_no}-{lane}")
                for name, content in w.place(row, row[at_size]):
                    for x in content:
                        yield (*x[:carried], name, False)
            for name, content in w.rest() if w else ():
                if last:
                    yield from ((*x[:carried], name, False) for x in content)
                else:
                    yield from ((*x[:carried], f"{name}-{no}", True) for no, x in bundles(content, [x[at_size] for x in content], w.capacity))

        return step

    before: dict[object, int] = {}

    def packed(rows: DataFrame, round_no: int, hashed: list[str]) -> tuple[DataFrame, bool]:
        """One round over rows of (kind, capacity, ..., size), written; and whether it was the last of every kind."""
        lanes, count = group_lanes(rows, "kind", per_lane)
        # A lane of fewer rows than its windows may hold bundles can leave all of them open; fewer lanes end that.
        lanes = {k: min(n, max(1, before[k] // 2)) if k in before else n for k, n in lanes.items()}
        before.update(lanes)
        carry = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes)
        step = packer(len(rows.columns), rows.columns.index("size"))
        done = one_round(rows, group="kind", hashed=hashed, first=[], lanes=lanes, tasks=lanes_for(count, per_lane), round_no=round_no, step=step, schema=f"{carry}, place string, open boolean", least_rounds=2, seed=17 + round_no)
        return materialize(done), round_no > 0 and max(lanes.values(), default=1) == 1

    placed, _ = packed(all_pieces.where("size < capacity"), 0, ["kind", "id", "piece"])
    rounds, last, now = [], False, placed
    while not last:
        left = now.where("open").groupBy("kind", "capacity", F.col("place").alias("unit")).agg(F.sum("size").alias("size"))
        now, last = packed(left, len(rounds) + 1, ["kind", "unit"])
        rounds.append(now)
    # Where the bundles of each round end up, from the last round back to the first.
    ends = rounds[-1].select("unit", "place")
    for r in reversed(rounds[:-1]):
        on = r.where("open").select("unit", F.col("place").alias("next")).join(broadcast_if(ends.withColumnRenamed("unit", "next")), "next")
        ends = r.where("NOT open").select("unit", "place").unionByName(on.select("unit", "place"))
    columns = ["kind", "id", "piece", "start", "size"]
    moved = placed.where("open").select(*columns, F.col("place").alias("unit")).join(broadcast_if(ends), "unit").select(*columns, F.col("place").alias("container_id"))
    settled = placed.where("NOT open").select(*columns, F.col("place").alias("container_id"))
    # Rows that repeat an item share its id and piece, so a full piece's container needs a number of its own.
    own = full.select(*columns, F.concat_ws("-", "kind", F.lit("full"), F.hex(F.monotonically_increasing_id())).alias("container_id"))
    return own.unionByName(settled).unionByName(moved).select(F.col("kind").alias("container_kind"), "container_id", F.col("id").alias(id), "piece", "start", "size")


def fill(packed: DataFrame, kinds: DataFrame, *, kind: str, capacity: str) -> DataFrame:
    """(container_kind, capacity_tokens, containers, tokens, least_containers, fill_bp) of each kind.

    least_containers: tokens divided by the capacity, rounded up, which no packing can beat.
    """
    totals = packed.groupBy("container_kind", "container_id").agg(F.sum("size").alias("size")).groupBy("container_kind").agg(F.count(F.lit(1)).alias("containers"), F.sum("size").alias("tokens"))
    k = kinds.select(F.col(kind).alias("container_kind"), F.col(capacity).cast("long").alias("capacity_tokens")).distinct()
    return totals.join(k, "container_kind").select(
        "container_kind", "capacity_tokens", "containers", "tokens",
        F.expr("(tokens + capacity_tokens - 1) div capacity_tokens").alias("least_containers"),
        F.expr("tokens * 10000 div (containers * capacity_tokens)").alias("fill_bp"),
    )
