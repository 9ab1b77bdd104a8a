"""Mixing sources to target weights: pivotal dependent rounding of fractional copies.

A document of a source should appear c times, the source's tokens wanted over its tokens there are.
The whole part of c is certain. The fraction is rounded by pairing documents of one source and moving
*tokens* between the two, in a random direction, until one of them is taken or left: each move keeps
the source's expected tokens exactly and each document's expectation. Lanes round in parallel; each
leaves at most one open document per source, and a tree of further rounds combines these. Large
documents go first, so that the one drawn at the very end tends to be small.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reckon.llm.lanes import reduce_in_rounds

PER_LANE = 200_000
#: Targets up to which they are read into the driver (a parameter table).
MOST_TARGETS = 10_000


@dataclass(frozen=True)
class Share:
    """What a source is to give: tokens wanted, and copies wanted of each of its documents."""

    source: str
    target_bp: int
    max_repeats: int
    documents: int
    available: int
    wanted: float

    @property
    def copies(self) -> float:
        c = min(float(self.max_repeats), self.wanted / self.available) if self.available else 0.0
        # Within rounding of a whole number there is nothing to draw.
        return float(round(c)) if abs(c - round(c)) < 1e-9 else c


def plan(targets: list[tuple[str, int, int]], available: dict[str, tuple[int, int]], total: int | None = None) -> list[Share]:
    """Tokens each source is to give, so that shares come as near to the targets as repeats allow.

    targets: (source, basis points, most copies). available: documents and tokens of each source.
    Without ``total``, the total is the largest at which every source that has tokens reaches its
    share; sources without tokens give nothing, and the others share the rest in proportion. With a
    larger ``total``, sources at their limit give all they may, and the others fill up in proportion.
    """
    live = [(s, bp, most, available[s][1]) for s, bp, most in targets if bp > 0 and most > 0 and available.get(s, (0, 0))[1] > 0]
    weight = sum(bp for _, bp, _, _ in live)
    if total is None:
        total = min((most * have * weight / bp for _, bp, most, have in live), default=0)
    wanted: dict[str, float] = {}
    rest, open_ = float(total), list(live)
    while open_:
        unit = rest / sum(bp for _, bp, _, _ in open_)
        capped = [x for x in open_ if x[2] * x[3] <= unit * x[1]]
        for s, bp, most, have in capped or open_:
            wanted[s] = float(most * have) if capped else unit * bp
            rest -= wanted[s]
        open_ = [x for x in open_ if x not in capped] if capped else []
    return [Share(s, bp, most, *available.get(s, (0, 0)), wanted.get(s, 0.0)) for s, bp, most in targets]


def chance(*of: object) -> float:
    """A number in [0, 1) that depends on nothing but its arguments."""
    return xxhash.xxh3_64_intdigest("\x1f".join(map(repr, of))) / 2**64


def settle(a: tuple, b: tuple, u: float) -> tuple[tuple, tuple]:
    """Move tokens between two open documents (id, source, tokens, p) until one has p 0 or 1.

    The expected tokens of both together stay; which one gains is drawn so that neither expects more.
    """
    (ia, sa, wa, pa), (ib, sb, wb, pb) = a, b
    to_a, to_b = min((1 - pa) * wa, pb * wb), min(pa * wa, (1 - pb) * wb)
    gain = to_a if u * (to_a + to_b) < to_b else -to_b
    na, nb = pa + gain / wa, pb - gain / wb
    # The side that set the amount ends exactly at 0 or 1, whatever the rounding of the division.
    if gain >= 0:
        na, nb = (1.0 if (1 - pa) * wa <= pb * wb else na), (0.0 if pb * wb <= (1 - pa) * wa else nb)
    else:
        na, nb = (0.0 if pa * wa <= (1 - pb) * wb else na), (1.0 if (1 - pb) * wb <= pa * wa else nb)
    return (ia, sa, wa, min(1.0, max(0.0, na))), (ib, sb, wb, min(1.0, max(0.0, nb)))


def pivot(rows: Iterator[tuple], last: bool, seed: int) -> Iterator[tuple]:
    """(id, source, tokens, p, open): rounds rows (id, source, tokens, p) of one source in turn."""
    held: tuple | None = None
    for row in rows:
        if held is None:
            held = row
            continue
        a, b = settle(held, row, chance(seed, held[0], row[0]))
        held = None
        for x in (a, b):
            if x[3] in (0.0, 1.0):
                yield (*x, False)
            else:
                held = x
    if held is not None:
        yield (*held[:3], float(chance(seed, "last", held[0]) < held[3]), False) if last else (*held, True)


def mix(documents: DataFrame, targets: DataFrame, *, id: str, source: str, size: str, total: int | None = None, seed: int = 7, per_lane: int = PER_LANE) -> tuple[DataFrame, list[Share]]:
    """((id, source, n_tokens, copies) of the chosen documents, the plan).

    Sizes must be written or cheap to compute, as they are read three times. Documents of no tokens,
    of a NULL source, or of a source without a target are never chosen. A source's tokens differ from
    those wanted by less than its largest document. Repeated rows are separate documents.
    """
    rows = documents.where((F.col(size) > 0) & F.col(source).isNotNull()).select(F.col(id).alias("id"), F.col(source).alias("source"), F.col(size).cast("long").alias("tokens"))
    wish = [(r["source"], int(r["target_share_bp"]), int(r["max_repeats"])) for r in targets.where("source IS NOT NULL").select("source", "target_share_bp", "max_repeats").distinct().limit(MOST_TARGETS + 1).collect()]
    if len(wish) > MOST_TARGETS:
        raise ValueError(f"more than {MOST_TARGETS} targets")
    names = [s for s, _, _ in wish]
    if len(set(names)) < len(names):
        raise ValueError("a source has more than one target")
    have = {r["source"]: (r["n"], r["t"]) for r in rows.where(F.col("source").isin(names)).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("t")).collect()}
    shares = plan(wish, have, total)
    spark = documents.sparkSession
    copies = spark.createDataFrame([(s.source, s.copies) for s in shares if s.copies > 0], "source string, c double")
    # As many rows as targets, which are bounded above.
    each = rows.join(F.broadcast(copies), "source").withColumn("base", F.floor("c")).withColumn("p", F.col("c") - F.floor("c"))
    id_type = dict(rows.dtypes)["id"]

    def step(round_no: int, lane: int, key: object, own: Iterator[tuple], last: bool) -> Iterator[tuple]:
        return pivot(own, last, seed + round_no)

    fractions = each.where("p > 0").select("id", "source", "tokens", "p")
    rounded = reduce_in_rounds(fractions, group="source", hashed=["source", "id", "tokens"], per_lane=per_lane, step=step, schema=f"id {id_type}, source string, tokens long, p double, open boolean", columns=["id", "source", "tokens", "p"], first=("tokens",), seed=seed)
    whole = each.where("p = 0").select("id", "source", "tokens", F.col("base").cast("long").alias("copies"))
    part = rounded.join(F.broadcast(copies), "source").select("id", "source", "tokens", (F.floor("c") + F.col("p")).cast("long").alias("copies"))
    chosen = whole.unionByName(part).where("copies > 0")
    return chosen.select(F.col("id").alias(id), F.col("source").alias(source), F.col("tokens").alias("n_tokens"), "copies"), shares


def actual_shares(chosen: DataFrame, shares: list[Share], *, source: str) -> DataFrame:
    """(source, target_share_bp, max_repeats, available_tokens, chosen_tokens, actual_share_bp) of each target.

    The actual share is in whole basis points, rounded down; NULL if nothing is chosen at all.
    """
    spark = chosen.sparkSession
    got = chosen.groupBy(F.col(source).alias("source")).agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("t"))
    asked = spark.createDataFrame([(s.source, s.target_bp, s.max_repeats, s.available) for s in shares], "source string, target_share_bp int, max_repeats int, available_tokens long")
    both = asked.join(got, "source", "left").withColumn("chosen_tokens", F.coalesce("t", F.lit(0)))
    total = both.agg(F.sum("chosen_tokens").alias("all"))
    share = F.expr("chosen_tokens * 10000") / F.nullif(total.scalar(), F.lit(0))
    return both.select("source", "target_share_bp", "max_repeats", "available_tokens", "chosen_tokens", F.floor(share).alias("actual_share_bp"))
