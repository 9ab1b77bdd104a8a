"""Queries p6 to p8 over the documents, whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reckon.llm import mixing, packing
from reckon.llm.tokens import sized
from reckon.llm.truncation import Truncation
from reckon.operators.scale import materialize
from reckon.sources.tables import table


def _sizes(spark: SparkSession, sf: str, *carry: str) -> DataFrame:
    return materialize(sized(table(spark, sf, "documents"), text="text", carry=carry))


def p6_pack(spark: SparkSession, sf: str) -> DataFrame:
    """Which text lies in which container, for each kind of container."""
    sizes = _sizes(spark, sf, "doc_id")
    return packing.pack(sizes, table(spark, sf, "pack_sizes"), id="doc_id", size="n_tokens", kind="container_kind", capacity="capacity_tokens")


def p6_fill(spark: SparkSession, sf: str) -> DataFrame:
    """How full the containers of each kind are, beside the least number possible."""
    return packing.fill(p6_pack(spark, sf), table(spark, sf, "pack_sizes"), kind="container_kind", capacity="capacity_tokens")


def _mixed(spark: SparkSession, sf: str, whole: bool = False):
    """The mix at the largest total that keeps all shares, or at as many tokens as there are."""
    sizes = _sizes(spark, sf, "doc_id", "source")
    total = (sizes.agg(F.sum("n_tokens").alias("n")).first()["n"] or 0) if whole else None
    return mixing.mix(sizes, table(spark, sf, "mix_targets"), id="doc_id", source="source", size="n_tokens", total=total)


def p7_mix(spark: SparkSession, sf: str) -> DataFrame:
    """The chosen documents and how often each appears."""
    return _mixed(spark, sf)[0]


def p7_shares(spark: SparkSession, sf: str) -> DataFrame:
    """The share that each source has in the mix, beside its target."""
    chosen, shares = _mixed(spark, sf)
    return mixing.actual_shares(chosen, shares, source="source")


def p7_shares_whole(spark: SparkSession, sf: str) -> DataFrame:
    """The shares of a mix of as many tokens as there are: sources at their most repeats fall short, and the others fill up."""
    chosen, shares = _mixed(spark, sf, whole=True)
    return mixing.actual_shares(chosen, shares, source="source")


def _truncation(spark: SparkSession, sf: str) -> Truncation:
    return Truncation(table(spark, sf, "documents"), id="doc_id", source="source", text="text")


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    """Documents whose text was cut before its end."""
    return _truncation(spark, sf).found().select(F.col("id").alias("doc_id"))


def p8_rates(spark: SparkSession, sf: str) -> DataFrame:
    """How often each source's documents are cut."""
    return _truncation(spark, sf).rates()


def p8_limits(spark: SparkSession, sf: str) -> DataFrame:
    """Candidate limits of each source, with texts at each length and those expected there naturally."""
    t = _truncation(spark, sf)
    return t.cells.select("scope", "unit", "limit", "length", "texts", F.round("natural", 3).alias("natural"), F.round("prior", 4).alias("prior"))


QUERIES = {f.__name__: f for f in (p6_pack, p6_fill, p7_mix, p7_shares, p7_shares_whole, p8_found, p8_rates, p8_limits)}

#: None of these can be said in SQL; tests/llm holds them against brute force and invariants.
SQL: dict[str, str] = {}
