"""Sizes of texts in tokens of a public tokenizer, counted beside the scan."""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A vocabulary file of ranks; any file of this form may be given instead.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How byte-level BPE of this vocabulary splits a text before merging (a fixed value of the format).
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


@functools.lru_cache(maxsize=4)
def encoder(vocabulary: str):
    """The encoder of a vocabulary file; a Python worker loads it once."""
    import tiktoken

    with open(vocabulary, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}
    return tiktoken.Encoding("public", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def sized(documents: DataFrame, *, text: str, carry: Sequence[str], vocabulary: str = VOCABULARY) -> DataFrame:
    """``carry`` columns and ``n_tokens`` of every row; whole texts, NULL and empty ones have 0 tokens.

    Only the text and the carried columns are read, and no text leaves its task.
    """
    carry = list(carry)
    rows = documents.select(*carry, F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode_ordinary
        for batch in batches:
            counts = [len(encode(t)) if (t := x.as_py()) else 0 for x in batch.column("_text")]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carry], pa.array(counts, pa.int64())], names=[*carry, "n_tokens"])

    ddl = ", ".join(f"`{c}` {t}" for c, t in rows.select(*carry).dtypes)
    return rows.mapInArrow(run, f"{ddl}, n_tokens long")
