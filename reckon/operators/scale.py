"""Helpers that keep operators safe at scale: checked broadcasts and durable intermediate tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DataType, StringType, StructType

#: Bytes, as held in memory, up to which a table is broadcast.
MOST_BYTES = 32 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only in local mode, where nothing else is configured, a temporary folder of this machine serves.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    already = spark.sparkContext.getCheckpointDir()
    if already:
        return already.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="reckon-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


#: Scratch folders open in this thread, innermost last; a stream's batches run in threads of their own.
_open = threading.local()


def scratch_folder(spark: SparkSession) -> str:
    """This application's own folder in the shared one; it is removed when the application ends."""
    if getattr(_open, "folders", None):
        return _open.folders[-1]
    folder = f"{shared_folder(spark)}/reckon-{spark.sparkContext.applicationId}"
    at, fs = _file_system(spark, folder)
    if not fs.exists(at):
        fs.mkdirs(at)
        fs.deleteOnExit(at)
    return folder


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """What is materialized inside is removed at the end; results must be read or written before."""
    folder = f"{scratch_folder(spark)}/{uuid.uuid4().hex}"
    _open.folders = [*getattr(_open, "folders", []), folder]
    try:
        yield folder
    finally:
        _open.folders = _open.folders[:-1]
        at, fs = _file_system(spark, folder)
        fs.delete(at, True)


def _written(df: DataFrame, *partition_by: str) -> tuple[DataFrame, str]:
    path = f"{scratch_folder(df.sparkSession)}/t-{uuid.uuid4().hex}"
    (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(path)
    # The schema is known, so reading back needs no job over the footers.
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back.

    Cuts the lineage, survives the loss of an executor, and makes every later reader see the same
    rows even where ``df`` isn't deterministic. Unlike ``checkpoint()`` it computes ``df`` once and
    leaves a columnar table that later scans can prune. The table goes with the application, or with
    the ``scratch`` block around it.
    """
    return _written(df, *partition_by)[0]


def _width(c: Column, kind: DataType) -> Column:
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 16
    if hasattr(kind, "elementType") or hasattr(kind, "keyType") or isinstance(kind, StructType):
        return F.coalesce(F.length(F.to_json(F.struct(c))), F.lit(0)) * 2 + 16
    return F.lit(8)


def measured(df: DataFrame, most_bytes: int = MOST_BYTES) -> tuple[DataFrame, bool]:
    """``df``, written, and whether it takes at most ``most_bytes`` in memory.

    It is computed once and measured as written: by its files first, which settles the large ones,
    then by a scan that adds up the widths of rows.
    """
    table, path = _written(df)
    at, fs = _file_system(df.sparkSession, path)
    if fs.getContentSummary(at).getLength() > most_bytes:
        return table, False
    row = sum((_width(F.col(f"`{f.name}`"), f.dataType) for f in table.schema.fields), F.lit(16))
    size = table.agg(F.sum(row.cast("long")).alias("b")).first()["b"] or 0
    return table, size <= most_bytes


def broadcast_if(df: DataFrame, most_bytes: int = MOST_BYTES) -> DataFrame:
    """``df``, written, with a broadcast hint if it is ``measured`` to be small enough.

    Beyond the bound the join falls back to a shuffle, which adaptive execution may split where a
    partition is skewed.
    """
    table, small = measured(df, most_bytes)
    return F.broadcast(table) if small else table
