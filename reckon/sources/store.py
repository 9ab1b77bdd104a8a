"""Versioned parquet datasets under one root: written aside, then made current by a new manifest.

A dataset's manifests are numbered and never change. The newest that can be read is the current one,
so a writer that dies leaves the dataset as it was, and of two writers of one number one fails. What
the last few manifests don't name any more is removed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Manifests, and what they name, that stay for readers that began before a switch.
KEPT = 2


class Store:
    """One workspace. Dropping it removes every dataset, version and manifest it holds."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _list(self, folder: str) -> list[str]:
        at = self._path(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def _load(self, name: str, file: str) -> dict[str, Any] | None:
        stream = self._fs.open(self._path(f"{self.root}/{name}/_manifests/{file}"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        except ValueError:
            return None
        finally:
            stream.close()

    def _manifests(self, name: str) -> list[tuple[int, dict[str, Any]]]:
        """The newest readable manifests, latest first, as many as are kept."""
        out = []
        for file in sorted(self._list(f"{self.root}/{name}/_manifests"), reverse=True):
            if file.endswith(".json") and (m := self._load(name, file)) is not None:
                out.append((int(file[:-5]), m))
                if len(out) == KEPT:
                    break
        return out

    def _switch(self, name: str, manifest: dict[str, Any]) -> None:
        files = [f for f in self._list(f"{self.root}/{name}/_manifests") if f.endswith(".json")]
        no = max((int(f[:-5]) for f in files), default=0) + 1
        out = self._fs.create(self._path(f"{self.root}/{name}/_manifests/{no:012d}.json"), False)
        try:
            out.write(bytearray(json.dumps(manifest).encode()))
        finally:
            out.close()
        kept = self._manifests(name)
        for f in files:
            if int(f[:-5]) < kept[-1][0]:
                self._fs.delete(self._path(f"{self.root}/{name}/_manifests/{f}"), False)
        named = {p.split("/")[0] for _, m in kept for p in m["parts"].values()}
        for version in self._list(f"{self.root}/{name}"):
            if version.startswith("v-") and version not in named:
                self._fs.delete(self._path(f"{self.root}/{name}/{version}"), True)

    def exists(self, name: str) -> bool:
        return bool(self._manifests(name))

    def note(self, name: str) -> dict[str, Any]:
        """What the last writer noted beside the data."""
        current = self._manifests(name)
        return current[0][1].get("note", {}) if current else {}

    def read(self, name: str, parts: Iterable[Any] | None = None) -> DataFrame:
        """The current version, or only some of its parts."""
        current = self._manifests(name)
        if not current:
            raise FileNotFoundError(f"{self.root}/{name}")
        m = current[0][1]
        schema = StructType.fromJson(m["schema"])
        only = None if parts is None else {str(p) for p in parts}
        paths = [f"{self.root}/{name}/{p}" for k, p in m["parts"].items() if only is None or k in only]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def replace(self, name: str, df: DataFrame, *partition_by: str) -> DataFrame:
        """Write a new version and switch to it; ``df`` may read the version before."""
        version = f"v-{uuid.uuid4().hex}"
        (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(f"{self.root}/{name}/{version}")
        self._switch(name, {"schema": df.schema.jsonValue(), "parts": {version: version}})
        return self.read(name)

    def append(self, name: str, df: DataFrame, token: str | None = None) -> DataFrame:
        """Add rows to the current version, or make the first. An append whose token was seen before does nothing."""
        current = self._manifests(name)
        m = current[0][1] if current else {"schema": df.schema.jsonValue(), "parts": {}}
        key = token or uuid.uuid4().hex
        if key not in m["parts"]:
            version = f"v-{uuid.uuid4().hex}"
            columns = StructType.fromJson(m["schema"]).names
            df.select(*columns).write.parquet(f"{self.root}/{name}/{version}")
            self._switch(name, {**m, "parts": {**m["parts"], key: version}})
        return self.read(name)

    def replace_parts(self, name: str, df: DataFrame, part: str, touched: Sequence[Any], note: dict[str, Any] | None = None) -> None:
        """Replace the touched parts by the rows of ``df`` whose column ``part`` names them; the others stay.

        ``part`` itself isn't stored. All parts and the note change in one switch.
        """
        version = f"v-{uuid.uuid4().hex}"
        df.write.partitionBy(part).parquet(f"{self.root}/{name}/{version}")
        fresh = {f.split("=", 1)[1]: f"{version}/{f}" for f in self._list(f"{self.root}/{name}/{version}") if f.startswith(f"{part}=")}
        current = self._manifests(name)
        stay = {k: p for k, p in (current[0][1]["parts"] if current else {}).items() if k not in {str(t) for t in touched}}
        self._switch(name, {"schema": df.drop(part).schema.jsonValue(), "parts": {**stay, **fresh}, "note": note or {}})

    def drop(self, name: str | None = None) -> None:
        self._fs.delete(self._path(f"{self.root}/{name}" if name else self.root), True)
