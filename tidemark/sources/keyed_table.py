"""A keyed table on plain Parquet: snapshots by version, upserts of the touched buckets, time travel, replay guard.

Rows lie in ``<path>/v=N/bucket=B``: bucket B is a hash of the key, N the version that wrote it.
``<path>/_versions/N.json`` names the version of each bucket and is written last, which makes version N
visible.  An upsert reads and rewrites only the buckets of its batch's keys.  All goes through Hadoop's
FileSystem, so any store works whose create-without-overwrite is atomic.  A version whose manifest isn't
there is never seen.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class KeyedTable:
    """``keys`` and ``schema`` (DDL) of a table under ``path``; ``buckets``: fixed when its first version is written."""

    spark: SparkSession
    path: str
    schema: str
    keys: tuple[str, ...]
    buckets: int = 16

    def _fs(self, name: str):
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), where

    def _names(self, folder: str) -> list[str]:
        fs, where = self._fs(folder)
        return [f.getPath().getName() for f in fs.listStatus(where)] if fs.exists(where) else []

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self._names("_versions") if n.endswith(".json"))

    def _manifest(self, version: int | None = None) -> dict:
        """What was recorded with a version, by default the last."""
        found = self.versions()
        if not found:
            return {"version": None, "batch_id": None, "operation": None, "buckets": {}, "writers": {}, "of": self.buckets}
        if version is not None and version not in found:
            raise ValueError(f"{self.path} has no version {version}")
        fs, where = self._fs(f"_versions/{found[-1] if version is None else version}.json")
        stream = fs.open(where)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def detail(self, version: int | None = None) -> dict:
        """A version's number, batch_id and operation, by default those of the last."""
        found = self._manifest(version)
        return {k: found[k] for k in ("version", "batch_id", "operation")}

    def history(self) -> list[dict]:
        return [self.detail(v) for v in self.versions()]

    def _bucket(self, of: int) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(of)).cast("int")

    def _rows(self, buckets: dict[str, int]) -> DataFrame:
        if not buckets:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/v={v}/bucket={b}" for b, v in sorted(buckets.items())])

    def read(self, version: int | None = None) -> DataFrame:
        """Rows of a version, by default the last; an empty table where there is none yet."""
        return self._rows(self._manifest(version)["buckets"]) if version is not None or self.versions() else self._rows({})

    def _touched(self, batch: DataFrame, of: int) -> set[str]:
        """Buckets of the batch's keys: at most ``of`` numbers reach the driver."""
        return {str(r["b"]) for r in batch.select(self._bucket(of).alias("b")).distinct().collect()}

    def read_buckets_of(self, batch: DataFrame) -> DataFrame:
        """Rows of the last version in the buckets of the batch's keys, all that an upsert of the batch may meet."""
        last = self._manifest()
        touched = self._touched(batch, last["of"]) if last["buckets"] else set()
        return self._rows({b: v for b, v in last["buckets"].items() if b in touched})

    def _write(self, rows: DataFrame, before: dict, kept: dict[str, int], batch_id: int | None, operation: str, writer: str) -> int:
        version = 0 if before["version"] is None else before["version"] + 1
        names = [c.split(" ")[0] for c in self.schema.split(", ")]
        # Dealt by bucket, so that a bucket is a few files of a good size, not one from every task; a large one is split.
        keyed = rows.select(*names, self._bucket(before["of"]).alias("bucket")).hint("rebalance", "bucket")
        keyed.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(f"{self.path}/v={version}")
        made = {n.split("=")[1]: version for n in self._names(f"v={version}") if n.startswith("bucket=")}
        writers = before["writers"] | ({writer: batch_id} if batch_id is not None else {})
        text = {"version": version, "batch_id": batch_id, "operation": operation, "buckets": kept | made, "writers": writers, "of": before["of"]}
        fs, where = self._fs(f"_versions/{version}.json")
        out = fs.create(where, False)
        try:
            out.write(bytearray(json.dumps(text).encode()))
        finally:
            out.close()
        return version

    def write(self, rows: DataFrame, batch_id: int | None = None, operation: str = "write", writer: str = "") -> int:
        """Writes ``rows`` as the whole next version and makes it visible; returns its number."""
        return self._write(rows, self._manifest(), {}, batch_id, operation, writer)

    def upsert(self, batch: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], batch_id: int | None = None, writer: str = "") -> bool:
        """Replaces the rows of the batch's buckets by ``merge(their rows, batch)``; the batch holds this table's keys.

        A batch id that isn't above the last one of the same ``writer`` (a streaming query's id) changes
        nothing; another writer counts from its own beginning.
        """
        before = self._manifest()
        last = before["writers"].get(writer)
        if batch_id is not None and last is not None and batch_id <= last:
            return False
        touched = self._touched(batch, before["of"])
        held = {b: v for b, v in before["buckets"].items() if b in touched}
        kept = {b: v for b, v in before["buckets"].items() if b not in touched}
        self._write(merge(self._rows(held), batch), before, kept, batch_id, "merge", writer)
        return True

    def vacuum(self, keep: int = 2) -> None:
        """Deletes all but the last ``keep`` versions and the files that only those used."""
        found = self.versions()
        used = {(str(v), b) for n in found[-keep:] for b, v in self._manifest(n)["buckets"].items()}
        for n in found[:-keep]:
            fs, where = self._fs(f"_versions/{n}.json")
            fs.delete(where, True)
        for folder in self._names(""):
            if folder.startswith("v=") and found and int(folder[2:]) <= found[-1]:
                for name in self._names(folder):
                    if name.startswith("bucket=") and (folder[2:], name.split("=")[1]) not in used:
                        fs, where = self._fs(f"{folder}/{name}")
                        fs.delete(where, True)

    def delete(self) -> None:
        fs, where = self._fs("")
        fs.delete(where, True)
