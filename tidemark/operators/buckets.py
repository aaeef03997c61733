"""Tables kept in hash buckets of their scope, so that a load reads and writes only the buckets of the scopes that it names.

A folder holds data/v=<version>/_bucket=<b>/ and manifests/<version>.json. A version writes new files for the buckets that
it touches; its manifest names, for every bucket, the version that wrote it. A version exists once its manifest does, and
manifests are put in place by a rename, so a load that fails half way changes nothing, and one that runs again under its
old number starts from the state before it and gives the same table.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import cdc


@dataclass
class Merge:
    """What a load did: its diff, and the buckets that it read and wrote."""

    diff: DataFrame
    buckets: list[int]


class ScopeTable:
    """A table with columns of `schema` in n_buckets buckets by the hash of its `scope` columns. n_buckets stays as it is first given."""

    def __init__(self, spark: SparkSession, path: str, schema: str, scope: list[str], n_buckets: int = 256):
        self.spark, self.path, self.schema, self.scope = spark, path.rstrip("/"), schema, list(scope)
        self.columns = spark.createDataFrame([], schema).columns
        self._jvm = spark._jvm.org.apache.hadoop.fs
        self._fs = self._at(self.path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        newest = self._manifest(None)
        self.n_buckets = newest["n_buckets"] if newest else n_buckets

    def _at(self, path: str):
        return self._jvm.Path(path)

    def _names(self, folder: str) -> list[str]:
        at = self._at(folder)
        return [f.getPath().getName() for f in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def versions(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in self._names(f"{self.path}/manifests") if n.endswith(".json"))

    def _manifest(self, before: int | None) -> dict | None:
        """The newest manifest of a version below `before`, or of any."""
        done = [v for v in self.versions() if before is None or v < before]
        if not done:
            return None
        text = self.spark.read.option("wholetext", True).text(f"{self.path}/manifests/{done[-1]}.json").first()[0]
        return json.loads(text)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.scope), F.lit(self.n_buckets)).cast("int")

    def read(self, buckets: list[int] | None = None, before: int | None = None) -> DataFrame:
        """The table at its newest version (below `before`), or only some of its buckets. At most n_buckets folders are named."""
        manifest = self._manifest(before)
        wrote = manifest["wrote"] if manifest else {}
        paths = [f"{self.path}/data/v={v}/_bucket={b}" for b, v in wrote.items() if buckets is None or int(b) in set(buckets)]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def load(self, staged: DataFrame, merge: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]], version: int, before_commit: Callable[[DataFrame], None] | None = None) -> Merge:
        """merge(current, staged) -> (new, diff), on the buckets of the staged scopes alone, as version `version`.

        Later versions must not exist. before_commit gets the diff before the new version is put in place.
        """
        if any(v > version for v in self.versions()):
            raise ValueError(f"version {version} is older than the table")
        staged = staged.select(self.columns)
        touched = sorted(r[0] for r in staged.select(self.bucket().alias("b")).distinct().collect())  # at most n_buckets
        new, diff = merge(self.read(touched, before=version), staged)
        if before_commit:
            before_commit(diff)
        self._commit(new, touched, version)
        return Merge(diff, touched)

    def _holds_scope(self, keys: list[str]) -> None:
        """Then rows match only within their bucket, and all others may stay unread."""
        if not set(self.scope) <= set(keys):
            raise ValueError("the columns that rows match on must hold the scope's columns")

    def merge_identity(self, staged: DataFrame, identity: list[str], version: int, update_payload: bool = False, before_commit: Callable[[DataFrame], None] | None = None) -> Merge:
        self._holds_scope(identity)
        return self.load(staged, lambda cur, stg: cdc.merge_identity(cur, stg, identity, self.scope, update_payload), version, before_commit)

    def merge_composite(self, staged: DataFrame, keys: list[str], version: int, before_commit: Callable[[DataFrame], None] | None = None) -> Merge:
        self._holds_scope(keys)
        return self.load(staged, lambda cur, stg: cdc.merge_composite(cur, stg, keys, self.scope), version, before_commit)

    def merge_keyed(self, staged: DataFrame, key: str, diff_cols: list[str], version: int, null_safe: bool = True, before_commit: Callable[[DataFrame], None] | None = None) -> Merge:
        """The scope of a keyed table is its key: buckets without a staged key stay unread."""
        if self.scope != [key]:
            raise ValueError("the table's scope must be its key")
        return self.load(staged, lambda cur, stg: cdc.merge_keyed(cur, stg, key, diff_cols, null_safe), version, before_commit)

    def _commit(self, rows: DataFrame, touched: list[int], version: int) -> None:
        folder = f"{self.path}/data/v={version}"
        if touched:
            rows.withColumn("_bucket", self.bucket()).repartition("_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(folder)
        full = {n.removeprefix("_bucket=") for n in (self._names(folder) if touched else []) if n.startswith("_bucket=")}
        old = self._manifest(version)
        wrote = {b: v for b, v in (old["wrote"] if old else {}).items() if int(b) not in touched} | {b: version for b in full}
        text = json.dumps({"n_buckets": self.n_buckets, "wrote": wrote})
        draft, final = self._at(f"{self.path}/manifests/.{version}.draft"), self._at(f"{self.path}/manifests/{version}.json")
        out = self._fs.create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        self._fs.delete(final, False)
        if not self._fs.rename(draft, final):
            raise OSError(f"could not put the manifest of version {version} in place")

    def clean(self, keep: int = 2) -> None:
        """Deletes manifests but the newest `keep`, and the buckets that none of those name."""
        versions = self.versions()
        kept = versions[-keep:]
        named = set()
        for v in kept:
            named |= {(int(b), int(w)) for b, w in self._manifest(v + 1)["wrote"].items()}
        for v in versions[:-keep]:
            self._fs.delete(self._at(f"{self.path}/manifests/{v}.json"), False)
        for name in self._names(f"{self.path}/data"):
            v = int(name.removeprefix("v="))
            for b in self._names(f"{self.path}/data/{name}"):
                if b.startswith("_bucket=") and v <= kept[-1] and (int(b.removeprefix("_bucket=")), v) not in named:
                    self._fs.delete(self._at(f"{self.path}/data/{name}/{b}"), True)
