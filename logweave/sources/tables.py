"""Keyed tables of a base and small deltas, where a manifest per version says which files count.

A writer adds a delta folder and then the next manifest, which names the base and
all deltas since; a fold writes a new base and then a manifest that names it alone.
Manifests are written last and never changed, so a reader that has picked one sees
the same rows for as long as its files exist, whatever is folded meanwhile.
:meth:`Table.expire` removes what the newest manifests no longer name.

Two writers that commit the same version: the second one fails, and may try again.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from logweave.operators import keyed

_MANIFEST = "base string, deltas array<struct<batch: bigint, folder: string>>, done bigint, version bigint"
NONE = -1
# Rows of a base come before those of every delta.
BASE_BATCH = -1
_BATCH = "__batch"


@dataclass(frozen=True)
class Version:
    """What one manifest names; ``done`` is the last batch that is in it."""

    number: int = NONE
    base: str | None = None
    deltas: tuple[tuple[int, str], ...] = ()
    done: int = NONE


@dataclass(frozen=True)
class Table:
    """A table below ``path``; per key the row of the newest batch counts, in it the greatest ``order``."""

    spark: SparkSession
    path: str
    schema: StructType
    keys: tuple[str, ...]
    order: tuple[str, ...] = ()

    def versions(self) -> DataFrame:
        """One row per manifest that is still there."""
        found = self.spark.read.schema(_MANIFEST).option("basePath", self._manifests).json(self._manifests)
        return found.filter("version IS NOT NULL")

    @property
    def _manifests(self) -> str:
        return f"{self.path}/manifests"

    def current(self, before: int | None = None) -> Version:
        """The newest version, to be handed to :meth:`read` as often as its rows are wanted.

        With ``before`` the newest without that batch and later ones, for a batch that is replayed.
        """
        try:
            versions = self.versions() if before is None else self.versions().filter(F.col("done") < before)
            found = versions.agg(F.max_by(F.struct("*"), "version").alias("v")).first()["v"]
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return Version()
        if found is None:
            return Version()
        deltas = tuple((d["batch"], d["folder"]) for d in found["deltas"])
        return Version(found["version"], found["base"], deltas, found["done"])

    def read(self, version: Version | None = None) -> DataFrame:
        """The rows of a version, the newest if none is given."""
        version = self.current() if version is None else version
        named = [(BASE_BATCH, version.base)] if version.base else []
        parts = [
            self.spark.read.schema(self.schema).parquet(f"{self.path}/{folder}").withColumn(_BATCH, F.lit(batch))
            for batch, folder in (*named, *version.deltas)
        ]
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        return keyed.latest(rows, self.keys, [_BATCH, *self.order]).drop(_BATCH)

    def _commit(self, version: Version) -> Version:
        row = [(version.base, list(version.deltas), version.done)]
        fields = "base string, deltas array<struct<batch: bigint, folder: string>>, done bigint"
        manifest = self.spark.createDataFrame(row, fields).coalesce(1)
        manifest.write.mode("error").json(f"{self._manifests}/version={version.number}")
        return version

    def add(self, rows: DataFrame, batch: int) -> Version:
        """The rows of a batch as one more delta; a batch that is in the table already is left alone."""
        now = self.current()
        if batch <= now.done:
            return now
        folder = f"data/batch-{batch}-{uuid.uuid4().hex}"
        rows.select(*self.schema.names).write.parquet(f"{self.path}/{folder}")
        deltas = (*now.deltas, (batch, folder))
        return self._commit(replace(now, number=now.number + 1, deltas=deltas, done=batch))

    def fold(self) -> Version:
        """Base and deltas as one new base."""
        now = self.current()
        if not now.deltas:
            return now
        folder = f"data/base-{now.number + 1}-{uuid.uuid4().hex}"
        self.read(now).select(*self.schema.names).write.parquet(f"{self.path}/{folder}")
        return self._commit(Version(now.number + 1, folder, (), now.done))

    def expire(self, keep: int = 10) -> list[str]:
        """Remove all but the newest ``keep`` manifests, then the folders that none of those names.

        Folders are listed before the manifests are read, so one that a writer is
        still filling, newer than every manifest, would be lost: expire between
        batches, from the writer.
        """
        listed = _folders(self.spark, f"{self.path}/data")
        found = self.versions().orderBy(F.desc("version")).collect()
        kept, gone = found[:keep], found[keep:]
        named = {row["base"] for row in kept} | {d["folder"] for row in kept for d in row["deltas"]}
        old = [f"data/{name}" for name in listed if f"data/{name}" not in named]
        removed = [*(f"manifests/version={row['version']}" for row in gone), *old]
        for folder in removed:
            _remove(self.spark, f"{self.path}/{folder}")
        return removed


def table(
    spark: SparkSession, path: str, schema: StructType | str, keys: Sequence[str], order: Sequence[str] = ()
) -> Table:
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return Table(spark, path.rstrip("/"), schema, tuple(keys), tuple(order))


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _folders(spark: SparkSession, path: str) -> list[str]:
    files, at = _file_system(spark, path)
    return [entry.getPath().getName() for entry in files.listStatus(at)] if files.exists(at) else []


def _remove(spark: SparkSession, path: str) -> None:
    files, at = _file_system(spark, path)
    files.delete(at, True)
