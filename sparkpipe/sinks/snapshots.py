"""Tables published by snapshot (M02, M05, M06, K14): readers see a publication whole or not at all.

A table is a folder of generations, which never change, and of versions::

    path/_generation=<id>/<column>=<value>/part-*.parquet   the rows that one publication wrote
    path/_versions/00000012.json                            schema and partition folders of version 12

A publication writes its rows as a new generation and then a version: the partition folders
that stay and the new ones.  One rename commits it, and fails if another writer took the
number.  A job that dies before the rename leaves files that no version names; readers keep
the version they have begun with.  Folders of partitions, not files, are listed, so a version
stays small, and its list prunes with the partition filters of the scan.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .writers import commit_text, delete_path, list_folders, list_names, partition_folder, path_exists, read_text

GENERATION = "_generation"
_VERSIONS = "_versions"


class PublicationConflict(RuntimeError):
    """Another writer published this version first; nothing of this publication is visible."""


@dataclass(frozen=True)
class Snapshot:
    """One version: its number, schema, partition folders, and the last token of each writer."""

    version: int
    schema: T.StructType
    folders: tuple[str, ...] = ()
    tokens: dict = field(default_factory=dict)


def _partition(folder: str) -> str:
    """The partition part of a folder, without its generation."""
    return folder.split("/", 1)[1] if "/" in folder else ""


class SnapshotTable:
    """A table of snapshots below ``path``, partitioned by ``partition_col`` (one column, several
    or none); ``fmt`` and ``options`` as for Spark's readers and writers.

    NULL and the empty string are one partition, as in every partitioned write of Spark.
    """

    def __init__(self, spark: SparkSession, path: str, partition_col: str | Sequence[str] | None = None,
                 fmt: str = "parquet", options: dict | None = None):
        self.spark, self.path, self.partition_col = spark, path.rstrip("/"), partition_col
        self.columns = [partition_col] if isinstance(partition_col, str) else list(partition_col or ())
        self.fmt, self.options = fmt, options or {}

    # -- versions
    def versions(self) -> list[int]:
        """Numbers of the versions, oldest first (a listing)."""
        names = list_names(self.spark, f"{self.path}/{_VERSIONS}")
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def snapshot(self, version: int | None = None) -> Snapshot | None:
        """A version, the latest by default; None if the table has none."""
        known = self.versions()
        if not known:
            return None
        if version is None:
            version = known[-1]
        elif version not in known:
            raise ValueError(f"{self.path} has no version {version}")
        body = json.loads(read_text(self.spark, self._file(version)))
        return Snapshot(version, T.StructType.fromJson(body["schema"]), tuple(body["folders"]), body["tokens"])

    def exists(self) -> bool:
        return bool(self.versions())

    def _file(self, version: int) -> str:
        return f"{self.path}/{_VERSIONS}/{version:08d}.json"

    # -- reading
    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version (the latest); filters on the partition column prune folders."""
        found = self.snapshot(version)
        if found is None:
            raise ValueError(f"{self.path} has no version")
        if not found.folders:
            return self.spark.createDataFrame([], found.schema)
        return self.rows_of(found, found.folders).select(*found.schema.names)

    def rows_of(self, found: Snapshot, folders: Iterable[str]) -> DataFrame:
        """Rows of some folders of a version, with their generation."""
        schema = T.StructType([*found.schema.fields, T.StructField(GENERATION, T.StringType())])
        return (self.spark.read.format(self.fmt).options(**self.options).schema(schema).option("basePath", self.path)
                .load([f"{self.path}/{f}" for f in folders]))

    # -- publishing
    def append(self, rows: DataFrame, writer: str | None = None, token: int | None = None) -> int:
        """Add ``rows``; a version that does not exist yet is the table's first."""
        return self._publish(rows, lambda folder: True, writer, token)

    def overwrite(self, rows: DataFrame, writer: str | None = None, token: int | None = None) -> int:
        """All rows of the table are ``rows`` now."""
        return self._publish(rows, lambda folder: False, writer, token)

    def replace(self, rows: DataFrame, values: Iterable[str | None], writer: str | None = None, token: int | None = None) -> int:
        """The partitions with these values (as text) of the one partition column now hold ``rows``;
        others stay as they are."""
        (column,) = self.columns
        gone = {partition_folder(self.spark, column, v) for v in values}
        return self._publish(rows, lambda folder: _partition(folder) not in gone, writer, token)

    def done(self, writer: str, token: int) -> bool:
        """Whether ``writer`` has published this or a later token: a batch that runs again changes nothing."""
        found = self.snapshot()
        return found is not None and found.tokens.get(writer, -1) >= token

    def _publish(self, rows: DataFrame, stays, writer: str | None = None, token: int | None = None) -> int:
        base = self.snapshot()
        name = f"{GENERATION}={uuid.uuid4().hex}"
        out = f"{self.path}/{name}"
        if self.columns:
            # few files a folder, and a hot partition split across writers
            rows = rows.repartitionByRange(*self.columns, F.xxhash64(*rows.columns))
        rows.write.format(self.fmt).options(**self.options).partitionBy(*self.columns).save(out)
        new = [name]
        for column in self.columns:
            new = [f"{f}/{part}" for f in new for part in list_folders(self.spark, f"{self.path}/{f}") if part.startswith(f"{column}=")]
        kept = [f for f in base.folders if stays(f)] if base else []
        tokens = dict(base.tokens) if base else {}
        if writer is not None:
            tokens[writer] = token
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in (base.schema if base else rows.schema).fields])
        return self._commit(Snapshot(base.version + 1 if base else 0, schema, (*kept, *new), tokens))

    def _commit(self, snapshot: Snapshot) -> int:
        """The one step that makes a publication visible."""
        body = {"schema": snapshot.schema.jsonValue(), "folders": snapshot.folders, "tokens": snapshot.tokens}
        if not commit_text(self.spark, self._file(snapshot.version), json.dumps(body)):
            raise PublicationConflict(f"{self.path} has a version {snapshot.version} already")
        return snapshot.version

    # -- upkeep
    def compact(self, most: int = 2) -> int | None:
        """Rewrite the partitions that lie in more than ``most`` folders as one; same rows.

        A version of its own; None if there is nothing to do.
        """
        found = self.snapshot()
        parts = Counter(_partition(f) for f in found.folders) if found else {}
        small = {f for f in found.folders if parts[_partition(f)] > most} if found else set()
        if not small:
            return None
        return self._publish(self.rows_of(found, small).select(*found.schema.names), lambda folder: folder not in small)

    def expire(self, keep: int) -> int:
        """Drop all but the latest ``keep`` versions and the generations that none of these names.

        Not while a publication runs: its generation is not named yet.  Returns the versions dropped.
        """
        known = self.versions()
        old = known[:-keep] if keep else []
        alive = {f.split("/", 1)[0] for v in known[len(old):] for f in self.snapshot(v).folders}
        for v in old:
            delete_path(self.spark, self._file(v))
        for name in list_folders(self.spark, self.path):
            if name.startswith(f"{GENERATION}=") and name not in alive:
                delete_path(self.spark, f"{self.path}/{name}")
        return len(old)


def open_table(spark: SparkSession, path: str, partition_col: str | None = None) -> SnapshotTable | None:
    """The snapshot table at ``path``, if there is one."""
    return SnapshotTable(spark, path, partition_col) if path_exists(spark, f"{path.rstrip('/')}/{_VERSIONS}") else None
