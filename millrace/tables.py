"""Immutable table versions on plain parquet.

Each write goes to a folder of its own; a small manifest, created last and never overwritten,
names the folders that make up version *n* together with the schema and the bookmark of the
change data it contains. Readers see whole versions only, a rewrite may leave untouched
partitions where they are, and a snapshot is a manifest that points to the same folders.

A write has two steps: ``prepare`` writes the rows and counts them on the way, ``commit`` makes
them the next version. Between the two they can be read and checked; ``reject`` keeps them as a
version that never was, with the reasons.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .operators.changes import table_changes
from .operators.joins import table_bytes
from .operators.merge import ACTION, merge_counts
from .storage import FileSystem, release

_VERSION = "_v"
_PUBLISHED = "_published"
_ACTIONS = ("I", "U", "D")
LARGE_BYTES = 256 * 1024 * 1024  # written rows from which on their shuffle files are dropped at once


@dataclass(frozen=True)
class Manifest:
    version: int
    schema: str
    base: str
    folders: list[str]
    partition_by: list[str] = field(default_factory=list)
    partitions: dict[str, str] = field(default_factory=dict)
    written: str = ""
    bookmark: int | None = None
    #: Counted while the version was written: its new rows, those of each merge action, and what
    #: the writer asked for besides.
    counts: dict[str, int] = field(default_factory=dict)
    #: What belongs to the version beside its rows, such as the versions of its index.
    extra: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Prepared:
    """Rows that are written but not yet a version."""

    name: str
    manifest: Manifest


class TableStore:
    """Named, versioned tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._fs = FileSystem(spark, root)

    # -- versions ------------------------------------------------------------------------------

    def versions(self, name: str) -> list[int]:
        files = self._fs.names(f"{self.root}/{name}/versions")
        return sorted(int(f[:-5]) for f in files if f.endswith(".json") and f[:-5].isdigit())

    def exists(self, name: str) -> bool:
        return bool(self.versions(name))

    def manifest(self, name: str, version: int | None = None) -> Manifest:
        if version is None:
            known = self.versions(name)
            if not known:
                raise LookupError(f"no such table: {name}")
            version = known[-1]
        return Manifest(**json.loads(self._fs.read_text(f"{self.root}/{name}/versions/{version:010d}.json")))

    def bookmark(self, name: str) -> int | None:
        return self.manifest(name).bookmark if self.exists(name) else None

    def _commit(self, name: str, manifest: Manifest) -> int:
        self._fs.create_text(
            f"{self.root}/{name}/versions/{manifest.version:010d}.json", json.dumps(manifest.__dict__)
        )
        return manifest.version

    # -- write and read --------------------------------------------------------------------------

    def prepare(
        self,
        df: DataFrame,
        name: str,
        partition_by: Sequence[str] = (),
        bookmark: int | None = None,
        keep_partitions: Iterable[str] = (),
        onto: int | None = None,
        observe: Mapping[str, Column] | None = None,
        options: Mapping[str, str] | None = None,
    ) -> Prepared:
        """Write ``df`` as what may become the next version.

        ``keep_partitions`` names partition values of the previous version, or of version
        ``onto`` (single partition column), that are carried over as they are; the caller does
        not include them in ``df``. ``observe`` are further aggregates to take during the write,
        ``options`` go to the Parquet writer.
        """
        known = self.versions(name)
        version = known[-1] + 1 if known else 1
        base = f"{self.root}/{name}/data"
        mark = f"{version:010d}-{uuid.uuid4().hex[:8]}"
        folder = f"{base}/{_VERSION}={mark}"
        metrics = {"rows": F.count(F.lit(1)), **(observe or {})}
        if (size := table_bytes(df)) is not None:
            metrics["bytes"] = size
        if ACTION in df.columns:
            metrics |= {f"rows_{a}": F.count_if(F.col(ACTION) == a) for a in _ACTIONS}
        # Each task of the write counts its own rows; no other job is needed for the counts.
        observation = Observation()
        observed = df.observe(observation, *[m.alias(k) for k, m in metrics.items()])
        writer = observed.write.mode("errorifexists").options(**{"compression": "zstd", **(options or {})})
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(folder)
        counts = {k: int(v) for k, v in observation.get.items() if v is not None}
        if counts.get("bytes", 0) >= LARGE_BYTES:
            release(self.spark)
        partitions: dict[str, str] = {}
        if len(partition_by) == 1:
            partitions = {
                n.split("=", 1)[1]: f"{folder}/{n}" for n in self._fs.names(folder) if n.startswith(partition_by[0] + "=")
            }
            if known:
                previous = self.manifest(name, onto or known[-1]).partitions
                partitions |= {v: previous[v] for v in keep_partitions if v not in partitions}
        elif list(keep_partitions):
            raise ValueError("partitions can be kept for a single partition column only")
        return Prepared(
            name,
            Manifest(
                version=version,
                schema=df.schema.json(),
                base=base,
                folders=sorted(partitions.values()) if partition_by and partitions else [folder],
                partition_by=list(partition_by),
                partitions=partitions,
                written=mark,
                bookmark=bookmark,
                counts=counts,
            ),
        )

    def commit(self, prepared: Prepared, extra: Mapping | None = None) -> int:
        """Make prepared rows the next version; fails when another writer came first."""
        return self._commit(prepared.name, replace(prepared.manifest, extra=dict(extra or {})))

    def write(self, df: DataFrame, name: str, partition_by: Sequence[str] = (), *args, extra: Mapping | None = None, **options) -> int:
        """Write ``df`` as the next version: ``prepare`` and ``commit`` in one."""
        return self.commit(self.prepare(df, name, partition_by, *args, **options), extra)

    def read_prepared(self, prepared: Prepared) -> DataFrame:
        """The rows a commit would show, carried-over partitions included."""
        return self._scan(prepared.manifest, prepared.manifest.folders).drop(_VERSION, ACTION)

    def prepared_rows(self, prepared: Prepared) -> DataFrame:
        """The rows that were written, with their merge action."""
        manifest = prepared.manifest
        return self._scan(manifest, [f for f in manifest.folders if f"/{_VERSION}={manifest.written}" in f]).drop(_VERSION)

    def reject(self, prepared: Prepared, failures: Sequence[Mapping]) -> str:
        """Leave prepared rows out of the table for good, and write down why; returns their mark."""
        mark = prepared.manifest.written
        record = {"manifest": prepared.manifest.__dict__, "failures": [dict(f) for f in failures]}
        self._fs.create_text(f"{self.root}/{prepared.name}/rejected/{mark}.json", json.dumps(record))
        return mark

    def rejected(self, name: str) -> dict[str, list[dict]]:
        """Failures of each rejected version of a table, by mark, in the order they were prepared."""
        folder = f"{self.root}/{name}/rejected"
        marks = sorted(f[:-5] for f in self._fs.names(folder) if f.endswith(".json"))
        return {m: json.loads(self._fs.read_text(f"{folder}/{m}.json"))["failures"] for m in marks}

    def read_rejected(self, name: str, mark: str) -> DataFrame:
        """The rows of a rejected version, to look into."""
        record = json.loads(self._fs.read_text(f"{self.root}/{name}/rejected/{mark}.json"))
        return self.read_prepared(Prepared(name, Manifest(**record["manifest"])))

    def _scan(self, manifest: Manifest, folders: Sequence[str]) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(manifest.schema))
        if not folders:
            return self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema]).limit(0)
        schema = T.StructType([*schema.fields, T.StructField(_VERSION, T.StringType())])
        return self.spark.read.schema(schema).option("basePath", manifest.base).parquet(*folders)

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """The table's columns at a version (default: the latest)."""
        manifest = self.manifest(name, version)
        return self._scan(manifest, manifest.folders).drop(_VERSION, ACTION)

    def read_partitions(self, name: str, values: Iterable[str], version: int | None = None) -> DataFrame:
        """A version's rows with these partition values; other folders are not listed."""
        manifest = self.manifest(name, version)
        return self._scan(manifest, [manifest.partitions[v] for v in values if v in manifest.partitions]).drop(
            _VERSION, ACTION
        )

    def written_rows(self, name: str, version: int | None = None) -> DataFrame:
        """Rows written by the run that made this version, with their merge action."""
        manifest = self.manifest(name, version)
        new = [f for f in manifest.folders if f"/{_VERSION}={manifest.written}" in f]
        return self._scan(manifest, new).drop(_VERSION)

    def merge_counts(self, name: str, version: int | None = None) -> DataFrame:
        """Inserted, updated and deleted rows of the merge that wrote this version.

        They were counted during the write. Only for a version written without counts is the
        action column read.
        """
        counts = self.manifest(name, version).counts
        if "rows_I" not in counts:
            return merge_counts(self.written_rows(name, version).select(ACTION))
        names = {"rows_inserted": "I", "rows_updated": "U", "rows_deleted": "D"}
        return self.spark.range(1).select(*[F.lit(counts[f"rows_{a}"]).cast("long").alias(n) for n, a in names.items()])

    def size(self, name: str, version: int | None = None) -> int | None:
        """Bytes of a version that was written as a whole, as measured during its write; else None."""
        manifest = self.manifest(name, version)
        if any(f"/{_VERSION}={manifest.written}" not in f for f in manifest.folders):
            return None
        return manifest.counts.get("bytes", 0 if manifest.counts.get("rows") == 0 else None)

    def changes(self, name: str, old: int, new: int, keys: Sequence[str]) -> DataFrame:
        """Rows that differ between two versions, with ``_change`` insert, update or delete.

        The manifests are compared first: folders that both versions name hold the same rows and
        are not read. A row that moved between partitions is an update, as both have changed.
        """
        before, after = self.manifest(name, old), self.manifest(name, new)
        shared = set(before.folders) & set(after.folders)
        sides = [
            self._scan(m, [f for f in m.folders if f not in shared]).drop(_VERSION, ACTION) for m in (before, after)
        ]
        return table_changes(*sides, keys)

    def read_or_empty(self, name: str, schema: str) -> DataFrame:
        """The latest version, or no rows of ``schema`` before the first."""
        if self.exists(name):
            return self.read(name)
        fields = T._parse_datatype_string(schema).fields
        # LIMIT 0 is known to be empty at planning time: joins with it are planned away.
        return self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields]).limit(0)

    def create(self, name: str, schema: str) -> int:
        """An empty table."""
        return self.write(self.read_or_empty(name, schema), name)

    # -- append, view, snapshot --------------------------------------------------------------------

    def append(self, df: DataFrame, name: str) -> None:
        """Add rows to an append-only table."""
        df.write.mode("append").parquet(f"{self.root}/{name}/rows")

    def read_appended(self, name: str, schema: str) -> DataFrame:
        path = f"{self.root}/{name}/rows"
        if not self._fs.exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def register(self, name: str, view: str | None = None) -> None:
        """Name the latest version as a temporary view."""
        self.read(name).createOrReplaceTempView(view or name)

    def publish(self, target: TableStore, names: Sequence[str], copy: bool = False) -> dict[str, int]:
        """Snapshot tables into another store.

        By default the snapshot shares the immutable folders of the current version; ``copy``
        rewrites the data. Later writes on either side do not show on the other.
        """
        done = {}
        if not copy:  # from now on this store keeps what the other one's manifests name
            known = f"{self.root}/{_PUBLISHED}/{hashlib.md5(target.root.encode()).hexdigest()}"
            self._fs.create_text(known, target.root, overwrite=True)
        for name in names:
            if copy:
                manifest = self.manifest(name)
                done[name] = target.write(self.read(name), name, manifest.partition_by, manifest.bookmark)
                continue
            known = target.versions(name)
            manifest = replace(self.manifest(name), version=known[-1] + 1 if known else 1, extra={})
            done[name] = target._commit(name, manifest)
        return done


    # -- retention -----------------------------------------------------------------------------------

    def tables(self) -> list[str]:
        return [n for n in self._fs.names(self.root) if self._fs.exists(f"{self.root}/{n}/versions")]

    def _manifest_path(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/versions/{version:010d}.json"

    def _needed(self, name: str, keep: int) -> set[int]:
        """Versions of a table that stay: the newest, and those that another table's versions name."""
        stay = set(self.versions(name)[-keep:])
        for other in self.tables():
            for version in self.versions(other):
                stay.update(v for t, v in self.manifest(other, version).extra.get("needs", {}).items() if t == name)
        return stay

    def _named_folders(self, name: str) -> set[str]:
        """Folders of a table's data that any manifest names: its own, rejected, or of a store it was published to."""
        named = {f for v in self.versions(name) for f in self.manifest(name, v).folders}
        for mark in self.rejected(name):
            named.update(json.loads(self._fs.read_text(f"{self.root}/{name}/rejected/{mark}.json"))["manifest"]["folders"])
        for mark in self._fs.names(f"{self.root}/{_PUBLISHED}"):
            other = TableStore(self.spark, self._fs.read_text(f"{self.root}/{_PUBLISHED}/{mark}"))
            for table in other.tables():
                for version in other.versions(table):
                    manifest = other.manifest(table, version)
                    if manifest.base == f"{self.root}/{name}/data":
                        named.update(manifest.folders)
        return named

    def discard(self, name: str, version: int) -> None:
        """Delete the rows that were written for a version of a working table; its manifest and counts stay."""
        written = self.manifest(name, version).written
        self._fs.delete(f"{self.root}/{name}/data/{_VERSION}={written}")

    def expire(self, name: str, keep: int = 1, grace: float = 86_400.0) -> list[str]:
        """Forget all versions of a table but the newest ``keep``; returns the folders deleted.

        Marks what the manifests name that stay (here, and in every store that snapshots were
        published to), then sweeps the rest. A version that a kept version of another table needs
        stays, and so does a folder carried over or shared, down to single partitions. Folders
        changed in the last ``grace`` seconds may belong to a write under way and are left. Rejected
        versions beyond the newest ``keep`` are forgotten too. Run again, it goes on where it stopped.
        """
        if keep < 1:
            raise ValueError("at least one version stays")
        stay = self._needed(name, keep)
        for version in self.versions(name):
            if version not in stay:
                self._fs.delete(self._manifest_path(name, version))
        for mark in list(self.rejected(name))[:-keep]:
            self._fs.delete(f"{self.root}/{name}/rejected/{mark}.json")
        named, base, swept = self._named_folders(name), f"{self.root}/{name}/data", []
        for version in self._fs.names(base):
            folder = f"{base}/{version}"
            if self._fs.age(folder) < grace or folder in named:
                continue
            inside = {f for f in named if f.startswith(f"{folder}/")}
            if not inside:
                swept.append(folder)
            else:
                swept += [f"{folder}/{p}" for p in self._fs.names(folder) if "=" in p and f"{folder}/{p}" not in inside]
        for folder in swept:
            self._fs.delete(folder)
        return swept


# -- run log -------------------------------------------------------------------------------------

LOG_DETAILS_SCHEMA = (
    "step_name string, started_at timestamp_ntz, rows_inserted long, rows_updated long, rows_deleted long, notes string"
)


def log_step(store: TableStore, step_name: str, counts: DataFrame, notes: str, started_at: Column | None = None) -> None:
    """Append the counts of one merge to the log."""
    started = F.current_timestamp() if started_at is None else started_at
    store.append(
        counts.select(
            F.lit(step_name).alias("step_name"),
            started.cast("timestamp_ntz").alias("started_at"),
            F.col("rows_inserted").cast("long"),
            F.col("rows_updated").cast("long"),
            F.col("rows_deleted").cast("long"),
            F.lit(notes).alias("notes"),
        ),
        "etl_log_details",
    )


def log_details(store: TableStore) -> DataFrame:
    return store.read_appended("etl_log_details", LOG_DETAILS_SCHEMA)


def log_summary(store: TableStore) -> DataFrame:
    """One count per logged step."""
    return log_details(store).select(
        "step_name",
        "started_at",
        (F.col("rows_inserted") + F.col("rows_updated") + F.col("rows_deleted")).alias("rows_affected"),
        "notes",
    )


def last_step(log: DataFrame) -> DataFrame:
    """The latest log row: a top-1, not a window over the whole log."""
    ties = [F.col(c).desc_nulls_last() for c in log.columns if c != "started_at"]
    return log.orderBy(F.col("started_at").desc_nulls_last(), *ties).limit(1)
