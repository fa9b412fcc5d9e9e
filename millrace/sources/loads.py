"""Loading staged files into raw tables with row-level rejects and per-file history.

A load is one scan: each record is cast and marked ``loaded`` or ``rejected``, and one write puts
both kinds under ``part=<mark>/status=<kind>``, a folder of the load's own. Its per-file summary
follows. The load takes its number last, by creating ``loads/<n>.json``, which names the folder: the
file can be created once, so of two writers one gets the number and the other tries the next, after
a look at what the first has loaded. A load that dies half way has no number and is invisible, and
numbers are in the order of commits, so that no reader of changes misses one.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import BROADCAST_BYTES, lookup
from ..operators.keys import assign_keys
from ..storage import FileSystem
from .files import FILE, MALFORMED, list_stage, read_csv, read_json
from .specs import Field, LoadSpec

STATUS, ERROR, RAW = "status", "_error", "_raw"
LOADED, REJECTED, SKIPPED = "loaded", "rejected", "skipped"

PART = "part"
MAX_FILES, MAX_BYTES = 10_000, 1 << 40  # of one load
_COMMIT = "load_id long, part string, batch string, highest long"
_COMMIT_BYTES = 256
_HISTORY = "file string, batch string, loaded_at timestamp, parsed long, loaded long, rejected long, first_error string"


def _varchar(kind: str) -> int | None:
    sized = re.fullmatch(r"varchar\((\d+)\)", kind)
    return int(sized.group(1)) if sized else None


def _type_of(kind: str) -> str:
    return "string" if _varchar(kind) else kind


def _text(field: Field) -> Column:
    value = F.col(field.record_field)
    return value if field.null_text is None else F.nullif(value, F.lit(field.null_text))


def _typed(field: Field) -> Column:
    value = _text(field)
    kind = _type_of(field.type)
    if kind == "string":
        return value
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return value.try_cast("decimal(38,0)").try_cast(kind)
    return value.try_cast(kind)


def _reason(field: Field, typed: Column) -> Column | None:
    """Why a field rejects its row, NULL when it does not."""
    tests = []
    if field.mode == "strict" and _type_of(field.type) != "string":
        tests.append((_text(field).isNotNull() & typed.isNull(), f"{field.name}: not a {field.type}"))
    size = _varchar(field.type)
    if size:
        tests.append((F.length(typed) > size, f"{field.name}: longer than {size}"))
    if field.required:
        tests.append((_text(field).isNull(), f"{field.name}: missing"))
    if not tests:
        return None
    return reduce(lambda rest, t: F.when(t[0], F.lit(t[1])).otherwise(rest), reversed(tests), F.lit(None).cast("string"))


def parse(records: DataFrame, spec: LoadSpec) -> DataFrame:
    """Cast text records and mark each one: typed columns, ``status``, ``_error``, ``_raw``, ``_file``.

    A rejected record keeps its text as JSON in ``_raw``; its typed columns are NULL. Text that
    could not be read as a record is rejected as it is.
    """
    checked = {f.name: _reason(f, _typed(f)) for f in spec.fields}
    reasons = [r for r in checked.values() if r is not None]
    text = F.to_json(F.struct(*dict.fromkeys(f.record_field for f in spec.fields)))
    if MALFORMED in records.columns:
        reasons.insert(0, F.when(F.col(MALFORMED).isNotNull(), F.lit("malformed record")))
        text = F.coalesce(F.col(MALFORMED), text)
    error = F.coalesce(*reasons) if reasons else F.lit(None).cast("string")
    bad = F.col(ERROR).isNotNull()
    return records.withColumn(ERROR, error).select(
        *[F.when(~bad, _typed(f)).cast(_type_of(f.type)).alias(f.name) for f in spec.fields],
        F.when(bad, F.lit(REJECTED)).otherwise(F.lit(LOADED)).alias(STATUS),
        F.col(ERROR),
        F.when(bad, text).alias(RAW),
        F.col(FILE),
    )


def split(records: DataFrame, spec: LoadSpec) -> tuple[DataFrame, DataFrame]:
    """Good rows and rejects of a batch, under the spec's error rule."""
    marked = apply_error_rule(parse(records, spec), spec)
    good = marked.filter(F.col(STATUS) == LOADED).select(*spec.columns)
    return good, marked.filter(F.col(STATUS) == REJECTED).select(RAW, ERROR, FILE)


def apply_error_rule(marked: DataFrame, spec: LoadSpec) -> DataFrame:
    """``continue`` keeps both kinds, ``abort`` fails on a reject, ``skip_file`` drops its file."""
    if spec.on_error == "continue":
        return marked
    if spec.on_error == "abort":
        stop = F.raise_error(F.concat(F.lit(f"load of {spec.table} aborted: "), F.col(ERROR)))
        return marked.withColumn(STATUS, F.when(F.col(STATUS) == REJECTED, stop.cast("string")).otherwise(F.col(STATUS)))
    if spec.on_error == "skip_file":
        bad_files = (
            marked.filter(F.col(STATUS) == REJECTED).select(FILE).distinct().withColumn("_skip", F.lit(True))
        )
        known = lookup(marked, bad_files, FILE, FILE, ["_skip"])
        skip = (F.col("_skip").isNotNull()) & (F.col(STATUS) == LOADED)
        return known.withColumn(STATUS, F.when(skip, F.lit(SKIPPED)).otherwise(F.col(STATUS))).drop("_skip")
    raise ValueError(f"unknown error rule: {spec.on_error}")


@dataclass(frozen=True)
class Load:
    """A committed load: its number, its folder, its batch label and the highest identity so far."""

    load_id: int
    part: str
    batch: str | None
    highest: int


class LandingZone:
    """Raw tables, their rejects and their load history below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._fs = FileSystem(spark, root)

    # -- layout ----------------------------------------------------------------------------------

    def _rows_path(self, table: str) -> str:
        return f"{self.root}/{table}/rows"

    def _history_path(self, table: str) -> str:
        return f"{self.root}/{table}/history"

    def _commit_path(self, table: str, load_id: int | None = None) -> str:
        folder = f"{self.root}/{table}/loads"
        return folder if load_id is None else f"{folder}/{load_id:010d}.json"

    def _commit(self, table: str, load_id: int) -> Load | None:
        """A committed load; None while its writer is at it."""
        text = self._fs.read_text(self._commit_path(table, load_id))
        return Load(**json.loads(text)) if text else None

    def last_load(self, table: str) -> int:
        """Number of the last committed load, 0 before the first."""
        names = self._fs.names(self._commit_path(table))
        numbers = sorted((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), reverse=True)
        return next((n for n in numbers if self._commit(table, n)), 0)

    def _commits_since(self, table: str, after: int, upto: int) -> list[Load]:
        return [c for c in (self._commit(table, n) for n in range(after + 1, upto + 1)) if c]

    def _committed(self, table: str, path: str, schema: str, after: int, upto: int) -> DataFrame:
        """What the loads after one and up to another have written below a folder, with ``load_id``.

        Folders of a few loads are named, and no other is listed; all of them are the folder itself.
        """
        reader = self.spark.read.schema(f"{schema}, {PART} string").option("basePath", path)
        if after:
            loads = self._commits_since(table, after, upto)
            rows = reader.parquet(*[f"{path}/{PART}={c.part}" for c in loads])
            numbers = self.spark.createDataFrame([(c.load_id, c.part) for c in loads], f"load_id long, {PART} string")
        else:
            rows = reader.parquet(path)
            numbers = self.spark.read.schema(_COMMIT).json(self._commit_path(table)).filter(F.col("load_id") <= upto)
            numbers = numbers.select("load_id", PART)
        if upto * _COMMIT_BYTES <= BROADCAST_BYTES:  # one short row per load
            return rows.join(F.broadcast(numbers), PART).drop(PART)
        return lookup(rows, numbers, PART, PART, ["load_id"], how="inner").drop(PART)

    def _rows(self, spec: LoadSpec, after: int = 0) -> DataFrame:
        """Rows of committed loads after a number."""
        last = self.last_load(spec.table)
        fields = [f"`{f.name}` {_type_of(f.type)}" for f in spec.fields]
        if spec.identity:
            fields.insert(0, f"`{spec.identity}` long")
        schema = ", ".join([*fields, *[f"`{n}` string" for n in (ERROR, RAW, FILE)], "loaded_at timestamp", f"{STATUS} string"])
        if last <= after:
            return self.spark.createDataFrame([], f"{schema}, load_id long")
        return self._committed(spec.table, self._rows_path(spec.table), schema, after, last)

    # -- reading -----------------------------------------------------------------------------------

    def table(self, spec: LoadSpec) -> DataFrame:
        """The raw table."""
        return self.changes_since(spec, 0).drop("load_id")

    def changes_since(self, spec: LoadSpec, bookmark: int) -> DataFrame:
        """Rows of loads after ``bookmark``, with ``load_id``; older folders are not listed."""
        columns = ([spec.identity] if spec.identity else []) + spec.columns
        rows = self._rows(spec, bookmark).filter(F.col(STATUS) == LOADED)
        return rows.select(*columns, "load_id")

    def rejected_rows(self, spec: LoadSpec, since: Column | None = None) -> DataFrame:
        """Rejected records with reason and file, optionally those loaded after a moment."""
        rows = self._rows(spec).filter(F.col(STATUS) == REJECTED)
        rows = rows if since is None else rows.filter(F.col("loaded_at") >= since)
        return rows.select(RAW, ERROR, FILE, "load_id", "loaded_at")

    def load_history(self, spec: LoadSpec, since: Column | None = None) -> DataFrame:
        """Per file and load: records parsed, loaded and rejected, and the first error."""
        last = self.last_load(spec.table)
        rows = self._history(spec, 0, last)
        return rows if since is None else rows.filter(F.col("loaded_at") >= since)

    def _history(self, spec: LoadSpec, after: int, upto: int) -> DataFrame:
        columns = [c.split()[0] for c in _HISTORY.split(", ")]
        if upto <= after:
            return self.spark.createDataFrame([], f"load_id long, {_HISTORY}")
        rows = self._committed(spec.table, self._history_path(spec.table), _HISTORY, after, upto)
        return rows.select("load_id", *columns)

    # -- loading -------------------------------------------------------------------------------------

    def new_files(self, spec: LoadSpec, path: str) -> DataFrame:
        """Listed files that no committed load has read."""
        listed = list_stage(self.spark, path, spec.pattern)
        seen = self.load_history(spec).select("file").distinct()
        return listed.join(seen, "file", "left_anti")

    def load(self, spec: LoadSpec, path: str, max_files: int = MAX_FILES, max_bytes: int = MAX_BYTES) -> int | None:
        """Load the files below ``path`` (or one named file) not loaded before.

        Many files are loaded in lots of at most so many files or bytes (a larger file is a lot of
        its own), each committed by itself; started again after an interruption, the next call goes
        on with the files that are left. Returns the number of the last load, None when there was
        nothing new. The list of new files is written once; the driver sees one lot's names at a time.
        """
        read, last = self.reader(spec), None
        for lot in self._lots(spec, path, max_files, max_bytes):
            names = [f for _, f in lot]
            last = self.write_load(spec, read(self.spark, [p for p, _ in lot]), files=names) or last
        return last

    def _lots(self, spec: LoadSpec, path: str, max_files: int, max_bytes: int) -> Iterator[list[tuple[str, str]]]:
        listing = f"{self.root}/{spec.table}/listings/{uuid.uuid4().hex}"
        numbered = assign_keys(self.new_files(spec, path).select("path", "size", "file"), "n", ["path"])
        seen = Observation()
        lot = F.floor((F.col("n") - 1) / max_files).cast("long")
        numbered.withColumn("lot", lot).observe(seen, F.max("lot").alias("last")).write.partitionBy("lot").parquet(listing)
        last = seen.get.get("last")
        for k in range(-1 if last is None else last + 1):
            files = self.spark.read.schema("path string, size long, file string, n long").parquet(f"{listing}/lot={k}")
            part, size = [], 0
            for r in files.orderBy("n").collect():  # max_files rows at most
                if part and size + r["size"] > max_bytes:
                    yield part
                    part, size = [], 0
                part.append((r["path"], r["file"]))
                size += r["size"]
            if part:
                yield part

    refresh = load

    @staticmethod
    def reader(spec: LoadSpec) -> Callable[..., DataFrame]:
        fields = list(dict.fromkeys(f.record_field for f in spec.fields))
        if spec.format == "csv":
            return lambda spark, path: read_csv(spark, path, fields, multi_line=bool(spec.multi_line))
        if spec.format == "json":
            multi_line = spec.multi_line if spec.multi_line is not None else True
            return lambda spark, path: read_json(spark, path, fields, multi_line=multi_line, malformed=True)
        if spec.format == "parquet":
            return lambda spark, path: spark.read.parquet(*([path] if isinstance(path, str) else path)).select(
                *[F.col(c).cast("string") for c in fields], F.col("_metadata.file_path").alias(FILE)
            )
        raise ValueError(f"unknown format: {spec.format}")

    def write_load(
        self, spec: LoadSpec, records: DataFrame, batch: str | None = None, files: Sequence[str] = ()
    ) -> int | None:
        """Write one batch of text records as the next load; several writers may do so at a time.

        A ``batch`` label that a committed load carries is not loaded again, nor are, under a
        label, files that other loads have in the history. ``files`` names the files read, so that
        those without rows enter the history too. None when nothing was left to load.

        A writer that finds its number taken looks which files the other loads hold: it writes its
        rows again without those (or with other identity numbers), and else only takes the next
        number.
        """
        last = self.last_load(spec.table)
        if batch is not None:
            if self._is_loaded(spec, batch):
                return None
            if last:
                others = self._history(spec, 0, last).filter(~F.col("batch").eqNullSafe(F.lit(batch)))
                records, files = self._without(records, files, others)
        while True:
            load = self._write_rows(spec, records, batch, files, last)
            if load is None:
                return None
            while True:
                if self._try_commit(spec.table, load):
                    return load.load_id
                before, last = last, load.load_id
                others = self._history(spec, before, last)
                mine = self.spark.read.schema(_HISTORY).parquet(f"{self._history_path(spec.table)}/{PART}={load.part}")
                shared = not mine.join(others.select("file"), "file", "left_semi").isEmpty()
                if shared or spec.identity:
                    break
                load = Load(last + 1, load.part, batch, load.highest)
            if shared:
                records, files = self._without(records, files, others)
                if batch is None and not files:
                    return None

    def _without(self, records: DataFrame, files: Sequence[str], others: DataFrame) -> tuple[DataFrame, list[str]]:
        """Records and names of those files that other loads do not hold."""
        seen = others.select("file").distinct().withColumn("_seen", F.lit(True))
        rest = lookup(records, seen, FILE, "file", ["_seen"]).filter(F.col("_seen").isNull()).drop("_seen")
        if files:
            listed = self.spark.createDataFrame([(f,) for f in files], "file string")
            taken = {r[0] for r in listed.join(others, "file", "left_semi").collect()}
            files = [f for f in files if f not in taken]
        return rest, list(files)

    def _write_rows(self, spec: LoadSpec, records: DataFrame, batch: str | None, files: Sequence[str], last: int) -> Load | None:
        """Rows and history in a folder of their own, for a load after ``last``."""
        part = f"{last + 1:010d}-{uuid.uuid4().hex[:12]}"
        if batch is not None:
            self._fs.create_text(self._batch_path(spec, batch), json.dumps({"part": part, "after": last}), overwrite=True)
        marked = apply_error_rule(parse(records, spec), spec)
        highest = self._commit(spec.table, last).highest if last else 0
        if spec.identity:
            marked = self._with_identity(spec, marked, highest)
        counted = Observation()
        folder = f"{self._rows_path(spec.table)}/{PART}={part}"
        marked = marked.withColumn("loaded_at", F.current_timestamp()).observe(
            counted, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(STATUS) == LOADED).alias("good")
        )
        marked.write.partitionBy(STATUS).option("compression", "zstd").parquet(folder)
        counts = counted.get
        if not counts.get("rows") and not files:
            return None
        self._write_history(spec, part, folder, batch, files)
        # The identity numbers of this load are reserved with its commit.
        return Load(last + 1, part, batch, highest + (counts.get("good") or 0) if spec.identity else 0)

    def _try_commit(self, table: str, load: Load) -> bool:
        """Whether the load got its number."""
        path = self._commit_path(table, load.load_id)
        try:
            self._fs.create_text(path, json.dumps(load.__dict__))
        except Exception:
            if self._fs.exists(path):
                return False
            raise
        return True

    def _batch_path(self, spec: LoadSpec, batch: str) -> str:
        return f"{self.root}/{spec.table}/batches/{hashlib.md5(batch.encode()).hexdigest()}"

    def _is_loaded(self, spec: LoadSpec, batch: str) -> bool:
        """Whether the rows last written for a batch label were committed."""
        path = self._batch_path(spec, batch)
        if not self._fs.exists(path):
            return False
        tried = json.loads(self._fs.read_text(path))
        later = self._commits_since(spec.table, tried["after"], self.last_load(spec.table))
        return any(c.part == tried["part"] and c.batch == batch for c in later)

    def _with_identity(self, spec: LoadSpec, marked: DataFrame, start: int) -> DataFrame:
        """Good rows numbered on from the highest number that the loads before have reserved."""
        good = assign_keys(marked.filter(F.col(STATUS) == LOADED), spec.identity, spec.columns, start)
        rest = marked.filter(F.col(STATUS) != LOADED).withColumn(spec.identity, F.lit(None).cast("bigint"))
        return good.unionByName(rest)

    def _write_history(self, spec: LoadSpec, part: str, folder: str, batch: str | None, files: Sequence[str] = ()) -> None:
        # A partition column of the folder, so the schema names it; nothing else but it, the file
        # name and the error is read.
        schema = f"{FILE} string, {ERROR} string, {STATUS} string"
        rows = self.spark.read.schema(schema).parquet(folder)
        summary = rows.groupBy(F.col(FILE).alias("file")).agg(
            F.count(F.lit(1)).alias("parsed"),
            F.count_if(F.col(STATUS) == LOADED).alias("loaded"),
            F.count_if(F.col(STATUS) == REJECTED).alias("rejected"),
            F.min(ERROR).alias("first_error"),
        )
        if files:  # those without rows have no summary
            listed = self.spark.createDataFrame([(f,) for f in files], "file string")
            counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("parsed", "loaded", "rejected")]
            summary = listed.join(summary, "file", "full").select("file", *counts, "first_error")
        summary.select(
            "file",
            F.lit(batch).cast("string").alias("batch"),
            F.current_timestamp().alias("loaded_at"),
            "parsed",
            "loaded",
            "rejected",
            "first_error",
        ).write.parquet(f"{self._history_path(spec.table)}/{PART}={part}")

    # -- retention ------------------------------------------------------------------------------------

    def sweep(self, spec: LoadSpec, grace: float = 86_400.0) -> list[str]:
        """Delete what no committed load names: folders of writers that died, and old lists of files.

        Folders changed in the last ``grace`` seconds may belong to a load under way and are left.
        """
        last = self.last_load(spec.table)
        named = {f"{PART}={c.part}" for c in self._commits_since(spec.table, 0, last)}
        swept = []
        for path, kept in ((self._rows_path(spec.table), named), (self._history_path(spec.table), named), (f"{self.root}/{spec.table}/listings", set())):
            swept += [f"{path}/{n}" for n in self._fs.names(path) if n not in kept and self._fs.age(f"{path}/{n}") >= grace]
        for folder in swept:
            self._fs.delete(folder)
        return swept
