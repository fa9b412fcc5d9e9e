"""Load every new file once as it arrives."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..sources.files import stream_csv, stream_json
from ..sources.loads import LandingZone
from ..sources.specs import LoadSpec
from ..storage import FileSystem

EVERY_MINUTE = {"processingTime": "1 minute"}
ONCE = {"availableNow": True}


def batch_files(zone: LandingZone, checkpoint: str, batch_id: int) -> list[str]:
    """Names of the files of one batch of a file stream, from the stream's checkpoint.

    The offsets of a batch name the last entry of the source's log that belongs to it; an entry
    holds the files of one listing. Empty when the checkpoint has no such log.
    """
    fs = FileSystem(zone.spark, checkpoint)

    def upto(batch: int) -> int:
        path = f"{checkpoint}/offsets/{batch}"
        if batch < 0 or not fs.exists(path):
            return -1
        return json.loads(fs.read_text(path).splitlines()[2])["logOffset"]

    first, last, folder = upto(batch_id - 1) + 1, upto(batch_id), f"{checkpoint}/sources/0"
    names = set(fs.names(folder))
    files = {}
    for entry in range(first, last + 1):
        name = str(entry) if str(entry) in names else f"{entry}.compact"
        if name not in names:  # compacted into a later entry
            name = next((f"{n}.compact" for n in range(entry, last + 100) if f"{n}.compact" in names), None)
        lines = fs.read_text(f"{folder}/{name}").splitlines()[1:] if name else []
        files |= {f["path"]: None for f in map(json.loads, lines) if f["batchId"] == entry}
    return list(files)


def auto_ingest(
    zone: LandingZone,
    spec: LoadSpec,
    source_dir: str,
    checkpoint: str,
    trigger: dict | None = None,
    after_load: Callable[[int], None] | None = None,
    **options,
) -> StreamingQuery:
    """Start a query that loads new files of ``source_dir`` into the spec's raw table.

    The checkpoint remembers the files; stopping and starting again from it loses and repeats
    nothing. A batch replayed after a failure is known by its label and not loaded twice.
    A spec without an error rule of its own (``abort``) skips a bad file here, as a stream that
    stops would stop at the same file again. Files without rows enter the history, too.
    ``trigger`` is ``ONCE`` (load what is there, then stop) or an interval. ``after_load`` runs
    after each batch, a replayed one included, so a step that failed runs again.
    """
    fields = list(dict.fromkeys(f.record_field for f in spec.fields))
    if spec.format == "csv":
        stream = stream_csv(zone.spark, source_dir, fields, pattern=spec.pattern, **options)
    elif spec.format == "json":
        multi_line = spec.multi_line if spec.multi_line is not None else True
        stream = stream_json(zone.spark, source_dir, fields, pattern=spec.pattern, multi_line=multi_line, **options)
    else:
        raise ValueError(f"no stream for format: {spec.format}")

    rule = spec.with_options(on_error="skip_file") if spec.on_error == "abort" else spec

    def load(batch: DataFrame, batch_id: int) -> None:
        zone.write_load(rule, batch, f"{checkpoint}#{batch_id}", batch_files(zone, checkpoint, batch_id))
        if after_load is not None:
            after_load(zone.last_load(spec.table))

    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or ONCE)).start()
