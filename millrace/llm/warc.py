"""WARC archives of pages, and a two-level index over their captures.

Pages are sorted by reversed-host URL key and written as records, each a gzip member of its own, so
that one record can be read by one range read. Beside each archive lies an index file: compressed
blocks of sorted lines, and after them a sparse directory with the first key of each block. A
lookup searches the directory, reads one block, searches its lines, and reads the record's range.
The top level is one row per index file with its first and last key.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import lookup
from ..storage import work_folder
from .common import shared_table

BLOCK_LINES = 1_000
MIN_REVISIT_BYTES = 1_000
LEVEL = 4  # of compression
DATE = "1970-01-01T00:00:00Z"  # pages carry no capture time
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
FILES = "index string, archive string, first_key string, last_key string, n_records long, directory_at long"
READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def url_key(url: Column) -> Column:
    """Reversed host, port, and the rest: ``http://a.b.com:80/x`` is ``com,b,a:80)/x``.

    A URL without ``://`` is its own key; NULL is the empty key.
    """
    rest = F.regexp_extract(url, r"^[^:]*://(?:[^@/?#]*@)?([\s\S]*)$", 1)
    host = F.lower(F.regexp_extract(rest, r"^([^/?#:]*)", 1))
    port = F.regexp_extract(rest, r"^[^/?#:]*(:[^/?#]*)?", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([\s\S]*)$", 1)
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), port, F.lit(")"), path)
    return F.coalesce(F.when(F.contains(url, F.lit("://")), key).otherwise(url), F.lit(""))


def base32_digest(hexadecimal: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def hex_digest(labelled: str) -> str:
    return base64.b32decode(labelled.removeprefix("sha1:")).hex()


def _uri(url: str | None) -> str:
    """A header value: one line, whatever the URL holds."""
    return json.dumps(url, ensure_ascii=True)


def record(row: dict) -> bytes:
    """One WARC/1.1 record as a gzip member. A revisit has no payload; its digest and size stay."""
    revisit = row["refers_to"] is not None
    block = HTTP_HEAD + (b"" if revisit else (row["html"] or "").encode("utf-8"))
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, 'page:' + str(row['page_id']))}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_uri(row['url'])}",
        f"WARC-Payload-Digest: {base32_digest(row['payload_digest'])}",
        f"X-Page-ID: {json.dumps(row['page_id'])}",
        f"X-Payload-Length: {row['payload_bytes']}",
    ]
    if revisit:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, 'page:' + str(row['refers_to']))}>",
            f"X-Refers-To-Page-ID: {row['refers_to']}",
        ]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", LEVEL, mtime=0)


def parse(member: bytes) -> dict:
    """A record read back: what its headers say, with digest and size of the payload it holds."""
    head, _, rest = gzip.decompress(member).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")[2]
    size, digest = int(fields["X-Payload-Length"]), hex_digest(fields["WARC-Payload-Digest"])
    refers = fields.get("X-Refers-To-Page-ID")
    if refers is None and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload of page {fields['X-Page-ID']} does not match its digest")
    return {
        "page_id": json.loads(fields["X-Page-ID"]),
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": fields["WARC-Type"],
        "refers_to": None if refers is None else int(refers),
        "url": json.loads(fields["WARC-Target-URI"]),
        "payload": payload,
    }


def identified(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Per page its key, payload size and SHA-1, and for a revisit the page it refers to.

    Of pages with equal payloads of at least ``min_bytes`` bytes the one with the largest id is
    the response. Rows that repeat this id are all responses, as are rows without an id. Only
    digests and ids are shuffled for this; the largest id combines before the shuffle.
    """
    body = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", "html", url_key(F.col("url")).alias("key"),
        F.octet_length(body).cast("long").alias("payload_bytes"), F.sha1(body).alias("payload_digest"),
    )
    large = rows.filter((F.col("payload_bytes") >= min_bytes) & F.col("page_id").isNotNull())
    shared = large.groupBy(F.col("payload_digest").alias("__digest"), F.col("payload_bytes").alias("__bytes")).agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n"))
    shared = shared_table(shared.filter("n > 1").select("__digest", "__bytes", "last"), "shared-payloads")
    joined = lookup(rows, shared, "payload_digest", "__digest", ["last", "__bytes"])
    refers = F.when((F.col("payload_bytes") == F.col("__bytes")) & (F.col("page_id") != F.col("last")), F.col("last"))
    return joined.withColumn("refers_to", refers).drop("last", "__bytes")


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_REVISIT_BYTES, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write archives and their index files; one row per pair of files, the index's top level.

    Each task takes one range of keys and writes files with names of its own; only those of tasks
    that succeeded are in the result, so a task may run again. A NULL html is an empty payload.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        name = uuid.uuid4().hex
        archive = index = None
        at = index_at = total = 0
        lines: list[str] = []
        directory: list[tuple[str, int, int]] = []
        first = last = ""

        def close_block() -> None:
            nonlocal index_at
            block = zlib.compress("\n".join(lines).encode(), LEVEL)
            index.write(block)
            directory.append((json.loads(lines[0])[0], index_at, len(block)))
            index_at += len(block)
            lines.clear()

        for batch in batches:
            for row in batch.to_pylist():
                if archive is None:
                    archive, index = store.open_output_stream(f"{root}/{name}.warc.gz", compression=None), store.open_output_stream(f"{root}/{name}.cdx", compression=None)
                    first = row["key"]
                member = record(row)
                archive.write(member)
                lines.append(json.dumps([row["key"], row["page_id"], at, len(member)]))
                last, at, total = row["key"], at + len(member), total + 1
                if len(lines) == block_lines:
                    close_block()
        if archive is None:
            return
        if lines:
            close_block()
        packed = zlib.compress(json.dumps(directory).encode(), LEVEL)
        index.write(packed + struct.pack("<QQ", index_at, len(packed)))
        archive.close()
        index.close()
        values = [f"{folder}/{name}.cdx", f"{folder}/{name}.warc.gz", first, last, total, index_at]
        kinds = [pa.string()] * 4 + [pa.int64()] * 2
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], k) for v, k in zip(values, kinds, strict=True)], ["index", "archive", "first_key", "last_key", "n_records", "directory_at"]
        )

    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    order = ["key", "page_id"]
    ranged = identified(pages, min_bytes).repartitionByRange(*order).sortWithinPartitions(*order)
    return shared_table(ranged.mapInArrow(run, FILES), "captures")


class Captures:
    """One archive through its index file."""

    def __init__(self, index: str, archive: str):
        store, name = fs.FileSystem.from_uri(index)
        self._index = store.open_input_file(name)
        store, name = fs.FileSystem.from_uri(archive)
        self._archive = store.open_input_file(name)
        size = self._index.size()
        at, length = struct.unpack("<QQ", self._index.read_at(16, size - 16))
        self.directory = json.loads(zlib.decompress(self._index.read_at(length, at)))
        self._first = [d[0] for d in self.directory]

    def block(self, k: int) -> list[list]:
        """Lines of a block: key, page, place and size of the record."""
        _, at, size = self.directory[k]
        return [json.loads(x) for x in zlib.decompress(self._index.read_at(size, at)).decode().split("\n")]

    def find(self, key: str) -> list[list]:
        """Lines of a key: binary search in the directory, then in the blocks that may hold it.

        Keys sort by code points, as Spark sorts their UTF-8 bytes.
        """
        k = max(0, bisect.bisect_left(self._first, key) - 1)
        found = []
        while k < len(self._first) and self._first[k] <= key:
            lines = self.block(k)
            lo = bisect.bisect_left(lines, key, key=lambda x: x[0])
            hi = bisect.bisect_right(lines, key, key=lambda x: x[0])
            found += lines[lo:hi]
            k += 1
        return found

    def read(self, at: int, size: int) -> bytes:
        return self._archive.read_at(size, at)

    def close(self) -> None:
        self._index.close()
        self._archive.close()


def _batch(rows: list[dict], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds, strict=True)], names)


_NAMES = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]


def read_archives(files: DataFrame) -> DataFrame:
    """Every record of the archives, read block by block through the index.

    The records of a block lie behind one another, so a block is one range read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                captures = Captures(row["index"], row["archive"])
                for k in range(len(captures.directory)):
                    lines = captures.block(k)
                    begin = lines[0][2]
                    data = captures.read(begin, lines[-1][2] + lines[-1][3] - begin)
                    yield _batch([parse(data[at - begin : at - begin + size]) for _, _, at, size in lines], _NAMES, _KINDS)
                captures.close()

    # Numbered, so that archives are not merged into one task however short their rows are.
    archives = files.select("index", "archive")
    return archives.repartition(max(1, archives.count()), "index").mapInArrow(run, READ)


def find_captures(files: DataFrame, urls: DataFrame) -> DataFrame:
    """Records of wanted URLs (column ``url``), payload included; unknown ones give no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, captures = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["index"] != opened:
                    if captures:
                        captures.close()
                    opened, captures = row["index"], Captures(row["index"], row["archive"])
                found = [parse(captures.read(at, size)) for _, _, at, size in captures.find(row["key"])]
                yield _batch(found, [*_NAMES, "payload"], [*_KINDS, pa.binary()])

    wanted = urls.select(url_key(F.col("url")).alias("key")).distinct()
    near = wanted.join(files.select("index", "archive", "first_key", "last_key"), F.col("key").between(F.col("first_key"), F.col("last_key")))
    return near.repartition("index").sortWithinPartitions("index").mapInArrow(run, f"{READ}, payload binary")


def write_and_read(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Round trip of a table of pages; ``folder`` defaults to a new one in the shared folder.

    Repeated rows give a record each. An empty table gives no file and no row. Columns other than
    ``page_id``, ``url`` and ``html`` are not read.
    """
    return read_archives(write_archives(pages, folder or work_folder(pages.sparkSession, "warc")))
