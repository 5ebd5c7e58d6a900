"""WARC archives with a two-level capture index.

Archives hold one gzip member per record, so any record can be read by its offset and length. The first
index level is the sorted list of captures, keyed by host labels in reverse and the rest of the address,
cut into blocks of many entries that are compressed one by one. The second level is a sparse directory
with the first key of every block. A lookup finds the block by binary search in the directory, reads and
decompresses that block only, and reads the records' own byte ranges.

Files are written by tasks into the folder given, through pyarrow's file systems, under names no other
attempt uses; a file counts once its index rows are stored, so a task that is run again does no harm.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stormledger.storage import scratch_path, stored

WARC_DATE = "2024-01-01T00:00:00Z"
# The directory travels with lookups: no more than this many blocks, so blocks grow with the archive.
MOST_BLOCKS = 200_000


@dataclass(frozen=True)
class Settings:
    # Payloads of fewer bytes are stored in full even if they repeat.
    least_revisit: int = 0
    # Records go to a new archive file beyond this many bytes.
    file_bytes: int = 64 << 20
    # Index entries per block, at least.
    block_entries: int = 1_024


def url_key(url: str | None) -> str:
    """Host labels reversed, then port, path and query: `org,example)/a?b`. Scheme, `www.` and fragment are left out."""
    text = (url or "").strip()
    text = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*://", "", text).partition("#")[0]
    host, rest = re.match(r"([^/?]*)/?(.*)\Z", text, re.S).groups()
    host = re.sub(r"^www\d*\.", "", host.rpartition("@")[2].lower())
    name, _, port = host.partition(":")
    return f"{','.join(reversed(name.split('.')))}{':' + port if port and port != '80' else ''})/{rest}"


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(page: int | None, url: str | None, digest: str, size: int, payload: bytes | None, refers: int | None) -> bytes:
    """One gzip member with a response, or with a revisit where `payload` is None."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    # Line ends in an address would end the header.
    target = re.sub(r"[\r\n]", lambda m: f"%{ord(m.group()):02X}", url or "")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if payload is None else 'response'}",
        f"WARC-Record-ID: <urn:page:{page}>",
        f"WARC-Date: {WARC_DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if payload is None:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{refers}>",
        ]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def parse_record(member: bytes) -> dict:
    """Headers, payload and payload size of one record; a revisit's size is that of the payload it stands for."""
    plain = zlib.decompress(member, 31)
    head, _, rest = plain.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http).group(1))
    return {
        "type": fields["WARC-Type"],
        "page": fields["WARC-Record-ID"][10:-1],
        "digest": fields["WARC-Payload-Digest"][5:],
        "refers": fields.get("WARC-Refers-To", "")[10:-1] or None,
        "size": size,
        "payload": payload,
    }


def _open_out(folder: str, name: str):
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    return system.open_output_stream(f"{path}/{name}", compression=None)


def _uri(path: str) -> str:
    return path if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path) else f"file://{path}"


def _number(value: str) -> int | None:
    return None if value == "None" else int(value)


CAPTURE = "key string, page_id long, file string, offset long, length long"


def write_archives(pages: DataFrame, folder: str, cfg: Settings = Settings()) -> DataFrame:
    """Write a record per row; the stored captures (key, page_id, file, offset, length)."""
    folder = _uri(folder)

    def task(batches):
        out, name, at = None, "", 0
        for batch in batches:
            rows = []
            for page, url, html, digest, size, first in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None or at > cfg.file_bytes:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = _open_out(folder, name)
                whole = first is None or first == page
                member = _record(page, url, digest, size, (html or "").encode() if whole else None, first)
                out.write(member)
                rows.append((url_key(url), page, name, at, len(member)))
                at += len(member)
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()))],
                names=["key", "page_id", "file", "offset", "length"],
            )
        if out is not None:
            out.close()

    def digests(batches):
        for batch in batches:
            payloads = [(h or "").encode() for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(map(_digest, payloads), pa.string()), pa.array(map(len, payloads), pa.int64())],
                names=["page_id", "url", "html", "digest", "size"],
            )

    mine = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    marked = mine.mapInArrow(digests, "page_id long, url string, html string, digest string, size long")
    # Only ids and digests are needed to find revisits; the pages then meet them by their own id, so
    # equal payloads, however many there are, are not brought to one task.
    seen = stored(marked.where(F.col("size") >= cfg.least_revisit).select("page_id", "digest"), "digests")
    several = seen.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    revisits = seen.join(several.select("digest", "first"), "digest").where("page_id != first").distinct()
    rows = marked.join(revisits, ["page_id", "digest"], "left").select("page_id", "url", "html", "digest", "size", "first")
    return stored(rows.mapInArrow(task, CAPTURE), "captures")


def write_index(captures: DataFrame, folder: str, cfg: Settings = Settings()) -> DataFrame:
    """Write sorted, compressed blocks; the stored directory (first, last, file, offset, length), a row per block.

    Captures are range-partitioned and sorted by key and page, so captures of one address may fill many
    blocks, and one block after another continues the order.
    """
    folder, entries = _uri(folder), max(cfg.block_entries, -(-captures.count() // MOST_BLOCKS))

    def task(batches):
        name, out, at, held, blocks = f"{uuid.uuid4().hex}.cdx.z", None, 0, [], []

        def flush():
            nonlocal out, at, held
            if out is None:
                out = _open_out(folder, name)
            data = zlib.compress("\n".join(json.dumps(r) for r in held).encode())
            out.write(data)
            blocks.append((held[0][0], held[-1][0], name, at, len(data)))
            at, held = at + len(data), []

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(row)
                if len(held) >= entries:
                    flush()
        if held:
            flush()
        if out is not None:
            out.close()
        columns = list(zip(*blocks)) or [()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64()))],
            names=["first", "last", "file", "offset", "length"],
        )

    ordered = captures.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id")
    made = ordered.select("key", "page_id", "file", "offset", "length").mapInArrow(
        task, "first string, last string, file string, offset long, length long"
    )
    return stored(made, "directory")


def write_warc(spark: SparkSession, pages: DataFrame, folder: str | None = None, cfg: Settings = Settings()) -> tuple[str, DataFrame]:
    """Write archives and index of `pages` (page_id, url, html); the folder, and the stored directory.

    A null html is an empty payload, a null url an empty address. Of equal payloads the one with the
    smallest page_id is a response and the others are revisits of it; rows that repeat that page_id are
    responses too. A null page_id is written as such and is never referred to while an id is there.
    """
    folder = folder or scratch_path(spark, "warc")
    captures = write_archives(pages, folder, cfg)
    return folder, write_index(captures, folder, cfg)


def lookup(addresses: DataFrame, folder: str, directory: DataFrame, payloads: bool = False) -> DataFrame:
    """All captures of each distinct address (url): (page_id, payload_bytes, payload_digest, record_type, refers_to).

    `addresses` are turned into keys and sorted over the cluster, so a task's keys are neighbours and
    blocks are read once per task. With `payloads` the column `payload` holds the bytes of responses.
    """
    folder = _uri(folder)
    blocks = directory.orderBy("first", "last", "file", "offset").limit(MOST_BLOCKS * 2).toArrow()
    firsts = np.array(blocks.column("first").to_pylist(), dtype=object)
    lasts = np.array(blocks.column("last").to_pylist(), dtype=object)
    places = [blocks.column(c).to_pylist() for c in ("file", "offset", "length")]

    def keys(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(map(url_key, batch.column(0).to_pylist()), pa.string())], names=["key"])

    def blocks_of(batches):
        """Binary search: the first block whose last key is not below, up to the last whose first key is not above."""
        for batch in batches:
            wanted = batch.column(0).to_pylist()
            out = []
            for key in wanted:
                low, high = np.searchsorted(lasts, key, "left"), np.searchsorted(firsts, key, "right")
                out += [(key, int(b)) for b in range(low, high)]
            columns = list(zip(*out)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64())], names=["key", "block"])

    def captures_of(batches):
        """Read each block once and keep the entries asked for."""
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder)
        held, entries = None, {}
        for batch in batches:
            out = []
            for key, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if block != held:
                    with system.open_input_file(f"{root}/{places[0][block]}") as f:
                        data = zlib.decompress(f.read_at(places[2][block], places[1][block]))
                    held, entries = block, {}
                    for line in data.decode().split("\n"):
                        row = json.loads(line)
                        entries.setdefault(row[0], []).append(row[2:])
                out += entries.get(key, ())
            columns = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()))], names=["file", "offset", "length"]
            )

    def read(batches):
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder)
        name, source = None, None
        for batch in batches:
            out = []
            for file, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if file != name:
                    if source is not None:
                        source.close()
                    name, source = file, system.open_input_file(f"{root}/{file}")
                r = parse_record(source.read_at(length, offset))
                if r["type"] == "response" and (_digest(r["payload"]) != r["digest"] or len(r["payload"]) != r["size"]):
                    raise ValueError(f"damaged record at {offset} of {file}")
                out.append((_number(r["page"]), r["size"], r["digest"], r["type"], r["refers"] and _number(r["refers"]), r["payload"] if payloads else None))
            columns = list(zip(*out)) or [()] * 6
            types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[n for n, _ in RECORD])
        if source is not None:
            source.close()

    wanted = addresses.select(F.col("url").cast("string")).mapInArrow(keys, "key string").distinct()
    found = wanted.mapInArrow(blocks_of, "key string, block long").repartitionByRange("block", "key").sortWithinPartitions("block", "key")
    ranges = found.mapInArrow(captures_of, "file string, offset long, length long")
    # Ranges of one file are read by few tasks, in order of offset; a file larger than the others is split.
    ranges = ranges.repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")
    made = ranges.mapInArrow(read, ", ".join(f"{n} {t}" for n, t in RECORD))
    return made if payloads else made.drop("payload")


RECORD = [("page_id", "long"), ("payload_bytes", "long"), ("payload_digest", "string"), ("record_type", "string"), ("refers_to", "long"), ("payload", "binary")]
