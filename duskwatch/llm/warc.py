"""WARC archives inside ZIP packages: write them, and read them by ranges.

A package is a ZIP file with stored (uncompressed) members: ``archive/data.warc.gz``, WARC
records as single gzip members one after the other, and ``indexes/index.cdxj``, a line per
record with its offset and length.  The reader finds the end-of-directory record, follows
ZIP64 locators and extra fields, takes the members' places from the central directory and
their local headers, and then reads runs of records by byte range.  Nothing is extracted,
and no task reads a whole package: a package is split into ranges of ``RANGE_BYTES``.

Of records with equal payloads of some length one is a response, the others revisit it.
Which one is decided by an aggregate per payload digest, so a payload that a third of all
pages share is combined before the shuffle.

Files are written through pyarrow's file systems to the folder given (any URI they know).
A task names its packages by its attempt, and only the manifest of attempts that Spark
accepted is read, so a retried task leaves at most an unused file.

Cases.  Null html: an empty payload.  Null url: an empty target.  A null page_id is written
without the header and comes back as null; it is never the largest of several ids.  Rows
with equal page_id and payload are all responses if that id is the largest.  A package
without records has an empty index.  Empty table: no packages, empty result.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from datetime import datetime

import pyarrow as pa
from pyarrow import fs as filesystems
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from duskwatch.llm.common import SLICE, stored

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PACKAGE_BYTES, RANGE_BYTES = 64 << 20, 4 << 20
# Fixed values of the format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END, END64, LOCATOR64, ENTRY, LOCAL = (
    b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04")
NAMES = uuid.UUID("6b2f6f0e-6f4d-5d7c-9a53-0d6f6c1c2a11")


def open_store(uri: str) -> tuple[filesystems.FileSystem, str]:
    return filesystems.FileSystem.from_uri(uri)


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMES, f'{page_id}/{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str,
           refers_to: int | None, date: datetime) -> bytes:
    """One WARC record; a revisit keeps the HTTP header and leaves the payload out."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    body = http if refers_to is not None else http + payload
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head = {"WARC-Type": "response" if refers_to is None else "revisit",
            "WARC-Record-ID": record_id(page_id, digest), "WARC-Date": f"{date:%Y-%m-%dT%H:%M:%SZ}",
            "WARC-Target-URI": target,
            "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()}
    if page_id is not None:
        head["X-Page-ID"] = str(page_id)
    if refers_to is not None:
        head |= {"WARC-Refers-To": record_id(refers_to, digest), "WARC-Profile": REVISIT_PROFILE}
    head |= {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(body))}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return f"WARC/1.1\r\n{lines}\r\n".encode() + body + b"\r\n\r\n"


def _headers(block: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in block.decode("utf-8", "replace").split("\r\n")[1:] if line)
    return {k.strip().lower(): v.strip() for k, v in pairs}


def parse_record(raw: bytes) -> dict:
    """The fields of one record; digest and length of a response come from its payload."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    warc = _headers(head)
    body = rest[:int(warc["content-length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    kind = warc["warc-type"]
    if kind == "response":
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    else:
        size = int(_headers(http).get("content-length", 0))
        digest = base64.b32decode(warc["warc-payload-digest"].removeprefix("sha1:")).hex()
    page = warc.get("x-page-id")
    return {"page_id": None if page is None else int(page), "url": warc.get("warc-target-uri"),
            "record_type": kind, "record_id": warc["warc-record-id"],
            "refers_to_id": warc.get("warc-refers-to"), "payload_bytes": size,
            "payload_digest": digest, "payload": payload if kind == "response" else None}


# Writing

def with_revisits(pages: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """Pages with digest and refers_to: the largest page_id with the payload, null for responses."""
    html = F.coalesce("html", F.lit(""))
    keyed = pages.select("page_id", "url", html.alias("html"), F.sha1(html).alias("digest"))
    # Stored first: its size is known then, so Spark ships a short list of repeated payloads
    # to the pages, and shuffles the pages by digest only if the list is long.
    largest = stored(keyed.where(F.octet_length("html") >= min_bytes).groupBy("digest")
                     .agg(F.max("page_id").alias("largest"), F.count("*").alias("n")).where("n > 1")
                     .select("digest", "largest"), "repeated")
    return (keyed.join(largest, "digest", "left")
            .withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("largest")),
                                            F.col("largest"))).drop("largest"))


class _Package:
    """A ZIP package being written."""

    def __init__(self, store, path: str):
        self.path, self.records, self.size, self.index = path, 0, 0, []
        self.out = store.open_output_stream(path)
        self.zip = zipfile.ZipFile(self.out, "w", zipfile.ZIP_STORED, allowZip64=True)
        self.data = self.zip.open(DATA, "w", force_zip64=True)

    def add(self, raw: bytes, url: str | None, page_id: int | None) -> None:
        pack = zlib.compressobj(1, zlib.DEFLATED, 31)
        packed = pack.compress(raw) + pack.flush()
        self.data.write(packed)
        self.index.append(json.dumps({"url": url, "page_id": page_id, "offset": self.size,
                                      "length": len(packed)}))
        self.size += len(packed)
        self.records += 1

    def close(self) -> None:
        self.data.close()
        self.zip.writestr(INDEX, "".join(line + "\n" for line in self.index))
        self.zip.close()
        self.out.close()


def write_packages(pages: DataFrame, folder: str, min_bytes: int = 1000,
                   date: datetime = datetime(2024, 1, 1)) -> DataFrame:
    """Write all pages; returns the stored manifest (path, records, data_bytes)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        task, package, number, raw_bytes, done = TaskContext.get(), None, 0, 0, []
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                for row in batch.slice(at, SLICE).to_pylist():
                    if package is None:
                        store.create_dir(root, recursive=True)
                        package = _Package(store, f"{root}/part-{task.partitionId():06d}-"
                                                  f"{task.taskAttemptId()}-{number}.zip")
                        number, raw_bytes = number + 1, 0
                    payload = row["html"].encode("utf-8", "replace")
                    raw_bytes += len(payload)
                    package.add(record(row["page_id"], row["url"], payload, row["digest"],
                                       row["refers_to"], date), row["url"], row["page_id"])
                    if raw_bytes >= PACKAGE_BYTES:
                        package.close()
                        done, package = [*done, package], None
        if package is not None:
            package.close()
            done.append(package)
        yield pa.RecordBatch.from_pydict({
            "path": pa.array([p.path.removeprefix(root + "/") for p in done], pa.string()),
            "records": pa.array([p.records for p in done], pa.int64()),
            "data_bytes": pa.array([p.size for p in done], pa.int64())})

    marked = with_revisits(pages, min_bytes).select("page_id", "url", "html", "digest", "refers_to")
    return stored(marked.mapInArrow(run, "path string, records long, data_bytes long"), "manifest")


# Reading

def _range(file, start: int, length: int) -> bytes:
    file.seek(start)
    return file.read(length)


def members(file, size: int) -> dict[str, tuple[int, int, int]]:
    """Members of a ZIP file by name: (method, place of the data, packed size)."""
    tail_at = max(0, size - (1 << 16) - 22 - 20)
    tail = _range(file, tail_at, size - tail_at)
    at = tail.rfind(END)
    if at < 0:
        raise ValueError("not a ZIP file: no end of central directory")
    count, length, start = struct.unpack("<HII", tail[at + 10:at + 20])
    if at >= 20 and tail[at - 20:at - 16] == LOCATOR64:
        place, = struct.unpack("<Q", tail[at - 12:at - 4])
        end64 = _range(file, place, 56)
        if end64[:4] != END64:
            raise ValueError("ZIP64 locator points to no ZIP64 directory end")
        count, length, start = struct.unpack("<QQQ", end64[32:56])
    directory, out, at = _range(file, start, length), {}, 0
    for _ in range(count):
        if directory[at:at + 4] != ENTRY:
            raise ValueError("broken central directory")
        method, = struct.unpack("<H", directory[at + 10:at + 12])
        packed, whole, names, extras, notes = struct.unpack("<IIHHH", directory[at + 20:at + 34])
        local, = struct.unpack("<I", directory[at + 42:at + 46])
        name = directory[at + 46:at + 46 + names].decode("utf-8", "replace")
        extra = directory[at + 46 + names:at + 46 + names + extras]
        while len(extra) >= 4:
            kind, n = struct.unpack("<HH", extra[:4])
            if kind == 1:                      # 64-bit values of the fields that are full
                wide = [v for v, in struct.iter_unpack("<Q", extra[4:4 + n - n % 8])]
                whole = wide.pop(0) if whole == 0xFFFFFFFF else whole
                packed = wide.pop(0) if packed == 0xFFFFFFFF else packed
                local = wide.pop(0) if local == 0xFFFFFFFF else local
            extra = extra[4 + n:]
        head = _range(file, local, 30)
        if head[:4] != LOCAL:
            raise ValueError(f"no local header for {name}")
        own = struct.unpack("<HH", head[26:30])
        out[name] = (method, local + 30 + sum(own), packed)
        at += 46 + names + extras + notes
    return out


def _index_entries(file, found: dict) -> dict[str, list[tuple[int, int]]]:
    """Per data member the (offset, length) of its records, in the order of the indexes."""
    data = [n for n in found if n.startswith("archive/")]
    places: dict[str, list[tuple[int, int]]] = {}
    for name, (method, place, n) in found.items():
        if not name.startswith("indexes/"):
            continue
        raw = _range(file, place, n)
        if method == zipfile.ZIP_DEFLATED:
            raw = zlib.decompress(raw, -15)
        elif method != zipfile.ZIP_STORED:
            raise ValueError(f"{name} is compressed by an unknown method {method}")
        for line in raw.decode().splitlines():
            entry = json.loads(line[line.index("{"):])
            member = f"archive/{entry['filename']}" if entry.get("filename") else data[0] if len(data) == 1 else None
            if member not in found:
                raise ValueError(f"{name} has an entry for no data member: {line}")
            places.setdefault(member, []).append((int(entry["offset"]), int(entry["length"])))
    return places


def record_ranges(file, size: int) -> Iterator[tuple[int, list[int] | None, int]]:
    """Runs of records: (place in the file, the records' lengths or None, bytes).

    An index entry belongs to the data member it names; one without a name belongs to the
    only member.  A data member without entries is one run whose records are found by
    inflating it.  Indexes may be deflated, data members may not.
    """
    found = members(file, size)
    places = _index_entries(file, found)
    for name, (method, start, length) in found.items():
        if not name.startswith("archive/"):
            continue
        if method != 0:
            raise ValueError(f"{name} is compressed by the ZIP and can't be read by ranges")
        if name not in places:
            yield start, None, length
        lengths: list[int] = []
        run, at = start, start
        for offset, size_ in places.get(name, ()):
            offset += start
            if lengths and (offset != at or at - run >= RANGE_BYTES):
                yield run, lengths, at - run
                lengths = []
            if not lengths:
                run = offset
            lengths.append(size_)
            at = offset + size_
        if lengths:
            yield run, lengths, at - run


def _records(raw: bytes, lengths: list[int] | None) -> Iterator[bytes]:
    if lengths is not None:
        at = 0
        for n in lengths:
            yield zlib.decompress(raw[at:at + n], 31)
            at += n
        return
    while raw:
        inflate = zlib.decompressobj(31)
        yield inflate.decompress(raw)
        raw = inflate.unused_data


RECORD = ("page_id long, url string, record_type string, record_id string, refers_to_id string, "
          "payload_bytes long, payload_digest string, payload binary")


def read_packages(manifest: DataFrame, folder: str, payload: bool = True) -> DataFrame:
    """All records of the packages in a manifest (column path, relative to the folder)."""
    def locate(batches):
        store, root = open_store(folder)
        for batch in batches:
            for path in batch["path"].to_pylist():
                size = store.get_file_info(f"{root}/{path}").size
                with store.open_input_file(f"{root}/{path}") as file:
                    runs = list(record_ranges(file, size))
                yield pa.RecordBatch.from_pydict({
                    "path": pa.array([path] * len(runs), pa.string()),
                    "start": pa.array([r[0] for r in runs], pa.int64()),
                    "lengths": pa.array([r[1] for r in runs], pa.list_(pa.int64())),
                    "bytes": pa.array([r[2] for r in runs], pa.int64())})

    def read(batches):
        store, root = open_store(folder)
        for batch in batches:
            for run in batch.to_pylist():
                with store.open_input_file(f"{root}/{run['path']}") as file:
                    raw = _range(file, run["start"], run["bytes"])
                rows = [parse_record(x) for x in _records(raw, run["lengths"])]
                if not payload:
                    for row in rows:
                        row["payload"] = None
                for at in range(0, len(rows), SLICE):
                    yield pa.RecordBatch.from_pylist(rows[at:at + SLICE], schema=schema)

    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                        ("record_id", pa.string()), ("refers_to_id", pa.string()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("payload", pa.binary())])
    cores = manifest.sparkSession.sparkContext.defaultParallelism
    runs = stored(manifest.repartition(cores, "path").select("path")
                  .mapInArrow(locate, "path string, start long, lengths array<long>, bytes long"), "runs")
    total = runs.agg(F.sum("bytes")).first()[0] or 0
    return (runs.repartition(max(cores, total // (4 * RANGE_BYTES)), "path", "start")
            .mapInArrow(read, RECORD))


def with_referred_page(records: DataFrame) -> DataFrame:
    """Add refers_to: the page_id of the response that a revisit names."""
    answers = (records.where("record_type = 'response'")
               .groupBy(F.col("record_id").alias("refers_to_id")).agg(F.max("page_id").alias("refers_to")))
    # Responses name nothing; kept out of the join, they are no key that all of them share.
    named = records.where(F.col("refers_to_id").isNotNull()).join(answers, "refers_to_id", "left")
    alone = records.where(F.col("refers_to_id").isNull()).withColumn("refers_to", F.lit(None).cast("long"))
    return named.unionByName(alone)
