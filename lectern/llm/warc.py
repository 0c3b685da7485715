"""WARC archives: writing, and normalising monolithic gzip files to one member a record with an offset index."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.runtime import materialise, new_path, ship

VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The synthetic pages have no capture time.
CAPTURED = "1970-01-01T00:00:00Z"
#: Extension fields: a page's id, and that of the page whose record a revisit stands for.
PAGE, REFERS = "X-Page-ID", "X-Refers-To-Page-ID"
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def _storage(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def record(place: str, page_id: int | None, url: str | None, payload: bytes, digest: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record. A revisit keeps the HTTP header, with the payload's length, and leaves out the payload.

    Its id follows from its place (file and number), so no two records share one, whatever ids pages have, and a task
    that runs again writes the same.
    """
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, place)}>",
            f"WARC-Date: {CAPTURED}", f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}"]
    if page_id is not None:
        head.append(f"{PAGE}: {page_id}")
    if url is not None:
        head.append("WARC-Target-URI: " + _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"{REFERS}: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return VERSION + b"\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def inflate(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The plain bytes of a gzip stream of any number of members, a bounded piece at a time; one without its end is an error."""
    d, begun = zlib.decompressobj(31), False
    for data in chunks:
        while data:
            if not begun:  # zeros may pad members
                data = data.lstrip(b"\0")
                if not data:
                    break
                begun = True
            out = d.decompress(data, 1 << 20)
            if out:
                yield out
            if d.eof:
                data, d, begun = d.unused_data, zlib.decompressobj(31), False
            else:
                data = d.unconsumed_tail
    if begun:
        if rest := d.flush():
            yield rest
        if not d.eof:
            raise ValueError("a gzip stream is cut off")


def split_records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and raw bytes of each record of a plain WARC stream; one record is held at a time."""
    held, pieces = bytearray(), iter(pieces)

    def until(n: int) -> bool:
        while len(held) < n:
            piece = next(pieces, None)
            if piece is None:
                return False
            held.extend(piece)
        return True

    while True:
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not until(len(held) + 1):
                if held.strip():
                    raise ValueError("a record is cut off")
                return
        h = headers(bytes(held[:end]))
        size = end + 4 + int(h["content-length"]) + 4
        if not until(size):
            raise ValueError("a record is cut off")
        yield h, bytes(held[:size])
        del held[:size]


def _chunks(f, size: int = 1 << 20) -> Iterator[bytes]:
    while data := f.read(size):
        yield data


class _File:
    """A file that appears under its name only when it is whole."""

    def __init__(self, store: fs.FileSystem, name: str):
        self.store, self.name = store, name
        self.temporary = f"{name}.{TaskContext.get().taskAttemptId()}.part"
        self.out = store.open_output_stream(self.temporary)

    def write(self, data: bytes) -> None:
        self.out.write(data)

    def close(self) -> None:
        self.out.close()
        self.store.move(self.temporary, self.name)


def dedup_targets(pages: DataFrame, least: int = 1000) -> DataFrame:
    """``pages`` with ``payload`` (UTF-8 bytes of html, null: empty), ``digest`` (SHA-1 hex) and ``refers_to``.

    ``refers_to`` is the largest page_id of the equal payloads of at least ``least`` bytes, where that is another
    page's; else null. Only digests that occur more than once meet their rows again.
    """
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    groups = rows.where(F.length("payload") >= least).groupBy("digest")
    groups = groups.agg(F.max("page_id").alias("__top"), F.count(F.lit(1)).alias("__n")).where("__n > 1")
    # written first: its size is then known, and pages are shuffled only where it is too large to broadcast
    groups = materialise(groups.select("digest", "__top"), "repeated")
    joined = rows.join(groups, "digest", "left")
    own = F.col("__top").isNull() | F.col("page_id").eqNullSafe(F.col("__top"))
    return joined.select("page_id", "url", "payload", "digest", F.when(~own, F.col("__top")).alias("refers_to"))


def write_archives(rows: DataFrame, folder: str, most_bytes: int = 256 << 20) -> DataFrame:
    """Write ``rows(page_id, url, payload, digest, refers_to)`` as archives that are one gzip stream each; one row a file.

    A partition goes on to another file past ``most_bytes`` of plain records. It is sorted first, and every attempt of a
    task names its own files, so those listed are one attempt's, whole, whatever another left behind.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _storage(folder)
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        serial, f, made, n, plain = 0, None, [], 0, 0
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns)):
                if f is None:
                    f = _File(store, f"{root}/part-{part:05d}-{serial:03d}-{attempt}.warc.gz")
                    z, n, plain = zlib.compressobj(4, zlib.DEFLATED, 31), 0, 0
                page_id, url, payload, digest, refers_to = r
                rec = record(f"{part}/{serial}/{n}", page_id, url, payload, bytes.fromhex(digest), refers_to, refers_to is not None)
                f.write(z.compress(rec))
                n, plain = n + 1, plain + len(rec)
                if plain >= most_bytes:
                    f.write(z.flush())
                    f.close()
                    made.append((f.name.rsplit("/", 1)[1], n))
                    f, serial = None, serial + 1
        if f is not None:
            f.write(z.flush())
            f.close()
            made.append((f.name.rsplit("/", 1)[1], n))
        yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64())], names=["file", "records"])

    store, root = _storage(folder)
    store.create_dir(root, recursive=True)
    ship(rows.sparkSession)
    ordered = rows.select("page_id", "url", "payload", "digest", "refers_to").sortWithinPartitions("page_id", "digest", "url")
    return materialise(ordered.mapInArrow(run, "file string, records long"), "archives")


def normalise(files: DataFrame, source: str, target: str) -> DataFrame:
    """Rewrite the archives ``files(file, records)`` of ``source`` into ``target``, every record a gzip member of its own.

    Each file is inflated once, as a stream. Beside it comes ``<file>.idx``: a line for each record with its offset,
    its member's length, its type and its id. One row a file: ``file, records``. Another number of
    records than the list says is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (store, root), (out_store, out_root) = _storage(source), _storage(target)
        for b in batches:
            for name, records in zip(*(c.to_pylist() for c in b.columns)):
                out, index = _File(out_store, f"{out_root}/{name}"), _File(out_store, f"{out_root}/{name}.idx")
                at = n = 0
                with store.open_input_stream(f"{root}/{name}", compression=None) as f:
                    for h, rec in split_records(inflate(_chunks(f))):
                        z = zlib.compressobj(4, zlib.DEFLATED, 31)
                        member = z.compress(rec) + z.flush()
                        out.write(member)
                        index.write(f"{at} {len(member)} {h['warc-type']} {h['warc-record-id']}\n".encode())
                        at, n = at + len(member), n + 1
                if n != records:
                    raise ValueError(f"{name}: {n} of {records} records")
                out.close()
                index.close()
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], names=["file", "records"])

    store, root = _storage(target)
    store.create_dir(root, recursive=True)
    ship(files.sparkSession)
    spread = files.select("file", "records").repartition(max(1, files.count()))
    return materialise(spread.mapInArrow(run, "file string, records long"), "normalised")


def read_archives(files: DataFrame, folder: str) -> DataFrame:
    """Read normalised archives through their indexes: ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    A response's digest is computed from its payload and must equal the header's. A revisit's digest and length are
    those of the full payload, from its headers.
    """
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"

    def page(of: str | None) -> int | None:
        return None if of is None else int(of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _storage(folder)
        for b in batches:
            for name in b.column(0).to_pylist():
                with store.open_input_stream(f"{root}/{name}.idx", compression=None) as f:
                    index = f.read().decode().splitlines()
                cols: list[list] = [[], [], [], [], []]
                with store.open_input_file(f"{root}/{name}") as f:
                    for line in index:
                        at, size, _, _ = line.split(" ", 3)
                        f.seek(int(at))
                        rec = zlib.decompress(f.read(int(size)), 31)
                        end = rec.index(b"\r\n\r\n")
                        h = headers(rec[:end])
                        block = rec[end + 4 : end + 4 + int(h["content-length"])]
                        cut = block.index(b"\r\n\r\n") + 4
                        digest = base64.b32decode(h["warc-payload-digest"].removeprefix("sha1:")).hex()
                        size = int(re.search(rb"Content-Length: (\d+)", block[:cut])[1])
                        if h["warc-type"] == "response" and (hashlib.sha1(block[cut:]).hexdigest() != digest or len(block) - cut != size):
                            raise ValueError(f"{name}, {h['warc-record-id']}: the payload is damaged")
                        for c, v in zip(cols, (page(h.get(PAGE.lower())), size, digest, h["warc-type"], page(h.get(REFERS.lower())))):
                            c.append(v)
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    ship(files.sparkSession)
    return files.select("file").repartition(max(1, files.count())).mapInArrow(run, schema)


def round_trip(spark: SparkSession, pages: DataFrame, folder: str | None = None, least: int = 1000) -> DataFrame:
    """Write a record for each row of ``pages``, normalise the archives, and read them back through their indexes.

    Null html is an empty payload; a null url has no target header; control characters in a url are percent-encoded.
    Of equal payloads of ``least`` bytes or more the largest page_id is a response (rows repeating that id all are),
    others and null ids revisit it; where all ids are null, all are responses. Very long pages are held one at a time.
    An empty table gives an empty result. Other columns are ignored. Without a ``folder`` the archives go where
    ``runtime.clean`` deletes them.
    """
    at = f"{folder}/warc-{uuid.uuid4().hex}" if folder else new_path(spark, "warc")
    raw = write_archives(dedup_targets(pages, least), f"{at}/monolithic")
    files = normalise(raw, f"{at}/monolithic", f"{at}/normalised")
    store, root = _storage(f"{at}/monolithic")
    store.delete_dir(root)  # every record is in the normalised archives now
    return read_archives(files, f"{at}/normalised")
