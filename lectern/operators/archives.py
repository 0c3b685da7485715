"""Expand zip archives into rows of their files: archives in a column, or files of which tasks read byte ranges."""

from __future__ import annotations

import bz2
import io
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.paths import ZIP, inside, mime_type_of, of_junk
from lectern.runtime import open_store, ship
from lectern.schema import ERROR

#: Rows are handed on when their contents reach this many bytes, or they this number.
GATHERED, MOST_ROWS = 16 << 20, 1000
#: Fixed values of the zip format: the local header's signature and size.
_LOCAL, _HEADER = b"PK\x03\x04", 30
#: What a damaged archive or entry may raise.
DAMAGED = (zipfile.BadZipFile, zipfile.LargeZipFile, zlib.error, EOFError, OSError, NotImplementedError, RuntimeError, ValueError, struct.error)


def kept_entries(z: zipfile.ZipFile) -> list[tuple[int, str, zipfile.ZipInfo]]:
    """Number, path and entry of an archive's files, in its order; of several entries of one path the last counts.

    Paths never lead out of the archive's folder: roots, drives and ``..`` are left out, and a name that has nothing
    else is none.
    """
    files = [(i, inside(e.filename), e) for i, e in enumerate(x for x in z.infolist() if not x.is_dir())]
    last = {name: i for i, name, _ in files}
    return [f for f in files if f[1] and last[f[1]] == f[0]]


def _reason(e: Exception) -> str:
    return f"{type(e).__name__}: {e}"[:500]


class _Gathered:
    """Rows made of others with some columns replaced, gathered into batches of bounded bytes."""

    def __init__(self, batch: pa.RecordBatch, replaced: list[str]):
        self.batch, self.names = batch, batch.schema.names
        self.replaced = replaced
        self.clear()

    def clear(self) -> None:
        self.rows: list[int] = []
        self.new: dict[str, list] = {n: [] for n in self.replaced}
        self.size = 0

    def add(self, row: int, **values: object) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        for n in self.replaced:
            self.new[n].append(values[n] if n in values else self.batch.column(n)[row].as_py())
        self.size += len(values.get("content") or b"")
        if self.size >= GATHERED or len(self.rows) >= MOST_ROWS:
            yield from self.done()

    def done(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            at, schema = pa.array(self.rows, pa.int64()), self.batch.schema
            columns = [pa.array(self.new[n], schema.field(n).type) if n in self.new else self.batch.column(n).take(at) for n in self.names]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
        self.clear()


def entries(zips: DataFrame, key: str = "key", content: str = "content") -> DataFrame:
    """``key, pos, path, content``: every file in every archive, in the archive's order; see ``kept_entries``."""
    ship(zips.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held: list[tuple] = []
            size = 0

            def done() -> pa.RecordBatch:
                kinds = (b.column(0).type, pa.int32(), pa.string(), pa.binary())
                return pa.RecordBatch.from_arrays([pa.array([h[i] for h in held], k) for i, k in enumerate(kinds)], names=["key", "pos", "path", "content"])

            for k, data in zip(b.column(0), b.column(1)):
                if data.is_valid:
                    with zipfile.ZipFile(io.BytesIO(data.as_buffer())) as z:
                        for i, name, e in kept_entries(z):
                            held.append((k.as_py(), i, name, z.read(e)))
                            size += e.file_size
                            if size >= GATHERED or len(held) >= MOST_ROWS:
                                yield done()
                                held, size = [], 0
            if held:
                yield done()

    schema = f"key {zips.schema[key].dataType.simpleString()}, pos int, path string, content binary"
    return zips.select(key, content).mapInArrow(run, schema)


class _Expansion:
    """What a row for a file of an archive, and for a failure, looks like."""

    CHANGED = ["title", "path", "mime_type", "content", "ord", "kind", "section_text"]

    def __init__(self, mime_types: list[str] | None, own_folder: bool):
        self.mime_types, self.own_folder = mime_types, own_folder

    def wants(self, name: str) -> bool:
        return not of_junk(name) and (self.mime_types is None or mime_type_of(name) in self.mime_types)

    def path(self, archive: str, name: str) -> str:
        return (archive + "/" if self.own_folder else archive[: archive.rfind("/") + 1]) + name

    def file(self, title: str, path: str, order: list | None, i: int, name: str, content: bytes | None) -> dict:
        return {"title": f"{title} > {name.rsplit('/', 1)[-1]}", "path": self.path(path, name), "mime_type": mime_type_of(name), "content": content, "ord": [*(order or []), i]}

    def failure(self, title: str, path: str, order: list | None, reason: str, i: int = -1, name: str = "") -> dict:
        at = {"title": f"{title} > {name.rsplit('/', 1)[-1]}", "path": self.path(path, name), "ord": [*(order or []), i]} if name else {}
        return at | {"mime_type": None, "content": None, "kind": ERROR, "section_text": reason}


def expand_archives(df: DataFrame, mime_types: list[str] | None = None, own_folder: bool = False) -> DataFrame:
    """Zip rows, whose bytes are in ``content``, replaced by a row for each file kept; other rows pass.

    Kept are files of ``mime_types`` (None: all) that are no junk; of several of one path the last. A new row has the archive's
    metadata, the title ``<archive> > <file>``, its own path, type and content. Its path is below the archive's folder, or with
    ``own_folder`` below one named as the archive, so that no two archives' files meet; it never leads elsewhere. An
    archive with nothing kept, or without bytes, disappears. A damaged archive, or entry, becomes a row of the kind ``error``, without type and
    content, that gives the reason as ``section_text``. Rows are handed on in batches of bounded bytes.
    """
    one = _Expansion(mime_types, own_folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            zips = [t == ZIP for t in b.column("mime_type").to_pylist()]
            if not all(zips):
                yield b.filter(pa.array([not z for z in zips]))
            made = _Gathered(b, one.CHANGED)
            for i in (i for i, z in enumerate(zips) if z):
                data, about = b.column("content")[i], [b.column(n)[i].as_py() for n in ("title", "path", "ord")]
                if not data.is_valid:
                    continue
                try:
                    z = zipfile.ZipFile(io.BytesIO(data.as_buffer()))
                    files = kept_entries(z)
                except DAMAGED as e:
                    yield from made.add(i, **one.failure(*about, _reason(e)))
                    continue
                for pos, name, e in files:
                    if one.wants(name):
                        try:
                            row = one.file(*about, pos, name, z.read(e))
                        except DAMAGED as x:
                            row = one.failure(*about, _reason(x), pos, name)
                        yield from made.add(i, **row)
            yield from made.done()

    ship(df.sparkSession)
    return df.mapInArrow(run, df.schema)


#: Where an entry lies in its archive, added to its row between listing and reading.
_PLACE = [("__archive", "string"), ("__entry", "string"), ("__at", "long"), ("__packed", "long"), ("__size", "long"), ("__method", "integer"), ("__crc", "long")]


def read_entry(f, at: int, packed: int, size: int, method: int, crc: int) -> bytes:
    """An entry's bytes, by its place in the central directory; only its own range of the archive is read."""
    f.seek(at)
    head = f.read(_HEADER)
    if len(head) < _HEADER or head[:4] != _LOCAL:
        raise zipfile.BadZipFile("no local header where the directory says")
    name, extra = struct.unpack("<HH", head[26:30])
    f.seek(at + _HEADER + name + extra)
    data = f.read(packed)
    if len(data) < packed:
        raise EOFError("the archive ends within an entry")
    if method == zipfile.ZIP_DEFLATED:
        data = zlib.decompress(data, -15, max(size, 1))
    elif method == zipfile.ZIP_BZIP2:
        data = bz2.decompress(data)
    elif method != zipfile.ZIP_STORED:
        raise NotImplementedError(f"compression method {method}")
    if len(data) != size or zlib.crc32(data) != crc:
        raise zipfile.BadZipFile("an entry's bytes do not fit its checksum")
    return data


class _Seekable:
    """A file of a store for ``zipfile``, which takes a place before the beginning for an ``OSError``."""

    def __init__(self, f):
        self.f = f

    def seek(self, at: int, whence: int = 0) -> int:
        try:
            return self.f.seek(at, whence)
        except pa.ArrowInvalid as e:
            raise OSError(str(e)) from e

    def __getattr__(self, name: str):
        return getattr(self.f, name)


def list_archive_files(df: DataFrame, mime_types: list[str] | None = None, own_folder: bool = False) -> DataFrame:
    """Zip rows replaced by a row for each file kept, as by ``expand_archives``, with its place in the archive instead of its content.

    The archive is the file at ``path``; only its central directory is read. Rows are narrow, however large the archives are.
    """
    one = _Expansion(mime_types, own_folder)
    places = [n for n, _ in _PLACE]
    schema = df.select("*").schema  # one of its own, to add to
    for n, kind in _PLACE:
        schema = schema.add(n, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            none = [pa.nulls(b.num_rows, {"string": pa.string(), "long": pa.int64(), "integer": pa.int32()}[k]) for _, k in _PLACE]
            b = pa.RecordBatch.from_arrays([*b.columns, *none], names=[*b.schema.names, *places])
            zips = [t == ZIP for t in b.column("mime_type").to_pylist()]
            if not all(zips):
                yield b.filter(pa.array([not z for z in zips]))
            made = _Gathered(b, one.CHANGED + places)
            for i in (i for i, z in enumerate(zips) if z):
                about = [b.column(n)[i].as_py() for n in ("title", "path", "ord")]
                try:
                    store, at = open_store(about[1])
                    with store.open_input_file(at) as f, zipfile.ZipFile(_Seekable(f)) as z:
                        files = [x for x in kept_entries(z) if one.wants(x[1])]
                except DAMAGED as e:
                    yield from made.add(i, **one.failure(*about, _reason(e)))
                    continue
                for pos, name, e in files:
                    if e.flag_bits & 1:
                        yield from made.add(i, **one.failure(*about, "an encrypted entry", pos, name))
                        continue
                    where = (about[1], name, e.header_offset, e.compress_size, e.file_size, e.compress_type, e.CRC)
                    yield from made.add(i, **one.file(*about, pos, name, None), **dict(zip(places, where)))
            yield from made.done()

    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


#: Entries that begin in one stretch of so many bytes of an archive are read by one task.
STRETCH = 64 << 20


def read_archive_files(listed: DataFrame, keep: tuple[str, ...] = (), stretch: int = STRETCH) -> DataFrame:
    """Rows of ``list_archive_files`` with their contents; an entry that cannot be read becomes an ``error`` row.

    Entries are dealt out by a hash of the archive and the ``stretch`` in which they begin, so that a large archive's files are read by
    many tasks, each its own byte ranges, and a small one is opened once. ``keep``: columns of the listing that stay.
    """
    places = [n for n, _ in _PLACE]
    names = [c for c in listed.columns if c not in places or c in keep]
    one = _Expansion(None, False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, f = None, None
        for b in batches:
            archive = b.column("__archive").to_pylist()
            plain = [a is None for a in archive]
            rest = b.select(names)
            if any(plain):
                yield rest.filter(pa.array(plain))
            made = _Gathered(rest, one.CHANGED)
            for i in (i for i, p in enumerate(plain) if not p):
                title, path, order = (rest.column(n)[i].as_py() for n in ("title", "path", "ord"))
                try:
                    if opened != archive[i]:
                        if f is not None:
                            f.close()
                        opened, f = None, None
                        store, at = open_store(archive[i])
                        f, opened = store.open_input_file(at), archive[i]
                    row = {"content": read_entry(f, *(b.column(n)[i].as_py() for n in places[2:]))}
                except DAMAGED as e:
                    row = one.failure(title, path, order, _reason(e))
                yield from made.add(i, **row)
            yield from made.done()
        if f is not None:
            f.close()

    ship(listed.sparkSession)
    parts = int(listed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # a number of its own: by the listing's few bytes adaptive execution would make one task of all
    dealt = listed.repartition(parts, "__archive", F.shiftright(F.col("__at"), stretch.bit_length() - 1), F.when(F.col("__archive").isNull(), F.xxhash64("path")))
    dealt = dealt.sortWithinPartitions("__archive", "__at")
    return dealt.mapInArrow(run, listed.select(*names).schema)


def expand_archive_files(df: DataFrame, mime_types: list[str] | None = None, own_folder: bool = False) -> DataFrame:
    """``expand_archives`` for archives that are files at ``path``: no archive is ever held whole, and many tasks read one."""
    return read_archive_files(list_archive_files(df, mime_types, own_folder))


def archived(df: DataFrame, own_folder: bool = False) -> DataFrame:
    """``path, content`` of every file in the zip rows of ``df``, at the paths that ``expand_archives`` would give them."""
    rows = df.where((F.col("mime_type") == ZIP) & F.col("content").isNotNull())
    folder = F.concat("path", F.lit("/")) if own_folder else F.regexp_extract("path", r"(?s)^(.*/)?[^/]*$", 1)
    return entries(rows.select(folder.alias("key"), "content")).select(F.concat("key", "path").alias("path"), "content")
