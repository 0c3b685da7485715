"""Rewriting files of drifted schemas to one evolved schema by a chain of single-bit migrations."""

from __future__ import annotations

import hashlib
import math
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from lectern.llm.words import quoted, unused
from lectern.runtime import materialise, shared_dir, ship

#: The bits of drift, and of the transforms that undo them.
RENAMED, REORDERED, MISSING, NARROWED = 1, 2, 4, 8
_ID = b"PARQUET:field_id"
#: Types that hold every value of another.
_WIDER = {(pa.int32(), pa.int64()), (pa.float32(), pa.float64())}
Batches = Iterator[pa.RecordBatch]


class Unreadable(ValueError):
    """A file whose schema no chain of these migrations leads to the evolved one."""


def with_ids(schema: pa.Schema) -> pa.Schema:
    """The fields, nullable, with Parquet field ids from 1 in their order."""
    return pa.schema([pa.field(f.name, f.type, True, {_ID: str(i).encode()}) for i, f in enumerate(schema, 1)])


def id_of(field: pa.Field) -> int:
    if not field.metadata or _ID not in field.metadata:
        raise Unreadable(f"column {field.name} has no field id")
    return int(field.metadata[_ID])


def drift(found: pa.Schema, target: pa.Schema) -> int:
    """In which ways a footer's schema differs from the target's, fields matched by id."""
    wanted, here = {id_of(f): f for f in target}, {id_of(f): f for f in found}
    if len(here) < len(found) or not here.keys() <= wanted.keys():
        raise Unreadable(f"field ids {sorted(map(id_of, found))} are not of the evolved schema")
    for i, f in here.items():
        if f.type != wanted[i].type and (f.type, wanted[i].type) not in _WIDER:
            raise Unreadable(f"column {f.name}: {f.type} does not widen to {wanted[i].type}")
    order = [i for i in wanted if i in here]
    return (
        RENAMED * any(f.name != wanted[i].name for i, f in here.items())
        | REORDERED * (list(here) != order)
        | MISSING * (len(here) < len(wanted))
        | NARROWED * any(f.type != wanted[i].type for i, f in here.items())
    )


def _rebuilt(batch: pa.RecordBatch, columns: list[pa.Array], fields: list[pa.Field]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields))


def rename(target: pa.Schema, defaults: dict[str, object]) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    """Columns get the name of their id."""
    names = {id_of(f): f.name for f in target}
    return lambda b: _rebuilt(b, b.columns, [f.with_name(names[id_of(f)]) for f in b.schema])


def reorder(target: pa.Schema, defaults: dict[str, object]) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    """Columns come in the order of the evolved schema."""
    place = {id_of(f): i for i, f in enumerate(target)}

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        order = sorted(range(b.num_columns), key=lambda i: place[id_of(b.schema.field(i))])
        return _rebuilt(b, [b.column(i) for i in order], [b.schema.field(i) for i in order])

    return run


def add(target: pa.Schema, defaults: dict[str, object]) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    """Missing columns are put where they belong among those there, filled with their default."""

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        columns, fields = list(b.columns), list(b.schema)
        here = {id_of(f) for f in fields}
        for i, f in enumerate(target):
            if id_of(f) not in here:
                columns.insert(i, pa.repeat(pa.scalar(defaults.get(f.name), f.type), b.num_rows))
                fields.insert(i, f)
        return _rebuilt(b, columns, fields)

    return run


def widen(target: pa.Schema, defaults: dict[str, object]) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
    """Columns get the evolved schema's types."""
    types = {id_of(f): f.type for f in target}
    return lambda b: _rebuilt(b, [c.cast(types[id_of(f)]) for c, f in zip(b.columns, b.schema)], [f.with_type(types[id_of(f)]) for f in b.schema])


#: Each undoes one bit, whatever the others are; reordering comes last, as added columns take part in it.
MIGRATIONS = ((NARROWED, widen), (MISSING, add), (RENAMED, rename), (REORDERED, reorder))


def migrated(batches: Batches, bits: int, target: pa.Schema, defaults: dict[str, object]) -> Batches:
    """The chain of the transforms that ``bits`` asks for, over a stream of batches; nothing is read before it is asked for."""
    for bit, make in MIGRATIONS:
        if bits & bit:
            batches = map(make(target, defaults), batches)
    return batches


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if ":" in folder.split("/", 1)[0] else f"file://{folder}")


class _Whole:
    """A Parquet file that appears under its name when it is whole; each attempt of a task writes one of its own."""

    def __init__(self, store: fs.FileSystem, root: str, name: str, schema: pa.Schema):
        self.store, self.name, self.schema, self.rows = store, f"{root}/{name}", schema, 0
        self.part = f"{root}/_{name}.{TaskContext.get().taskAttemptId()}"
        self.out = pq.ParquetWriter(self.part, schema, filesystem=store)

    def write(self, batch: pa.RecordBatch) -> None:
        self.out.write_batch(pa.RecordBatch.from_arrays(batch.columns, schema=self.schema))
        self.rows += batch.num_rows

    def close(self) -> None:
        self.out.close()
        self.store.move(self.part, self.name)


def version_of(file_no: int, versions: int = 24, most: int = 15) -> int:
    """Which drift a starting file of the query has."""
    v = zlib.crc32(b"7:%d" % file_no) % versions
    return v if v <= most else 0


def drifted(target: pa.Schema, version: int, swapped: tuple[str, str], missing: tuple[str, ...], narrow: dict[str, pa.DataType]) -> tuple[list[str], pa.Schema]:
    """The evolved columns that a file of this version holds, in its order, and its schema."""
    fields = [f for f in target if not (version & MISSING and f.name in missing)]
    if version & REORDERED:
        fields = [fields[0], *reversed(fields[1:])]
    names = [f.name for f in fields]
    if version & NARROWED:
        fields = [f.with_type(narrow.get(f.name, f.type)) for f in fields]
    if version & RENAMED:
        other = dict(zip(swapped, reversed(swapped)))
        fields = [f.with_name(other.get(f.name, f.name)) for f in fields]
    return names, pa.schema(fields)


#: How the query's starting files drift.
SWAPPED, LEFT_OUT = ("name", "email"), ("nation_id", "city")
NARROW = {"balance": pa.float32(), "nation_id": pa.int32()}
DEFAULTS = {"nation_id": -1, "city": "none"}


def _before(counts: DataFrame, groups: int = 1024) -> DataFrame:
    """``part, n`` with the rows of earlier parts, over two levels: parts within at most ``groups`` runs of them, and those runs.

    So the one window over all runs holds a fixed number of rows at most, however many parts there are.
    """
    upto = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = materialise(counts, "parts")
    last = counts.agg(F.max("part")).first()[0] or 0
    counts = counts.withColumn("group", F.shiftright("part", max(0, last.bit_length() - groups.bit_length() + 1)))
    near = counts.withColumn("near", upto(Window.partitionBy("group").orderBy("part")))
    far = counts.groupBy("group").agg(F.sum("n").alias("n")).select("group", upto(Window.orderBy("group")).alias("far"))
    return near.join(far, "group").select("part", "n", (F.col("near") + F.col("far")).alias("before"))


def numbered_files(df: DataFrame, key: str, files: int = 1000) -> tuple[DataFrame, list[str], int, int]:
    """``df`` with the file of each row, in the order of the key's CRC-32 and the key: the frame, its order, rows a file and rows in all.

    Narrow keys alone are range partitioned; of those, the first of each file, ``files`` + 1 at most whatever the
    input, go back to the tasks as bounds. Equal keys are ordered by a hash of their row, equal rows by their place in the input, which must
    be a table of files: it is read twice.
    """
    crc, number, mix, uid, file_no = order = unused(df, "__crc", "__key", "__mix", "__uid", "__file")
    value = F.col(quoted(key)).cast("long")
    row = F.xxhash64(*[F.col(quoted(c)) for c in df.columns])
    keyed = df.withColumns({
        crc: F.coalesce(F.crc32(F.encode(value.cast("string"), "UTF-8")), F.lit(1 << 32)), number: F.coalesce(value, F.lit((1 << 63) - 1)),
        mix: row, uid: F.monotonically_increasing_id(),
    })
    order = order[:4]
    sorted_keys = keyed.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    ranked = materialise(sorted_keys.withColumn("__at", F.monotonically_increasing_id()), "ranked")
    counts = ranked.groupBy(F.shiftright("__at", 33).alias("part")).agg(F.count(F.lit(1)).alias("n"))
    n = ranked.count()
    per = 1 + n // files
    # the places in a part whose rank begins a file
    first = F.pmod(-F.col("before"), F.lit(per))
    starts = _before(counts).where(first < F.col("n")).select("part", F.explode(F.sequence(first, F.col("n") - 1, F.lit(per).cast("long"))).alias("i"))
    # at most a row a file: the number of files bounds it
    at = starts.select((F.shiftleft("part", 33) + F.col("i")).alias("__at"))
    bounds = sorted(tuple(r) for r in ranked.join(F.broadcast(at), "__at", "left_semi").select(*order).collect())
    crcs = np.array([b[0] for b in bounds], np.int64)

    @F.arrow_udf("int")
    def place(c: pa.Array, k: pa.Array, m: pa.Array, u: pa.Array) -> pa.Array:
        keys = c.to_numpy()
        out = np.searchsorted(crcs, keys) - 1
        for i in np.flatnonzero(np.isin(keys, crcs)).tolist():
            out[i] = bisect_right(bounds, (c[i].as_py(), k[i].as_py(), m[i].as_py(), u[i].as_py())) - 1
        return pa.array(out.astype(np.int32))

    return keyed.withColumn(file_no, place(*map(F.col, order))), [file_no, *order], per, n


def write_start(df: DataFrame, folder: str, target: pa.Schema, key: str, files: int = 1000) -> DataFrame:
    """Write ``df`` as drifted files; ``file_no, version, path, n_rows``. One task writes a file whole, as a stream."""
    rows, order, per, n = numbered_files(df, key, files)
    names = target.names

    def run(batches: Batches) -> Batches:
        store, root = _store(folder)
        out, now, made = None, None, []

        def done() -> None:
            out.close()
            made.append((now, version_of(now), f"{folder}/{out.name.rsplit('/', 1)[1]}", out.rows))

        for b in batches:
            no = b.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(no)) + 1).tolist(), len(no)]
            for lo, hi in zip(cuts, cuts[1:]) if len(no) else ():
                if out is None or no[lo] != now:
                    if out is not None:
                        done()
                    now = int(no[lo])
                    held, schema = drifted(target, version_of(now), SWAPPED, LEFT_OUT, NARROW)
                    out = _Whole(store, root, f"clients-{now:05d}.parquet", schema)
                part = b.slice(lo, hi - lo)
                columns = [part.column(1 + names.index(c)).cast(f.type, safe=False) for c, f in zip(held, schema)]
                out.write(pa.RecordBatch.from_arrays(columns, schema=schema))
        if out is not None:
            done()
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], k) for i, k in enumerate(kinds)], names=["file_no", "version", "path", "n_rows"])

    store, root = _store(folder)
    store.create_dir(root, recursive=True)
    dealt = rows.repartition(order[0]).sortWithinPartitions(*order).select(order[0], *map(quoted, names))
    made = materialise(dealt.mapInArrow(run, "file_no long, version long, path string, n_rows long"), "start")
    expected = F.least(F.lit(per), F.lit(n) - F.col("file_no") * per)
    if made.agg(F.sum("n_rows")).first()[0] != (n or None) or not made.where(F.col("n_rows") != expected).isEmpty():
        raise RuntimeError("the table gave other rows when it was read again")
    return made


def _spread(files: DataFrame) -> DataFrame:
    """File names over tasks: up to four a core, at most one a file."""
    return files.repartition(max(1, min(files.count(), 4 * files.sparkSession.sparkContext.defaultParallelism)))


def detect(files: DataFrame, target: pa.Schema) -> DataFrame:
    """``path, drift, start_columns`` by each file's footer, written down before anything is rewritten."""

    def run(batches: Batches) -> Batches:
        for b in batches:
            found = []
            for path in b.column(0).to_pylist():
                store, at = _store(path)
                schema = pq.read_schema(at, filesystem=store)
                found.append((path, drift(schema, target), ",".join(schema.names)))
            kinds = (pa.string(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], k) for i, k in enumerate(kinds)], names=["path", "drift", "start_columns"])

    return materialise(_spread(files.select("path")).mapInArrow(run, "path string, drift int, start_columns string"), "drift")


def rewrite(files: DataFrame, target: pa.Schema, defaults: dict[str, object]) -> DataFrame:
    """Bring the files of ``files(path)`` to the evolved schema: ``start, drift, start_columns, path, rewritten``.

    A file without drift stays untouched. Another is streamed, through the chain of transforms that its footer asks for, into a new file
    ``<name>-evolved.parquet`` beside it, rows and order kept; the old files go when all new ones are whole. Steps are
    written down one after the other, and a task that runs again finds its input as it was, so lost executors lose nothing. Fields are matched by
    id; a column without one, an unknown id, or a type that does not widen is an error. Empty files keep their schema only.
    """
    found = detect(files, target)

    def run(batches: Batches) -> Batches:
        for b in batches:
            made = []
            for path, bits in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                store, at = _store(path)
                root, name = at.rsplit("/", 1)
                name = name.removesuffix(".parquet") + "-evolved.parquet"
                with store.open_input_file(at) as f:
                    old = pq.ParquetFile(f)
                    # batches carry their ids in the footer's schema only
                    rows = (pa.RecordBatch.from_arrays(x.columns, schema=old.schema_arrow.remove_metadata()) for x in old.iter_batches())
                    out = _Whole(store, root, name, target)
                    for x in migrated(rows, bits, target, defaults):
                        if not x.schema.equals(target):
                            raise Unreadable(f"{path} does not reach the evolved schema")
                        out.write(x)
                    if out.rows != old.metadata.num_rows:
                        raise Unreadable(f"{path}: {out.rows} of {old.metadata.num_rows} rows")
                out.close()
                made.append((path, f"{path.rsplit('/', 1)[0]}/{name}"))
            yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], pa.string()) for i in (0, 1)], names=["start", "path"])

    def remove(batches: Batches) -> Batches:
        for b in batches:
            for path in b.column(0).to_pylist():
                store, at = _store(path)
                if store.get_file_info(at).type != fs.FileType.NotFound:
                    store.delete_file(at)
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])

    made = materialise(_spread(found.where("drift <> 0").select("path", "drift")).mapInArrow(run, "start string, path string"), "rewritten")
    made.select("start").mapInArrow(remove, "n long").agg(F.sum("n")).collect()
    both = found.withColumnRenamed("path", "start").join(made, "start", "left")
    return both.select("start", "drift", "start_columns", F.coalesce("path", "start").alias("path"), F.col("path").isNotNull().alias("rewritten"))


def _written(column: pa.Array, field: pa.Field) -> pa.Array:
    """Values as text: integers in decimal, times in microseconds, floats as the floor of 2^20 times them; null as ?."""
    if pa.types.is_timestamp(field.type):
        column = column.cast(pa.timestamp("us", field.type.tz)).cast(pa.int64())
    elif pa.types.is_floating(field.type):
        scaled = pc.multiply(column, 1048576.0)
        if pc.all(pc.less(pc.abs(scaled), 2.0**62)).as_py() is False or pc.any(pc.is_nan(scaled)).as_py():
            text = lambda x: None if x is None else str(math.floor(x)) if math.isfinite(x) else str(x)
            return pa.array([text(x) for x in scaled.to_pylist()], pa.string()).fill_null("?")
        column = pc.floor(scaled).cast(pa.int64())
    return column.cast(pa.string()).fill_null("?")


def digests(files: DataFrame, key: str) -> DataFrame:
    """``path, n_rows, n_nulls, ids_sha256, rows_sha256, columns`` of each file of ``files(path)``, read as a stream."""

    def run(batches: Batches) -> Batches:
        for b in batches:
            found = []
            for path in b.column(0).to_pylist():
                store, at = _store(path)
                with store.open_input_file(at) as f:
                    data = pq.ParquetFile(f)
                    n = nulls = 0
                    ids, rows = hashlib.sha256(), hashlib.sha256()
                    for x in data.iter_batches():
                        if not x.num_rows:
                            continue
                        text = [_written(c, f) for c, f in zip(x.columns, x.schema)]
                        for digest, lines, by in ((ids, text[x.schema.names.index(key)], ","), (rows, pc.binary_join_element_wise(*text, "|"), "\n")):
                            digest.update(((by if n else "") + by.join(lines.to_pylist())).encode())
                        n += x.num_rows
                        nulls += sum(c.null_count for c in x.columns)
                    found.append((path, n, nulls, ids.hexdigest(), rows.hexdigest(), ",".join(data.schema_arrow.names)))
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], k) for i, k in enumerate(kinds)],
                                             names=["path", "n_rows", "n_nulls", "ids_sha256", "rows_sha256", "columns"])

    schema = "path string, n_rows long, n_nulls long, ids_sha256 string, rows_sha256 string, columns string"
    return _spread(files.select("path")).mapInArrow(run, schema)


def evolved_schema(df: DataFrame, types: dict[str, pa.DataType]) -> pa.Schema:
    """The schema of ``df`` with some types changed, nullable, with field ids from 1."""
    return with_ids(pa.schema([pa.field(f.name, types.get(f.name, f.type)) for f in to_arrow_schema(df.schema)]))


def migrate_clients(spark: SparkSession, clients: DataFrame, key: str = "client_id", files: int = 1000) -> DataFrame:
    """Write ``clients`` as drifted files of a new folder, rewrite them to the evolved schema there, and describe each.

    ``file_no, version, n_rows, n_nulls, ids_sha256, rows_sha256, start_columns, columns, path, rewritten``. The folder lies in the shared one
    and stays. Nulls stay null; a null key counts after all others; repeated keys and rows keep their number, ordered
    by a hash of the row; very long texts are values like others; a balance that is no number is written as nan or inf. Other columns than the contract's ten get ids and
    types of their own and pass through. An empty table gives no file and an empty result.
    """
    ship(spark)
    folder = f"{shared_dir(spark)}/clients-{uuid.uuid4().hex}"
    target = evolved_schema(clients, {"nation_id": pa.int64()})
    start = write_start(clients, folder, target, key, files)
    final = materialise(rewrite(start, target, DEFAULTS), "final")
    store, root = _store(folder)
    for f in store.get_file_info(fs.FileSelector(root)):  # two names a file at most: what lost attempts left
        if f.base_name.startswith("_"):
            store.delete_file(f.path)
    described = final.join(start.select(F.col("path").alias("start"), "file_no", "version"), "start").join(digests(final, key), "path")
    return described.select(
        "file_no", "version", "n_rows", "n_nulls", "ids_sha256", "rows_sha256", "start_columns", "columns", "path", "rewritten"
    )
