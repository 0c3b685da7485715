import datetime as dt
import hashlib
import math
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from lectern.llm import migration as M

NAMES = ["client_id", "master_id", "source", "updated_at", "name", "email", "city", "nation_id", "segment", "balance"]
SCHEMA = ("client_id long, master_id long, source string, updated_at timestamp_ntz, name string, email string, city string, nation_id int, "
          "segment string, balance double")  # fmt: skip
TARGET = M.with_ids(pa.schema(list(zip(NAMES, [pa.int64(), pa.int64(), pa.string(), pa.timestamp("us"), pa.string(), pa.string(), pa.string(),
                                               pa.int64(), pa.string(), pa.float64()]))))


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute_force(rows, files=1000):
    """Each file's row, from the definition, in plain Python."""
    ordered = sorted(rows, key=lambda r: (zlib.crc32(str(r[0]).encode()), r[0]))
    per, out = 1 + len(rows) // files, []
    for no in range(-(-len(rows) // per)):
        v = zlib.crc32(f"7:{no}".encode()) % 24
        v = 0 if v > 15 else v
        some, nulls, lines = ordered[no * per : (no + 1) * per], 0, []
        for r in some:
            r = list(r)
            if v & 4:
                r[6], r[7] = "none", -1
            if v & 8 and r[9] is not None:
                r[9] = float(np.float32(r[9]))
            nulls += r.count(None)
            if r[3] is not None:
                r[3] = (r[3] - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
            if r[9] is not None:
                r[9] = math.floor(1048576 * r[9])
            lines.append("|".join("?" if x is None else str(x) for x in r))
        start = [n for n in NAMES if not (v & 4 and n in ("nation_id", "city"))]
        start = [start[0], *start[:0:-1]] if v & 2 else start
        start = [{"name": "email", "email": "name"}.get(n, n) for n in start] if v & 1 else start
        out.append((no, v, len(some), nulls, sha(",".join(str(r[0]) for r in some)), sha("\n".join(lines)), ",".join(start), ",".join(NAMES), bool(v)))
    return out


def check(spark, df, rows, files=1000):
    got = M.migrate_clients(spark, df, files=files).collect()
    assert sorted((*r[:8], r.rewritten) for r in got) == brute_force(rows, files)
    folder = {r.path.rsplit("/", 1)[0] for r in got}
    assert len(folder) <= 1
    for f in folder:
        here = Path(f.removeprefix("file://"))
        assert sorted(p.name for p in here.iterdir() if not p.name.startswith(".")) == sorted(r.path.rsplit("/", 1)[1] for r in got)
        for r in got:
            assert pq.read_schema(r.path.removeprefix("file://")).equals(TARGET if r.rewritten else TARGET, check_metadata=False)
            assert [M.id_of(x) for x in pq.read_schema(r.path.removeprefix("file://"))] == list(range(1, 11))


def some_rows(n):
    rows = []
    for i in range(n):
        at = None if i % 11 == 3 else dt.datetime(2024, 1, 1) + dt.timedelta(hours=i, microseconds=i)
        rows.append((i * 7, i, None if i % 5 == 4 else "web", at, f"n|{i}", None if i % 3 == 1 else f"e{i}", "Zürich", i % 25 if i % 7 else None, "x" * (i % 40), None if i % 13 == 5 else -10.01 * i))
    return rows


@pytest.mark.parametrize("n, files", [(0, 1000), (1, 1000), (700, 1000), (1500, 40)])
def test_files_equal_the_definition(spark, n, files):
    rows = some_rows(n)
    check(spark, spark.createDataFrame(rows, SCHEMA).repartition(5), rows, files)


def test_repeated_ids_rows_and_nulls(spark, tmp_path):
    """A third of the rows has one key and many are equal: files are full all the same, and no row is lost."""
    rows = some_rows(200) + [(7, 1, "web", None, "n", "e", "c", 1, "s", 1.0)] * 150 + [(None, 2, None, None, None, None, None, None, None, float("nan"))] * 3
    spark.createDataFrame(rows, SCHEMA).repartition(6).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    got = M.migrate_clients(spark, df, files=20).collect()
    per = 1 + len(rows) // 20
    assert [r.n_rows for r in sorted(got)] == [min(per, len(rows) - i * per) for i in range(len(got))]
    ids = []
    for r in sorted(got):
        ids += pq.read_table(r.path.removeprefix("file://"))["client_id"].to_pylist()
    assert ids == sorted((r[0] for r in rows), key=lambda i: (1 << 32, 0) if i is None else (zlib.crc32(str(i).encode()), i))
    assert [r.rows_sha256 for r in sorted(M.migrate_clients(spark, df, files=20).collect())] == [r.rows_sha256 for r in sorted(got)]


@pytest.mark.parametrize("bits", range(16))
def test_every_chain_reaches_the_evolved_schema(bits):
    held, schema = M.drifted(TARGET, bits, M.SWAPPED, M.LEFT_OUT, M.NARROW)
    assert M.drift(schema, TARGET) == bits
    batch = pa.RecordBatch.from_arrays([pa.nulls(3, f.type) for f in schema], schema=schema)
    (out,) = M.migrated(iter([batch]), bits, TARGET, M.DEFAULTS)
    assert out.schema.equals(TARGET) and out.num_rows == 3
    assert out.column("city").to_pylist() == (["none"] * 3 if bits & 4 else [None] * 3)


def test_the_chain_is_lazy():
    read = []

    def batches():
        for i in range(3):
            read.append(i)
            yield pa.RecordBatch.from_arrays([pa.nulls(1, f.type) for f in schema], schema=schema)

    held, schema = M.drifted(TARGET, 15, M.SWAPPED, M.LEFT_OUT, M.NARROW)
    chain = M.migrated(batches(), 15, TARGET, M.DEFAULTS)
    assert read == []
    next(chain)
    assert read == [0]


def test_what_no_chain_mends_is_an_error():
    field = lambda n, t, i: pa.field(n, t, True, {b"PARQUET:field_id": str(i).encode()})
    for schema in ([pa.field("client_id", pa.int64())], [field("x", pa.int64(), 99)], [field("client_id", pa.string(), 1)]):
        with pytest.raises(M.Unreadable):
            M.drift(pa.schema(schema), TARGET)


def test_odd_numbers_are_written():
    f = pa.field("balance", pa.float64())
    got = M._written(pa.array([1.5, None, float("nan"), float("inf"), 1e300]), f).to_pylist()
    assert got == [str(3 * 524288), "?", "nan", "inf", str(math.floor(1e300 * 1048576))]
    assert M._written(pa.array([-0.3, None]), f).to_pylist() == [str(math.floor(-0.3 * 1048576)), "?"]


def test_a_rewrite_that_runs_again_finds_its_input(spark, tmp_path):
    """The old files go only after all new ones are written, so a repeated step gives the same."""
    folder = tmp_path / "f"
    folder.mkdir()
    held, schema = M.drifted(TARGET, 9, M.SWAPPED, M.LEFT_OUT, M.NARROW)
    for i in range(3):
        s = TARGET if i == 0 else schema
        pq.write_table(pa.Table.from_arrays([pa.nulls(i + 1, f.type) for f in s], schema=s), folder / f"a{i}.parquet")
    files = spark.createDataFrame([(f"{folder}/a{i}.parquet",) for i in range(3)], "path string")
    got = sorted(map(tuple, M.rewrite(files, TARGET, M.DEFAULTS).select("drift", "path", "rewritten").collect()))
    assert got == [(0, f"{folder}/a0.parquet", False), (9, f"{folder}/a1-evolved.parquet", True), (9, f"{folder}/a2-evolved.parquet", True)]
    again = spark.createDataFrame([(p,) for _, p, _ in got], "path string")
    assert [r.drift for r in M.rewrite(again, TARGET, M.DEFAULTS).collect()] == [0, 0, 0]


@pytest.mark.parametrize("parts, groups", [(1, 1024), (40, 8), (1000, 4), (7, 1)])
def test_rows_before_a_part(spark, parts, groups):
    sizes = [(i * 37) % 11 + 1 for i in range(parts)]
    df = spark.createDataFrame(list(enumerate(sizes)), "part long, n long")
    got = {r.part: (r.n, r.before) for r in M._before(df, groups).collect()}
    assert got == {i: (n, sum(sizes[:i])) for i, n in enumerate(sizes)}
    assert M._before(df.limit(0)).count() == 0
