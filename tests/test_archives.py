"""Archives read by range: directories first, each entry's bytes by a task of its own, damage as rows."""

import io
import random
import zipfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lectern.functions import paths as P
from lectern.operators import archives as A
from lectern.schema import ERROR, as_resources


def zipped(files, kind=zipfile.ZIP_DEFLATED):
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w", kind) as z:
        for name, data in files:
            z.writestr(name, data)
    return b.getvalue()


def rows_of(spark, folder, archives, in_cells):
    rows = []
    for i, (name, data) in enumerate(archives.items()):
        (folder / name).write_bytes(data)
        rows.append((name, f"{folder}/{name}", P.ZIP, data if in_cells else None, [i]))
    rows.append(("other", f"{folder}/o.md", P.MARKDOWN, None, [99]))
    return as_resources(spark.createDataFrame(rows, "title string, path string, mime_type string, content binary, ord array<int>"), source=F.lit("s"), url=F.lit("u"))


def both(spark, folder, archives, types=None):
    """The same archives from cells and from files."""
    (folder / "x").mkdir()
    found = [A.expand_archives(rows_of(spark, folder / "x", archives, True), types), A.expand_archive_files(rows_of(spark, folder / "x", archives, False), types)]
    out = [sorted((r.title, r.path, r.mime_type, r.kind, bytes(r.content) if r.content is not None else None, r.ord) for r in df.collect()) if not any(
        r.kind == ERROR for r in df.collect()) else df.orderBy("path", "title").collect() for df in found]
    return out


@pytest.mark.filterwarnings("ignore:Duplicate name")
def test_both_ways_give_the_same_and_the_last_entry_counts(spark, tmp_path):
    rng = random.Random(1)
    many = [(f"d{i % 7}/f{i}.pdf", rng.randbytes(i * 37)) for i in range(200)]
    archives = {
        "a.zip": zipped([("x.pdf", b"old"), ("y.pdf", b"y"), ("x.pdf", b"new"), ("../y.pdf", b"up"), ("e.pdf", b""), ("__MACOSX/j.pdf", b"j")]),
        "b.zip": zipped(many), "s.zip": zipped(many[:9], zipfile.ZIP_STORED), "z2.zip": zipped(many[:9], zipfile.ZIP_BZIP2), "none.zip": zipped([]),
    }
    cells, files = both(spark, tmp_path, archives)
    assert cells == files and len(cells) == 3 + 200 + 9 + 9 + 1
    own = {r[0]: r[4] for r in files if r[0].startswith("a.zip")}
    assert own == {"a.zip > x.pdf": b"new", "a.zip > y.pdf": b"up", "a.zip > e.pdf": b""}


def test_damage_is_a_row_and_the_rest_is_read(spark, tmp_path):
    good = zipped([("a.pdf", b"A" * 100), ("b.pdf", b"B" * 100)], zipfile.ZIP_STORED)
    hurt = good.replace(b"B" * 100, b"B" * 99 + b"x")  # its checksum is another's
    for found in both(spark, tmp_path, {"bad.zip": b"no archive", "cut.zip": good[:80], "hurt.zip": hurt, "good.zip": good}):
        assert sorted((r.title, r.kind) for r in found) == [
            ("bad.zip", ERROR), ("cut.zip", ERROR), ("good.zip > a.pdf", None), ("good.zip > b.pdf", None), ("hurt.zip > a.pdf", None), ("hurt.zip > b.pdf", ERROR), ("other", None)]
        for r in found:
            assert (r.kind == ERROR) == bool(r.section_text) and (r.kind != ERROR or (r.content is None and r.mime_type is None))


def test_an_archive_is_read_by_many_tasks_and_never_whole(spark, tmp_path, monkeypatch):
    rng = random.Random(2)
    data = zipped([(f"f{i}.pdf", rng.randbytes(50_000)) for i in range(60)])
    df = A.list_archive_files(rows_of(spark, tmp_path, {"a.zip": data}, False), [P.PDF])
    read = A.read_archive_files(df, stretch=1 << 18).where("mime_type = 'application/pdf'")
    tasks = {r.p: r.n for r in read.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
    assert len(tasks) > 1 and sum(tasks.values()) == 60
    assert A.read_archive_files(df).where("mime_type = 'application/pdf'").select(F.spark_partition_id()).distinct().count() == 1
    # the bytes that are asked for: the directory, and for an entry its header and its own range
    asked = Counter()

    class Seen(io.FileIO):
        def read(self, n=-1):
            out = super().read(n)
            asked["bytes"] += len(out)
            return out

    (tmp_path / "a.zip").write_bytes(data)
    with Seen(str(tmp_path / "a.zip")) as f, zipfile.ZipFile(f) as z:
        e = A.kept_entries(z)[30][2]
        assert asked["bytes"] < 100_000
        asked.clear()
        assert len(A.read_entry(f, e.header_offset, e.compress_size, e.file_size, e.compress_type, e.CRC)) == 50_000
        assert asked["bytes"] < 51_000


def test_batches_are_gathered(spark, monkeypatch):
    batch = A.pa.RecordBatch.from_pydict({"title": ["a"], "content": [None]}, schema=A.pa.schema([("title", A.pa.string()), ("content", A.pa.binary())]))
    made = A._Gathered(batch, ["content"])
    out = [b for i in range(2500) for b in made.add(0, content=b"x")] + list(made.done())
    assert [b.num_rows for b in out] == [1000, 1000, 500]
    monkeypatch.setattr(A, "GATHERED", 10)
    assert [b.num_rows for i in range(3) for b in made.add(0, content=b"12345")] == [2]
