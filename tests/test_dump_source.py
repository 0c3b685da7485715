"""The dump as a data source: batches and streams give the rows of read_dump, and filters on folders keep pages closed."""

import json

import pytest
from pyspark.sql import functions as F

from lectern.sources.course_dump import read_dump
from lectern.sources.dump_source import dump_resources, register_dump

LMS = "https://lms"
COLUMNS = ["title", "source", "url", "path", "mime_type", "kind", "section_title", "section_text", "ord"]


def make(root, n, hole=None):
    index = ""
    for i in range(n):
        folder = f"File_{i % 3}" if i % 4 else f"Quiz_{i % 3}"
        (root / folder).mkdir(exist_ok=True)
        lms = f'<a href="{LMS}/r/{i}">p</a>' if i % 2 else ""
        (root / folder / f"p{i}.html").write_text(f'<html><main><a href="content/old.md">o</a><a href="content/f{i}.PDF">c</a>{lms}</main>')
        if hole == i:
            (root / folder / f"p{i}.html").unlink()
        index += f'<h3>Section <b>{i}</b></h3><div>text {i} <a href="./{folder}/p{i}.html">T{i} ({folder[:4]})</a><a href="https://else/{i}">x</a></div>'
    (root / "index.html").write_text(index)


def read(spark, root, **options):
    register_dump(spark)
    return spark.read.format("course_dump").options(path=str(root), lms_prefix=LMS, **options).load()


def rows(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


@pytest.mark.parametrize("prefixes", [("./File",), ("./File", "./Quiz"), ("./", "https://else"), ("nothing",)])
def test_batches_equal_read_dump(spark, tmp_path, prefixes):
    make(tmp_path, 11)
    got = dump_resources(read(spark, tmp_path, prefixes=json.dumps(prefixes), pages_per_task=2))
    if any(p.startswith("https") for p in prefixes):
        got = got.where("path IS NOT NULL")
        want = read_dump(spark, str(tmp_path), LMS, prefixes).where("path IS NOT NULL")
    else:
        want = read_dump(spark, str(tmp_path), LMS, prefixes)
    assert rows(got) == rows(want)


def test_missing_pages(spark, tmp_path):
    make(tmp_path, 6, hole=2)
    with pytest.raises(Exception, match="no page or content link"):
        read(spark, tmp_path).collect()
    loose = read(spark, tmp_path, strict="false")
    assert rows(dump_resources(loose)) == rows(read_dump(spark, str(tmp_path), LMS, strict=False))
    with pytest.raises(Exception, match="lms_prefix"):
        spark.read.format("course_dump").load(str(tmp_path)).collect()


def test_filters_on_folders_open_no_other_page(spark, tmp_path):
    make(tmp_path, 12)
    whole = [r.title for r in read(spark, tmp_path).where("folder = 'File_1'").collect()]
    for p in (tmp_path / "File_2").iterdir():
        p.unlink()  # a page that is opened all the same would be an error
    for cond in ("folder = 'File_1'", "folder IN ('File_1', 'None')", "startswith(folder, 'File_1')"):
        assert sorted(r.title for r in read(spark, tmp_path).where(cond).where(F.length("title") > 0).collect()) == sorted(whole) and whole
    with pytest.raises(Exception, match="no page"):
        read(spark, tmp_path).where("title <> 'x'").collect()


def test_a_stream_gives_new_links_once(spark, tmp_path):
    dump = tmp_path / "dump"
    dump.mkdir()
    register_dump(spark)

    def run():
        stream = dump_resources(spark.readStream.format("course_dump").options(path=str(dump), lms_prefix=LMS).load())
        q = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(once=True).start()
        q.awaitTermination()
        return rows(spark.read.parquet(str(tmp_path / "out")))

    make(dump, 5)
    assert run() == rows(read_dump(spark, str(dump), LMS))
    assert run() == rows(read_dump(spark, str(dump), LMS))
    make(dump, 9)
    assert run() == rows(read_dump(spark, str(dump), LMS))
