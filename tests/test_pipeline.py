import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from lectern.plans import course
from lectern.plans.pipeline import Pipeline, available, from_name
from lectern.schema import METADATA_FIELDS, as_resources
from lectern.sinks.base import DummySink
from lectern.sinks.content_metadata import ContentMetadataSink
from lectern.sources.base import Table
from lectern.sources.config import read_env
from lectern.sources.files import content_hash, data_url, read_binary, read_text
from lectern.streaming.arrivals import stream_links


def dump(root):
    files = {
        "8 - 9 Oct": ("File_1", "hw.pdf", b"# Exercise 1\ntext\f# Solution 1\nsolved", "Homework 1 (File)"),
        "15 - 16 Oct": ("File_2", "z.zip", None, "Problems (File)"),
        "Lecture notes": ("File_3", "n.pdf", b"notes", "Chapter 2024 (File)"),
    }
    index = ""
    for section, (folder, file, data, title) in files.items():
        (root / folder / "content").mkdir(parents=True)
        if data is None:
            b = io.BytesIO()
            with zipfile.ZipFile(b, "w") as z:
                z.writestr("x/nb.ipynb", json.dumps({"nbformat": 4, "metadata": {}, "cells": [{"cell_type": "markdown", "source": "## Problem 7\ndo"}]}))
                z.writestr("__MACOSX/x.pdf", b"")
            data = b.getvalue()
        (root / folder / "content" / file).write_bytes(data)
        (root / folder / "p.html").write_text(f'<main><a href="https://lms/{folder}">l</a><a href="content/{file}">c</a></main>')
        index += f'<h3>{section}</h3><div><a href="./{folder}/p.html">{title}</a></div>'
    (root / "index.html").write_text(index)


def test_course_end_to_end(spark, tmp_path):
    out = tmp_path / "course"
    dump(out / "lms")
    info = {"course_title": "Té", "semester": 1}
    pipeline = from_name("course", dump=str(out / "lms"), output=str(out), info=info, lms_prefix="https://lms")
    df = pipeline.run(spark)
    titles = [r.title for r in df.orderBy("ord").collect()]
    assert titles == ["Homework 1 > Exercise 1", "Problems > nb.ipynb > Exercise 7", "Chapter 2024"]
    raw = (out / "metadata" / "moodle.json").read_text(encoding="utf-8")
    meta = json.loads(raw)
    assert raw == json.dumps(meta, ensure_ascii=False, indent=2) and meta["course_info"] == info
    docs = meta["documents"]
    assert [list(d) for d in docs] == [[n.rstrip("_") for n in METADATA_FIELDS]] * 3
    assert [d["title"] for d in docs] == titles
    assert docs[0]["number"] == "5" and docs[0]["sub_number"] == "1" and docs[0]["from"] == "2025-10-08T00:00:00.000000" and docs[0]["until"] is None
    assert docs[2]["processing_method"] == "google" and docs[2]["number"] == "2024"
    for d in docs:
        assert (out / d["path"]).exists(), d["path"]
    assert (out / docs[0]["path"]).read_text() == "# Solution 1\nsolved"
    assert (out / docs[2]["path"]).read_bytes() == b"notes"


def some(spark, n, source):
    return as_resources(spark.range(n), title=F.concat(F.lit("t"), "id"), source=F.lit(source), url=F.lit("u"), path=F.concat(F.lit("/base/f"), "id"),
                        ord=F.array(F.col("id").cast("int")), text=F.lit("x"))


def test_every_sink_sees_the_same_rows(spark, tmp_path):
    some(spark, 3, "mooc.v2").write.parquet(str(tmp_path / "a"))
    some(spark, 2, "b").createOrReplaceTempView("lectern_b")
    sinks = tuple(ContentMetadataSink(str(tmp_path / o), {}, base="/base") for o in ("one", "two"))
    p = Pipeline("p", (Table(parquet=str(tmp_path / "a")), Table("lectern_b"), Table("lectern_b")), (lambda d: d.where("id > 0"),), (*sinks, DummySink()))
    p.run(spark)
    for o in ("one", "two"):
        assert len(json.loads((tmp_path / o / "metadata" / "mooc.json").read_text())["documents"]) == 2
        docs = json.loads((tmp_path / o / "metadata" / "b.json").read_text())["documents"]
        assert [d["title"] for d in docs] == ["t1", "t1"] and docs[0]["path"] == "content/f1"
        assert (tmp_path / o / "content" / "f1").read_text() == "x"


def test_registry(spark):
    assert "course" in available() and course.__name__ == "course"
    with pytest.raises(ValueError, match="available: .*course"):
        from_name("nothing")
    p = Pipeline("p", (Table("lectern_c"),), (lambda d: d.drop("week"),))
    some(spark, 1, "c").createOrReplaceTempView("lectern_c")
    with pytest.raises(TypeError):
        p.transform(p.extract(spark))


def test_files(spark, tmp_path, monkeypatch):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.md").write_text("é", encoding="utf-8")
    (tmp_path / ".DS_Store").write_bytes(b"j")
    (tmp_path / "a" / "p.png").write_bytes(b"abc")
    files = read_binary(spark, str(tmp_path))
    got = {r.name: r for r in files.select("name", "mime_type", content_hash(F.col("content")).alias("h"), data_url(F.col("content"), F.col("mime_type")).alias("d")).collect()}
    assert set(got) == {"x.md", "p.png"} and got["p.png"].d == "data:image/png;base64,YWJj" and len(got["x.md"].h) == 64
    assert read_binary(spark, str(tmp_path), longest=2).count() == 1
    assert [r.text for r in read_text(spark, str(tmp_path)).collect()] == ["é"]
    with pytest.raises(Exception, match="unknown MIME"):
        files.select(data_url(F.col("content"), F.lit(None).cast("string"))).collect()
    env = tmp_path / ".env"
    env.write_text("A=1\n# B=2\nexport C='x y'\nD=z # note\n")
    monkeypatch.setenv("A", "over")
    assert read_env(env) == {"A": "over", "C": "x y", "D": "z"} and read_env(tmp_path / "none") == {}


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "i.html").write_text('<h3>S</h3><p><a href="./File_1/a.html">t</a></p>')
    q = stream_links(spark, str(tmp_path / "in")).writeStream.format("memory").queryName("lectern_arrivals").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "ck")).start()
    q.awaitTermination()
    assert [(r.section_title, r.url) for r in spark.table("lectern_arrivals").collect()] == [("S", "./File_1/a.html")]
