"""The standard course over hand-made dumps: paths that do not meet, calls that are made once, settings and clients."""

import io
import json
import mimetypes
import sys
import threading
import types
import uuid
import zipfile
from http.server import BaseHTTPRequestHandler, HTTPServer
from pathlib import Path

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from lectern.functions import paths as P
from lectern.models import ModelError, RemoteClient, StandIn
from lectern.operators import archives
from lectern.operators.archives import archived, entries, expand_archives
from lectern.operators.pdfs import LARGEST, library_pages
from lectern.plans import course
from lectern.schema import as_resources
from lectern.sinks.content_metadata import ContentMetadataSink, file_names
from lectern.sinks.course_files import read_manifest
from lectern.sources.course_dump import read_dump


def zipped(files):
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        for name, data in files.items():
            z.writestr(name, data)
    return b.getvalue()


def notebook(source):
    return json.dumps({"nbformat": 4, "metadata": {}, "cells": [{"cell_type": "markdown", "source": source}]})


def dump(root, files, section="8 - 9 Oct"):
    """``files``: (folder, name, bytes, title); several may lie in one folder."""
    index = f"<h3>{section}</h3><div>"
    for i, (folder, name, data, title) in enumerate(files):
        (root / folder / "content").mkdir(parents=True, exist_ok=True)
        (root / folder / "content" / name).write_bytes(data)
        (root / folder / f"p{i}.html").write_text(f'<main><a href="content/{name}">c</a></main>')
        index += f'<a href="./{folder}/p{i}.html">{title} (File)</a>'
    (root / "index.html").write_text(index + "</div>")


def documents(out):
    return json.loads((out / "metadata" / "moodle.json").read_text(encoding="utf-8"))["documents"]


class Counting(StandIn):
    """Leaves a file for each call."""

    def __init__(self, folder):
        object.__setattr__(self, "folder", str(folder))
        object.__setattr__(self, "name", "counting")

    def _mark(self, what):
        (Path(self.folder) / f"{what}-{uuid.uuid4().hex}").touch()

    def calls(self):
        return sorted(p.name.split("-")[0] for p in Path(self.folder).iterdir())

    def transcribe(self, page):
        self._mark("page")
        return super().transcribe(page)

    def stitch(self, pages):
        self._mark("stitch")
        return super().stitch(pages)

    def split(self, text):
        self._mark("split")
        return super().split(text)

    def describe(self, image, mime_type):
        self._mark("image")
        return super().describe(image, mime_type)


SHEET = b"# Exercise 1\n%s\n# Exercise 2\n%s"


def test_every_document_has_its_own_file(spark, tmp_path):
    out = tmp_path / "course"
    dump(out / "lms", [
        ("File_1", "a.pdf", SHEET % (b"one", b"two"), "Homework A"), ("File_1", "b.pdf", SHEET % (b"three", b"four"), "Homework B"),
        ("File_1", "c.md", SHEET % (b"five", b"six"), "Homework C"),
        ("File_1", "a.ipynb", notebook("# Exercise 1\nseven").encode(), "Homework D"),
        ("File_1", "y.zip", zipped({"n.ipynb": notebook("# Exercise 1\neight")}), "Homework E"),
        ("File_1", "z.zip", zipped({"n.ipynb": notebook("# Exercise 1\nnine"), "../../../escaped.ipynb": notebook("# Exercise 1\nten"), "/etc/x.ipynb": notebook("# Exercise 1\neleven")}), "Homework F"),
    ])
    course(dump=str(out / "lms"), output=str(out), info={}, lms_prefix="https://lms").run(spark)
    docs = documents(out)
    texts = {d["title"]: (out / d["path"]).read_text().split("\n")[-1] for d in docs}
    assert len({d["path"] for d in docs}) == len(docs) == 11
    assert sorted(texts.values()) == sorted("one two three four five six seven eight nine ten eleven".split())
    assert texts["Homework B > Exercise 2"] == "four" and texts["Homework E > n.ipynb > Exercise 1"] == "eight"
    assert not list(tmp_path.glob("*.ipynb*")) and not [p for p in tmp_path.rglob("escaped*") if "content" not in p.parts]


def test_models_are_called_once_and_not_again_with_a_cache(spark, tmp_path):
    out = tmp_path / "course"
    book = notebook("![own](i/x.png) <img src='q'> ![w](y.webp) ![u](z.blob) ![](gone.png)\n# Exercise 1\nt")
    dump(out / "lms", [
        ("File_1", "a.pdf", b"# Exercise 1\np\fq", "Homework A"), ("File_2", "b.pdf", b"# Exercise 1\np\fq", "Homework B"),
        ("File_3", "z.zip", zipped({"n.ipynb": book, "i/x.png": b"12345", "y.webp": b"123", "z.blob": b"1"}), "Homework C"),
    ])
    (tmp_path / "calls").mkdir()
    client = Counting(tmp_path / "calls")
    make = lambda: course(dump=str(out / "lms"), output=str(out), info={}, lms_prefix="https://lms", client=client, cache=str(tmp_path / "cache"))
    first = make().run(spark)
    want = ["image", "image", "page", "page", "split", "split", "stitch"]
    assert client.calls() == want
    first.count()
    assert client.calls() == want
    before = documents(out)
    assert [r.title for r in make().run(spark).orderBy("ord").collect()] == [d["title"] for d in before] and documents(out) == before
    assert client.calls() == want
    # the images stand before the first heading, so the sheet itself is looked at
    rows = make().stages[1](make().stages[0](make().extract(spark)))
    text = rows.where("path LIKE '%n.ipynb.md'").first().text
    assert "![png image of 5 bytes](i/x.png)" in text and "![webp image of 3 bytes](y.webp)" in text and "![u](z.blob)" in text and "![](gone.png)" in text
    assert client.calls() == want


@pytest.mark.parametrize("cached", [False, True])
def test_each_archive_is_opened_twice_a_run(spark, tmp_path, monkeypatch, cached):
    """Once for its directory and once for its entries, documents and images together, however many stages follow."""
    out, opened = tmp_path / "course", tmp_path / "opened"
    opened.mkdir()
    book = notebook("![own](i.PNG)\n# Exercise 1\nt")
    dump(out / "lms", [("File_1", f"z{i}.zip", zipped({"n.ipynb": book, "a.pdf": f"# Exercise 1\np{i}", "i.PNG": "12345"}), "Homework") for i in range(3)])
    real = archives.open_store

    def counting(uri):
        (opened / f"{uri.rsplit('/', 1)[1]}-{uuid.uuid4().hex}").touch()
        return real(uri)

    monkeypatch.setattr(archives, "open_store", counting)
    # the functions that tasks run must carry the counting one, so they go by value
    cloudpickle.register_pickle_by_value(archives)
    try:
        rows = course(dump=str(out / "lms"), output=str(out), info={}, lms_prefix="https://lms", cache=str(tmp_path / "cache") if cached else None).run(spark)
    finally:
        cloudpickle.unregister_pickle_by_value(archives)
    assert rows.where("path LIKE '%n.ipynb%'").count() == 3 and rows.where("path LIKE '%a.pdf%'").count() == 3
    names = [p.name.split("-")[0] for p in opened.iterdir()]
    assert sorted(names) == sorted(["z0.zip", "z1.zip", "z2.zip"] * 2)


def test_a_damaged_archive_does_not_stop_the_course(spark, tmp_path):
    out = tmp_path / "course"
    dump(out / "lms", [("File_1", "bad.zip", b"PK no", "Broken"), ("File_2", "a.md", SHEET % (b"one", b"two"), "Homework A")])
    rows, report = course(dump=str(out / "lms"), output=str(out), info={}, lms_prefix="https://lms").report(spark)
    assert [d["title"] for d in documents(out)] == ["Homework A > Exercise 1", "Homework A > Exercise 2"]
    (failed,) = read_manifest(spark, str(out)).where("kind = 'failure'").collect()
    assert failed.path.endswith("bad.zip") and "BadZipFile" in failed.reason
    counts = {r.name: (r.rows, r.errors) for r in report.collect()}
    assert counts == {"sources": (2, 0), "infer_metadata": (2, 0), "described_notebooks": (2, 1), "pdfs_to_markdown": (2, 1), "split_exercises": (3, 1)}


def test_deeper_pages_and_odd_names(spark, tmp_path):
    dump(tmp_path, [("File_1", "a+b c.pdf", b"x", "T")])
    deep = tmp_path / "File_1" / "content" / "File_1"
    deep.mkdir()
    (deep / "p0.html").write_text('<main><a href="content/wrong.pdf">c</a></main>')
    got = read_dump(spark, str(tmp_path), "https://lms").collect()
    assert [(r.title, r.path) for r in got] == [("T", f"{tmp_path}/File_1/content/a+b c.pdf")]


def test_clashes_are_errors(spark, tmp_path):
    rows = spark.createDataFrame([("a", "/base/x", "1"), ("a", "/base/x", "1"), ("b", "/base/y", "2")], "source string, path string, text string")
    res = as_resources(rows, title=F.lit("t"), url=F.lit("u"))
    ContentMetadataSink(str(tmp_path / "o"), {}, base="/base").load(res)
    assert (tmp_path / "o" / "content" / "x").read_text() == "1"
    with pytest.raises(ValueError, match="content/x"):
        ContentMetadataSink(str(tmp_path / "p"), {}, base="/base").load(res.unionByName(res.withColumn("text", F.lit("other"))))
    assert not (tmp_path / "p").exists()
    with pytest.raises(Exception, match="is not below"):
        ContentMetadataSink(str(tmp_path / "q"), {}, base="/base").load(res.withColumn("path", F.lit("/base/../x")))


def test_sources_keep_files_of_their_own(spark, tmp_path):
    assert file_names(["mooc.v2", "b"]) == {"mooc.v2": "mooc.json", "b": "b.json"}
    assert file_names(["mooc.v1", "mooc.v2", "mooc.v1.x"]) == {s: f"{s}.json" for s in ("mooc.v1", "mooc.v2", "mooc.v1.x")}
    with pytest.raises(ValueError, match="meet"):
        file_names(["a/b.1", "a_b.1", "b.1"])
    rows = spark.createDataFrame([("mooc.v1", "/base/x"), ("mooc.v2", "/base/y")], "source string, path string")
    ContentMetadataSink(str(tmp_path), {}, base="/base").load(as_resources(rows, title=F.col("source"), url=F.lit("u"), text=F.lit("t")))
    for s in ("mooc.v1", "mooc.v2"):
        assert [d["title"] for d in json.loads((tmp_path / "metadata" / f"{s}.json").read_text())["documents"]] == [s]


def test_archive_entries_stay_inside(spark):
    data = zipped({"../../up.pdf": "1", "/abs.pdf": "2", "C:\\w\\in.pdf": "3", "a/./b.pdf": "4", "..": "5"})
    rows = spark.createDataFrame([("t", "/d/z.zip", P.ZIP, data)], "title string, path string, mime_type string, content binary")
    res = as_resources(rows, source=F.lit("s"), url=F.lit("u"))
    assert sorted(r.path for r in expand_archives(res, [P.PDF]).collect()) == ["/d/a/b.pdf", "/d/abs.pdf", "/d/up.pdf", "/d/w/in.pdf"]
    assert sorted(r.path for r in archived(res, own_folder=True).where("path LIKE '%up%'").collect()) == ["/d/z.zip/up.pdf"]
    assert entries(res.select(F.col("path").alias("key"), "content")).where("path LIKE '%..%'").count() == 0


def test_types_agree_with_their_column_form(spark):
    names = ["a.PDF", "a.tar.gz", "noext", ".hidden", "dir.v/x", "a.b.ipynb", "x.", "é.md", "y.webp", "f.tgz.bz2", "..md", "a.gz", ".tar.gz", "c.epub"]
    df = spark.createDataFrame([(n,) for n in names], "p string")
    got = df.select("p", P.guess_mime_type(F.col("p")).alias("m"), P.is_junk(F.col("p")).alias("j")).collect()
    assert [r.m for r in got] == [P.mime_type_of(r.p) for r in got] and [r.j for r in got] == [P.of_junk(r.p) for r in got]
    # endings of the standard library's table, whatever their case
    known = mimetypes.MimeTypes(())
    for ending, kind in known.types_map[True].items():
        assert P.MIME_TYPES[ending] == kind or ending in P._OWN_TYPES
    assert P.mime_type_of("a.TIF") == "image/tiff" and P.mime_type_of("a.svgz") == "image/svg+xml" and P.mime_type_of("b.txz") == "application/x-tar"


class Endpoint(BaseHTTPRequestHandler):
    """Fails once for each new message, then answers by what it was asked."""

    seen: list = []
    auth: set = set()

    def do_POST(self):
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        Endpoint.auth.add(self.headers.get("Authorization"))
        key = json.dumps(body)
        first = key not in Endpoint.seen
        Endpoint.seen.append(key)
        content = body["messages"][0]["content"]
        if "forbidden" in key:
            return self.reply(403, {"error": "no"})
        if first:
            return self.reply(503, {"error": "busy"})
        if "response_format" in body:
            text = '{"exercises": [{"snippet": "s", "number": "1", "is_solution": true}]}' if "good" in content else "not json"
        else:
            text = " " + (content if isinstance(content, str) else content[1]["image_url"]["url"]) + "\n"
        self.reply(200, {"choices": [{"message": {"content": text}}]})

    def reply(self, code, body):
        data = json.dumps(body).encode()
        self.send_response(code)
        self.send_header("Content-Length", str(len(data)))
        self.end_headers()
        self.wfile.write(data)

    def log_message(self, *args):
        pass


def test_remote_client(spark, tmp_path):
    server = HTTPServer(("127.0.0.1", 0), Endpoint)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        env = tmp_path / ".env"
        env.write_text(f"MODEL_BASE_URL=http://127.0.0.1:{server.server_port}/v1\nMODEL_NAME=m\nMODEL_API_KEY='k'\nCACHE_DIR={tmp_path / 'cache'}\n")
        from lectern.sources.config import read_env

        client = RemoteClient.from_settings(read_env(env), pause=0.01)
        assert client.describe(b"abc", "image/webp") == "data:image/webp;base64,YWJj"
        assert client.transcribe(b"abc") == "data:image/png;base64,YWJj"
        assert client.stitch(["a", "b"]).endswith("```\na\n```\n\n```\nb\n```")
        assert client.split("good") == [{"snippet": "s", "number": "1", "is_solution": True}]
        with pytest.raises(ModelError, match="form"):
            client.split("bad")
        with pytest.raises(ModelError, match="403"):
            client.stitch(["forbidden"])
        assert Endpoint.auth == {"Bearer k"}
        with pytest.raises(ValueError, match="MODEL_NAME"):
            RemoteClient.from_settings({"MODEL_BASE_URL": "x"})
        # in a course, by settings alone
        out = tmp_path / "course"
        dump(out / "lms", [("File_1", "a.md", b"good", "Homework A")])
        course(dump=str(out / "lms"), output=str(out), info={}, lms_prefix="https://lms", settings=str(env)).run(spark)
        assert [d["title"] for d in documents(out)] == ["Homework A > Exercise 1"] and (tmp_path / "cache").exists()
    finally:
        server.shutdown()
    with pytest.raises(ModelError, match="no reply"):
        RemoteClient("m", f"http://127.0.0.1:{server.server_port}", tries=2, pause=0.01, timeout=1).stitch([])


def test_library_renderer(monkeypatch):
    """Pages come at their size, scaled down where they are too large."""
    asked = []

    class Page:
        def __init__(self, w, h):
            self.rect = types.SimpleNamespace(width=w, height=h)

        def get_pixmap(self, matrix, alpha):
            asked.append((round(self.rect.width * matrix[0]), round(self.rect.height * matrix[1])))
            return types.SimpleNamespace(tobytes=lambda kind: kind.encode())

    class Book(list):
        __enter__ = lambda self: self
        __exit__ = lambda self, *a: None

    fake = types.SimpleNamespace(open=lambda stream, filetype: Book([Page(600, 800), Page(4096, 3072), Page(1000, 6144)]), Matrix=lambda a, b: (a, b))
    monkeypatch.setitem(sys.modules, "pymupdf", fake)
    assert list(library_pages(b"x")) == [b"png"] * 3
    assert asked == [(600, 800), (2048, 1536), (500, 3072)] and all(w <= LARGEST[0] and h <= LARGEST[1] for w, h in asked)
