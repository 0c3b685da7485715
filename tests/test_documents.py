import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from lectern.functions import paths as P
from lectern.models.client import StandIn
from lectern.operators.archives import entries, expand_archives
from lectern.operators.cache import Cache
from lectern.operators.exercises import dedup_exercises, files_of, parse_reply, split_exercises, unique_exercises
from lectern.operators.notebooks import describe_images, images_rewritten, markdown_of, notebooks_to_markdown
from lectern.operators.pdfs import clamped, fenced, pdfs_to_markdown, png_data_url
from lectern.schema import as_resources, check_schema


def resources(spark, rows):
    """rows: (title, path, mime type, content, text, type, subtype)."""
    kinds = "title string, path string, mime_type string, content binary, text string, type string, subtype string, ord array<int>"
    df = spark.createDataFrame([(*r, *[None] * (7 - len(r)), [i]) for i, r in enumerate(rows)], kinds)
    return as_resources(df, source=F.lit("s"), url=F.col("path"))


def zipped(files):
    b = io.BytesIO()
    with zipfile.ZipFile(b, "w") as z:
        for name, data in files.items():
            z.writestr(name, data)
    return b.getvalue()


def test_archives(spark):
    data = zipped({"__MACOSX/a.pdf": "j", "x/": "", "x/a.pdf": "A", "x/.DS_Store": "j", "b.ipynb": "B", ".ipynb_checkpoints/c.ipynb": "j", "d.txt": "D", "in.zip": "Z"})
    rows = resources(spark, [("t", "/d/z.zip", P.ZIP, data), ("none", "/d/e.zip", P.ZIP, zipped({"q.txt": "x"})), ("p", "/d/p.md", P.MARKDOWN), ("n", "/d/n", None)])
    got = check_schema(expand_archives(rows, [P.PDF, P.IPYNB])).orderBy("ord").collect()
    assert [(r.title, r.path, r.mime_type) for r in got] == [
        ("t > a.pdf", "/d/x/a.pdf", P.PDF), ("t > b.ipynb", "/d/b.ipynb", P.IPYNB), ("p", "/d/p.md", P.MARKDOWN), ("n", "/d/n", None)]
    assert bytes(got[0].content) == b"A" and got[0].url == "/d/z.zip"
    assert expand_archives(rows).count() == 7
    assert entries(rows.where("content IS NOT NULL").select(F.col("title").alias("key"), "content")).count() == 8


NOTEBOOK = {
    "nbformat": 4, "metadata": {"language_info": {"name": "julia"}},
    "cells": [
        {"cell_type": "markdown", "source": ["# T\n", "![a](i.png)"]},
        {"cell_type": "code", "source": "1+1", "outputs": [{"output_type": "execute_result", "data": {"text/plain": ["2"], "image/png": "xx"}}, {"output_type": "stream", "text": "a\nb\n"}]},
        {"cell_type": "raw", "source": "r"}, {"cell_type": "code", "source": "", "outputs": [{"output_type": "display_data", "data": {"image/png": "x"}}]},
    ],
}


def one(spark, value, kind, column):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column.alias("r")).first().r


def test_notebook_markdown(spark):
    read = lambda book: one(spark, json.dumps(book).encode() if isinstance(book, dict) else book, "binary", markdown_of(F.col("v")))
    assert read(NOTEBOOK) == "# T\n![a](i.png)\n\n```julia\n1+1\n```\n\n    2\n\n    a\n    b\n\nr\n\n```julia\n\n```\n"
    old = {"nbformat": 3, "worksheets": [{"cells": [{"cell_type": "heading", "level": 2, "source": "H"}, {"cell_type": "code", "input": "x", "outputs": [{"output_type": "pyout", "text": ["y"]}]}]}]}
    assert read(old) == "## H\n\n```python\nx\n```\n\n    y\n"
    # a source that looks like a list is a string, an error's lines are its traceback, a kernel names the language
    odd = {"nbformat": 4, "metadata": {"kernelspec": {"language": "R"}, "language_info": {"name": "x"}}, "cells": [
        {"cell_type": "markdown", "source": '["a", "b"]'}, {"cell_type": "markdown", "source": []}, {"cell_type": "heading", "source": "h"},
        {"cell_type": "code", "source": ["é\\n", "漢"], "outputs": [
            {"output_type": "error", "traceback": ["t1", "t2"]}, {"output_type": "display_data", "data": {"text/markdown": "*m*", "text/plain": "p"}}, {"output_type": "stream"}]},
    ]}
    assert read(odd) == '["a", "b"]\n\n\n\n# h\n\n```R\né\\n漢\n```\n\n    t1\n    t2\n\n    *m*\n'
    assert read({"cells": []}) == "\n" and read(None) is None and read(b"\xef\xbb\xbf" + json.dumps({"cells": [{"cell_type": "raw", "source": "r"}]}).encode()) == "r\n"
    with pytest.raises(Exception, match="(?i)malformed"):
        read(b"no notebook")


def test_images(spark):
    text = '![a](x.png) <IMG alt="b" src="y.png"> <img src="z.png"/> <img alt="q"> ![]()'
    rewritten = lambda t, alts=None: one(spark, t, "string", images_rewritten(F.col("v"), None if alts is None else F.create_map(*[F.lit(x) for kv in alts.items() for x in kv])))
    assert rewritten(text) == '![a](x.png) ![b](y.png) ![](z.png) <img alt="q"> ![]()'
    assert rewritten(text, {"x.png": "X", "z.png": "Z"}).startswith("![X](x.png) ![b](y.png) ![Z](z.png)")
    assert rewritten("$1 \\ ![a](x.png) end\n", {"x.png": "$2 \\1"}) == "$1 \\ ![$2 \\1](x.png) end\n" and rewritten("") == "" and rewritten("none") == "none"
    for odd in ("![a\u2028b](i.png)", "![a\rb](i.png)", "![a\x85b](i.png)"):  # no line feed, so one reference
        assert rewritten(odd, {"i.png": "I"}) == "![I](i.png)"
    assert rewritten("![a\nb](i.png)", {"i.png": "I"}) == "![a\nb](i.png)"
    assert rewritten('<img\u00a0src="i.png">') == "![](i.png)" and rewritten('![<img src="a.png">](b.png)', {"a.png": "A"}) == "![![A](a.png)](b.png)"
    docs = spark.createDataFrame([("/d/n/a.md", text.replace("x.png", "../i/x.png")), ("/d/b.md", "plain")], "path string, text string")
    files = spark.createDataFrame([("/d/i/x.png", b"123"), ("/d/n/y.png", b"4"), ("/d/other.png", b"5")], "path string, content binary")
    got = {r.path: r.text for r in describe_images(docs, files).collect()}
    assert got["/d/n/a.md"].startswith("![png image of 3 bytes](../i/x.png) ![png image of 1 bytes](y.png) ![](z.png)") and got["/d/b.md"] == "plain"


def test_where_references_lead(spark):
    cases = {("/d/n", "../i/x.png"): "/d/i/x.png", ("/d", "./a/./b.png"): "/d/a/b.png", ("/d", "../../x"): "/x", ("", "a/../b"): "b", ("", "../b"): "../b",
             ("d", "../../b"): "../b", ("/d", "/e/f.png"): "/e/f.png", ("file:///out/d", "../i.png"): "file:///out/i.png", ("/d", "https://h/x.png"): "https://h/x.png"}
    df = spark.createDataFrame(list(cases), "f string, s string")
    assert {(r.f, r.s): r.at for r in df.select("f", "s", P.resolved(F.col("f"), F.col("s")).alias("at")).collect()} == cases


def test_rows_of_one_path_keep_their_texts(spark):
    """Two notebooks of one path, a repeated one, and rows without a path."""
    book = lambda t: json.dumps({"cells": [{"cell_type": "markdown", "source": f"{t} ![own](i.png)"}]}).encode()
    rows = resources(spark, [("a", "/d/n.ipynb", P.IPYNB, book("one")), ("b", "/d/n.ipynb", P.IPYNB, book("two")), ("c", "/d/n.ipynb", P.IPYNB, book("two")), ("m", "/d/m.md", P.MARKDOWN, None, "m")])
    files = spark.createDataFrame([("/d/i.png", b"12"), ("/d/i.png", b"123")], "path string, content binary")
    got = notebooks_to_markdown(rows, files).orderBy("ord").collect()
    assert [r.text for r in got] == ["one ![png image of 2 bytes](i.png)\n", *["two ![png image of 2 bytes](i.png)\n"] * 2, "m"]
    free = spark.createDataFrame([(None, "x ![o](/d/i.png)"), (None, "y"), ("/d/p", None)], "path string, text string")
    assert sorted(map(tuple, describe_images(free, files).collect()), key=str) == sorted([(None, "x ![png image of 2 bytes](/d/i.png)"), (None, "y"), ("/d/p", None)], key=str)


def test_no_python_in_image_and_notebook_plans(spark):
    files = spark.createDataFrame([("/d/i.png", b"12")], "path string, content binary")
    rows = resources(spark, [("n", "/d/a.ipynb", P.IPYNB, json.dumps(NOTEBOOK).encode())])
    for df in (notebooks_to_markdown(rows, files), notebooks_to_markdown(rows)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan


def test_notebook_stage(spark):
    rows = resources(spark, [("n", "/d/a.b.ipynb", P.IPYNB, json.dumps(NOTEBOOK).encode()), ("m", "/d/m.md", P.MARKDOWN, None, "<img src=\"k\">"), ("x", "/d/x", None)])
    got = check_schema(notebooks_to_markdown(rows)).orderBy("ord").collect()
    assert [(r.path, r.mime_type) for r in got] == [("/d/a.b.md", P.MARKDOWN), ("/d/m.md", P.MARKDOWN), ("/d/x", None)]
    assert got[0].text.startswith("# T") and got[0].content is None and got[1].text == '<img src="k">'
    files = spark.createDataFrame([("/d/i.png", b"12")], "path string, content binary")
    assert "![png image of 2 bytes](i.png)" in notebooks_to_markdown(rows, files).orderBy("ord").first().text


class Counting(StandIn):
    """Leaves a file for each call."""

    def __init__(self, folder):
        object.__setattr__(self, "folder", str(folder))

    def _mark(self, what):
        import uuid
        from pathlib import Path

        (Path(self.folder) / f"{what}-{uuid.uuid4().hex}").touch()

    def transcribe(self, page):
        self._mark("page")
        return super().transcribe(page)

    def stitch(self, pages):
        self._mark("stitch")
        return super().stitch(pages)


def test_pdfs_call_the_model_once_a_page(spark, tmp_path):
    sheet = ("exam", "previous_year_exam")
    rows = resources(spark, [("a", "/d/a.pdf", P.PDF, b" one \ftwo\fthree", None, *sheet), ("b", "/d/b.pdf", P.PDF, b" one \ftwo\fthree", None, *sheet),
                             ("c", "/d/c.pdf", P.PDF, b"other", None, "theory", "x"), ("d", "/d/d.md", P.MARKDOWN, None, "t", *sheet), ("e", "/d/e", None)])
    out = check_schema(pdfs_to_markdown(rows, [sheet], Counting(tmp_path)))
    got = out.orderBy("ord").collect()
    out.count()
    assert [(r.path, r.text) for r in got[:2]] == [("/d/a.md", "one\n\ntwo\n\nthree"), ("/d/b.md", "one\n\ntwo\n\nthree")]
    assert [(r.path, r.mime_type) for r in got[2:]] == [("/d/c.pdf", P.PDF), ("/d/d.md", P.MARKDOWN), ("/d/e", None)]
    names = [p.name.split("-")[0] for p in tmp_path.iterdir()]
    assert names.count("page") == 3 and names.count("stitch") == 1
    with pytest.raises(Exception, match="without pages"):
        pdfs_to_markdown(resources(spark, [("z", "/z.pdf", P.PDF, b"")])).collect()


def test_page_helpers(spark):
    assert clamped(100, 100) == (100, 100) and clamped(4096, 3072) == (2048, 1536) and clamped(1000, 6144) == (500, 3072)
    assert png_data_url(b"a") == "data:image/png;base64,YQ=="
    df = spark.createDataFrame([(1, 1, "b"), (1, 0, "a")], "k int, page int, text string")
    assert fenced(df, ["k"]).first().document == "```\na\n```\n\n```\nb\n```"


SHEET = "preface\n# Exercise 1\ns1\n## Solution 1: x\nfirst\n## Solution 1\nlast\n# Problem 1.2\np\n# exercise 10.\nt\nexercise 3 no heading\n"


def test_split_and_dedup(spark):
    found = StandIn().split(SHEET)
    assert [(e["number"], e["is_solution"]) for e in found] == [("1", False), ("1", True), ("1", True), ("1.2", False), ("10", False)]
    reply = json.dumps({"exercises": [*found, {"snippet": "n", "number": "", "is_solution": False}]})
    df = spark.createDataFrame([(reply,)], "r string").select(parse_reply(F.col("r")).alias("e"))
    unique = df.select(unique_exercises(F.col("e")).alias("u")).first().u
    assert [(e.number, e.snippet.split("\n")[-1]) for e in unique] == [("1", "last"), ("1.2", "p"), ("10", "t\nexercise 3 no heading".split("\n")[-1])]
    flat = df.select(F.lit(7).alias("k"), F.posexplode("e").alias("pos", "e")).select("k", "pos", "e.*")
    table = dedup_exercises(flat, ["k"]).orderBy("first_pos").collect()
    assert [(r.number, r.snippet, r.is_solution) for r in table] == [(e.number, e.snippet, e.is_solution) for e in unique]


def test_split_stage(spark):
    hw = ("practice", "homework")
    rows = resources(spark, [("s", "/d/s.md", P.MARKDOWN, None, SHEET, *hw), ("none", "/d/n.md", P.MARKDOWN, None, "no headings", *hw),
                             ("pass", "/d/p.md", P.MARKDOWN, None, SHEET, "theory", "x"), ("pdf", "/d/q.pdf", P.PDF, None, None, *hw), ("nil", "/d/z", None)])
    got = check_schema(split_exercises(rows, [hw])).orderBy("ord").collect()
    assert [r.title for r in got] == ["s > Exercise 1.2", "s > Exercise 1", "s > Exercise 10", "pass", "pdf", "nil"]
    assert [r.path for r in got[:3]] == ["/d/exercises/1.2.md", "/d/exercises/1.md", "/d/exercises/10.md"]
    assert all(r.one_chunk_per_doc and not r.is_solution for r in got[:3]) and not got[3].one_chunk_per_doc
    old = split_exercises(rows.where("title = 's'"), None, legacy_suffix=True).orderBy("ord").collect()
    assert [(r.sub_number, r.text.split("\n")[0]) for r in old] == [("1", "# Problem 1.2"), ("10", "# exercise 10.")]
    assert split_exercises(rows, None).count() == 8


def test_cache(spark, tmp_path):
    cache = Cache(str(tmp_path / "c"))
    docs = spark.createDataFrame([("A", "x.md"), ("A", "y.md"), ("B", "x.md"), ("A", "x.md")], "content string, filename string")
    calls = []

    def compute(df):
        calls.append(df.count())
        return df.withColumn("value", F.concat("content", F.lit("-"), "filename"))

    got = cache.through(docs, "op-1", compute)
    assert sorted(r.value for r in got.collect()) == ["A-x.md", "A-x.md", "A-y.md", "B-x.md"]
    assert cache.through(docs, "op-1", compute).count() == 4
    cache.through(docs, "op-2", compute)
    assert calls == [3, 0, 3]
    assert cache.read(spark, "none").count() == 0


def test_paths(spark):
    names = ["a.PDF", "a.tar.gz", "noext", ".hidden", "dir.v/x", "a.b.ipynb", "x.", "é.md"]
    df = spark.createDataFrame([(f"/r/{n}",) for n in names], "p string")
    p = F.col("p")
    got = df.select(P.guess_mime_type(p), P.stem(p), P.with_suffix(p, ".md"), P.parent(p), P.file_name(p)).collect()
    assert [r[0] for r in got] == [P.PDF, "application/x-tar", None, None, None, P.IPYNB, None, P.MARKDOWN]
    assert [r[1] for r in got] == ["a", "a.tar", "noext", ".hidden", "x", "a.b", "x.", "é"]
    assert [r[2] for r in got][:3] == ["/r/a.md", "/r/a.tar.md", "/r/noext.md"] and got[4][2] == "/r/dir.v/x.md"
    assert got[4][3] == "/r/dir.v"
    strip = spark.createDataFrame([("  a b\n\x1f",)], "t string").select(P.strip(F.col("t"))).first()[0]
    assert strip == "a b"
    with pytest.raises(Exception, match="is not below"):
        df.select(P.relative_to(p, "/other")).collect()


def test_numbers_that_would_share_a_file_name(spark):
    """1/2 and 1_2 are two exercises with a file each; alone, a slash is an underscore."""
    schema = "k int, e array<struct<snippet:string,number:string,is_solution:boolean>>"
    rows = [(1, [("a", "1/2", False), ("b", "1_2", False), ("c", "3/4", False)]), (2, [("a", "1/2/3", False), ("b", "1_2/3", True)]), (3, []), (4, None)]
    got = {r.k: r.f for r in spark.createDataFrame(rows, schema).select("k", files_of(F.col("e")).alias("f")).collect()}
    names = {k: [e.file for e in f] for k, f in got.items() if f is not None}
    assert names[1][1:] == ["1_2.md", "3_4.md"] and names[1][0].startswith("1_2-") and names[1][0].endswith(".md")
    assert len(set(names[2])) == 2 and all("/" not in n for n in names[1] + names[2])
    assert [e.number for e in got[1]] == ["1/2", "1_2", "3/4"] and names[3] == [] and got[4] is None
