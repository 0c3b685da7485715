import duckdb
import pytest
from pyspark.sql import functions as F

from lectern.functions.html import anchors, sections
from lectern.queries import ORACLE_SQL, QUERIES
from lectern.sources.course_dump import last_links, link_target, read_dump, resolve, section_links

INDEX = """<html><body><h3> 3 - 4 <b>Octob</b> </h3>before<p>Text <i>one</i></p>
<ul><li><a href="./File_1/a.html">Sheet <b>1</b> (File)</a><li><a href="http://x/y">other</a></ul><script>var a="<a href='./File_9/z.html'>no</a>"</script>
<div>&amp; after<h3>Inner</h3><p><a href="./File_2/b.html">nested</a></p></div><a href="./File_3/c.html">itself</a>
<h3>Empty</h3><p>no links</p><h3>Last</h3><div><a href="./File_2/b.html">again (File)</a></div></body></html>"""


def test_sections():
    got = sections(INDEX)
    assert [s["section_title"] for s in got] == ["3 - 4Octob", "Inner", "Empty", "Last"]
    first = got[0]
    assert [x["url"] for x in first["links"]] == ["./File_1/a.html", "http://x/y", "./File_2/b.html"]
    assert first["links"][0]["title"] == "Sheet1(File)"
    assert first["section_text"] == "Text\none\nSheet\n1\n(File)\nother\n& after\nInner\nnested\nitself"
    assert [x["url"] for x in got[1]["links"]] == ["./File_2/b.html"]
    assert sections(None) == sections("") == []


def test_entities_that_are_read():
    page = "<h3>a &amp; b&amp;&amp</h3><p>&lt;x&gt; &nbsp &#65; &amp;lt;</p>"
    assert [(s["section_title"], s["section_text"]) for s in sections(page)] == [("a & b&&", "<x> \xa0 A &lt;")]
    assert [(s["section_title"], s["section_text"]) for s in sections(page, entities=("amp", "lt", "gt"))] == [("a & b&&amp", "<x> &nbsp &#65; &lt;")]
    assert sections(None, entities=("amp",)) == []


@pytest.mark.parametrize("name", ["page_sections", "page_section_links"])
def test_texts_cut_within_an_entity_are_read_as_in_sql(spark, tmp_path, name):
    page = lambda t: f"<html><head><title>{t}</title></head><body><article><h1>{t}</h1><p>x &amp y<a href=\"/u\">u</a></p></article></body></html>"
    rows = [(i, page(t)) for i, t in enumerate(["a&amp;&amp;&amp", "b &lt", "c&amp;lt; &quot", "d &gt;&am", "e &amp;"])]
    spark.createDataFrame(rows, "page_id long, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    got = QUERIES[name](spark, str(tmp_path))
    want = duck.sql(ORACLE_SQL[name])
    assert sorted(tuple(r) for r in got.select(*want.columns).collect()) == sorted(want.fetchall()) and got.count() == len(rows)


def test_anchors():
    assert anchors("<p><a href='1'>x</a><a>no</a></p>") == [{"url": "1", "title": "x"}]
    assert anchors("<p></p>", "main") is None
    assert anchors("</b><main><br><a href=2>y</main><a href=3>z", "main") == [{"url": "2", "title": "y"}]
    assert [a["url"] for a in anchors("<div>" * 5000 + "<a href=q>r</a>")] == ["q"]


def test_section_links_order_and_prefix(spark):
    df = spark.createDataFrame([(1, INDEX), (2, None)], "page int, html string")
    got = section_links(df).collect()
    assert [(r.url, r.ord) for r in sorted(got, key=lambda r: r.ord)] == [
        ("./File_1/a.html", [0, 0]), ("./File_2/b.html", [0, 2]), ("./File_2/b.html", [1, 0]), ("./File_2/b.html", [3, 0])]
    assert {r.section_title for r in got} == {"3 - 4Octob", "Inner", "Last"}


PAGES = [("File_1", "a.html", '<main><a href="content/x.pdf">1</a><a href="https://lms/1">l</a><a href="content/y.PDF">2</a></main>'),
         ("File_2", "b.html", '<a href="https://lms/no">out</a><main><a href="content/z.ipynb">3</a></main>')]


def test_resolve(spark):
    links = spark.createDataFrame([("./File_1/a.html", "Sheet (File) (File)"), ("./File_2/b.html", " b "), ("http://else", "x")], "url string, title string")
    pages = spark.createDataFrame(PAGES, "folder string, file string, html string")
    got = {r.title: (r.url, r.path, r.mime_type) for r in resolve(links, pages, "/d/", "https://lms").collect()}
    assert got == {
        "Sheet": ("https://lms/1", "/d/File_1/content/y.PDF", "application/pdf"),
        "b": ("./File_2/b.html", "/d/File_2/content/z.ipynb", "application/x-ipynb+json"),
        "x": ("http://else", None, None),
    }


@pytest.mark.parametrize("url, html", [("./a/b/c.html", "<main></main>"), ("./File_1/missing.html", ""), ("./File_3/a.html", "<p>no main</p>"), ("./File_3/a.html", "<main></main>")])
def test_strict_and_permissive(spark, url, html):
    links = spark.createDataFrame([(url, "t")], "url string, title string")
    pages = spark.createDataFrame([*PAGES, ("File_3", "a.html", html)], "folder string, file string, html string")
    with pytest.raises(Exception):
        resolve(links, pages, "/d", "https://lms").collect()
    assert resolve(links, pages, "/d", "https://lms", strict=False).first().path is None


def test_link_target_null(spark):
    assert spark.range(1).select(link_target(F.lit(None).cast("string")).alias("t")).first().t is None
    df = spark.createDataFrame([(1, "<main></main>")], "k int, html string")
    assert last_links(df, ["k"], "https://lms").first().content is None


def test_read_dump(spark, tmp_path):
    (tmp_path / "index.html").write_text(INDEX, encoding="utf-8")
    for folder, file, html in PAGES:
        (tmp_path / folder).mkdir()
        (tmp_path / folder / file).write_text(html)
    got = read_dump(spark, str(tmp_path), "https://lms").orderBy("ord").collect()
    assert [r.title for r in got] == ["Sheet1", "nested", "nested", "again"]
    assert {r.source for r in got} == {"moodle"} and got[0].kind == "moodle" and got[0].path.endswith("File_1/content/y.PDF")
