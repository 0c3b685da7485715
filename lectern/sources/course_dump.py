"""Course page dumps: an index page of sections with links, and a page for each linked resource."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import html as H
from lectern.functions.paths import guess_mime_type
from lectern.sources.files import below
from lectern.runtime import ship
from lectern.schema import LMS, as_resources

#: Links of an index that lead to resource pages.
PREFIXES = ("./File",)


def section_links(pages: DataFrame, prefixes: tuple[str, ...] = PREFIXES, header: str = "h3", entities: tuple[str, ...] | None = None) -> DataFrame:
    """``pages(html, ...)`` to one row a kept link: the other columns, ``section_title, section_text, url, title, ord``.

    Links are kept before any row is made; a section without one gives none. ``ord`` is (section, link), from 0, in
    document order. ``entities`` as in ``html.sections``.
    """
    ship(pages.sparkSession)
    keep = [c for c in pages.columns if c != "html"]
    found = pages.select(*keep, F.posexplode(H.sections_of(F.col("html"), header, entities)).alias("__s", "__section"))
    links = F.filter(
        F.transform(F.col("__section.links"), lambda x, i: F.struct(i.alias("i"), x["url"].alias("url"), x["title"].alias("title"))),
        lambda x: H.starts_with_any(x["url"], prefixes),
    )
    rows = found.select(*keep, "__s", F.col("__section.section_title"), F.col("__section.section_text"), F.explode(links).alias("__l"))
    return rows.select(*keep, "section_title", "section_text", F.col("__l.url").alias("url"), F.col("__l.title").alias("title"),
                       F.array("__s", "__l.i").alias("ord"))


def link_target(url: Column, strict: bool = True) -> Column:
    """``struct(folder, file)`` of a local url ``./<folder>/<file>``; any other number of parts is an error, or null."""
    parts = F.split(url, "/")
    fit = F.when(F.size(parts) == 3, F.struct(parts[1].alias("folder"), parts[2].alias("file")))
    if not strict:
        return fit
    wrong = F.raise_error(F.concat(F.lit("not ./<folder>/<file>: "), url)).cast("struct<folder:string,file:string>")
    return F.when(fit.isNotNull(), fit).when(url.isNotNull(), wrong)


def last_links(pages: DataFrame, keys: list[str], lms_prefix: str, content_prefix: str = "content/", within: str | None = "main", strict: bool = True) -> DataFrame:
    """For each page its last link into the learning platform and its last content link: ``keys, lms_url, content``.

    A page without the ``within`` element is an error, or has neither.
    """
    ship(pages.sparkSession)
    # not deterministic to the optimizer: a filter on what is found would else be pushed below and parse each page twice
    found = H.anchors_of(F.col("html"), within, once=True)
    if strict:
        missing = F.raise_error(F.lit(f"no <{within}> in a page")).cast("array<struct<url:string,title:string>>")
        found = F.coalesce(found, missing)
    last = lambda prefix, but=None: F.element_at(F.filter(
        F.col("__a"), lambda x: F.startswith(x["url"], F.lit(prefix)) & (~F.startswith(x["url"], F.lit(but)) if but else F.lit(True))), -1)["url"]
    rows = pages.select(*keys, found.alias("__a"))
    rows = rows.withColumn("__a", F.when(F.size("__a") > 0, F.col("__a")))
    safe = lambda prefix, but=None: F.when(F.exists("__a", lambda x: F.startswith(x["url"], F.lit(prefix)) & (~F.startswith(x["url"], F.lit(but)) if but else F.lit(True))), last(prefix, but))
    return rows.select(*keys, safe(lms_prefix).alias("lms_url"), safe(content_prefix, lms_prefix).alias("content"))


def resolve(links: DataFrame, pages: DataFrame, base: str, lms_prefix: str, strict: bool = True) -> DataFrame:
    """Replace local urls by what their resource page says: platform url, content path, clean title and MIME type.

    ``pages(folder, file, html)``. Each page is parsed once, however often it is linked; urls that are not local stay
    as they are, without path. A page or content link that is missing is an error, or gives nulls.
    """
    local = F.startswith(F.col("url"), F.lit("./"))
    at = F.when(local, link_target(F.col("url"), strict))
    rows = links.withColumn("__at", at).withColumn("folder", F.col("__at.folder")).withColumn("file", F.col("__at.file")).drop("__at")
    wanted = pages.join(rows.select("folder", "file").distinct(), ["folder", "file"], "left_semi")
    found = last_links(wanted, ["folder", "file"], lms_prefix, strict=strict).withColumn("__page", F.lit(True))
    rows = rows.join(found, ["folder", "file"], "left")
    path = F.concat(F.lit(base.rstrip("/") + "/"), F.col("folder"), F.lit("/"), F.col("content"))
    if strict:
        absent = F.concat(F.lit("no page or content link for "), F.col("url"))
        path = F.when(F.col("folder").isNull(), F.lit(None)).otherwise(F.coalesce(path, F.raise_error(absent).cast("string")))
    title = F.when(F.col("folder").isNotNull(), H.clean_link_title(F.col("title"), F.col("folder"))).otherwise(F.col("title"))
    rows = rows.withColumns({"path": path, "title": title, "url": F.coalesce("lms_url", "url")})
    return rows.withColumn("mime_type", guess_mime_type(F.col("path"))).drop("folder", "file", "lms_url", "content", "__page")


def read_dump(spark: SparkSession, dump: str, lms_prefix: str, prefixes: tuple[str, ...] = PREFIXES, header: str = "h3", strict: bool = True) -> DataFrame:
    """The resources of a dump folder with an ``index.html`` and ``<folder>/<file>.html`` pages."""
    base = dump.rstrip("/")
    index = spark.read.text(f"{base}/index.html", wholetext=True).select(F.col("value").alias("html"))
    pages = spark.read.option("pathGlobFilter", "*.html").option("recursiveFileLookup", "true").text(base, wholetext=True)
    # a resource page lies in a folder of the dump's own, not deeper
    parts = F.split(below(F.col("_metadata.file_path"), spark, base), "/")
    pages = pages.select(parts.alias("p"), F.col("value").alias("html")).where(F.size("p") == 2)
    pages = pages.select(F.col("p")[0].alias("folder"), F.col("p")[1].alias("file"), "html")
    rows = resolve(section_links(index, prefixes, header), pages, base, lms_prefix, strict)
    return as_resources(rows, source=F.lit("moodle"), kind=F.lit(LMS))
