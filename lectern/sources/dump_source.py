"""A course dump as a Spark data source, for batches and streams: ``spark.read.format("course_dump")``."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition, StringStartsWith
from pyspark.sql.types import StructType

from lectern.functions.html import anchors, sections
from lectern.functions.paths import mime_type_of
from lectern.runtime import open_store, ship
from lectern.schema import LMS, as_resources
from lectern.sources.course_dump import PREFIXES

#: A row a kept link of the index, resolved by its page. ``folder`` is the page's; filters on it decide which pages are opened.
SCHEMA = "folder string, section_title string, section_text string, title string, url string, path string, mime_type string, ord array<int>"
_ARROW = pa.schema([(n, pa.string()) for n in ("folder", "section_title", "section_text", "title", "url", "path", "mime_type")] + [("ord", pa.list_(pa.int32()))])


@dataclass
class Pages(InputPartition):
    """Links whose pages one task opens: section title and text, url, link title, place."""

    links: list[tuple]


@dataclass
class Dump:
    """How a dump is read, from the source's options."""

    path: str
    lms_prefix: str
    prefixes: tuple[str, ...]
    header: str
    strict: bool
    per_task: int

    @classmethod
    def of(cls, options: dict[str, str]) -> Dump:
        if missing := [k for k in ("path", "lms_prefix") if not options.get(k)]:
            raise ValueError(f"course_dump needs the option {', '.join(missing)}")
        prefixes = tuple(json.loads(options.get("prefixes", json.dumps(PREFIXES))))
        return cls(options["path"].rstrip("/"), options["lms_prefix"], prefixes, options.get("header", "h3"), options.get("strict", "true").lower() != "false", int(options.get("pages_per_task", "64")))

    def text(self, name: str) -> str | None:
        store, root = open_store(self.path)
        try:
            with store.open_input_stream(f"{root}/{name}", compression=None) as f:
                return f.read().decode("utf-8", "replace")
        except FileNotFoundError:
            return None

    def links(self) -> list[tuple]:
        """The index's kept links, in document order."""
        out = []
        for i, s in enumerate(sections(self.text("index.html"), self.header)):
            for j, link in enumerate(s["links"]):
                if link["url"].startswith(self.prefixes):
                    out.append((s["section_title"], s["section_text"], link["url"], link["title"], [i, j]))
        return out

    def parts(self, links: list[tuple]) -> list[Pages]:
        """Links of one folder stay together where a task's share allows."""
        links = sorted(links, key=lambda x: (_folder(x[2]) or "", x[4]))
        return [Pages(links[i : i + self.per_task]) for i in range(0, len(links), self.per_task)] or [Pages([])]

    def rows(self, part: Pages) -> Iterator[pa.RecordBatch]:
        """Resolved links; a page that several link to one after the other is parsed once."""
        seen: dict[str, tuple[str | None, str | None]] = {}
        out = []
        for section_title, section_text, url, title, place in part.links:
            folder, path = _folder(url), None
            if url.startswith("./"):
                if folder is None:
                    if self.strict:
                        raise ValueError(f"not ./<folder>/<file>: {url}")
                else:
                    name = url[2:]
                    if name not in seen:
                        seen = {name: self.page(name)}
                    lms, content = seen[name]
                    if content is None and self.strict:
                        raise ValueError(f"no page or content link for {url}")
                    path = None if content is None else f"{self.path}/{folder}/{content}"
                    title = title.replace(f"({folder.split('_', 1)[0]})", "").strip()
                    url = lms or url
            out.append({"folder": folder, "section_title": section_title, "section_text": section_text, "title": title, "url": url, "path": path,
                        "mime_type": mime_type_of(path) if path else None, "ord": place})
        yield pa.RecordBatch.from_pylist(out, schema=_ARROW)

    def page(self, name: str) -> tuple[str | None, str | None]:
        """A page's last link into the platform, and its last content link."""
        html = self.text(name)
        found = anchors(html, "main") if html is not None else []
        if found is None:
            if self.strict:
                raise ValueError(f"no <main> in {name}")
            found = []
        lms = [a["url"] for a in found if a["url"].startswith(self.lms_prefix)]
        content = [a["url"] for a in found if a["url"].startswith("content/") and not a["url"].startswith(self.lms_prefix)]
        return (lms or [None])[-1], (content or [None])[-1]


def _folder(url: str) -> str | None:
    parts = url.split("/")
    return parts[1] if url.startswith("./") and len(parts) == 3 else None


class DumpReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.dump, self.wanted = Dump.of(options), []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Equality, membership and prefixes of ``folder`` are taken; the rest is Spark's."""
        for f in filters:
            if getattr(f, "attribute", None) == ("folder",) and isinstance(f, (EqualTo, In, StringStartsWith)):
                self.wanted.append(f)
            else:
                yield f

    def fits(self, folder: str | None) -> bool:
        def one(f: Filter) -> bool:
            if isinstance(f, In):
                return folder in f.value
            return folder == f.value if isinstance(f, EqualTo) else folder.startswith(f.value)

        return not self.wanted or folder is not None and all(map(one, self.wanted))

    def partitions(self) -> list[Pages]:
        return self.dump.parts([x for x in self.dump.links() if self.fits(_folder(x[2]))])

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        return self.dump.rows(partition)


class DumpStreamReader(DataSourceStreamReader):
    """New links of an index that grows at its end; the offset is how many links it has."""

    def __init__(self, options: dict[str, str]):
        self.dump = Dump.of(options)

    def initialOffset(self) -> dict:
        return {"links": 0}

    def latestOffset(self) -> dict:
        return {"links": len(self.dump.links())}

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        return self.dump.parts(self.dump.links()[start["links"] : end["links"]])

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        return self.dump.rows(partition)

    def commit(self, end: dict) -> None:
        """Nothing is kept for offsets that are done."""


class CourseDumpSource(DataSource):
    """Options: ``path``, ``lms_prefix``, and ``prefixes`` (JSON), ``header``, ``strict``, ``pages_per_task`` as ``read_dump`` has them."""

    @classmethod
    def name(cls) -> str:
        return "course_dump"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DumpReader:
        return DumpReader(dict(self.options))

    def streamReader(self, schema: StructType) -> DumpStreamReader:
        return DumpStreamReader(dict(self.options))


def register_dump(spark: SparkSession) -> None:
    """Make ``course_dump`` known to the session. Filters on ``folder`` are pushed to it."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(CourseDumpSource)


def dump_resources(rows: DataFrame) -> DataFrame:
    """Rows of the source, batch or stream, as resources."""
    return as_resources(rows, source=F.lit("moodle"), kind=F.lit(LMS))
