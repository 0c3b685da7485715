"""PDFs to Markdown: pages, a transcription of each, and one stitched text."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.paths import MARKDOWN, PDF, with_suffix
from lectern.models.calls import calling, parallel_of
from lectern.models.client import ModelClient, StandIn
from lectern.models.remote import image_url
from lectern.operators.cache import Cache, hits, once
from lectern.operators.gates import change_where, in_pairs, passes
from lectern.runtime import materialise, ship

#: Fixed value: largest page image that a model is given, in pixels.
LARGEST = (2048, 3072)
#: Turns a PDF's bytes into page images. No PDF library is part of this project; ``library_pages`` uses one if it is there.
Renderer = Callable[[bytes], Iterable[bytes]]


def form_feed_pages(content: bytes) -> list[bytes]:
    """Stand-in renderer: pages of a plain text, parted by form feeds."""
    return content.split(b"\f") if content else []


def clamped(width: int, height: int, most: tuple[int, int] = LARGEST) -> tuple[int, int]:
    """The size of an image scaled down, if need be, to fit; never up."""
    scale = min(most[0] / width, most[1] / height, 1.0)
    return int(width * scale), int(height * scale)


def png_data_url(png: bytes) -> str:
    return image_url(png)


def library_pages(content: bytes, dpi: int = 72) -> Iterator[bytes]:
    """Renderer over the optional library ``pymupdf``: each page as a PNG at ``dpi``, scaled down to ``LARGEST``."""
    import pymupdf

    with pymupdf.open(stream=content, filetype="pdf") as book:
        for page in book:
            width, height = page.rect.width * dpi / 72, page.rect.height * dpi / 72
            fit = clamped(max(1, int(width)), max(1, int(height)))
            zoom = pymupdf.Matrix(fit[0] / page.rect.width, fit[1] / page.rect.height)
            yield page.get_pixmap(matrix=zoom, alpha=False).tobytes("png")


def pages(df: DataFrame, keys: list[str], render: Renderer = form_feed_pages, gathered: int = 16 << 20) -> DataFrame:
    """``keys, page, image`` for every page; a document without pages is an error. Pages are handed on in batches of about ``gathered`` bytes."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, number, images, size = [], [], [], 0

            def done() -> pa.RecordBatch:
                own = [b.column(j).take(pa.array(at, pa.int64())) for j in range(len(keys))]
                return pa.RecordBatch.from_arrays([*own, pa.array(number, pa.int32()), pa.array(images, pa.binary())], names=[*keys, "page", "image"])

            for i in range(b.num_rows):
                n = 0
                for n, image in enumerate(render(b.column(len(keys))[i].as_py() or b""), 1):
                    at.append(i)
                    number.append(n - 1)
                    images.append(image)
                    size += len(image)
                    if size >= gathered:
                        yield done()
                        at, number, images, size = [], [], [], 0
                if not n:
                    raise ValueError("a PDF without pages")
            if at:
                yield done()

    schema = df.select(*keys).schema.add("page", "integer").add("image", "binary")
    return df.select(*keys, "content").mapInArrow(run, schema)


def fenced(pages: DataFrame, keys: list[str], page: str = "page", text: str = "text") -> DataFrame:
    """``keys, document``: each page in triple backticks, in page order, joined by blank lines."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(page).alias("p"), F.col(text).alias("t"))))
    one = F.transform(ordered, lambda x: F.concat(F.lit("```\n"), x["t"], F.lit("\n```")))
    return pages.groupBy(*keys).agg(F.array_join(one, "\n\n").alias("document"))


def pdfs_to_markdown(df: DataFrame, pairs: list[tuple[str, str]] | None = None, client: ModelClient | None = None, render: Renderer = form_feed_pages, requests: int = 64,
                     cache: Cache | None = None, keep_ending: bool = False) -> DataFrame:
    """PDF rows of the given (type, subtype) pairs turned into Markdown rows; others pass.

    Equal contents are transcribed once, a call for each distinct page and one for stitching, in ``requests`` tasks at most, each with as
    many calls at once as the client stands; pages keep their order. Replies are written to shared storage before anything
    reads them, so a lost task repeats no other's calls. With a ``cache`` they are kept page by page, in batches, and whole texts as well: a run that was
    stopped goes on where it was. A page that the model refuses is marked in the text, and tried again by the next run; if stitching is
    refused, pages are joined by blank lines. ``keep_ending``: ``a.pdf`` becomes ``a.pdf.md``.
    """
    client = client or StandIn()
    ship(df.sparkSession)
    scope = f"pdf-1-{client.name}-{getattr(render, '__name__', type(render).__name__)}"

    def replies(call: Callable[[bytes], str]) -> Callable[[DataFrame], DataFrame]:
        ask = calling(call, parallel_of(client))
        return lambda d: d.repartition(requests, "sha256").select("sha256", ask("content").alias("r")).select("sha256", "r.value", "r.error")

    def whole(books: DataFrame) -> DataFrame:
        """``sha256, value, complete``"""
        read = materialise(pages(books, ["sha256"], render), "pages")
        read = once(read, F.lit(True), F.col("image"), f"page-1-{client.name}", replies(client.transcribe), cache)
        marked = F.coalesce("__value", F.concat(F.lit("<!-- page "), F.col("page") + 1, F.lit(" could not be transcribed -->")))
        ordered = F.transform(F.array_sort(F.collect_list(F.struct("page", marked.alias("text")))), lambda x: x["text"])
        texts = read.groupBy("sha256").agg(ordered.alias("pages"), F.min(F.col("__value").isNotNull()).alias("complete"))
        texts = once(texts, F.lit(True), F.encode(F.to_json("pages"), "UTF-8"), f"stitch-1-{client.name}", replies(lambda b: client.stitch(json.loads(b))), cache)
        complete = F.col("complete") & F.col("__value").isNotNull()
        return texts.select("sha256", F.coalesce("__value", F.array_join("pages", "\n\n")).alias("value"), complete.alias("complete"))

    gate = passes(in_pairs(pairs) & (F.col("mime_type") == PDF))
    keyed = df.withColumn("__sha", F.sha2(F.when(gate, F.col("content")), 256))
    books = keyed.where("__sha IS NOT NULL").groupBy(F.col("__sha").alias("sha256")).agg(F.first("content").alias("content"))
    if cache is None:
        made = materialise(whole(books).select("sha256", "value"), "made")
    else:
        keys = materialise(keyed.where("__sha IS NOT NULL").select(F.col("__sha").alias("sha256")).distinct(), "keys")
        known = materialise(hits(keys.withColumn("filename", F.lit("value")), cache.lookup(keys, scope)).select("sha256", "value"), "known")
        new = materialise(whole(books.join(known.select("sha256"), "sha256", "left_anti")), "new")
        if not new.isEmpty():
            cache.write(new.where("complete").select("sha256", F.lit("value").alias("filename"), "value"), scope)
        made = known.union(new.select("sha256", "value"))
    rows = keyed.join(made.toDF("__sha", "__value"), "__sha", "left")
    path = F.concat("path", F.lit(".md")) if keep_ending else with_suffix(F.col("path"), ".md")
    out = change_where(rows, gate, path=path, mime_type=F.lit(MARKDOWN), processing_method=F.lit(None), text=F.col("__value"), content=F.lit(None))
    return out.select(*df.columns)
