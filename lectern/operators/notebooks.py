"""Notebooks to Markdown, and image references to descriptions, by native functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.paths import IPYNB, MARKDOWN, guess_mime_type, parent, resolved, with_suffix
from lectern.models.calls import calling, parallel_of
from lectern.models.client import ModelClient, StandIn
from lectern.operators.cache import Cache, once
from lectern.operators.gates import change_where, passes
from lectern.runtime import materialise, ship

#: The patterns of image references and of an HTML image's description. What may be anything is so but for a line feed.
MD_IMAGE = r"!\[([^\n]*?)\]\(([^\n]*?)\)"
HTML_IMAGE = r'(?iU)<img\s+[^>]*src="([^"]+)"[^>]*>'
ALT = r'(?iU)alt="([^"]*)"'

_OUTPUT = "output_type string, text variant, traceback array<string>, `text/markdown` variant, `text/plain` variant, markdown variant"
_OUTPUT += ", data struct<`text/markdown`: variant, `text/plain`: variant, markdown: variant, text: variant>"
_CELL = f"cell_type string, source variant, input variant, level string, outputs array<struct<{_OUTPUT}>>"
#: What is read of a notebook; images and other data of outputs are passed over.
NOTEBOOK = f"""cells array<struct<{_CELL}>>, worksheets array<struct<cells: array<struct<{_CELL}>>>>,
    metadata struct<kernelspec: struct<language: string>, language_info: struct<name: string>>"""


def _joined(source: Column) -> Column:
    """A text that is a string or a list of its lines; null where there is none."""
    return F.coalesce(F.array_join(F.try_variant_get(source, "$", "array<string>"), ""), F.try_variant_get(source, "$", "string"))


def _output(o: Column) -> Column:
    """The text of a cell's output; images and other data have none."""
    named = lambda of, *names: F.coalesce(*[_joined(of[n]) for n in names], F.lit(""))
    data = F.when(o["data"].isNotNull(), named(o["data"], "text/markdown", "text/plain", "markdown", "text"))
    return (
        F.when(o["output_type"] == "stream", named(o, "text"))
        .when(o["output_type"].isin("error", "pyerr"), F.coalesce(F.array_join(o["traceback"], "\n"), F.lit("")))
        .otherwise(F.coalesce(data, named(o, "text/markdown", "text/plain", "markdown", "text")))
    )


def markdown_of(content: Column) -> Column:
    """Markdown of notebooks' bytes or text, of format 3 or 4; null for null, and an error for what is no notebook.

    This project's own form: Markdown and raw cells as they are, code cells fenced with the kernel's language, their
    outputs indented by four spaces; a blank line between parts; one line feed at the end.
    """
    book = F.from_json(F.regexp_replace(content.cast("string"), "^﻿", ""), NOTEBOOK, {"mode": "FAILFAST"})
    empty = F.array().cast(f"array<struct<{_CELL}>>")
    sheets = F.flatten(F.transform(F.filter(book["worksheets"], lambda w: w["cells"].isNotNull()), lambda w: w["cells"]))
    cells = F.coalesce(book["cells"], sheets, empty)
    language = F.coalesce(F.nullif(book["metadata"]["kernelspec"]["language"], F.lit("")), F.nullif(book["metadata"]["language_info"]["name"], F.lit("")), F.lit("python"))
    indented = lambda t: F.concat(F.lit("    "), F.replace(t, F.lit("\n"), F.lit("\n    ")))

    def parts(c: Column) -> Column:
        source = F.coalesce(_joined(c["source"]), _joined(c["input"]), F.lit(""))
        found = F.transform(F.coalesce(c["outputs"], F.array().cast(f"array<struct<{_OUTPUT}>>")), lambda o: F.regexp_replace(_output(o), r"\n+\z", ""))
        code = F.concat(F.array(F.concat(F.lit("```"), language, F.lit("\n"), source, F.lit("\n```"))), F.transform(F.filter(found, lambda t: t != ""), indented))
        head = F.concat(F.repeat(F.lit("#"), F.coalesce(c["level"].cast("int"), F.lit(1))), F.lit(" "), source)
        return F.when(c["cell_type"] == "code", code).when(c["cell_type"] == "heading", F.array(head)).otherwise(F.array(source))

    return F.when(content.isNotNull(), F.concat(F.array_join(F.flatten(F.transform(cells, parts)), "\n\n"), F.lit("\n")))


def _replaced(text: Column, pattern: str, new: Callable[[Column], Column]) -> Column:
    """``text`` with ``new`` of each match in its place: the text between matches and the matches, put together in turn."""
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), new)
    between = F.split(text, pattern, -1)
    return F.when(F.size(found) == 0, text).otherwise(F.array_join(F.zip_with(between, found, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), ""))


def images_rewritten(text: Column, alts: Column | None = None) -> Column:
    """Image references with the descriptions in ``alts``, a map by source; HTML images become Markdown ones in any case."""

    def image(own: Column, source: Column) -> Column:
        known = own if alts is None else F.coalesce(F.try_element_at(alts, source), own)
        return F.concat(F.lit("!["), known, F.lit("]("), source, F.lit(")"))

    if alts is not None:  # without descriptions a Markdown image stays what it is
        text = _replaced(text, MD_IMAGE, lambda m: image(F.regexp_extract(m, MD_IMAGE, 1), F.regexp_extract(m, MD_IMAGE, 2)))
    return _replaced(text, HTML_IMAGE, lambda m: image(F.regexp_extract(m, ALT, 1), F.regexp_extract(m, HTML_IMAGE, 1)))


def image_sources(text: Column) -> Column:
    """What a text's image references name, each once; HTML images may also stand in the description of a Markdown one."""
    return F.array_distinct(F.concat(F.regexp_extract_all(text, F.lit(MD_IMAGE), 2), F.regexp_extract_all(text, F.lit(HTML_IMAGE), 1)))


def _described(rows: DataFrame, text: str, files: DataFrame, client: ModelClient, cache: Cache | None) -> DataFrame:
    """``rows`` with the image references of the column ``text`` rewritten; rows meet their descriptions by path and text."""
    path, body = F.col("path"), F.col(text)
    # rows of one path and text have the same images; a row's path alone tells nothing of its text
    same = F.sha2(F.concat(F.coalesce(F.concat(F.lit("p"), path), F.lit("n")), F.lit("\0"), F.coalesce(F.concat(F.lit("t"), body), F.lit("n"))), 256)
    keyed = rows.withColumn("__k", same)
    refs = keyed.select("__k", F.coalesce(parent(path), F.lit("")).alias("folder"), F.explode(image_sources(body)).alias("src")).where("src <> ''").distinct()
    refs = materialise(refs.select("__k", "src", resolved(F.col("folder"), F.col("src")).alias("at")), "images")
    # a file of an unknown type is no image that a model could see: its reference keeps its own text
    seen = files.select(F.col("path").alias("at"), "content").withColumn("kind", guess_mime_type(F.col("at"))).where("kind IS NOT NULL AND content IS NOT NULL")
    seen = seen.join(refs.select("at").distinct(), "at", "left_semi")
    if type(client) is StandIn and cache is None:
        alts = seen.select("at", client.described(F.col("content"), F.col("kind")).alias("alt"))
    else:

        def typed(content: bytes) -> str:
            """Of a type, a line feed and an image's bytes: images are told apart by both."""
            kind, _, image = content.partition(b"\n")
            return client.describe(image, kind.decode())

        ask = calling(typed, parallel_of(client))
        reply = lambda d: d.select("sha256", ask("content").alias("r")).select("sha256", "r.value", "r.error")
        data = F.concat(F.encode("kind", "UTF-8"), F.encode(F.lit("\n"), "UTF-8"), F.col("content"))
        alts = once(seen, F.lit(True), data, f"describe-1-{client.name}", reply, cache)
        alts = alts.select("at", F.col("__value").alias("alt"))
    # of several files of one path one counts
    alts = refs.join(alts.groupBy("at").agg(F.min("alt").alias("alt")), "at").where("alt IS NOT NULL")
    alts = alts.groupBy("__k").agg(F.map_from_entries(F.collect_list(F.struct("src", "alt"))).alias("__alts"))
    found = keyed.join(alts, "__k", "left").withColumn(text, images_rewritten(body, F.col("__alts")))
    return found.select(*rows.columns)


def describe_images(df: DataFrame, files: DataFrame, client: ModelClient | None = None, cache: Cache | None = None) -> DataFrame:
    """``df(path, text)`` with image references rewritten; those to a file in ``files(path, content)`` get the client's description.

    References are found, and replaced, by the same native patterns, and joined to the files by where they lead. An empty reference names
    no file, and a file of an unknown type is no image. Each image is described once, however often it is shown; a client other than the stand-in
    describes each distinct one once, and its words are kept; in the ``cache``, if there is one; an image that it refuses keeps its own text. Rows of one path, and rows without one, keep their own texts.
    """
    ship(df.sparkSession)
    return _described(df, "text", files, client or StandIn(), cache)


def notebooks_to_markdown(df: DataFrame, files: DataFrame | None = None, client: ModelClient | None = None, cache: Cache | None = None, keep_ending: bool = False) -> DataFrame:
    """Notebook rows turned into Markdown rows; others pass. The text is a column, written by a sink only.

    Images are described where ``files(path, content)`` has them; rows are then written once to shared storage, as they are read twice. Conversions are
    kept in the ``cache``, if there is one, by the notebook's content. ``keep_ending``: ``a.ipynb`` becomes ``a.ipynb.md``, so that it meets no ``a.pdf``'s.
    """
    ship(df.sparkSession)
    gate = passes(F.col("mime_type") == IPYNB)
    if cache is None:
        rows = df.withColumn("__value", markdown_of(F.when(gate, F.col("content"))))
    else:
        rows = once(df, gate, F.col("content"), "notebook-1", lambda d: d.withColumn("value", markdown_of(F.col("content"))), cache)
    if files is not None:
        rows = _described(materialise(rows, "notebooks"), "__value", files, client or StandIn(), cache)
        text = F.col("__value")
    else:
        text = images_rewritten(F.col("__value"))
    path = F.concat("path", F.lit(".md")) if keep_ending else with_suffix(F.col("path"), ".md")
    out = change_where(rows, gate, path=path, mime_type=F.lit(MARKDOWN), processing_method=F.lit(None), text=text, content=F.lit(None))
    return out.select(*df.columns)
