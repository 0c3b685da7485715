"""Content files and one metadata document a source."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.paths import relative_to
from lectern.runtime import materialise
from lectern.schema import ERROR, METADATA_FIELDS
from lectern.sinks.course_files import CONTENT, FAILURE, METADATA, write_files


def documents_by_source(df: DataFrame, part: Column) -> DataFrame:
    """``source, part, n_docs, documents``: metadata documents in order, duplicates kept, a row for each ``part`` of a source.

    ``part`` rises with ``ord`` and holds a bounded number of rows, so that no task gathers a source; parts in order
    are the source.
    """
    doc = F.struct(*[F.col(n).alias(n.rstrip("_")) for n in METADATA_FIELDS])
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("ord", "title", "path", doc.alias("doc")))), lambda x: x["doc"])
    return df.groupBy("source", part.alias("part")).agg(F.count(F.lit(1)).alias("n_docs"), ordered.alias("documents"))


def content_paths(df: DataFrame, output: str) -> DataFrame:
    """``df`` with paths below ``output`` turned into ``content/<path below it>``; another path is an error."""
    return df.withColumn("path", relative_to(F.col("path"), output, "content/"))


class ContentMetadataSink:
    """Writes ``content/...`` and ``metadata/<source>.json`` below ``output``, with a ``manifest``; every sink sees the same rows.

    A row's text or content is written; a row with neither has its file copied. Content and metadata appear together when all is
    written, and files of an earlier run that are stale go with it (see ``course_files``). Rows of the kind ``error`` are no documents: the
    manifest names them. Different contents under one path are an error, before anything is written, or with
    ``clash="last"`` the last in order counts; equal ones are one file. A source's document is streamed by one task in
    order, an entry at a time, as its form is one file: named as the source up to its last dot, or, where two sources'
    names would meet, as the whole source.
    """

    def __init__(self, output: str, course_info: dict, base: str | None = None, clash: str = "error"):
        if clash not in ("error", "last"):
            raise ValueError(f"clash is error or last, not {clash}")
        self.output, self.course_info, self.base, self.clash = output.rstrip("/"), course_info, (base or output).rstrip("/"), clash

    def load(self, df: DataFrame) -> None:
        failed = F.coalesce(F.col("kind") == ERROR, F.lit(False))
        good = df.where(~failed)
        note = df.where(failed).select(F.lit(FAILURE).alias("what"), "path", *_empty("source", "data"), F.coalesce("section_text", F.lit("")).alias("doc"))
        content = self._content(good)
        # metadata first: the task of a large source takes longest
        write_files(self._metadata(content_paths(good, self.base)).union(content).union(note), self.output, self.course_info)

    def _content(self, df: DataFrame) -> DataFrame:
        to, data = relative_to(F.col("path"), self.base, "content/").alias("to"), F.coalesce(F.encode("text", "UTF-8"), F.col("content")).alias("data")
        # a file that is copied counts by its path
        rows = df.select("path", "ord", to, data).withColumn("is", F.coalesce(F.sha2("data", 256), F.lit("")))
        found = rows.select("to", "is", F.struct("ord", "is").alias("at")).groupBy("to").agg(F.min("is").alias("a"), F.max("is").alias("b"), F.max("at")["is"].alias("last"))
        clashes = found.where("a <> b")
        if self.clash == "last":
            clashes = materialise(clashes.select("to", "last"), "clashes")
            rows = rows.join(clashes, "to", "left").where("last IS NULL OR last = is")
        elif clash := [r.to for r in clashes.select("to").sort("to").limit(5).collect()]:
            raise ValueError(f"different contents under one path: {', '.join(clash)}")
        return rows.select(F.lit(CONTENT).alias("what"), F.col("to").alias("path"), F.col("path").alias("source"), "data", *_empty("doc"))

    def _metadata(self, df: DataFrame) -> DataFrame:
        files = file_names([r.source for r in df.select("source").distinct().collect()])  # a name for each file that is written
        name = F.create_map(*[F.lit(x) for kv in files.items() for x in kv])[F.col("source")] if files else F.lit(None)
        doc = F.to_json(F.struct(*[F.col(n).alias(n.rstrip("_")) for n in METADATA_FIELDS]), {"ignoreNullFields": "false"})
        ordered = df.repartition("source").sortWithinPartitions("source", "ord", "title", "path")
        return ordered.select(F.lit(METADATA).alias("what"), F.concat(F.lit("metadata/"), name).alias("path"), *_empty("source", "data"), doc.alias("doc"))


def _empty(*names: str) -> list[Column]:
    return [F.lit(None).cast("binary" if n == "data" else "string").alias(n) for n in names]


def file_names(sources: list[str]) -> dict[str, str]:
    """The metadata file of each source, no two the same."""
    short = {s: PurePosixPath(s).with_suffix(".json").name for s in sources}
    if len(set(short.values())) == len(short):
        return short
    whole = {s: s.replace("/", "_") + ".json" for s in sources}
    if len(set(whole.values())) < len(whole):
        raise ValueError(f"sources whose files would meet: {', '.join(sorted(sources))}")
    return whole
