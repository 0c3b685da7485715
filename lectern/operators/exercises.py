"""Split Markdown into exercises and keep one text for each number."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions.paths import MARKDOWN, stem
from lectern.models.calls import calling, parallel_of
from lectern.models.client import ModelClient, StandIn
from lectern.operators.cache import Cache, once
from lectern.operators.gates import change_where, explode_where, in_pairs, passes
from lectern.runtime import ship

EXERCISES = "array<struct<snippet:string,number:string,is_solution:boolean>>"


def split_text(text: Column, client: ModelClient | None = None) -> Column:
    """The client's exercises of each text, in order."""
    client = client or StandIn()
    kind = pa.list_(pa.struct([("snippet", pa.string()), ("number", pa.string()), ("is_solution", pa.bool_())]))

    @F.arrow_udf(EXERCISES)
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([client.split(t.as_py()) if t.is_valid else [] for t in texts], kind)

    return run(text)


def parse_reply(reply: Column) -> Column:
    """A model's JSON reply ``{"exercises": [...]}`` as exercises."""
    return F.from_json(reply, f"struct<exercises:{EXERCISES}>")["exercises"]


def dedup_exercises(df: DataFrame, keys: list[str], pos: str = "pos") -> DataFrame:
    """One row for each number of a document: its last solution if there is one, else its first statement.

    ``df(keys, number, snippet, is_solution, pos)`` to ``keys, number, snippet, is_solution, first_pos``, where
    ``first_pos`` orders numbers by first occurrence. Null and empty numbers are left out. A partial aggregate.
    """
    rows = df.where(F.coalesce(F.col("number") != "", F.lit(False)))
    solved = F.coalesce(F.col("is_solution"), F.lit(False))
    last = F.max(F.when(solved, F.struct(F.col(pos).alias("p"), F.col("snippet").alias("t"))))
    first = F.min(F.when(~solved, F.struct(F.col(pos).alias("p"), F.col("snippet").alias("t"))))
    best = rows.groupBy(*keys, "number").agg(last.alias("l"), first.alias("f"), F.min(pos).alias("first_pos"))
    return best.select(*keys, "number", F.coalesce("l", "f")["t"].alias("snippet"), F.col("l").isNotNull().alias("is_solution"), "first_pos")


def unique_exercises(found: Column) -> Column:
    """``dedup_exercises`` within an array, in order of first occurrence; no shuffle."""
    kept = F.filter(found, lambda e: F.coalesce(e["number"] != "", F.lit(False)))
    numbers = F.array_distinct(F.transform(kept, lambda e: e["number"]))

    def choose(n: Column) -> Column:
        own = F.filter(kept, lambda e: e["number"] == n)
        solutions = F.filter(own, lambda e: F.coalesce(e["is_solution"], F.lit(False)))
        return F.when(F.size(solutions) > 0, F.element_at(solutions, -1)).otherwise(own[0])

    return F.transform(numbers, choose)


def file_of(number: Column, legacy_suffix: bool = False) -> Column:
    """The exercise's file name; a slash would lead elsewhere and becomes an underscore. ``legacy_suffix``: 1.2 gives 1.md."""
    safe = F.replace(number, F.lit("/"), F.lit("_"))
    return F.concat(stem(safe) if legacy_suffix else safe, F.lit(".md"))


def files_of(exercises: Column) -> Column:
    """``file, number, snippet`` of a document's unique exercises; a number with a slash whose file name another has as well gets a part of its hash."""

    def name(e: Column) -> Column:
        shared = F.size(F.filter(exercises, lambda x: file_of(x["number"]) == file_of(e["number"]))) > 1
        apart = F.concat(e["number"], F.lit("-"), F.substring(F.sha2(e["number"].cast("binary"), 256), 1, 8))
        return file_of(F.when(shared & F.contains(e["number"], F.lit("/")), apart).otherwise(e["number"]))

    return F.transform(exercises, lambda e: F.struct(name(e).alias("file"), e["number"].alias("number"), e["snippet"].alias("snippet")))


def split_exercises(df: DataFrame, pairs: list[tuple[str, str]] | None = None, client: ModelClient | None = None, legacy_suffix: bool = False, cache: Cache | None = None, own_folder: bool = False) -> DataFrame:
    """Markdown rows of the given (type, subtype) pairs replaced by a row for each exercise; others pass.

    A text without exercises disappears. New rows come in the order of their file names, by code point, and are one
    chunk each; their solution flag is the document's. No two numbers of a document share a file name. Their files go to ``exercises/`` beside the document, or with
    ``own_folder`` into a folder named as the document, so that no two sheets' exercises meet. A client other than the
    stand-in is called once for each distinct text, and its replies are kept; in the ``cache``, if there is one. A sheet that it refuses passes whole.
    """

    client = client or StandIn()
    ship(df.sparkSession)
    gate = passes(in_pairs(pairs) & (F.col("mime_type") == MARKDOWN))
    # a sheet that was Markdown from the start has its bytes only
    text = F.coalesce("text", F.col("content").cast("string"))
    if type(client) is StandIn and cache is None:
        found = df.withColumn("__found", split_text(F.when(gate, text), client))
    else:
        ask = calling(lambda b: json.dumps({"exercises": client.split(b.decode())}, ensure_ascii=False), parallel_of(client))
        reply = lambda d: d.select("sha256", ask("content").alias("r")).select("sha256", "r.value", "r.error")
        found = once(df, gate, F.encode(text, "UTF-8"), f"split-1-{client.name}", reply, cache)
        found = found.withColumn("__found", F.coalesce(parse_reply(F.col("__value")), F.array().cast(EXERCISES)))
        gate = gate & (F.col("__value").isNotNull() | text.isNull())  # a refused sheet stays whole
    found = found.withColumn("__unique", unique_exercises(F.col("__found")))
    old = lambda e: F.struct(file_of(e["number"], True).alias("file"), e["number"].alias("number"), e["snippet"].alias("snippet"))
    found = found.withColumn("__named", F.transform("__unique", old) if legacy_suffix else files_of(F.col("__unique")))
    if legacy_suffix:  # of one file name the last counts
        later = lambda e, i: F.exists(F.slice("__named", i + 2, F.size("__named")), lambda x: x["file"] == e["file"])
        found = found.withColumn("__named", F.filter("__named", lambda e, i: ~later(e, i)))
    each = F.transform(F.array_sort("__named"), lambda e, i: F.struct(i.alias("i"), e["file"].alias("file"), e["number"].alias("number"), e["snippet"].alias("snippet")))
    out = explode_where(found, gate, each, "__e")
    number = stem(F.col("__e.file")) if legacy_suffix else F.col("__e.number")
    out = change_where(
        out,
        gate,
        title=F.concat("title", F.lit(" > Exercise "), number),
        path=F.concat(F.concat("path", F.lit(".")) if own_folder else F.regexp_extract("path", r"(?s)^(.*/)?[^/]*$", 1), F.lit("exercises/"), F.col("__e.file")),
        sub_number=number,
        one_chunk_per_doc=F.lit(True),
        text=F.col("__e.snippet"),
        content=F.lit(None),
        ord=F.concat(F.coalesce("ord", F.array().cast("array<int>")), F.array("__e.i")),
    )
    return out.select(*df.columns)
