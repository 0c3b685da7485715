"""The resource row: one document or file of a course, with its inferred metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S, _I, _B = T.StringType(), T.IntegerType(), T.BooleanType()

#: Fields of a resource in their fixed order: name, type, default (required ones have none).
REQUIRED = ["title", "source", "url", "path", "mime_type"]
OPTIONAL: list[tuple[str, T.DataType, object]] = [
    ("id", T.LongType(), None), ("type", _S, None), ("subtype", _S, None),
    ("is_solution", _B, False), ("is_qa", _B, False), ("is_video", _B, False), ("is_gemini_processed_video", _B, False),
    ("srt_path", _S, None), ("associated_video_lectures", T.ArrayType(_S), None),
    ("week", _I, None), ("number", _S, None), ("sub_number", _S, None),
    ("date", T.DateType(), None), ("year", _S, None), ("from_", _S, None), ("until", _S, None),
    ("processing_method", _S, None), ("model", _S, None), ("tikz", _B, False),
    ("one_chunk_per_page", _B, False), ("one_chunk_per_doc", _B, False), ("original_link", _S, None), ("pipeline_link", _S, None),
]
#: Fields of the variants, what kind a row is, its place in the source's order, and its content.
VARIANT: list[tuple[str, T.DataType]] = [
    ("kind", _S), ("section_title", _S), ("section_text", _S), ("chapter", _S), ("subchapter", _S),
    ("ord", T.ArrayType(_I)), ("content", T.BinaryType()), ("text", _S),
]

RESOURCE_SCHEMA = T.StructType(
    [T.StructField(n, _S, n in ("mime_type",)) for n in REQUIRED]
    + [T.StructField(n, t, True) for n, t, _ in OPTIONAL]
    + [T.StructField(n, t, True) for n, t in VARIANT]
)

#: The 23 keys of a metadata document in their fixed order; ``from_`` is written as ``from``.
METADATA_FIELDS = [
    "title", "path", "id", "type", "subtype", "is_solution", "is_qa", "is_video", "is_gemini_processed_video", "srt_path",
    "associated_video_lectures", "week", "number", "sub_number", "from_", "until", "processing_method", "model", "tikz",
    "one_chunk_per_page", "one_chunk_per_doc", "original_link", "pipeline_link",
]

#: Kinds of resource. An error stands for what could not be read: it has no type and no content, its reason is ``section_text``.
LMS, MOOC, ERROR = "moodle", "mooc", "error"


def as_resources(df: DataFrame, **columns: Column) -> DataFrame:
    """Rows of the full schema from ``df``'s columns of those names and ``columns``; what is missing gets its default."""
    default = {n: v for n, _, v in OPTIONAL}
    out = []
    for f in RESOURCE_SCHEMA:
        if f.name in columns:
            c = columns[f.name]
        elif f.name in df.columns:
            c = F.col(f.name)
        elif f.name in REQUIRED and f.name != "mime_type":
            raise TypeError(f"a resource needs {f.name}")
        else:
            c = F.lit(default.get(f.name))
        out.append(c.cast(f.dataType).alias(f.name))
    return df.select(*out)


def check_schema(df: DataFrame) -> DataFrame:
    """``df`` itself, if it has the resource fields with their types in order; stages end with this."""
    found, wanted = [(f.name, f.dataType) for f in df.schema], [(f.name, f.dataType) for f in RESOURCE_SCHEMA]
    if found != wanted:
        odd = [f"{a} is not {b}" for a, b in zip(found, wanted) if a != b] or [f"{len(found)} fields"]
        raise TypeError("not a resource table: " + "; ".join(odd[:5]))
    return df


def copy_with(df: DataFrame, **changes: Column) -> DataFrame:
    """Rows with some fields replaced; a name that is no field is an error."""
    if unknown := sorted(set(changes) - set(df.columns)):
        raise TypeError(f"no such field: {', '.join(unknown)}")
    return df.withColumns({n: c.cast(df.schema[n].dataType) for n, c in changes.items()})


def metadata(df: DataFrame) -> DataFrame:
    """The metadata projection: 23 columns, ``from_`` named ``from``."""
    return df.select(*[F.col(n).alias(n.rstrip("_")) for n in METADATA_FIELDS])
