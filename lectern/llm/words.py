"""Word rules and row identity shared by these operators: words are runs of anything but ASCII white space."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.runtime import materialise

#: One word: no space, tab, line feed, vertical tab, form feed or carriage return.
WORD = r"[^\x20\x09-\x0D]+"
GAPS = r"[\x20\x09-\x0D]+"
#: The names of a row's keys in tables that hold no columns of the caller's.
KEYS = ["__rk1", "__rk2"]


def word_count(text: Column) -> Column:
    """Number of words in a text; null counts as 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def quoted(name: str) -> str:
    """A column's name as ``select`` takes it, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores added until no column of ``df`` has them in any case."""
    taken = {c.lower() for c in df.columns}
    tail = ""
    while any((n + tail).lower() in taken for n in names):
        tail += "_"
    return [n + tail for n in names]


def row_keys(df: DataFrame, names: list[str] | None = None) -> list[Column]:
    """Two independent 64-bit hashes over all columns, never null: the identity of a row, equal for repeated rows.

    A null and its place count: hashes alone would pass over it. Nested and map values count as their JSON, with nulls.
    """

    def seen(f: T.StructField) -> list[Column]:
        c = F.col(quoted(f.name))
        flat = not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))
        return [c.isNull(), c if flat else F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"})]

    cols = [seen(f) for f in df.schema]
    there, back = [x for c in cols for x in c], [x for c in reversed(cols) for x in c]
    one, two = names or KEYS
    return [F.xxhash64(F.lit("a"), *there).alias(one), F.xxhash64(F.lit("b"), *back).alias(two)]


def numbered(rows: DataFrame, name: str, most: int = 1000) -> DataFrame:
    """``rows`` with ``name``: the number, from 0, of a row among those equal to it in every column.

    Equal rows are counted, then made again from their count, a task for ``most`` of them where there are more: so
    they can be told apart and dealt to different tasks, and the outcome does not depend on the input's order.
    """
    counted = materialise(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("__n")), "counted")
    every = lambda a, b: F.explode(F.sequence(a, b)).alias(name)
    few = counted.where(F.col("__n") <= most).select(*rows.columns, every(F.lit(0).cast("long"), F.col("__n") - 1))
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(__n - 1) div {most}L"))).alias("__part")
    many = counted.where(F.col("__n") > most).select("*", parts).repartition(*rows.columns, "__part")
    last = F.least(F.col("__n"), (F.col("__part") + 1) * most) - 1
    return few.unionByName(many.select(*rows.columns, every(F.col("__part") * most, last)))


def vocabulary(path: str) -> str:
    """Where a vocabulary file lies on this machine: a bare name is one of the public files', anything else a path."""
    if Path(path).name != path:
        return path
    import public_tokenizers

    return public_tokenizers.path(path)
