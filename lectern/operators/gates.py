"""Stages that change some rows and let the others pass."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lectern.schema import ERROR, copy_with


def in_pairs(pairs: Iterable[tuple[str, str]] | None) -> Column:
    """Whether (type, subtype) is one of ``pairs``; no pairs: always."""
    pairs = list(pairs or [])
    if not pairs:
        return F.lit(True)
    hit = F.lit(False)
    for a, b in pairs:
        hit = hit | ((F.col("type") == a) & (F.col("subtype") == b))
    return hit


def passes(gate: Column) -> Column:
    """The gate with null as false: a row that it says nothing about comes through unchanged."""
    return F.coalesce(gate, F.lit(False))


def change_where(df: DataFrame, gate: Column, **changes: Column) -> DataFrame:
    """Rows that pass the gate with fields replaced; others as they are, in place. One projection over one scan."""
    return copy_with(df, **{n: F.when(passes(gate), c).otherwise(F.col(n)) for n, c in changes.items()})


def explode_where(df: DataFrame, gate: Column, each: Column, name: str) -> DataFrame:
    """A row for each element of ``each`` where the gate passes (none: no row), and one row, with null, elsewhere.

    One pass over the input: splitting and uniting the rows again would compute everything before it twice.
    """
    return df.select("*", F.explode(F.when(passes(gate), each).otherwise(F.array(F.lit(None)))).alias(name))


def concatenate(*parts: DataFrame) -> DataFrame:
    """UNION ALL of sources, in order: each part's number is put before its rows' ``ord``."""
    if not parts:
        raise ValueError("nothing to concatenate")
    numbered = [p.withColumn("ord", F.concat(F.array(F.lit(i)), F.coalesce("ord", F.array().cast("array<int>")))) for i, p in enumerate(parts)]
    out = numbered[0]
    for p in numbered[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def totals() -> list[Column]:
    """How many rows there are, and how many of them stand for errors."""
    return [F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("kind") == ERROR, 1)).alias("errors")]


def counted(df: DataFrame, stage: str | Observation) -> DataFrame:
    """``df`` with its ``totals`` observed under a name as rows pass, without a job of its own."""
    return df.observe(stage, *totals())
