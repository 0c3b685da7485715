"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.words import KEYS, numbered, quoted, row_keys, unused, word_count
from lectern.runtime import materialise, ship

#: Probabilities nearer to 0 or 1 than this are whole.
_WHOLE = 1e-9


def _level(by: DataFrame) -> float:
    """The level at which each source's target is its weight times the level, but for those that stop at their cap.

    ``by(__w, __cap, source_size)``, a row a source. Each round fixes the sources that the level so far fills beyond their
    cap and spreads the rest anew; the level only rises and settles when no further source stops. One number goes to the driver.
    """
    level = 0.0
    while True:
        full = F.col("__cap") <= F.col("__w") * F.lit(level)
        left = F.sum("source_size") - F.coalesce(F.sum(F.when(full, F.col("__cap"))), F.lit(0.0))
        r = by.agg(left.alias("left"), F.sum(F.when(~full, F.col("__w"))).alias("w")).first()
        if not r.w or r.left / r.w <= level * (1 + 1e-12):
            return level if r.w else float("inf")
        level = r.left / r.w


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), most: float = 3.0) -> DataFrame:
    """Targets of the sources in ``sizes(source, size)``: ``source, __sno, source_size, __rows, target``.

    Sources in code point order, null last, weigh ``weights``, repeating. The targets share the sum of all sizes by
    weight; one stops at ``most`` times its source's size and the excess is shared anew. Sources are numbered within
    sorted ranges, so that any number of them is no window of one task.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("__rows"))
    ordered = by.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(F.col("source").asc_nulls_last())
    # the number's upper bits are the range, the lower 33 the place in it
    by = materialise(ordered.withColumn("__at", F.monotonically_increasing_id()), "sources")
    part, place = F.shiftright("__at", 33), F.expr("__at % 8589934592L")
    ranges = sorted(tuple(r) for r in by.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    before, n = {}, 0
    for p, rows in ranges:
        before[p], n = n, n + rows
    if not ranges:
        return by.select("source", F.col("__at").alias("__sno"), "source_size", "__rows", F.lit(0.0).alias("target"))
    offset = F.create_map(*[F.lit(x).cast("long") for kv in before.items() for x in kv])[part]
    by = by.withColumn("__sno", offset + place + 1)
    by = by.withColumn("__w", F.array(*map(F.lit, weights))[F.pmod(F.col("__sno") - 1, F.lit(len(weights))).cast("int")])
    by = by.withColumn("__cap", F.col("source_size") * F.lit(float(most)))
    level = _level(by)
    return by.select("source", "__sno", "source_size", "__rows", F.least(F.col("__w") * F.lit(level), F.col("__cap")).alias("target"))


def pivot(size: np.ndarray, frac: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, int | None]:
    """Round copy probabilities pairwise in the given order; the place of the one left fractional, if any.

    A pair exchanges words: one document's expected words rise as the other's fall, until one probability is 0 or 1.
    The direction is drawn so that every probability keeps its mean, and the sum of expected words never changes.
    """
    p, draws = frac.tolist(), rng.random(len(frac)).tolist()
    w, held = size.tolist(), None
    for j in range(len(p)):
        if not _WHOLE < p[j] < 1 - _WHOLE:
            p[j] = float(round(p[j]))
            continue
        if held is None:
            held = j
            continue
        i = held
        up = min((1 - p[i]) * w[i], p[j] * w[j])
        down = min(p[i] * w[i], (1 - p[j]) * w[j])
        m = up if draws[j] * (up + down) < down else -down
        p[i] += m / w[i]
        p[j] -= m / w[j]
        held = None
        for k in (i, j):
            if _WHOLE < p[k] < 1 - _WHOLE:
                held = k
            else:
                p[k] = float(round(p[k]))
    return np.array(p), held


def pivot_rest(size: np.ndarray, p: float, rng: np.random.Generator) -> tuple[np.ndarray, int | None]:
    """Like ``pivot`` for documents that all have probability ``p``, each paired in turn with all those after it as one unit.

    The unit keeps one common probability, so it stays a fair partner: with large documents first, each is settled
    by a small shift of the rest, and the one left fractional is small.
    """
    out, draws, rest = np.zeros(len(size)), rng.random(len(size)).tolist(), float(size.sum())
    for k, w in enumerate(size.tolist()):
        if not _WHOLE < p < 1 - _WHOLE:
            out[k:] = round(p)
            return out, None
        rest -= w
        if k == len(size) - 1 or rest <= 0:
            break
        up, down = min((1 - p) * w, p * rest), min(p * w, (1 - p) * rest)
        m = up if draws[k] * (up + down) < down else -down
        own, p = p + m / w, p - m / rest
        if _WHOLE < own < 1 - _WHOLE:
            out[k], out[k + 1 :] = own, round(p)
            return out, k
        out[k] = round(own)
    else:
        return out, None
    out[k] = p
    return out, k


def copies(docs: DataFrame, size: Column | None = None, weights: tuple[float, ...] = (5.0, 2.0, 1.0), most: float = 3.0, seed: int = 42, cell: int = 1000) -> DataFrame:
    """How often the mix takes each row of ``docs``: ``doc_id, source, size, source_size, target, copies, taken`` and row keys.

    Every document of a source is due target / source size copies; the whole part is fixed and the fraction is
    rounded by pivoting. Cells of about ``cell`` rows of one source are rounded in a task each, large documents
    first, each against the rest of its cell; a cell leaves one fractional row at most, and those of ``cell`` cells
    meet pair by pair in the next level's cells, up to one row a source, which is rounded to the nearer side. So a
    source's taken words differ from its target by half the size of one document at most (mostly a small one),
    however many rows a source has, and no task holds a source. Equal rows are dealt to cells each by itself.

    Sizes default to words; rows of size 0 (null, empty or blank text) take the nearer whole number of copies and no
    words. A null source is a source. Ties and repeated rows are interchangeable. Very long texts are counted where they
    lie. Other columns, of any type and name, only enter the row keys. An empty table gives an empty result. Reruns
    agree: cells, order and draws come from hashes and ``seed``.
    """
    spark = docs.sparkSession
    ship(spark)
    size = word_count(F.col("text")) if size is None else size
    # ids travel as text: pandas would turn longs with a null into doubles
    sized = docs.select(F.col("doc_id").cast("string"), "source", size.cast("long").alias("size"), *row_keys(docs))
    rows = materialise(numbered(sized, "__again"), "sizes")
    targets = materialise(source_targets(rows, weights, most), "targets")
    due = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    joined = rows.join(targets.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    joined = joined.withColumn("__due", due).withColumn("copies", F.floor(F.col("__due") + F.lit(_WHOLE)))
    joined = joined.withColumn("__p", F.greatest(F.col("__due") - F.col("copies"), F.lit(0.0)))
    joined = joined.withColumn("__cell", F.pmod(F.xxhash64(F.lit(seed), "__rk1", "__again"), F.ceil(F.col("__rows") / F.lit(cell))))
    fields = joined.schema

    def run(first: bool, last: bool):
        def one(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(["size", "__rk1", "__rk2", "__again"], ascending=[False, True, True, True]).reset_index(drop=True)
            p, w = pdf["__p"].to_numpy(float).copy(), pdf["size"].to_numpy(float)
            p[w == 0] = np.round(p[w == 0])
            key = [seed, int(pdf["__sno"].iloc[0]), int(pdf["__cell"].iloc[0])]
            rng, some = np.random.default_rng(key), int((w > 0).sum())
            p[:some], held = pivot_rest(w[:some], p[0], rng) if first and some else pivot(w[:some], p[:some], rng)
            if last and held is not None:
                p[held] = float(round(p[held]))
            # whole ones move into copies; the one held stays fractional for the next level
            whole = np.ones(len(p), bool)
            if held is not None and not last:
                whole[held] = False
            pdf["copies"] = pdf["copies"] + np.where(whole, p, 0).astype(np.int64)
            pdf["__p"] = np.where(whole, -1.0, p)
            return pdf

        return one

    cells = -(-(targets.agg(F.max("__rows")).first()[0] or 1) // cell)
    done, level = None, joined
    while True:
        out = materialise(level.groupBy("__sno", "__cell").applyInPandas(run(done is None, cells == 1), fields), "rounded")
        part = out.where(F.col("__p") < 0)
        done = part if done is None else done.union(part)
        if cells == 1:
            break
        level = out.where(F.col("__p") >= 0).withColumn("__cell", F.floor(F.col("__cell") / F.lit(cell)))
        cells = -(-cells // cell)
    doc_id = F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id")
    return done.select(doc_id, "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "__rk1", "__rk2")


def mix(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with each row as often as the mix takes it.

    Decisions go back to the texts by row key, so columns may have any type and name. Rows equal in every column are one
    row that is made as often as they are taken together, by a task for every thousand of them. Null, empty and blank
    texts as in ``copies``; an empty table gives an empty one.
    """
    taken = copies(docs, **options).groupBy(*KEYS).agg(F.sum("copies").alias("t"), F.count(F.lit(1)).alias("n"))
    taken = materialise(taken, "copies")
    one, two, t, n, part, again = unused(docs, *KEYS, "__t", "__n", "__part", "__again")
    keyed = docs.select("*", *row_keys(docs, [one, two])).join(taken.toDF(one, two, t, n), [one, two]).where(F.col(t) > 0)
    names = list(map(quoted, docs.columns))
    times = lambda low, high: F.explode(F.sequence(low, high)).alias(again)
    first = F.lit(1).cast("long")
    once = keyed.where(F.col(n) == 1).select(*names, times(first, F.col(t))).select(*names)
    if taken.where("n > 1").isEmpty():
        return once
    more = keyed.where(F.col(n) > 1).dropDuplicates([one, two])
    more = more.withColumn(part, F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"({t} - 1) div 1000L")))).repartition(one, two, part)
    more = more.select(*names, times(first, F.least(F.lit(1000).cast("long"), F.col(t) - F.col(part) * 1000))).select(*names)
    return once.unionByName(more)
