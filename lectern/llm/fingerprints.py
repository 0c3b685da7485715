"""Threshold-scaled document sketches, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.words import GAPS, ascii_lower

#: A row without an id sorts as this one.
_NO_ID = -(1 << 63)


def sketch(text: Column, width: int = 5, scale: int = 8) -> Column:
    """The sorted distinct shingle hashes under 1/``scale`` of the hash range, or the lowest hash if none is.

    Shingles are ``width`` words, A-Z lower-cased; a shorter text is one shingle. A null, empty or blank text has an
    empty sketch. The lowest hash keeps short texts comparable. Sketches of parts merge (see ``merge``).
    """
    cut = F.lit(_NO_ID + (1 << 64) // scale)
    words = F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAPS), lambda w: w != "")

    def hashes(w: Column) -> Column:
        n = F.greatest(F.size(w) - F.lit(width - 1), F.lit(1))
        every = F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(F.slice(w, i, width)))
        return F.when(F.size(w) > 0, every).otherwise(F.array().cast("array<long>"))

    def kept(h: Column) -> Column:
        low = F.filter(h, lambda x: x < cut)
        return F.when(F.size(low) > 0, low).when(F.size(h) > 0, F.array(F.array_min(h))).otherwise(h)

    # each step is bound to a lambda variable, so that it is computed once
    found = F.transform(F.transform(F.array(words), hashes), kept)[0]
    return F.array_sort(F.array_distinct(found))


def merge(a: Column, b: Column, scale: int = 8) -> Column:
    """The sketch of two texts' shingles together, from their sketches."""
    cut = F.lit(_NO_ID + (1 << 64) // scale)

    def kept(h: Column) -> Column:
        low = F.filter(h, lambda x: x < cut)
        return F.when(F.size(low) > 0, low).when(F.size(h) > 0, F.array(F.array_min(h))).otherwise(h)

    return F.array_sort(F.transform(F.array(F.array_union(a, b)), kept)[0])


def containment(a: Column, b: Column) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` has too; two empty sketches give 1, one empty gives 0."""
    n = F.size(a)
    return F.when(n > 0, F.size(F.array_intersect(a, b)) / n).otherwise((F.size(b) == 0).cast("double"))


def likeness(a: Column, b: Column) -> Column:
    """Containment of the smaller sketch in the other, so that a part of a much longer text is like it."""
    n = F.least(F.size(a), F.size(b))
    return F.when(n > 0, F.size(F.array_intersect(a, b)) / n).otherwise((F.size(a) == F.size(b)).cast("double"))


def as_string(s: Column) -> Column:
    """A sketch as text: 16 hex digits a hash, in order."""
    return F.array_join(F.transform(s, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def _longs(values: list[int]) -> Column:
    """A literal array of any length, folded once when the plan is made."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _bucket_of(key: Column, bounds: list[int]) -> Column:
    """Number of bounds at or below ``key``, less 1, by binary search over a literal array."""
    if len(bounds) == 1:
        return F.lit(0)
    array = _longs(bounds)
    steps, s = [], 1
    while s < len(bounds):
        steps.insert(0, s)
        s *= 2

    def down(at: Column, step: Column) -> Column:
        to = at + step
        fits = (to < F.lit(len(bounds))) & (F.get(array, to) <= key)
        return F.when(fits, to).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), down)


def _ranges(docs: DataFrame, n: int, rows_per_bucket: int, most_buckets: int) -> tuple[DataFrame, int]:
    """``docs`` with ``__k``, the number ``__b`` of its range by (doc_id, text hash) and whether it is ``__first`` there; how many.

    Quantiles of doc_id give up to ``most_buckets`` ranges, an id of several quantiles one of its own. Ranges that are
    still large are cut evenly by id and hash, into as many as their rows ask for.
    """
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID))
    buckets = max(1, min(most_buckets, -(-n // rows_per_bucket)))
    cuts = [i / buckets for i in range(buckets)]
    found = docs.select(key.alias("k")).agg(F.min("k").alias("low"), F.percentile_approx("k", cuts, 20 * buckets).alias("cuts")).first()
    hot = {a for a, b in zip(found.cuts, found.cuts[1:]) if a == b and a < (1 << 63) - 1}
    bounds = sorted({found.low, *[c for c in found.cuts if c > found.low], *[c + 1 for c in hot]})
    # one row a range: its actual first and last keys
    held = docs.select(key.alias("k"), _bucket_of(key, bounds).alias("b")).groupBy("b")
    held = sorted(r[1:] for r in held.agg(F.min("k"), F.max("k"), F.count(F.lit(1))).collect())
    lows = [low for low, _, _ in held]
    parts = [-(-c // rows_per_bucket) if c > 2 * rows_per_bucket else 1 for _, _, c in held]
    keyed = docs.withColumn("__k", key).withColumn("__b", _bucket_of(key, lows))
    if max(parts) == 1:
        return keyed.withColumn("__first", F.get(_longs(lows), F.col("__b")) == F.col("__k")), len(lows)
    base = [0]
    for x in parts[:-1]:
        base.append(base[-1] + x)
    of = lambda values: F.get(_longs(values), F.col("__b"))
    low, span, part = of(lows), of([min(high - first, (1 << 63) - 1) for first, high, _ in held]), of(parts)
    # exact while ids are within 2^53 of the first; the hash counts only there
    exact = (F.col("__k") - low).cast("double") + (F.col("__h").cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    place = F.when(span < (1 << 53), exact).otherwise(F.col("__k").cast("double") - low.cast("double"))
    sub = F.least(F.floor(place / (span.cast("double") + 1) * part), part - 1)
    keyed = keyed.withColumn("__g", F.when(part > 1, of(base) + sub).otherwise(of(base)))
    firsts = keyed.groupBy("__g").agg(F.min(F.struct("__k", "__h")).alias("f")).select("__g", "f.*").collect()
    g, k, h = map(list, zip(*sorted(tuple(r) for r in firsts)))
    keyed = keyed.withColumn("__b", _bucket_of(F.col("__g"), g)).drop("__g")
    return keyed.withColumn("__first", (of(k) == F.col("__k")) & (of(h) == F.col("__h"))), len(g)


def with_next(docs: DataFrame, carried: list[str], rows_per_bucket: int = 2000, most_buckets: int = 16384) -> DataFrame:
    """``docs`` with ``next_<c>`` for each carried column: that of the row with the next doc_id, and of the first after the last.

    One shuffle: rows are dealt by ranges of doc_id and text hash (see ``_ranges``), and a range's first row is also sent
    to the range before it. Null ids come first; equal ids are ordered by text hash. An only row follows itself.
    """
    n = docs.count()
    if not n:
        return docs.select("*", *[F.col(c).alias(f"next_{c}") for c in carried])
    names = [f"`{c}`" for c in docs.columns]
    keyed, ranges = _ranges(docs, n, rows_per_bucket, most_buckets)
    before = F.pmod(F.col("__b") - 1, F.lit(ranges))
    own = F.struct(F.col("__b").alias("b"), F.lit(0).alias("s"))
    where = F.when(F.col("__first"), F.array(own, F.struct(before.alias("b"), F.lit(1).alias("s")))).otherwise(F.array(own))
    dealt = keyed.select("*", F.explode(where).alias("__to"))
    window = Window.partitionBy("__to.b").orderBy(F.col("__to.s"), F.col("__k"), F.col("__h"))
    follow = [F.lead(f"`{c}`").over(window).alias(f"next_{c}") for c in carried]
    return dealt.select("*", *follow).where("__to.s = 0").select(*names, *[f"next_{c}" for c in carried])


def fingerprint_edits(docs: DataFrame, width: int = 5, scale: int = 8) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, with likeness to the edited and to the next text.

    The edited text is the text with its last floor(n_chars / 4) code points replaced by the first as many (or all)
    of the next document. Null counts as empty. Empty texts have the empty fingerprint and likeness 1 to each other.
    Repeated rows and equal ids follow each other. An empty table gives an empty result. Other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("__h"), sketch(text, width, scale).alias("sketch"))
    rows = with_next(rows, ["text", "sketch"]).withColumn("n", F.length("text").cast("long"))
    cut = F.floor(F.col("n") / 4).cast("int")
    head = F.substring(F.col("text"), F.lit(1), F.col("n").cast("int") - cut)
    edited = F.concat(head, F.substring(F.col("next_text"), F.lit(1), cut))
    rows = rows.select("doc_id", "n", "sketch", "next_sketch", edited.alias("edited"))
    rows = rows.select("*", sketch(F.col("edited"), width, scale).alias("edited_sketch"))
    return rows.select(
        "doc_id",
        F.col("n").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        as_string(F.col("sketch")).alias("fingerprint"),
        as_string(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )
