"""Proportional stratified interleaving of sources over shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.words import KEYS, numbered, row_keys, unused
from lectern.runtime import materialise


def _ranked(rows: DataFrame, by: list[str], bucket: Column, bits: int, order: list[Column], name: str) -> DataFrame:
    """``rows`` with ``name``: their rank from 0 within ``by``, in an order that ``bucket`` (``bits`` bits, ascending) agrees with.

    Counts of buckets give each bucket's offset, over two levels: buckets within their upper half's group, and groups.
    So a window over counts holds about the root of the number of buckets, and rows are sorted within a bucket only.
    """
    bucketed = rows.withColumn("__b", bucket)
    sizes = bucketed.groupBy(*by, "__b").agg(F.count(F.lit(1)).alias("__n"))
    sizes = materialise(sizes.withColumn("__u", F.shiftright("__b", bits // 2)), "sizes")
    upto = lambda w: F.coalesce(F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    upper = sizes.groupBy(*by, "__u").agg(F.sum("__n").alias("__n"))
    upper = upper.select(*by, "__u", upto(Window.partitionBy(*by).orderBy("__u")).alias("__far"))
    near = sizes.withColumn("__near", upto(Window.partitionBy(*by, "__u").orderBy("__b")))
    offsets = near.join(upper, [*by, "__u"]).select(*by, "__b", (F.col("__near") + F.col("__far")).alias("__before"))
    local = F.row_number().over(Window.partitionBy(*by, "__b").orderBy(*order)) - 1
    return bucketed.withColumn("__i", local).join(offsets, [*by, "__b"]).withColumn(name, F.col("__i") + F.col("__before")).drop("__b", "__i", "__before")


def assign(docs: DataFrame, shards: int = 24, seed: int = 42, rows_per_bucket: int = 2000) -> DataFrame:
    """Place every row of ``docs``: ``doc_id, source, size, text_crc32, shard, slot`` and row keys.

    Rows are shuffled within their source by a seeded hash; a row's rank there, plus a start
    between 0 and 1 hashed from the source, over the source's count is its fractional rank. In the order of fractional ranks every stretch holds the sources in the corpus's proportions, so
    equal cuts of that order give shards whose row counts differ by one at most and which all match the mixture.
    ``slot`` is the place within the shard, from 0 without gaps.

    ``size`` is the text's UTF-8 bytes (null: none) plus 8, ``text_crc32`` the unsigned CRC-32 of those bytes. A null
    source is a source; null, empty and very long texts and null ids are placed like any other. Repeated rows are told
    apart by a number and spread like different ones. Fewer rows than shards leave shards empty. An empty table gives
    an empty result. Other columns, of any type and name, only enter the keys.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", "source", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), *row_keys(docs))
    rows = numbered(rows, "__again").withColumn("__h", F.xxhash64(F.lit(seed), *KEYS, "__again"))
    rows = rows.withColumn("__s", F.struct(F.col("source").isNull().alias("a"), F.coalesce("source", F.lit("")).alias("b")))
    rows = materialise(rows, "rows")
    counts = rows.groupBy("__s").agg(F.count(F.lit(1)).alias("__of"))
    total = rows.count()
    if not total:
        none = F.lit(None)
        return rows.select("doc_id", "source", "size", "text_crc32", none.cast("int").alias("shard"), none.cast("long").alias("slot"), *KEYS)
    # the hash's top bits: every source spreads evenly over as many buckets as the largest may need
    bits = max(0, (total // rows_per_bucket).bit_length())
    top = F.shiftright(F.col("__h"), 64 - bits) if bits else F.lit(0).cast("long")
    ranked = _ranked(rows, ["__s"], top, bits, [F.col("__h"), *map(F.col, KEYS), F.col("__again")], "__rank")
    # each source starts at a place of its own, so that many small sources do not meet at one rank
    start = F.pmod(F.xxhash64(F.lit(seed), "__s"), F.lit(1 << 20)) / float(1 << 20)
    ranked = ranked.join(counts, "__s").withColumn("__f", (F.col("__rank") + start) / F.col("__of"))
    ranked = materialise(ranked.select("doc_id", "source", "size", "text_crc32", *KEYS, "__again", "__h", "__s", "__f"), "ranked")
    bucket = F.floor(F.col("__f") * F.lit(1 << bits))
    placed = _ranked(ranked.withColumn("__one", F.lit(1)), ["__one"], bucket, bits, [F.col("__f"), F.col("__h"), *map(F.col, KEYS), F.col("__again")], "__at")
    shard = F.expr(f"(__at * {shards}) div {total}L")
    placed = placed.withColumn("shard", shard.cast("int"))
    first = F.expr(f"(cast(shard as long) * {total}L + {shards - 1}) div {shards}")
    return placed.select("doc_id", "source", "size", "text_crc32", "shard", (F.col("__at") - first).cast("long").alias("slot"), *KEYS)


def write_shards(docs: DataFrame, path: str, shards: int = 24, seed: int = 42) -> None:
    """Write ``docs`` as Parquet in folders ``shard=0`` to ``shard=<shards - 1>``, each file sorted by ``slot``.

    A shard is written by several tasks, each a range of its slots, so that no task holds a shard. Columns of ``docs``
    named shard or slot are replaced. Rows equal in every column are interchangeable: of each such group one row meets
    all its places.
    """
    plan = materialise(assign(docs, shards, seed).select(*KEYS, "shard", "slot"), "plan")
    one, two = unused(docs, *KEYS)
    rows = docs.select("*", *row_keys(docs, [one, two])).drop("shard", "slot")
    if not plan.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        rows = rows.dropDuplicates([one, two])
    both = rows.join(plan.toDF(one, two, "shard", "slot"), [one, two]).drop(one, two)
    both.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
