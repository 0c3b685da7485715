"""Near copies by shingle similarity: SimHash links and MinHash bands give the candidates, exact shingle sets decide.

SimHash alone cannot: at a similarity of 0.8 half of all pairs differ in more than 7 of 64 bits, a radius at which a grid
holds most of the corpus in range of every document. So its links of ``RADIUS`` bits come first, and bands find the rest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm.graph import connected_components, in_blocks
from lectern.llm.simhash import keep_first, shingle_hashes
from lectern.llm.simhash import links as simhash_links
from lectern.llm.words import KEYS, row_keys
from lectern.runtime import materialise, ship

#: Texts that agree in all ``DEPTH`` minima of one of ``BANDS`` bands are candidates: at similarity 0.8 all but 3 in a million pairs.
BANDS, DEPTH = 32, 5
#: Minima of 160 that may differ (in four bits each) in a pair worth an exact check: at similarity 0.8 the mean is 30, the deviation 5.
DIFFER = 56
#: Bits in which the fingerprints of first candidates may differ.
RADIUS = 3
#: Members of one band that one task compares; larger bands are compared in blocks.
BAND_LIMIT = 512
#: Rows that come to Python at once where they hold texts or shingle sets; the session's own number is for narrow ones.
WIDE_ROWS = 500
_RNG = np.random.default_rng(42)
_TIMES = _RNG.integers(0, 1 << 63, BANDS * DEPTH).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _RNG.integers(0, 1 << 63, BANDS * DEPTH).astype(np.uint64)
_CHUNK = 512


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """The sorted distinct shingle hashes of a whole text."""
    found = [np.unique(h) for h in shingle_hashes(text, width)]
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.uint64)


def band_keys(shingles: np.ndarray) -> tuple[list[int], list[int]]:
    """A hash for each band over its minima, and the minima's last four bits, 16 a number; none for an empty set."""
    if not len(shingles):
        return [], []
    low = np.full(BANDS * DEPTH, (1 << 64) - 1, np.uint64)
    for i in range(0, len(shingles), _CHUNK):
        np.minimum(low, (shingles[i : i + _CHUNK, None] * _TIMES + _PLUS).min(axis=0), out=low)
    b, size = low.tobytes(), 8 * DEPTH
    keys = [xxhash.xxh64_intdigest(b[i * size : (i + 1) * size], i) for i in range(BANDS)]
    bits = (low >> np.uint64(32) & np.uint64(15)).reshape(-1, 16) << np.arange(0, 64, 4, dtype=np.uint64)
    return np.array(keys, np.uint64).view(np.int64).tolist(), np.bitwise_or.reduce(bits, axis=1).view(np.int64).tolist()


def simhash_of(shingles: np.ndarray) -> int:
    """SimHash of the set, as a signed number: a bit is 1 if it is set in over half of the hashes."""
    set_bits = np.zeros(64, np.int64)
    for i in range(0, len(shingles), 100_000):
        part = np.ascontiguousarray(shingles[i : i + 100_000], "<u8").view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(set_bits * 2 > len(shingles), bitorder="little").tobytes(), "little", signed=True)


@contextmanager
def _wide_rows(spark: SparkSession) -> Iterator[None]:
    """What is written inside passes rows to Python in batches of ``WIDE_ROWS``, so that a worker holds few texts or sets."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    own = spark.conf.get(name)
    spark.conf.set(name, str(min(WIDE_ROWS, int(own)) if int(own) > 0 else WIDE_ROWS))
    try:
        yield
    finally:
        spark.conf.set(name, own)


def _with(rows: DataFrame, types: str, of: Callable[[np.ndarray], tuple], width: int) -> DataFrame:
    """``rows`` with ``text`` replaced by the columns ``types``, which ``of`` makes from its shingle set."""
    keep = [c for c in rows.columns if c != "text"]
    ship(rows.sparkSession)
    added = T.StructType.fromDDL(types)
    schema = T.StructType([*rows.select(*keep).schema, *added])
    names, kinds = added.names, [pa.list_(pa.int64()) if isinstance(f.dataType, T.ArrayType) else pa.int64() for f in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [of(shingle_set(t.as_py(), width)) for t in b.column(0)]
            new = [pa.array([m[i] for m in made], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], *new], names=[*keep, *names])

    return rows.select("text", *keep).mapInArrow(run, schema)


def _node(text: Column) -> Column:
    """The node of a text: its hash; all texts without words are one."""
    return F.when(F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False)), F.xxhash64(text)).otherwise(F.lit(0).cast("long"))


_FOURS = np.uint64(0x1111111111111111)


def _may_be_similar(n: np.ndarray, root: np.ndarray, low: np.ndarray, least: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of members, of different roots, whose sizes and minima allow the similarity."""
    small, large = np.minimum(n[:, None], n[None, :]), np.maximum(n[:, None], n[None, :])
    may = np.triu((root[:, None] != root[None, :]) & (small * least.denominator >= large * least.numerator), 1)
    if may.any():
        differ = np.zeros(may.shape, np.uint8)
        for x in low.T:
            d = x[:, None] ^ x[None, :]
            d |= d >> np.uint64(1)
            d |= d >> np.uint64(2)
            differ += np.bitwise_count(d & _FOURS)
        may &= differ <= DIFFER
    return np.nonzero(may)


def _shared(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs ``i, j``: one by one, or for many pairs as products of 0/1 matrices."""
    if len(i) <= 256:
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i.tolist(), j.tolist())], np.int64)
    used, at = np.unique(np.concatenate((i, j)), return_inverse=True)
    row = np.repeat(np.arange(len(used)), [len(sets[k]) for k in used.tolist()])
    _, column, times = np.unique(np.concatenate([sets[k] for k in used.tolist()]), return_inverse=True, return_counts=True)
    often = times > 1
    number = np.cumsum(often) - 1
    row, column = row[often[column]], number[column[often[column]]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both, width = np.zeros((len(used), len(used)), np.float32), 4096
    for lo in range(0, int(often.sum()), width):
        a, b = np.searchsorted(column, (lo, lo + width))
        part = np.zeros((len(used), width), np.float32)
        part[row[a:b], column[a:b] - lo] = 1
        both += part @ part.T
    return both[at[: len(i)], at[len(i) :]].astype(np.int64)


def _forest(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> Iterator[int]:
    """Places of the pairs that join what no pair before them has joined, roots being joined already."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    for at, (a, b) in enumerate(zip(root[i].tolist(), root[j].tolist())):
        if (a := find(a)) != (b := find(b)):
            parent[a] = b
            yield at


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of equal ``key, block`` of a partition sorted by them."""
    kept: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if kept is None else pa.concat_tables([kept, table]).combine_chunks()
        by = np.stack([table.column(c).to_numpy() for c in ("key", "block")], axis=1)
        starts = np.flatnonzero(np.concatenate(([True], np.any(by[1:] != by[:-1], axis=1)))).tolist()
        for lo, hi in zip(starts, starts[1:]):
            yield table.slice(lo, hi - lo)
        kept = table.slice(starts[-1])
    if kept is not None:
        yield kept


def _lists(t: pa.Table, name: str) -> np.ndarray:
    """A column of lists of one length as a matrix."""
    c = t.column(name).combine_chunks()
    c = c.chunk(0) if isinstance(c, pa.ChunkedArray) else c
    return c.flatten().to_numpy(zero_copy_only=False).reshape(len(c), -1)


def _candidates(t: pa.Table, least: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a run's members that may be similar and share no band before this one."""
    i, j = _may_be_similar(t.column("n").to_numpy(), t.column("root").to_numpy(), _lists(t, "low").view(np.uint64), least)
    if not len(i):
        return i, j
    keys, own = _lists(t, "keys"), t.column("key")[0].as_py()
    band = int(np.flatnonzero(keys[0] == own)[0])
    first = np.concatenate([(keys[i[a : a + 65536]] == keys[j[a : a + 65536]]).argmax(axis=1) for a in range(0, len(i), 65536)])
    return i[first == band], j[first == band]


def _suspects(batches: Iterator[pa.RecordBatch], least: Fraction) -> Iterator[pa.RecordBatch]:
    """The members of a band that are to be compared there, without their block: see ``_candidates``."""
    for t in _runs(batches):
        if t.num_rows > 1:
            found = np.unique(np.concatenate(_candidates(t, least)))
            if len(found):
                yield from t.take(pa.array(found)).drop_columns(["block"]).to_batches()


def _exact_links(batches: Iterator[pa.RecordBatch], least: Fraction) -> Iterator[pa.RecordBatch]:
    """Links ``u, v`` between the roots of a band's similar members; a pair is compared in the first band it shares."""
    num, den = least.numerator, least.denominator
    for t in _runs(batches):
        n, root = t.column("n").to_numpy(), t.column("root").to_numpy()
        i, j = _candidates(t, least) if len(n) > 1 else ((), ())
        if not len(i):
            continue
        sets = [np.array(x, np.int64) for x in t.column("set").to_pylist()]
        similar = _shared(sets, i, j) * (num + den) >= (n[i] + n[j]) * num
        i, j = i[similar], j[similar]
        kept = list(_forest(root, i, j))
        yield pa.RecordBatch.from_arrays([pa.array(root[i[kept]]), pa.array(root[j[kept]])], names=["u", "v"])


def _sorted(dealt: DataFrame) -> DataFrame:
    """Members that have a block, so that each band, or pair of its blocks, is a run of one sorted partition."""
    return dealt.repartition("key", "block").sortWithinPartitions("key", "block")


def _in_order(members: DataFrame) -> DataFrame:
    """Members dealt to blocks and sorted."""
    return _sorted(in_blocks(members, ["key"], "node", BAND_LIMIT))


def _similar(pairs: DataFrame, sets: DataFrame, similarity: Fraction) -> DataFrame:
    """The pairs ``u, v`` whose shingle sets have at least that Jaccard similarity, by whole numbers only."""
    both = F.size(F.array_intersect("a", "b"))
    num, den = similarity.numerator, similarity.denominator
    enough = both * (num + den) >= (F.size("a") + F.size("b")) * num
    return pairs.join(sets.toDF("u", "a"), "u").join(sets.toDF("v", "b"), "v").where(enough).select("u", "v")


def near_copies(docs: DataFrame, width: int = 5, similarity: str = "0.8") -> DataFrame:
    """``doc_id, __rk1, __rk2, __root`` for each row of ``docs``: rows of one root are linked by near copies.

    Two texts are linked if the Jaccard similarity of their sets of ``width``-word shingles is ``similarity`` or more;
    null, empty and blank texts are copies of each other. Very long texts are read whole. Equal texts are one node, so
    repeated rows cost one. Other columns, of any type and name, only enter the keys. An empty table gives an empty result.

    Candidates come from two sides: fingerprints linked by ``simhash.links``, and MinHash bands, in which each member
    is compared with the smallest one. That joins most of a large group at the cost of a row a member. Then members
    that share a band but have different roots are compared in the first one they share, in blocks: by sizes and minima,
    and exactly if these allow the similarity. Of those links, which join roots, a band gives no more than it has members.
    """
    least = Fraction(similarity)
    keyed = docs.select("doc_id", "text", _node(F.col("text")).alias("node"), *row_keys(docs))
    made = lambda s: (len(s), simhash_of(s), *band_keys(s))
    spark = docs.sparkSession
    with _wide_rows(spark):
        rows = materialise(_with(keyed, "n long, fp long, keys array<long>, low array<long>", made, width), "bands")
    members = rows.select("node", "n", F.explode("keys").alias("key"))
    buckets = members.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("top")).where("hub <> top")
    buckets = materialise(buckets.select("key", "hub"), "buckets")
    within = materialise(members.join(buckets, "key").select("key", "hub", "node", "n").distinct(), "members")

    prints = materialise(rows.where("n > 0").groupBy("fp").agg(F.min("node").alias("least")), "prints")
    edges = materialise(simhash_links(prints.select(F.col("fp").alias("__fp")), RADIUS).distinct(), "edges")
    edges = edges.join(prints.toDF("u", "a"), "u").join(prints.toDF("v", "b"), "v").select("a", "b")
    equal = rows.where("n > 0").join(prints, "fp").select("least", "node")
    pairs = within.select("hub", "node").union(edges).union(equal).toDF("u", "v").where("u <> v")
    pairs = materialise(pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "pairs")

    wanted = materialise(within.select("node").union(pairs.select("u")).union(pairs.select("v")).distinct(), "wanted")
    sketches = rows.join(wanted, "node", "left_semi").select("node", "low", "keys").dropDuplicates(["node"])
    texts = docs.select(_node(F.col("text")).alias("node"), "text").join(wanted, "node", "left_semi").dropDuplicates(["node"])
    with _wide_rows(spark):
        sets = materialise(_with(texts, "set array<long>", lambda s: (s.view(np.int64),), width), "sets")
    links = materialise(_similar(pairs, sets, least), "links")
    roots = connected_components(links)

    rooted = within.join(roots, "node", "left").select("key", "node", "n", F.coalesce("root", "node").alias("root"))
    rooted = materialise(rooted, "rooted")
    apart = rooted.groupBy("key").agg(F.min("root").alias("one"), F.max("root").alias("other")).where("one <> other")
    apart = rooted.join(apart.select("key"), "key").join(sketches, "node")
    apart = materialise(apart.select("key", "node", "n", "root", "low", "keys"), "apart")
    suspects = _in_order(apart).mapInArrow(lambda it: _suspects(it, least), apart.schema)
    # a member may be met in several pairs of blocks; written, so that bands are counted without their sets
    suspects = materialise(suspects.dropDuplicates(["key", "node"]), "suspects")
    rest = in_blocks(suspects, ["key"], "node", BAND_LIMIT).join(sets, "node")
    with _wide_rows(spark):
        more = materialise(_sorted(rest).mapInArrow(lambda it: _exact_links(it, least), "u long, v long"), "links")
    if not more.isEmpty():
        tops = materialise(connected_components(more), "tops")
        joined = roots.join(tops.toDF("root", "top"), "root", "left").select("node", F.coalesce("top", "root").alias("root"))
        roots = joined.union(tops.join(roots, "node", "left_anti").select("node", "root"))
    known = materialise(roots, "roots")
    return rows.join(known, "node", "left").select("doc_id", *KEYS, F.coalesce("root", "node").alias("__root"))


def keep_one(docs: DataFrame, width: int = 5, similarity: str = "0.8") -> DataFrame:
    """``docs`` with one row of each group of ``near_copies``: that of the smallest doc_id (null last), ties by row hash.

    Odd rows as in ``near_copies`` and ``simhash.keep_first``.
    """
    return keep_first(docs, materialise(near_copies(docs, width, similarity), "components"))
