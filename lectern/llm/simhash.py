"""SimHash near-duplicates by a segment-popcount embedding and a grid join."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.graph import connected_components, in_blocks
from lectern.llm.words import KEYS, quoted, row_keys, unused
from lectern.runtime import materialise, ship

#: Segments of two bits; their popcounts (0, 1 or 2) stay packed in place.
SEGMENTS = 32
#: Chances that two random segments have equal popcounts (1/16 + 1/4 + 1/16), and popcounts that differ by one.
SAME_SEGMENT, NEXT_SEGMENT = 0.375, 0.5
#: Vectors that a random one may meet in its range of a coarse grid.
MEETINGS = 64
#: Members of one grid cell that one task compares; larger cells are compared in blocks.
CELL_LIMIT = 4096
_CHUNK = 100_000


def shingle_hashes(text: str | None, width: int, seed: int = 42) -> Iterator[np.ndarray]:
    """Hashes of the shingles of a whole text, in chunks; a text of fewer words is one shingle, and no words give none."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return
    joined, width = b" ".join(words), min(width, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n, digest = len(words) - width + 1, xxhash.xxh64_intdigest
    for lo in range(0, n, _CHUNK):
        hi = min(n, lo + _CHUNK)
        a, b = starts[lo:hi].tolist(), ends[lo + width - 1 : hi + width - 1].tolist()
        yield np.array([digest(joined[i:j], seed) for i, j in zip(a, b)], dtype="<u8")


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """SimHash of a whole text: a bit is 1 if it is set in over half of the shingle hashes. No words: 0."""
    n, set_bits = 0, np.zeros(64, np.int64)
    for h in shingle_hashes(text, width, seed):
        n += len(h)
        set_bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(set_bits * 2 > n, bitorder="little").tobytes(), "little")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def with_fingerprint(rows: DataFrame, text: str = "text", width: int = 3, seed: int = 42) -> DataFrame:
    """``rows`` with its text column replaced by ``__fp`` (the fingerprint's 64 bits as a signed long)."""
    keep = [c for c in rows.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = pa.array([_signed(fingerprint(t.as_py(), width, seed)) for t in b.column(0)], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[1:], fps], names=[*keep, "__fp"])

    ship(rows.sparkSession)
    fields = rows.select(*[f"`{c}`" for c in keep]).schema.add("__fp", "long")
    return rows.select(f"`{text}`", *[f"`{c}`" for c in keep]).mapInArrow(run, fields)


def embedding(fp: F.Column) -> F.Column:
    """The 32 popcounts of the two-bit segments, packed two bits each. Their Manhattan distance never exceeds the Hamming distance."""
    half, pairs = F.shiftrightunsigned(fp, 1), F.lit(0x5555555555555555)
    one = fp.bitwiseXOR(half).bitwiseAND(pairs)
    both = fp.bitwiseAND(half).bitwiseAND(pairs)
    return one.bitwiseOR(F.shiftleft(both, 1))


@dataclass(frozen=True)
class Grid:
    """Cells of the embedding: each of ``masks`` keeps some of its segments, and a vector lies in the cell of what it keeps.

    Vectors at Manhattan distance ``radius`` or less are, under one mask at least, no further apart than ``reach`` (0 or
    1): in one cell, or in cells that differ by one in one count.
    """

    masks: tuple[int, ...]
    reach: int


def _cut(blocks: int, dropped: int) -> tuple[int, ...]:
    """Masks over the packed embedding: every way to leave out ``dropped`` of the blocks."""
    cuts = [round(i * SEGMENTS / blocks) for i in range(blocks + 1)]
    parts = [sum(3 << (2 * s) for s in range(cuts[i], cuts[i + 1])) for i in range(blocks)]
    return tuple(_signed(sum(c)) for c in combinations(parts, blocks - dropped))


def grid_for(n: int, radius: int) -> Grid:
    """The coarsest grid in whose range a random vector meets few others, for ``n`` distinct ones.

    Of a distance of ``radius`` over equal blocks, one block at least holds no more than its share. So one block and then
    two halves with neighbouring cells come first; beyond, as many blocks as the radius are left out and cells are whole.
    """
    for blocks in (1, 2):
        reach, segments = radius // blocks, SEGMENTS // blocks
        near = SAME_SEGMENT**segments * (1 + reach * segments * NEXT_SEGMENT / SAME_SEGMENT)
        if reach <= 1 and n * near <= MEETINGS:
            return Grid(_cut(blocks, blocks - 1), reach)
    for blocks in range(radius + 2, radius + 9):
        if n * SAME_SEGMENT ** (SEGMENTS * (blocks - radius) / blocks) <= 2 or comb(blocks + 1, radius) > 200:
            break
    return Grid(_cut(blocks, radius), 0)


def grid_cells(batches: Iterator[pa.RecordBatch], grid: Grid) -> Iterator[pa.RecordBatch]:
    """The cells ``mask, cell`` in which each vector ``(__fp, embedding)`` meets others: its own, and the neighbours below it.

    Of two cells that differ by one in one count, the vector in the upper cell visits the lower one.
    """
    for b in batches:
        fp, e = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns)
        e = e.view(np.uint64)
        for i, m in enumerate(grid.masks):
            own = e & np.uint64(m & 0xFFFFFFFFFFFFFFFF)
            found, at = [own], [np.arange(len(e))]
            for s in range(SEGMENTS) if grid.reach else ():
                if m >> (2 * s) & 1:
                    some = np.flatnonzero(e >> np.uint64(2 * s) & np.uint64(3))
                    found.append(own[some] - np.uint64(1 << (2 * s)))
                    at.append(some)
            cell, who = np.concatenate(found).view(np.int64), fp[np.concatenate(at)]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cell), i, np.int32)), pa.array(cell), pa.array(who)], names=["mask", "cell", "__fp"])


def _tree(x: np.ndarray, radius: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Edges of a spanning forest of the links among ``x``, breadth first: as many edges as members at most."""
    left, a, b = x, [], []
    while len(left) > 1:
        frontier, left = left[:1], left[1:]
        while len(frontier) and len(left):
            grown = []
            for f in frontier:
                near = _near(f, left, radius)
                if near.any():
                    hit = left[near]
                    left = left[~near]
                    a.append(np.full(len(hit), f, np.uint64))
                    b.append(hit)
                    grown.append(hit)
                    if not len(left):
                        break
            frontier = np.concatenate(grown) if grown else np.empty(0, np.uint64)
    return a, b


_PAIRS = np.uint64(0x5555555555555555)


def _near(f: np.ndarray, g: np.ndarray, radius: int) -> np.ndarray:
    """Manhattan distance of the embeddings as the bound, then the exact Hamming distance for those that pass."""
    one = np.uint64(1)
    e, h = f - ((f >> one) & _PAIRS), g - ((g >> one) & _PAIRS)
    # |a - b| of counts 0, 1, 2 in two bits: their exclusive or is 3 where the counts are 1 and 2, and the distance there is 1
    d = e ^ h
    d = d ^ ((d & (d >> one) & _PAIRS) << one)
    low = np.bitwise_count(d & _PAIRS).astype(np.int64) + 2 * np.bitwise_count((d >> one) & _PAIRS)
    ok = low <= radius
    if ok.any():
        ok &= np.bitwise_count(f ^ g) <= radius
    return ok


def _cell_edges(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links within runs of equal cell in a partition sorted by cell; a run that spans batches is carried over."""

    def links(cells: np.ndarray, x: np.ndarray) -> pa.RecordBatch | None:
        start = np.flatnonzero(np.concatenate(([True], np.any(cells[1:] != cells[:-1], axis=1))))
        length = np.diff(np.concatenate((start, [len(x)])))
        a, b = [], []
        for off in (1, 2, 3):
            for first in range(4 - off):
                s = start[(length <= 4) & (length > first + off)] + first
                if len(s):
                    near = _near(x[s], x[s + off], radius)
                    a.append(x[s][near])
                    b.append(x[s + off][near])
        for s, n in zip(start[length > 4].tolist(), length[length > 4].tolist()):
            p, q = _tree(np.unique(x[s : s + n]), radius)
            a += p
            b += q
        if not a or not sum(map(len, a)):
            return None
        u, v = np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    kept_cells, kept = np.empty((0, 3), np.int64), np.empty(0, np.uint64)
    for batch in batches:
        if not batch.num_rows:
            continue
        cells = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns[:3]], axis=1)
        x = batch.column(3).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        cells, x = np.concatenate((kept_cells, cells)), np.concatenate((kept, x))
        tail = len(x) - 1
        differs = np.flatnonzero(np.any(cells[:-1] != cells[-1], axis=1))
        tail = differs[-1] + 1 if len(differs) else 0
        kept_cells, kept = cells[tail:], x[tail:]
        if tail and (out := links(cells[:tail], x[:tail])) is not None:
            yield out
    if len(kept) and (out := links(kept_cells, kept)) is not None:
        yield out


def links(fps: DataFrame, radius: int = 3, cell_limit: int = CELL_LIMIT) -> DataFrame:
    """Edges ``u, v`` between distinct fingerprints (column ``__fp``) that connect all at Hamming distance ``radius`` or less.

    A range join over a grid of the embedding (see ``grid_for``): vectors in range meet in a cell, their Manhattan
    distance bounds the Hamming distance from below, and what passes is compared exactly. Within a cell a spanning
    forest of the exact links comes out, so a large cluster costs as many rows as it has members. A cell of over
    ``cell_limit`` members is cut into blocks, and every two blocks are compared in a group of their own: no link is
    lost and no task holds more than two blocks.
    """
    ship(fps.sparkSession)
    grid = grid_for(fps.count(), radius)
    cells = fps.select("__fp", embedding(F.col("__fp"))).mapInArrow(lambda it: grid_cells(it, grid), "mask int, cell long, __fp long")
    dealt = in_blocks(cells, ["mask", "cell"], "__fp", cell_limit)
    return (
        dealt.select("mask", "cell", "block", "__fp")
        .repartition("mask", "cell", "block")
        .sortWithinPartitions("mask", "cell", "block")
        .mapInArrow(lambda it: _cell_edges(it, radius), "u long, v long")
    )


def near_duplicates(docs: DataFrame, width: int = 3, radius: int = 3, seed: int = 42) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fingerprint, component_id`` and its row keys ``__rk1, __rk2``.

    ``fingerprint`` is 16 lowercase hex digits. ``component_id`` is the smallest doc_id reachable over links of
    ``radius`` or fewer differing bits, the row's own included; null doc_ids are passed over, and a component of
    nulls only has a null id. Null, empty and blank texts have fingerprint zero and link like any other. Repeated
    rows each get a row. Very long texts are hashed in chunks. An empty table gives an empty result. Columns besides
    doc_id and text, of any type and name, only enter the keys.

    Equal fingerprints meet once; a group of any number of copies is one node of the graph.
    """
    keyed = docs.select(F.col("doc_id"), F.col("text"), *row_keys(docs))
    rows = materialise(with_fingerprint(keyed, "text", width, seed), "fingerprints")
    classes = materialise(rows.groupBy("__fp").agg(F.min("doc_id").alias("__first")), "classes")
    roots = connected_components(links(classes.select("__fp"), radius)).withColumnRenamed("node", "__fp")
    rooted = classes.join(roots, "__fp", "left").withColumn("root", F.coalesce("root", "__fp"))
    low = rooted.groupBy("root").agg(F.min("__first").alias("component_id"))
    known = rooted.join(low, "root").select("__fp", "component_id", F.col("root").alias("__root"))
    return rows.join(known, "__fp").select(
        "doc_id", F.lower(F.lpad(F.hex("__fp"), 16, "0")).alias("fingerprint"), "component_id", "__rk1", "__rk2", "__root"
    )


def keep_one(docs: DataFrame, width: int = 3, radius: int = 3, seed: int = 42) -> DataFrame:
    """``docs`` with one row of each component of ``near_duplicates``; see ``keep_first`` for which, and for odd rows."""
    return keep_first(docs, materialise(near_duplicates(docs, width, radius, seed), "components"))


def keep_first(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``docs`` with one row of each ``__root`` of ``rows``: that of the smallest doc_id (null last), ties by row hash.

    ``rows`` has a ``doc_id, __rk1, __rk2, __root`` for each row of ``docs`` and is read several times.
    Only the losers' keys travel to the texts; repeated rows equal in every column are merged by those keys, in which
    nulls and their places count. Columns may have any type and name. Null, empty, blank and very long texts are kept
    or dropped as their root says. An empty table gives an empty one.
    """
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("__rk1"), F.col("__rk2"))
    best = rows.groupBy("__root").agg(F.min(order).alias("__b"))
    # written first, so that the join below shuffles both sides anew and a large component can be split
    best = materialise(best.select("__root", F.col("__b.__rk1").alias("__b1"), F.col("__b.__rk2").alias("__b2")), "best")
    losers = (
        rows.join(best, "__root")
        .where((F.col("__rk1") != F.col("__b1")) | (F.col("__rk2") != F.col("__b2")))
        .select("__rk1", "__rk2")
        .distinct()
    )
    one, two = unused(docs, *KEYS)
    keyed = docs.select("*", *row_keys(docs, [one, two]))
    kept = keyed.join(losers.toDF(one, two), [one, two], "left_anti")
    again = rows.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not again.isEmpty():
        kept = kept.dropDuplicates([one, two])
    return kept.select(*map(quoted, docs.columns))
