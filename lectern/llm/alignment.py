"""Token by token alignment of two tokenizers over a corpus."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.pieces import by_size, segments
from lectern.llm.pieces import tokenizer as pieces
from lectern.llm.words import vocabulary
from lectern.runtime import materialise, ship

#: Room for batch numbers within one partition.
_PART = 1 << 32


class Ranked:
    """A byte-level vocabulary of ranks; its ids, and each id's bytes. No string is special."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encode = tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for b, i in ranks.items():
            self.bytes_of[i] = b


class Aligner:
    """Cuts texts into groups of A and B tokens at the byte offsets where both end."""

    def __init__(self, a: str, b: str):
        self.a, self.b = Ranked(vocabulary(a)), pieces(b)
        self.a_size, self.b_size = (np.array([len(x) for x in t.bytes_of], np.int64) for t in (self.a, self.b))
        self.most = max(len(self.a_size), len(self.b_size))
        #: An id's text before another of its side, before the other side, and before the next group.
        self.written = [f"{i}{end}" for end in ",|;" for i in range(self.most)]

    def stretches(self, texts: list[str | None]) -> list[list[tuple[np.ndarray, np.ndarray]] | None]:
        """A and B ids of texts with a space before them, in stretches that end together; none where their bytes are not the text's.

        B reads all texts together, so that chunks new to its table are merged in one go.
        """
        parts = [list(segments(t)) if t else [] for t in texts]
        mine = iter(self.b.encode_all([p for some in parts for p in some]))
        out: list[list[tuple[np.ndarray, np.ndarray]] | None] = []
        for some in parts:
            found, ids = [], [next(mine) for _ in some]
            for part, b in zip(some, ids):
                data = f" {part}".encode()
                a = self.a.encode(f" {part}")
                if b"".join(map(self.a.bytes_of.__getitem__, a)) != data or b"".join(map(self.b.bytes_of.__getitem__, b)) != data:
                    break
                found.append((np.array(a, np.int64), np.array(b, np.int64)))
            out.append(found if found and len(found) == len(some) else None)
        return out

    def align(self, text: str | None) -> tuple[int, int, np.ndarray, str]:
        return self.align_all([text])[0]

    def align_all(self, texts: list[str | None]) -> list[tuple[int, int, np.ndarray, str]]:
        """For each text the numbers of A and B tokens, the linked pairs (B id in the upper half), and the hash of the groups."""
        return list(map(self._aligned, self.stretches(texts)))

    def _aligned(self, found: list[tuple[np.ndarray, np.ndarray]] | None) -> tuple[int, int, np.ndarray, str]:
        if found is None:
            return 0, 0, np.zeros(0, np.int64), ""
        digest, links, n_a, n_b = hashlib.sha256(), [], 0, 0
        for x, (a, b) in enumerate(found):
            a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
            at = np.searchsorted(b_end, a_end)
            last_a = np.flatnonzero(b_end[at] == a_end)  # every token has bytes, so a group's last tokens are its one link
            last_b = at[last_a]
            links.append(b[last_b] << 32 | a[last_a])
            # A's tokens of a group, then B's: each is moved by the other side's tokens before it
            group_a, group_b = np.searchsorted(last_a, np.arange(len(a))), np.searchsorted(last_b, np.arange(len(b)))
            order = np.empty(len(a) + len(b), np.int64)
            a_text, b_text = a.copy(), b.copy()
            a_text[last_a] += self.most
            b_text[last_b] += 2 * self.most
            order[np.arange(len(a)) + np.concatenate(([0], last_b + 1))[group_a]] = a_text
            order[np.arange(len(b)) + (last_a + 1)[group_b]] = b_text
            groups = "".join(map(self.written.__getitem__, order.tolist()))
            digest.update((groups if x + 1 < len(found) else groups[:-1]).encode())
            n_a, n_b = n_a + len(a), n_b + len(b)
        return n_a, n_b, np.concatenate(links), digest.hexdigest()


_LOADED: dict[tuple[str, str], Aligner] = {}


def aligner(a: str, b: str) -> Aligner:
    """One pair of tokenizers for each Python worker."""
    if (a, b) not in _LOADED:
        _LOADED[a, b] = Aligner(a, b)
    return _LOADED[a, b]


def pack_postings(pair: np.ndarray, doc: np.ndarray, times: np.ndarray) -> bytes:
    """Postings sorted by pair, then document: each pair once with its number of documents, compressed."""
    first = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
    keys, n = pair[first], np.diff(np.concatenate((first, [len(pair)])))
    head = np.array([len(keys), len(pair)], np.int64).tobytes()
    body = np.diff(keys, prepend=0).tobytes() + n.astype(np.int32).tobytes() + doc.astype(np.int32).tobytes() + times.astype(np.int32).tobytes()
    return head + pa.compress(body, "zstd", asbytes=True)


def unpack_postings(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs, each one's number of postings, and the postings' documents and multiplicities."""
    k, n = np.frombuffer(data, np.int64, 2).tolist()
    body = pa.decompress(data[16:], decompressed_size=12 * k + 8 * n, codec="zstd", asbytes=True)
    per = np.frombuffer(body, np.int32, offset=8 * k)
    return np.cumsum(np.frombuffer(body, np.int64, k)), per[:k], per[k : k + n], per[k + n :]


def postings(docs: DataFrame, a: str, b: str, buckets: int, batch_bytes: int = 4 << 20, batch_docs: int = 4096) -> DataFrame:
    """Documents aligned a batch at a time: a row for each document, and for each batch and bucket of B ids one of its postings.

    A document has ``batch, idx, doc_id, n_a, n_b, n_groups, n_links, groups_sha256``, its postings lie in ``bucket, postings``.
    """
    names = ["batch", "idx", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "bucket", "postings"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.binary()]

    def rows(columns: dict[str, list]) -> pa.RecordBatch:
        n = len(columns["batch"])
        return pa.RecordBatch.from_arrays([pa.array(columns.get(c, [None] * n), k) for c, k in zip(names, kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align, serial = aligner(a, b), TaskContext.get().partitionId() * _PART
        held: list[tuple] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            n = len(held)
            columns = list(zip(*held))
            links: list[np.ndarray] = list(columns[3])
            number = [len(x) for x in links]
            yield rows({"batch": [serial] * n, "idx": list(range(n)), "doc_id": list(columns[0]), "n_a": list(columns[1]), "n_b": list(columns[2]),
                        "n_groups": number, "n_links": number, "groups_sha256": list(columns[4])})
            pair, doc = np.concatenate(links), np.repeat(np.arange(n), number)
            order = np.lexsort((doc, pair))
            pair, doc = pair[order], doc[order]
            first = np.flatnonzero(np.concatenate(([True], (pair[1:] != pair[:-1]) | (doc[1:] != doc[:-1])))[: len(pair)])
            times, pair, doc = np.diff(np.concatenate((first, [len(pair)]))), pair[first], doc[first]
            bucket = (pair >> 32) % buckets
            for k in np.unique(bucket).tolist():
                at = bucket == k
                yield rows({"batch": [serial], "bucket": [k], "postings": [pack_postings(pair[at], doc[at], times[at])]})

        for batch in batches:
            rows_in = ((d, t.as_py() or "") for d, t in zip(batch.column(0).to_pylist(), batch.column(1)))
            for part in by_size(rows_in, 1 << 20):
                made = align.align_all([t for _, t in part])
                for (doc, text), (n_a, n_b, links, groups) in zip(part, made):
                    held.append((doc, n_a, n_b, links, groups))
                    size += len(text)
                    if size >= batch_bytes or len(held) >= batch_docs:
                        yield from flush()
                        held, size, serial = [], 0, serial + 1
        if held:
            yield from flush()
        align.b.known.clear()  # an idle worker, which later stages share, holds none

    schema = "batch long, idx int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, bucket int, postings binary"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def pair_counts(found: DataFrame, buckets: int, per_row: int = 1 << 16) -> DataFrame:
    """``bucket, pairs, counts``: how often each pair of ids is linked in the whole corpus, in sorted stretches of a bucket's pairs."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data in b.column(0):
                pair, n, _, times = unpack_postings(data.as_py())
                total = np.add.reduceat(times.astype(np.int64), np.cumsum(n) - n)
                yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(total)], names=["pair", "n"])

    def stretch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bucket = b.column(0).to_numpy()
            for k in np.unique(bucket).tolist():
                at = np.flatnonzero(bucket == k)
                lo, hi = int(at[0]), int(at[-1]) + 1  # sorted by bucket
                for x in range(lo, hi, per_row):
                    part = [c.slice(x, min(per_row, hi - x)).to_numpy().astype("<i8").tobytes() for c in b.columns[1:]]
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), *(pa.array([p], pa.binary()) for p in part)], names=["bucket", "pairs", "counts"])

    counted = found.where("bucket is not null").select("postings").mapInArrow(each, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counted = counted.select((F.shiftright("pair", 32) % buckets).cast("int").alias("bucket"), "pair", "n")
    ordered = counted.repartition("bucket").sortWithinPartitions("bucket", "pair")
    return materialise(ordered.mapInArrow(stretch, "bucket int, pairs binary, counts binary"), "counts")


def contributions(found: DataFrame, counts: DataFrame, parts: int) -> DataFrame:
    """``batch, idx, n_best, count_sum``: what the pairs of each bucket add to each document.

    Counts and postings meet by bucket of B ids, a bucket's postings in ``parts`` groups by batch, each of which gets the
    bucket's counts. Both come as one stream, sorted by Spark, which spills: first the counts, of which the maximum of
    each B id is taken, then the postings, a batch at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, pairs, counts, best = None, [], [], None
        for b in batches:
            for bucket, part, batch, keys, values in zip(*(c.to_pylist() for c in b.columns)):
                if at != (bucket, part):
                    at, pairs, counts, best = (bucket, part), [], [], None
                if batch is None:
                    pairs.append(np.frombuffer(keys, "<i8"))
                    counts.append(np.frombuffer(values, "<i8"))
                    continue
                if best is None:
                    pair, count = np.concatenate(pairs), np.concatenate(counts)
                    order = np.argsort(pair)
                    pair, count = pair[order], count[order]
                    side = pair >> 32
                    first = np.flatnonzero(np.concatenate(([True], side[1:] != side[:-1])))
                    most = np.maximum.reduceat(count, first)
                    best = count == np.repeat(most, np.diff(np.concatenate((first, [len(pair)]))))
                key, n, doc, times = unpack_postings(values)
                where = np.searchsorted(pair, key)
                times, where = times.astype(np.int64), np.repeat(where, n)
                docs, place = np.unique(doc, return_inverse=True)
                n_best, total = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
                np.add.at(n_best, place, times * best[where])
                np.add.at(total, place, times * count[where])
                columns = [pa.array(np.full(len(docs), batch)), pa.array(docs.astype(np.int32)), pa.array(n_best), pa.array(total)]
                yield pa.RecordBatch.from_arrays(columns, names=["batch", "idx", "n_best", "count_sum"])

    none = F.lit(None)
    part = F.pmod(F.xxhash64("batch"), F.lit(parts)).cast("int").alias("part")
    post = found.where("bucket is not null").select("bucket", part, "batch", none.cast("binary").alias("keys"), F.col("postings").alias("vals"))
    every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    total = counts.select("bucket", every, none.cast("long").alias("batch"), F.col("pairs").alias("keys"), F.col("counts").alias("vals"))
    stream = total.unionByName(post).repartition("bucket", "part").sortWithinPartitions("bucket", "part", F.col("batch").asc_nulls_first())
    return stream.mapInArrow(run, "batch long, idx int, n_best long, count_sum long")


def align(docs: DataFrame, a: str, b: str, buckets: int = 64, batches_per_part: int = 256) -> DataFrame:
    """Each row of ``docs`` with its aligned tokens in numbers: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    ``a`` is a byte-level vocabulary of ranks that reads a text with a space before it, ``b`` a merge-type one that adds its own.
    Groups end where tokens of both end at one byte; the tokens that end there are linked. A pair's count is how many
    links of the whole corpus hold it; ``n_best`` are a document's links whose count no pair of the same B id exceeds,
    ``count_sum`` sums the counts over its links.

    Postings, a document's pairs and how often it holds each, are shuffled by B id in buckets, in batches of documents; a bucket is
    split by batch, so that neither a frequent id nor a large corpus makes a group that one task must hold. A task holds the counts of
    one bucket's pairs and one batch.

    A text that is null or empty, or whose tokens' bytes do not join to a space and the text (one that holds U+2581), has no tokens: zeros
    and an empty hash. Very long texts are encoded in stretches. Repeated rows count as often as they come, null and repeated ids are kept, other columns
    are ignored, and an empty table gives an empty result.
    """
    ship(docs.sparkSession)
    found = materialise(postings(docs, a, b, buckets), "postings")
    batches = found.where("idx = 0").count()
    made = contributions(found, pair_counts(found, buckets), -(-max(batches, 1) // batches_per_part))
    summed = made.groupBy("batch", "idx").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    rows = found.where("bucket is null").select("batch", "idx", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return rows.join(summed, ["batch", "idx"], "left").select("doc_id", "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"), "groups_sha256")
