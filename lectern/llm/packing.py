"""Bounded-space online packing of token sequences."""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.words import vocabulary
from lectern.runtime import materialise, ship

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Room for sequence numbers within one partition.
_PART = 1 << 38


class WordTokenizer:
    """Token ids of a word-level BPE file, equal to the ``tokenizers`` library's, as little-endian 32-bit bytes.

    No pre-token of this file spans white space, so ids are kept by white-space-delimited chunk. A chunk of common
    characters not seen before goes through a byte-pair encoder over the file's own vocabulary, in which a space
    stands for the word end; any other chunk, and one that holds a special token's string, goes through the library. The
    chunk table is bounded and starts anew when full.
    """

    #: White space as the library's regular expressions know it, of which str.split() differs by U+001C to U+001F.
    _SPACE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
    #: Characters on which Python's and the library's lower-casing, composition and classes agree.
    _COMMON = re.compile(r"[!-~\xa1-\xac\xae-\u012f\u0132-\u017e\u2013\u2014\u2018-\u201d\u2022\u2026\u20ac]*")
    _PRE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_\xb2\xb3\xb9\xbc-\xbe]+|[0-9\xb2\xb3\xb9\xbc-\xbe]|(?:[^\w\s]|_)+")

    def __init__(self, path: str, limit: int = 400_000):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        special = {t.content for t in self.whole.get_added_tokens_decoder().values()}
        byte_of = _byte_alphabet()
        ranks = {}
        for token, i in vocab.items():
            if token not in special:
                end = token.endswith("</w>") and token != "</w>"
                ranks[bytes(byte_of[c] for c in (token[:-4] if end else token)) + b" " * end] = i
        self.pieces = tiktoken.Encoding("word-bpe", pat_str=r"[^ ]+ ", mergeable_ranks=ranks, special_tokens={})
        self.special = re.compile("|".join(map(re.escape, sorted(special))) or "(?!)")
        self.known: dict[str, bytes] = {}
        self.limit = limit

    def chunk(self, c: str) -> bytes:
        if self._COMMON.fullmatch(c) and not self.special.search(c):
            words = self._PRE.findall(unicodedata.normalize("NFC", c).lower())
            ids = self.pieces.encode_ordinary(" ".join(words) + " ") if words else []
        else:
            ids = self.whole.encode(c, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        chunks = text.split() if not re.search("[\x1c-\x1f]", text) else [c for c in self._SPACE.split(text) if c]
        known = self.known
        if len(known) > self.limit:
            known.clear()
        out, lo = [], 0
        while lo < len(chunks):  # a very long text may hold more chunks than the table
            part = chunks[lo : lo + self.limit]
            for c in set(part).difference(known):
                known[c] = self.chunk(c)
            out.append(b"".join(map(known.__getitem__, part)))
            lo += self.limit
            if lo < len(chunks):
                known.clear()
        return b"".join(out)


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use: printable Latin-1 for itself, the rest from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


_LOADED: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One tokenizer for each Python worker."""
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(vocabulary(path))
    return _LOADED[path]


class Packer:
    """Open windows of one stream: best fit, and the fullest goes when none fits, topped up with a cut."""

    def __init__(self, capacity: int, windows: int):
        self.capacity, self.windows = capacity, windows
        self.open: list[tuple[int, int]] = []  # free tokens and serial, sorted
        self.held: dict[int, list] = {}
        self.serial = 0
        self.done: list[list] = []

    def _put(self, at: int, piece: tuple) -> None:
        """Put a piece in the open window at this place; one that is full then goes."""
        free, key = self.open.pop(at)
        self.held[key].append(piece)
        if free == (n := len(piece[2]) // 4):
            self.done.append(self.held.pop(key))
        else:
            insort(self.open, (free - n, key))

    def add(self, doc: object, start: int, ids: bytes, total: int) -> None:
        """``start``: tokens of the document before ``ids``; whole windows go at once, what remains is placed."""
        full = 4 * self.capacity
        at = 0
        while len(ids) - at >= full:
            self.done.append([(doc, start + at // 4, ids[at : at + full], total)])
            at += full
        ids, start = ids[at:], start + at // 4
        while ids:
            n = len(ids) // 4
            at = bisect_left(self.open, (n, -1))
            if at < len(self.open):
                return self._put(at, (doc, start, ids, total))
            if len(self.open) < self.windows:
                self.serial += 1
                self.held[self.serial] = [(doc, start, ids, total)]
                return insort(self.open, (self.capacity - n, self.serial))
            room = self.open[0][0]
            self._put(0, (doc, start, ids[: 4 * room], total))
            ids, start = ids[4 * room :], start + room

    def close(self) -> list[tuple] | None:
        """Merge what is open, the fullest first, into full windows; what is left over, at most one window, is returned."""
        rest = [p for _, key in self.open for p in self.held[key]]
        self.open, self.held, self.windows = [], {}, 1
        for p in rest:
            self.add(*p)
        return next(iter(self.held.values()), None)


def _rows(done: list[list], first: int) -> dict[str, list]:
    cols: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")}
    for i, seq in enumerate(done):
        offset = 0
        for doc, start, ids, total in seq:
            n = len(ids) // 4
            for k, v in zip(cols, (doc, start, n, zlib.crc32(ids), total, first + i, offset)):
                cols[k].append(v)
            offset += n
    return cols


_KINDS = {k: pa.int64() for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")}


def _batch(done: list[list], first: int, left: bool) -> pa.RecordBatch:
    cols = _rows(done, first)
    ids = [p[2] if left else None for seq in done for p in seq]
    arrays = [pa.array(v, _KINDS[k]) for k, v in cols.items()]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(ids, pa.binary())], names=[*cols, "ids"])


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, windows: int = 32, end_id: int = 2, fan_in: int = 64) -> DataFrame:
    """Pack whole documents into sequences of at most ``capacity`` tokens; one row for each piece.

    Each partition keeps ``windows`` open windows. A document's remainder goes to the window that it fits best. When
    none fits and all are open, the fullest is topped up with a cut and goes. At a partition's end its windows are
    merged into full ones, leaving one; those of ``fan_in`` partitions are merged in a task, then those of as many
    such groups, until one group is left. So all sequences but the last hold ``capacity`` tokens.

    Null and empty texts are the end id alone. A special token's string in a text is that token, as the library reads
    it. Repeated rows and ids are packed as often as they come; null ids stay
    null. Very long texts are cut over many sequences. An empty table gives an empty result. Other columns are
    ignored. Sequence ids have gaps and follow the input's partitions.
    """
    spark = docs.sparkSession
    ship(spark)
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        tok, packer, made = tokenizer(tokenizer_path), Packer(capacity, windows), part * _PART
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                text = text.as_py()
                ids = (tok.encode(text) if text else b"") + end
                packer.add(doc, 0, ids, len(ids) // 4)
                if len(packer.done) >= 500:
                    yield _batch(packer.done, made, False)
                    made += len(packer.done)
                    packer.done = []
        tok.known.clear()  # an idle worker, which later stages share, holds none
        left = packer.close()
        yield _batch(packer.done, made, False)
        if left:
            yield _batch([left], made + len(packer.done), True)

    def merge(table: pa.Table) -> pa.Table:
        # Arrow throughout: pandas would turn ids beside a null into doubles
        rows = table.select([*_KINDS, "ids"]).sort_by([("sequence_id", "ascending"), ("offset", "ascending")]).to_pylist()
        packer = Packer(capacity, 1)
        for r in rows:
            packer.add(r["doc_id"], r["start"], r["ids"], r["doc_tokens"])
        left = packer.close()
        free = sorted({r["sequence_id"] for r in rows})
        out = [_batch([s], free.pop(0), False) for s in packer.done]
        if left:
            out.append(_batch([left], free.pop(0), True))
        return pa.Table.from_batches(out)

    first = materialise(docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, f"{PIECE}, ids binary"), "pieces")
    pieces = [c.split()[0] for c in PIECE.split(", ")]
    out, left = first.where("ids is null").select(*pieces), first.where("ids is not null")
    groups = (first.agg(F.max("sequence_id")).first()[0] or 0) // _PART + 1
    width = _PART
    while groups > 1:
        width, groups = width * fan_in, -(-groups // fan_in)
        group = F.expr(f"sequence_id div {width}L")
        merged = materialise(left.groupBy(group.alias("g")).applyInArrow(merge, f"{PIECE}, ids binary"), "leftovers")
        out, left = out.union(merged.where("ids is null").select(*pieces)), merged.where("ids is not null")
    return out.union(left.select(*pieces))
