"""SentencePiece encoding and decoding with merge-type vocabularies."""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.words import vocabulary
from lectern.runtime import ship

SPACE = "▁"
#: Bytes that are no UTF-8 become a replacement character each.
codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


def segments(text: str, size: int = 1 << 20) -> Iterator[str]:
    """``text`` cut at single spaces between ASCII letters, about every ``size`` characters; the spaces at the cuts are left out.

    No token of the tokenizers here spans such a place but for one that begins with the space. A text without one is not cut.
    """
    lo = 0
    while len(text) - lo > size:
        m = _CUT.search(text, lo + size)
        if not m:
            break
        yield text[lo : m.start()]
        lo = m.end()
    yield text[lo:] if lo else text


_CUT = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")


def _words(part: str) -> list[str]:
    """A text, with a space before it, cut before every first space of a run; that space is left out."""
    if "  " in part or part[:1] == " " or part[-1:] == " " or not part:
        return [w[1:] for w in re.findall(r" +[^ ]*", " " + part)]
    return part.split(" ")


class Mismatch(ValueError):
    """Ids or a text that differ from the library's."""


class _Pairs:
    """What two adjacent pieces make and how that scores, for arrays of pairs: a hash table with linear probing."""

    def __init__(self, id_of: dict[str, int], score: dict[str, float], n: int):
        made = [(id_of[p[:i]] * n + id_of[p[i:]], id_of[p], score[p]) for p in id_of for i in range(1, len(p)) if p[:i] in id_of and p[i:] in id_of]
        self.n, bits = n, max(4, (4 * len(made)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        #: Equal scores have equal ranks; 0 is no pair.
        rank = {v: i for i, v in enumerate(sorted({m[2] for m in made}), 1)}
        self.keys = np.full(1 << bits, -1, np.int64)
        self.made, self.rank = np.zeros(1 << bits, np.int32), np.zeros(1 << bits, np.int32)
        slots = self._slot(np.array([m[0] for m in made], np.int64)).tolist()
        taken: dict[int, int] = {}
        for at, m in zip(slots, made):
            while at in taken:
                at = (at + 1) & self.mask
            taken[at] = 1
            self.keys[at], self.made[at], self.rank[at] = m[0], m[1], rank[m[2]]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Places in ``made`` and ``rank``; one of an empty slot where there is no such pair."""
        keys = left.astype(np.int64) * self.n + right
        at = self._slot(keys)
        while True:
            held = self.keys[at]
            other = (held != keys) & (held != -1)
            if not other.any():
                return at
            at[other] = (at[other] + 1) & self.mask


class PieceTokenizer:
    """Ids of a merge-type vocabulary, equal to the ``sentencepiece`` library's, and texts of ids.

    Adjacent symbols, at first characters, are merged by an agenda: the pair whose piece scores best goes first, of equal
    scores the leftmost; what it makes is offered again with its neighbours. Characters outside the vocabulary are
    spelled in bytes. No merge crosses two characters that are adjacent in no piece, so a text is cut there, and ids are kept by
    space-delimited chunk in a bounded table where no piece holds a space after another character.
    """

    #: Longer chunks are not kept, so the table's bytes are bounded too.
    _KEPT = 64
    #: Chunks of up to so many symbols are merged together, in arrays.
    _FEW = 32

    def __init__(self, path: str, limit: int = 400_000):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.id_of = {names[i]: i for i in plain}
        self.score = {names[i]: sp.get_score(i) for i in plain}
        self.byte_id = {int(names[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        if len(self.byte_id) != 256:
            raise ValueError("a vocabulary without pieces for all bytes")
        self.adjacent = {p[i : i + 2] for p in self.id_of for i in range(len(p) - 1)}
        if any(SPACE in p.lstrip(SPACE) for p in self.id_of):
            raise ValueError("a vocabulary whose pieces hold spaces after other characters")
        #: A token's bytes within the text: spaces for their marks, bytes for byte pieces.
        self.bytes_of = [b""] * n
        for p, i in self.id_of.items():
            self.bytes_of[i] = p.replace(SPACE, " ").encode()
        for b, i in self.byte_id.items():
            self.bytes_of[i] = bytes([b])
        self.unknown = {i for i in range(n) if sp.is_unknown(i)}
        self.odd = self.unknown | {i for i in range(n) if sp.is_control(i)}
        self.marked = {i for p, i in self.id_of.items() if p[0] == SPACE}
        self.pairs = _Pairs(self.id_of, self.score, n)
        #: A character's id: its piece, its byte if it is one, else -2.
        self.first = np.full(0x110000, -2, np.int32)
        for b in range(128):
            self.first[b] = self.byte_id[b]
        for p, i in self.id_of.items():
            if len(p) == 1:
                self.first[ord(p)] = i
        self.known: dict[str, tuple[int, ...]] = {}
        self.limit = limit

    def chunks(self, words: list[str]) -> list[tuple[int, ...]]:
        """``chunk`` of each word. The agendas of short ones are rows of arrays: in each round every row makes its best merge."""
        out: list[tuple[int, ...] | None] = [None] * len(words)
        size = np.array([len(w) for w in words]) + 1
        for low, high in pairwise((0, 6, 9, 13, 20, self._FEW)):
            at = np.flatnonzero((size > low) & (size <= high))
            for some in np.array_split(at, -(-len(at) // 20_000)) if len(at) else ():
                for i, ids in zip(some.tolist(), self._rows([words[i] for i in some.tolist()], size[some], high)):
                    out[i] = ids
        return [self.chunk(w) if ids is None else ids for w, ids in zip(words, out)]

    def _rows(self, words: list[str], size: np.ndarray, width: int) -> list[tuple[int, ...] | None]:
        """Ids of chunks of at most ``width`` symbols; none for one with characters spelled in several bytes."""
        n, pairs = len(words), self.pairs
        text = (SPACE + SPACE.join(w.replace(" ", SPACE) for w in words)).encode("utf-32-le")
        start = np.cumsum(size) - size
        row = np.repeat(np.arange(n), size)
        symbol = np.full((n, width + 1), -1, np.int32)  # a last column that nothing is merged with
        symbol[row, np.arange(len(row)) - start[row]] = self.first[np.frombuffer(text, np.uint32)]
        odd = (symbol == -2).any(axis=1)
        after = np.tile(np.arange(1, width + 2, dtype=np.int32), (n, 1))
        before = after - 2
        found = pairs.find(symbol[:, :-1], symbol[:, 1:])
        rank, made = pairs.rank[found], pairs.made[found]
        rank[(symbol[:, 1:] < 0) | (symbol[:, :-1] < 0)] = 0
        on = np.arange(n)
        while True:
            i = rank[on].argmax(axis=1)
            some = rank[on, i] > 0
            on, i = on[some], i[some]
            if not len(on):
                break
            j = after[on, i]
            k = after[on, j]
            h = before[on, i]
            symbol[on, i], symbol[on, j] = made[on, i], -1
            after[on, i], before[on, k] = k, i
            rank[on, j] = 0
            inner = h >= 0
            for rows, left, right in ((on, i, k), (on[inner], h[inner], i[inner])):
                a, b = symbol[rows, left], symbol[rows, right]
                at = pairs.find(a, b)
                rank[rows, left], made[rows, left] = np.where((a >= 0) & (b >= 0), pairs.rank[at], 0), pairs.made[at]
        flat, ends = symbol[symbol >= 0].tolist(), np.cumsum((symbol >= 0).sum(axis=1)).tolist()
        return [None if o else tuple(flat[a:b]) for o, a, b in zip(odd.tolist(), [0, *ends], ends)]

    def agenda(self, s: str) -> list[str]:
        """The pieces of a stretch of text, marks for spaces: a heap of adjacent pairs, whose outdated entries are passed over."""
        symbols = list(s)
        score, heap, n = self.score, [], len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def offer(i: int, j: int) -> None:
            if (made := score.get(symbols[i] + symbols[j])) is not None:
                heapq.heappush(heap, (-made, i, j, len(symbols[i]) + len(symbols[j])))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, size = heapq.heappop(heap)
            if not symbols[i] or not symbols[j] or len(symbols[i]) + len(symbols[j]) != size:
                continue  # one of the pair has been merged since
            symbols[i], symbols[j] = symbols[i] + symbols[j], ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                offer(i, k)
            if before[i] >= 0:
                offer(before[i], i)
        return [p for p in symbols if p]

    def chunk(self, word: str) -> tuple[int, ...]:
        """Ids of a space and what follows it."""
        s = SPACE + word.replace(" ", SPACE)
        cuts = [0, *(i for i in range(1, len(s)) if s[i - 1 : i + 1] not in self.adjacent), len(s)]
        ids: list[int] = []
        for p in chain.from_iterable(self.agenda(s[a:b]) for a, b in pairwise(cuts)):
            if (i := self.id_of.get(p)) is not None:
                ids.append(i)
            else:
                ids += [self.byte_id[b] for b in p.encode()]
        return tuple(ids)

    def encode(self, text: str) -> list[int]:
        """Ids of a text, which a space is put before; an empty text has none."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str], check: bool = False) -> list[list[int]]:
        """Ids of each text. With ``check`` chunks new to the table are held against the library, in one call."""
        cut = [[_words(p) for p in segments(t.replace(SPACE, " "))] if t else [] for t in texts]
        known = self.known
        if len(known) > self.limit:
            known.clear()
        new = list({w for parts in cut for words in parts for w in words}.difference(known))
        known.update(zip(new, self.chunks(new)))
        if check:
            self.check(new)
        out = [list(chain.from_iterable(map(known.__getitem__, chain.from_iterable(parts)))) for parts in cut]
        for w in new:
            if len(w) > self._KEPT:
                del known[w]
        return out

    def check(self, words: list[str]) -> None:
        """Hold the table's entries of these chunks against the library; a difference is an error."""
        words = [w for w in words if w]  # no text makes the library encode a lone space
        for w, ids in zip(words, self.library.encode(words, num_threads=1)):
            if self.known[w] != tuple(ids):
                raise Mismatch(f"ids of {w[:80]!r} differ from the library's")

    def decode(self, ids: list[int]) -> str:
        """The text of any ids, as the library's decoder gives it: without the first space, control ids left out."""
        parts, run = [], []
        if not self.odd.isdisjoint(ids):
            for i in ids:
                if i in self.odd:  # also ends a run of bytes
                    parts.append(self._text(run, not any(parts)))
                    parts.append(" ⁇ " if i in self.unknown else "")
                    run = []
                else:
                    run.append(i)
            ids = run
        parts.append(self._text(ids, not any(parts)))
        return "".join(parts)

    def _text(self, ids: list[int], first: bool) -> str:
        data = b"".join(map(self.bytes_of.__getitem__, ids))
        lead = first and data[:1] == b" " and ids[0] in self.marked
        return data[lead:].decode("utf-8", "each_byte")


_LOADED: dict[str, PieceTokenizer] = {}


def tokenizer(path: str) -> PieceTokenizer:
    """One tokenizer for each Python worker."""
    if path not in _LOADED:
        _LOADED[path] = PieceTokenizer(vocabulary(path))
    return _LOADED[path]


def piece_ids(text: Column, model: str) -> Column:
    """A text's ids as an array; null for null."""

    @F.arrow_udf("array<int>")
    def run(texts: pa.Array) -> pa.Array:
        tok = tokenizer(model)
        return pa.array([tok.encode(t.as_py()) if t.is_valid else None for t in texts], pa.list_(pa.int32()))

    return run(text)


def piece_text(ids: Column, model: str) -> Column:
    """The text of an array of ids; null for null."""

    @F.arrow_udf("string")
    def run(lists: pa.Array) -> pa.Array:
        tok = tokenizer(model)
        return pa.array([tok.decode(x.as_py()) if x.is_valid else None for x in lists], pa.string())

    return run(ids)


def by_size(rows: Iterable[tuple], most: int) -> Iterator[list[tuple]]:
    """Rows in lists whose texts, their last fields, have about ``most`` characters together."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[-1])
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def digests(docs: DataFrame, model: str, check: bool = True, batch_chars: int = 1 << 20) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row of ``docs``: whole texts encoded, and their ids decoded.

    Texts are encoded in parts of an Arrow batch of about ``batch_chars`` characters. With ``check`` every chunk that a part
    brings, before its ids are used, is encoded by the library too, and every text's ids are decoded by it; a difference is an
    error. As no piece crosses chunks, that covers every id given out. A null or empty text has no ids: the hashes are those of the
    empty string. Very long texts are read whole, a chunk at a time; ties and repeated rows come out as often as they are there, each by
    its own text. Null ids stay null, other columns are ignored, and an empty table gives an empty result.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(model)
        name = [str(i) for i in range(len(tok.bytes_of))]
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for b in batches:
            found: list[tuple[int, str, str]] = []
            for part in by_size(((t.as_py() or "",) for t in b.column(1)), batch_chars):
                ids = tok.encode_all([t for (t,) in part], check)
                texts = list(map(tok.decode, ids))
                if check and texts != tok.library.decode(ids, num_threads=1):
                    raise Mismatch("a decoded text differs from the library's")
                found += [(len(i), sha(",".join(map(name.__getitem__, i))), sha(t)) for i, t in zip(ids, texts)]
            cols = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        tok.known.clear()  # an idle worker, which later stages share, holds none

    schema = docs.select("doc_id").schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    return docs.select("doc_id", "text").mapInArrow(run, schema)
