"""Edit-aware token counts: a segment tree of pre-token segments for each document."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.words import vocabulary
from lectern.runtime import ship

#: Characters after which the next safe cut ends a segment.
SEGMENT = 256
#: A cut between a letter and a space before a letter always falls between pre-tokens, whatever stands around.
#: Three letters before it: an apostrophe's contraction is then over.
_CUT = re.compile(r"(?<=[^\W\d_][^\W\d_][^\W\d_])(?= [^\W\d_])")
#: Characters around a cut on which it rests.
_BEFORE, _AFTER = 3, 2

_LOADED: dict[str, object] = {}


def encoder(path: str):
    """One encoder of a ``.tiktoken`` file for each Python worker."""
    if path not in _LOADED:
        import public_tokenizers
        import tiktoken

        with open(vocabulary(path), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _LOADED[path] = tiktoken.Encoding("byte-bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[path]


def segments(text: str, least: int = SEGMENT) -> list[str]:
    """Cut a text at the first safe cut after every ``least`` characters."""
    out, lo = [], 0
    while m := _CUT.search(text, lo + least):
        out.append(text[lo : m.start()])
        lo = m.start()
    if lo < len(text) or not out:
        out.append(text[lo:])
    return out


@dataclass
class Tree:
    """A complete binary tree over a document's segments: characters and tokens of each node; leaves hold the text."""

    leaves: list[str]
    chars: list[int]
    tokens: list[int]
    width: int
    encoded: int = 0

    @classmethod
    def build(cls, text: str, count) -> Tree:
        leaves = segments(text)
        return cls._over(leaves, [count(s) for s in leaves])

    @classmethod
    def kept(cls, text: str, chars: list[int], tokens: list[int]) -> Tree:
        """A tree from its leaves' measures, without encoding anything."""
        leaves, at = [], 0
        for n in chars:
            leaves.append(text[at : at + n])
            at += n
        if at != len(text):
            raise ValueError("the tree is not of this text")
        return cls._over(leaves, tokens)

    @classmethod
    def _over(cls, leaves: list[str], counts: list[int]) -> Tree:
        width = 1
        while width < len(leaves):
            width *= 2
        pad = [0] * (width - len(leaves))
        chars = [0] * width + [len(s) for s in leaves] + pad
        tokens = [0] * width + counts + pad
        for i in range(width - 1, 0, -1):
            chars[i] = chars[2 * i] + chars[2 * i + 1]
            tokens[i] = tokens[2 * i] + tokens[2 * i + 1]
        return cls(leaves, chars, tokens, width)

    @property
    def total(self) -> int:
        return self.tokens[1]

    def find(self, at: int) -> tuple[int, int]:
        """The leaf that holds character ``at`` and the characters before it; past the end: the last leaf with text."""
        if not self.chars[1]:
            return 0, 0
        at = max(0, min(at, self.chars[1] - 1))
        i, before = 1, 0
        while i < self.width:
            i *= 2
            if at - before >= self.chars[i]:
                before += self.chars[i]
                i += 1
        return i - self.width, before

    def _set(self, leaf: int, text: str, n: int) -> None:
        self.leaves[leaf] = text
        i = leaf + self.width
        self.chars[i], self.tokens[i] = len(text), n
        while i > 1:
            i //= 2
            self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
            self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def replace(self, start: int, end: int, text: str, count) -> None:
        """Replace characters start to end. Segments that the edit or a cut's context touches are encoded anew."""
        size = self.chars[1]
        start, end = max(0, min(start, size)), max(0, min(end, size))
        end = max(start, end)
        # a cut rests on the characters beside it: an edit there takes the segment on its other side along
        a, at = self.find(start - _AFTER)
        b, b_at = self.find(end + _BEFORE - 1 if end < size else size - 1)
        stop = b_at + len(self.leaves[b])
        held = "".join(self.leaves[a : b + 1])
        new = held[: start - at] + text + held[end - at : stop - at]
        parts = segments(new) if new else [""]
        self.encoded += len(new)
        if len(parts) <= b - a + 1 or (len(parts) == 1):
            parts += [""] * (b - a + 1 - len(parts))
            for i, s in enumerate(parts):
                self._set(a + i, s, count(s) if s else 0)
            return
        # more segments than places: the tree is laid out anew, the others' counts are kept
        counts = self.tokens[self.width : self.width + len(self.leaves)]
        done = self.encoded
        again = Tree._over([*self.leaves[:a], *parts, *self.leaves[b + 1 :]], [*counts[:a], *[count(s) for s in parts], *counts[b + 1 :]])
        self.leaves, self.chars, self.tokens, self.width, self.encoded = again.leaves, again.chars, again.tokens, again.width, done

    def text(self) -> str:
        return "".join(self.leaves)


TREE = "leaf_chars array<int>, leaf_tokens array<int>"


def _leaves(tree: Tree) -> tuple[list[int], list[int]]:
    at = slice(tree.width, tree.width + len(tree.leaves))
    return tree.chars[at], tree.tokens[at]


def build_trees(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``doc_id, text, n_tokens, leaf_chars, leaf_tokens``: the documents with their trees, to be kept in a table.

    Only leaves are kept; sums above them take one pass to restore. A null text has one empty leaf.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        for b in batches:
            trees = [Tree.build(t.as_py() or "", lambda s: len(enc.encode_ordinary(s))) for t in b.column(1)]
            yield _kept_batch(b.column(0), b.column(1), trees)

    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, f"doc_id long, text string, n_tokens long, {TREE}")


def _kept_batch(ids: pa.Array, texts: pa.Array, trees: list[Tree]) -> pa.RecordBatch:
    leaves = [_leaves(t) for t in trees]
    lists = [pa.array([x[i] for x in leaves], pa.list_(pa.int32())) for i in (0, 1)]
    counts = pa.array([t.total for t in trees], pa.int64())
    return pa.RecordBatch.from_arrays([ids, texts, counts, *lists], names=["doc_id", "text", "n_tokens", "leaf_chars", "leaf_tokens"])


def apply_edits(kept: DataFrame, edits: Column, tokenizer_path: str) -> DataFrame:
    """The table of ``build_trees`` after each row's edits: new texts, counts and trees; only touched segments are encoded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        count = lambda s: len(enc.encode_ordinary(s))
        for b in batches:
            trees, texts = [], []
            for text, chars, tokens, todo in zip(*(c.to_pylist() for c in b.columns[1:])):
                tree = Tree.kept(text or "", chars, tokens)
                changed = _edit(tree, todo, count)
                trees.append(tree)
                texts.append(tree.text() if changed else text)
            yield _kept_batch(b.column(0), pa.array(texts, pa.string()), trees)

    ship(kept.sparkSession)
    rows = kept.select("doc_id", "text", "leaf_chars", "leaf_tokens", edits.alias("edits"))
    return rows.mapInArrow(run, f"doc_id long, text string, n_tokens long, {TREE}")


def _edit(tree: Tree, todo: list[dict] | None, count) -> bool:
    """Apply edits in order; an edit without a place is skipped. Whether there were any."""
    placed = [e for e in todo or [] if e["start"] is not None and e["stop"] is not None]
    for e in placed:
        tree.replace(e["start"], e["stop"], e["text"] or "", count)
    return bool(placed)


def count_edited(docs: DataFrame, edits: Column, tokenizer_path: str) -> DataFrame:
    """Token counts of every whole text before and after its edits, the latter from the updated tree.

    ``edits`` is an array of (start, stop, replacement) in code points, applied in order, each to the text that the
    one before left; places outside a text are moved to its ends, an edit without a place is
    skipped, and a null replacement is empty. Returns ``doc_id,
    n_chars, n_tokens, n_segments, edited_chars, edited_tokens, encoded_chars``; the last is what was encoded anew.

    A null text counts as empty: no tokens, one empty segment; null edits are none. Texts of any length keep one tree
    in memory at a time. Rows stand alone: repeated rows and ids agree; other columns are ignored; an empty table
    gives an empty result. Special tokens' strings are ordinary text.
    """
    schema = "doc_id long, n_chars long, n_tokens long, n_segments long, edited_chars long, edited_tokens long, encoded_chars long"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        count = lambda s: len(enc.encode_ordinary(s))
        for b in batches:
            out = []
            for doc, text, todo in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                tree = Tree.build(text.as_py() or "", count)
                row = [doc, tree.chars[1], tree.total, len(tree.leaves)]
                _edit(tree, todo.as_py(), count)
                out.append([*row, tree.chars[1], tree.total, tree.encoded])
            cols = list(zip(*out)) if out else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=names)

    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text", edits.alias("edits")).mapInArrow(run, schema)


def sample_edits(text: Column) -> Column:
    """Three edits that follow from the text: a replaced stretch in the middle, an insertion at a quarter, a deletion at the start."""
    n = F.length(text)
    half, quarter = F.floor(n / 2).cast("int"), F.floor(n / 4).cast("int")
    edit = lambda a, b, t: F.struct(a.alias("start"), b.alias("stop"), t.alias("text"))
    return F.array(
        edit(half, half + 40, F.substring(text, 1, 60)),
        edit(quarter, quarter, F.lit(" it's 2 new words ")),
        edit(F.lit(0), F.lit(7), F.lit("")),
    )
