import random

import pytest
from pyspark.sql import functions as F

from lectern.llm.queries import BYTE_BPE, tokenizer_path
from lectern.llm.tokencounts import Tree, apply_edits, build_trees, count_edited, encoder, sample_edits, segments

ALPHABET = ["word", " ", "  ", "\n", "'", "'ll", "don't", "42", "é", "漢", "🙂", "!", " the", "abc def", "I'", "l", "re", "\t", "\x00", "e\u0301"]


@pytest.fixture(scope="module")
def count():
    enc = encoder(tokenizer_path(BYTE_BPE))
    return lambda s: len(enc.encode_ordinary(s))


@pytest.mark.parametrize("seed", range(8))
def test_random_edits_equal_a_full_count(count, seed):
    rng = random.Random(seed)
    make = lambda n: "".join(rng.choice(ALPHABET) for _ in range(n))
    text = make(rng.choice([0, 1, 30, 2000])) + " some plain words follow here" * rng.choice([0, 60])
    tree = Tree.build(text, count)
    assert tree.total == count(text) and "".join(segments(text)) == text
    for _ in range(150):
        a = rng.randint(0, len(text) + 3)
        b = min(a + rng.choice([0, 1, 2, 5, 40, 700]), len(text) + 5)
        new = make(rng.choice([0, 1, 2, 8, 300]))
        tree.replace(a, b, new, count)
        text = text[:a] + new + text[b:]
        assert tree.text() == text and tree.chars[1] == len(text)
        assert tree.total == count(text)


def test_few_characters_are_encoded_anew(count):
    text = " plain words follow here" * 4000
    tree = Tree.build(text, count)
    for i in range(10):
        tree.replace(1000 * i, 1000 * i + 3, "edit", count)
    assert tree.encoded < 10 * 1200 and tree.total == count(tree.text())


def test_odd_rows(odd_docs, no_docs, count):
    got = count_edited(odd_docs, sample_edits(F.col("text")), tokenizer_path(BYTE_BPE)).collect()
    assert len(got) == odd_docs.count()
    texts = {r.doc_id: r.text or "" for r in odd_docs.collect()}
    for r in got:
        if r.doc_id is not None:
            assert (r.n_chars, r.n_tokens) == (len(texts[r.doc_id]), count(texts[r.doc_id]))
    assert {(r.n_tokens, r.edited_tokens, r.n_segments) for r in got if r.doc_id == 2} == {(0, 0, 1)}
    assert count_edited(no_docs, sample_edits(F.col("text")), tokenizer_path(BYTE_BPE)).count() == 0
    none = count_edited(odd_docs, F.lit(None).cast("array<struct<start:int,stop:int,text:string>>"), tokenizer_path(BYTE_BPE))
    assert none.where("n_tokens <> edited_tokens OR encoded_chars <> 0").count() == 0


def test_kept_trees(odd_docs, count):
    path = tokenizer_path(BYTE_BPE)
    kept = build_trees(odd_docs, path)
    assert {(r.doc_id, r.text) for r in kept.collect()} == {(r.doc_id, r.text) for r in odd_docs.collect()}
    twice = apply_edits(apply_edits(kept, sample_edits(F.col("text")), path), sample_edits(F.col("text")), path)
    for r in twice.collect():
        assert r.n_tokens == sum(r.leaf_tokens) == count(r.text or "") and sum(r.leaf_chars) == len(r.text or "")
    with pytest.raises(ValueError):
        Tree.kept("abc", [2], [1])
