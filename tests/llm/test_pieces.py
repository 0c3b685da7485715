import hashlib
import random

import pytest
from pyspark.sql import functions as F

from lectern.llm import pieces
from lectern.llm.queries import PIECE_BPE, tokenizer_path
from tests.llm.conftest import TEXTS

sentencepiece = pytest.importorskip("sentencepiece")
PARTS = ["a", "b", " ", "  ", "\n", "x" * 70, "é", "漢字", "🙂", "▁", "\x00", "\r", "<s>", "<0x41>", "<unk>", "​", "\t", "1234", " the", "ing",
         "é", "</s>", "{\r", "▁▁", "undgeschtzlich", ".\nHe"]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


@pytest.fixture(scope="module")
def tok():
    return pieces.PieceTokenizer(tokenizer_path(PIECE_BPE))


def odd_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12))) for _ in range(n)]


def test_ids_equal_the_librarys(tok):
    texts = odd_texts(4000) + [t or "" for t in TEXTS] + ["x" * 50_000, " " * 30_000, "漢字仮名" * 5000, "ab " * 500_000]
    for t, mine in zip(texts, tok.encode_all(texts)):
        assert mine == tok.library.encode(t), repr(t[:80])


def test_array_and_heap_agendas_agree(tok):
    words = [w for t in odd_texts(2000, 2) for w in t.replace("▁", " ").split(" ")]
    assert tok.chunks(words) == [tok.chunk(w) for w in words]


def test_any_ids_decode_as_by_the_library(tok):
    rng = random.Random(3)
    for _ in range(5000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(260), rng.randrange(3), 259, 29871]) for _ in range(rng.randint(0, 8))]
        assert tok.decode(ids) == tok.library.decode(ids), ids


def test_the_table_is_bounded_and_a_wrong_entry_is_an_error(tok):
    small = pieces.PieceTokenizer(tokenizer_path(PIECE_BPE), limit=50)
    for t in odd_texts(200, 4):
        assert small.encode(t) == tok.library.encode(t)
    small.known["wrong"] = (1,)
    with pytest.raises(pieces.Mismatch):
        small.check(["wrong"])


def test_segments_lose_nothing():
    text = "ab cd, ef gh " * 1000
    assert " ".join(pieces.segments(text, 100)) == text and len(list(pieces.segments(text, 100))) > 50
    assert list(pieces.segments("x" * 500, 100)) == ["x" * 500]


def test_rows_against_the_library(spark, odd_docs, no_docs, tok):
    rows = pieces.digests(odd_docs, PIECE_BPE, batch_chars=100)
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = []
    for r in odd_docs.select("doc_id", "text").collect():
        ids = tok.library.encode(r.text or "")
        want.append((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(tok.library.decode(ids))))
    assert sorted(map(tuple, rows.collect()), key=str) == sorted(want, key=str)
    assert pieces.digests(no_docs, PIECE_BPE).count() == 0


def test_columns_of_ids_and_texts(spark, odd_docs, tok):
    both = odd_docs.select("text", pieces.piece_ids(F.col("text"), PIECE_BPE).alias("ids")).withColumn("back", pieces.piece_text(F.col("ids"), PIECE_BPE))
    for r in both.collect():
        assert (r.ids, r.back) == ((None, None) if r.text is None else (tok.library.encode(r.text), tok.library.decode(r.ids)))
