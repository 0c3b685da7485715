import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from lectern.llm import alignment
from lectern.llm.queries import BYTE_BPE, PIECE_BPE, tokenizer_path
from tests.llm.test_pieces import odd_texts

sentencepiece = pytest.importorskip("sentencepiece")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def byte_of():
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def brute_force(docs):
    """Every document's row by the library tokenizers, one pair of tokens after the other."""
    a = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECE_BPE))
    letters = byte_of()
    a_bytes = {i: bytes(letters[c] for c in s) for s, i in a.get_vocab().items() if i != 50256}
    b_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in range(len(b))]
    found, counts = [], Counter()
    for doc, text in docs:
        x, y = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        data = (" " + text).encode() if text else b""
        if not text or b"".join(a_bytes[i] for i in x) != data or b"".join(b_bytes[i] for i in y) != data:
            found.append((doc, 0, 0, [], ""))
            continue
        ends = [dict(zip(np.cumsum([len(of[i]) for i in ids]).tolist(), range(len(ids)))) for ids, of in ((x, a_bytes), (y, b_bytes))]
        links, groups, p, q = [], [], 0, 0
        for end in sorted(ends[0].keys() & ends[1].keys()):
            i, j = ends[0][end], ends[1][end]
            links.append((x[i], y[j]))
            groups.append(",".join(map(str, x[p : i + 1])) + "|" + ",".join(map(str, y[q : j + 1])))
            p, q = i + 1, j + 1
        counts.update(links)
        found.append((doc, len(x), len(y), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = defaultdict(int)
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    return sorted(((d, n, m, len(k), len(k), sum(counts[p] == best[p[1]] for p in k), sum(counts[p] for p in k), g) for d, n, m, k, g in found), key=str)


def rows(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=str)


def test_odd_rows(spark, odd_docs, no_docs):
    docs = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    assert rows(alignment.align(odd_docs, BYTE_BPE, PIECE_BPE)) == brute_force(docs)
    assert rows(alignment.align(no_docs, BYTE_BPE, PIECE_BPE)) == []


@pytest.mark.parametrize("buckets, per", [(1, 1), (5, 2), (64, 256)])
def test_split_buckets_give_the_same(spark, buckets, per):
    """Small batches, hot ids, many groups a bucket."""
    docs = [(i, t) for i, t in enumerate(odd_texts(300, 7))] + [(1000 + i, "the cat <|endoftext|> the dog") for i in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    assert rows(alignment.align(df, BYTE_BPE, PIECE_BPE, buckets, per)) == brute_force(docs)


def test_segments_align_as_the_whole(monkeypatch):
    texts = ["The undgeschtzlich of de la Onhaedin is here, 12 times. " * 40, "x y z " * 100]
    one = alignment.Aligner(BYTE_BPE, PIECE_BPE)
    whole = [one.align(t) for t in texts]
    monkeypatch.setattr(alignment, "segments", lambda t: alignment_segments(t, 50))
    for a, b in zip(whole, map(one.align, texts)):
        assert (a[0], a[1], a[2].tolist(), a[3]) == (b[0], b[1], b[2].tolist(), b[3])


def alignment_segments(text, size):
    from lectern.llm.pieces import segments

    return segments(text, size)


def test_postings_pack_and_unpack():
    rng = random.Random(5)
    rows = sorted({(rng.randrange(20) << 32 | rng.randrange(9), rng.randrange(50)) for _ in range(300)})
    pair, doc = (np.array(x, np.int64) for x in zip(*rows))
    times = np.arange(1, len(rows) + 1)
    key, n, got_doc, got_times = alignment.unpack_postings(alignment.pack_postings(pair, doc, times))
    assert np.repeat(key, n).tolist() == pair.tolist() and got_doc.tolist() == doc.tolist() and got_times.tolist() == times.tolist()
