from fractions import Fraction

import numpy as np
import pytest

import corpus_pipeline
from lectern.llm import nearcopies


def shingles(text, width=5):
    w = text.lower().split()
    return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))}


def similarity(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


def texts():
    """Groups of edited copies: similarities from 0.6 to 1, exact fifths among them, and chains of copies of copies."""
    rng = np.random.default_rng(3)
    out = ["a b c d e f g h", "a b c d e f g h i", "a b c d e f g h i j", "A  b c d\te f g h"]
    for group in range(25):
        words = [f"w{rng.integers(9999)}" for _ in range(int(rng.integers(20, 200)))]
        out.append(" ".join(words))
        for _ in range(6):
            for at in rng.choice(len(words), max(1, len(words) // int(rng.integers(40, 120))), replace=False):
                words[at] = f"x{rng.integers(9999)}"
            out.append(" ".join(words))
    return out


@pytest.mark.parametrize("limit", [512, 8])
def test_stage_keeps_one_of_each_group_of_similar_texts(spark, monkeypatch, limit):
    monkeypatch.setattr(nearcopies, "BAND_LIMIT", limit)
    every = texts()
    parent = list(range(len(every)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(every)):
        for j in range(i):
            if similarity(every[i], every[j]) >= 0.8:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    want = sorted({find(i) for i in range(len(every))})
    assert 30 < len(want) < len(every) - 50
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(every)], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()) == want


def test_links_found_within_bands_join_roots(spark, monkeypatch):
    """Chains of windows that slide over long texts: ends share nothing, so hubs alone leave a chain in pieces."""
    rng = np.random.default_rng(6)
    docs = []
    for chain in range(12):
        words = [f"c{chain}x{rng.integers(9999)}" for _ in range(400)]
        docs += [(len(docs) + k, " ".join(words[9 * k : 9 * k + 110])) for k in range(30)]
    assert similarity(docs[0][1], docs[1][1]) >= 0.8 > similarity(docs[0][1], docs[2][1])
    calls, own = [], nearcopies.connected_components
    monkeypatch.setattr(nearcopies, "connected_components", lambda e: calls.append(e.count()) or own(e))
    got = nearcopies.near_copies(spark.createDataFrame(docs, "doc_id long, text string")).toPandas()
    assert len(calls) == 2 and calls[1] > 0, "the second search found links"
    assert len(got) == len(docs) and got["__root"].nunique() == 12
    assert (got.groupby(got.doc_id // 30)["__root"].nunique() == 1).all()


def test_odd_rows(odd_docs, no_docs):
    kept = nearcopies.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids, key=lambda x: (x is None, x or 0)) == [0, 2, 5, 6, 7, 8, 9, None]
    assert nearcopies.keep_one(no_docs).count() == 0


def test_shared_and_forest():
    """Intersections are the same pair by pair and as matrix products; a forest joins what the pairs join."""
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.integers(0, 400, int(rng.integers(1, 200)))) for _ in range(60)]
    i, j = np.triu_indices(60, 1)
    want = [len(set(sets[a]) & set(sets[b])) for a, b in zip(i, j)]
    assert len(i) > 256 and nearcopies._shared(sets, i, j).tolist() == want
    assert nearcopies._shared(sets, i[:100], j[:100]).tolist() == want[:100]
    kept = list(nearcopies._forest(np.arange(60), i, j))
    assert len(kept) == 59


def test_bound_keeps_similar_pairs():
    rng = np.random.default_rng(4)
    sets, low = [], []
    base = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    for _ in range(60):  # each shares 8 of 9 parts or more with the first
        own = base.copy()
        own[rng.choice(300, 33, replace=False)] = rng.integers(0, 1 << 63, 33).astype(np.uint64)
        sets.append(np.unique(own))
        low.append(np.array(nearcopies.band_keys(sets[-1])[1], np.int64).view(np.uint64))
    first = [k for k, s in enumerate(sets) if len(np.intersect1d(base, s)) / len(np.union1d(base, s)) >= 0.8]
    low = np.array([np.array(nearcopies.band_keys(np.unique(base))[1], np.int64).view(np.uint64), *low])
    i, j = nearcopies._may_be_similar(np.array([300] * 61), np.arange(61), low, Fraction("0.8"))
    assert {k + 1 for k in first} <= set(j[i == 0].tolist()) and len(first) > 40


def test_pairs_at_the_bound(spark):
    """A similarity of exactly 0.8 links, one shingle less does not: 404 or 403 of 504 words are 400 or 399 of 500 shingles."""
    rows = []
    for i in range(30):
        text = [f"w{i}x{j}" for j in range(504)]
        rows += [(3 * i, " ".join(text)), (3 * i + 1, " ".join(text[: 404 if i % 2 else 403]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in nearcopies.keep_one(docs).collect()) == sorted([3 * i for i in range(30)] + [3 * i + 1 for i in range(30) if i % 2 == 0])
