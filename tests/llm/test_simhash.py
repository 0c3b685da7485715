import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lectern.llm import simhash
from lectern.llm.graph import connected_components


def brute(text):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def components(fps, radius=3):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def test_fingerprint_matches_brute_force(odd_docs):
    for r in odd_docs.select("text").distinct().collect():
        if r.text is None or len(r.text) < 1000:
            assert simhash.fingerprint(r.text) == brute(r.text)
    assert simhash.fingerprint("word " * 3) == simhash.fingerprint("WORD " * 3)


def test_odd_rows(spark, odd_docs, no_docs):
    got = simhash.near_duplicates(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[1].component_id == by[0].component_id == 0
    assert {by[i].fingerprint for i in (2, 3, 4)} == {"0" * 16} and by[4].component_id == 2
    assert [r.component_id for r in got if r.doc_id is None and r.fingerprint == "0" * 16] == [2]
    assert simhash.near_duplicates(no_docs).count() == 0
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted(ids, key=lambda x: (x is None, x or 0)) == [0, 2, 5, 6, 7, 8, 9, None]
    assert simhash.keep_one(no_docs).count() == 0


@pytest.mark.parametrize("limit", [4096, 8])
def test_links_match_brute_force(spark, limit):
    rng = np.random.default_rng(5)
    fps = [0, 1, (1 << 64) - 1]
    for _ in range(40):
        base = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(2))
        fps.append(base)
        for _ in range(int(rng.integers(0, 12))):
            x = base
            for b in rng.choice(64, int(rng.integers(1, 6)), replace=False):
                x ^= 1 << int(b)
            fps.append(x)
    fps = sorted(set(fps))
    df = spark.createDataFrame([(simhash._signed(x),) for x in fps], "__fp long")
    roots = {r.node: r.root for r in connected_components(simhash.links(df, 3, limit)).collect()}
    got = [roots.get(simhash._signed(x), simhash._signed(x)) for x in fps]
    want = components(fps)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_embedding_bounds_hamming(spark):
    rng = np.random.default_rng(1)
    f, g = rng.integers(0, 1 << 63, 500).astype(np.uint64), rng.integers(0, 1 << 63, 500).astype(np.uint64)
    for a, b in zip(f, g):
        near = simhash._near(a, np.array([b]), 64)[0]
        assert near
    row = spark.range(1).select(simhash.embedding(F.lit(0b11_10_01_00)).alias("e")).first()
    assert row.e == 0b10_01_01_00


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(500, 501), (7, 7)], "u long, v long")
    roots = {r.node: r.root for r in connected_components(edges).collect()}
    assert all(roots[i] == 0 for i in range(101)) and roots[501] == 500 and len(roots) == 103
