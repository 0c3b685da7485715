import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm.mixing import copies, mix, pivot, pivot_rest, source_targets


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_ = {}, set(names)
    left = sum(sizes.values())
    while open_:
        total = sum(w[s] for s in open_)
        over = [s for s in open_ if left * w[s] / total > most * sizes[s]]
        if not over:
            target |= {s: left * w[s] / total for s in open_}
            break
        for s in over:
            target[s] = most * sizes[s]
        open_ -= set(over)
        left = sum(sizes.values()) - sum(target.values())
    return target


@pytest.mark.parametrize("sizes", [{"a": 1000, "b": 10, "c": 500, None: 90}, {"x": 5}, {"a": 1, "b": 1, "c": 1, "d": 10_000}, {"a": 0, "b": 0}])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in source_targets(df).collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys()
    assert all(got[s] == pytest.approx(want[s]) for s in want)


def test_pivots_keep_sum_and_means():
    rng = np.random.default_rng(0)
    size = np.sort(rng.integers(1, 300, 40).astype(float))[::-1]
    for f, p in ((pivot, np.full(40, 0.3)), (pivot, rng.random(40)), (pivot_rest, 0.3)):
        mean = np.zeros(40)
        for seed in range(3000):
            out, held = f(size, p, np.random.default_rng(seed))
            whole = np.delete(out, [held]) if held is not None else out
            assert set(whole) <= {0.0, 1.0}
            assert (out * size).sum() == pytest.approx((size * p).sum(), rel=1e-6)
            mean += out / 3000
        assert np.abs(mean - p).max() < 0.06


def test_sources_come_near_targets(spark):
    rng = np.random.default_rng(2)
    rows = [(i, "w " * int(rng.integers(1, 200)), "hot" if i % 3 else f"s{i % 5}") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = copies(docs, cell=50).toPandas()
    assert len(got) == 4000 and (got.taken <= 3 * got["size"]).all() and (got.taken == got.copies * got["size"]).all()
    for _, g in got.groupby("source"):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= g["size"].max() / 2 + 1e-6
    again = copies(docs.repartition(7), cell=50).toPandas()
    assert got.sort_values("doc_id").taken.tolist() == again.sort_values("doc_id").taken.tolist()


def test_odd_rows(odd_docs, no_docs):
    got = copies(odd_docs).toPandas()
    assert len(got) == odd_docs.count()
    assert got[got["size"] == 0].taken.sum() == 0 and got.source.isna().any()
    assert copies(no_docs).count() == 0 and mix(no_docs).count() == 0
    mixed = mix(odd_docs)
    assert mixed.columns == odd_docs.columns
    assert mixed.count() == got.copies.sum()
    first = mixed.where(F.col("doc_id") == 0).count()
    assert first == got[got.doc_id == 0].copies.sum()
